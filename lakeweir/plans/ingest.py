"""Full and incremental ingestion of a paginated source into run folders.

Pages come from a paged endpoint (:func:`fetch_pages`) or any relation of page bodies
(:func:`ingest_pages`). Each body is parsed once, into written (page, key, record) rows from
which the load is judged and landed.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeweir.errors import MissingKey, PageBoundReached, PageFetchError
from lakeweir.functions.runs import new_run_name
from lakeweir.operators.increment import before_stop, newer_than, stop_page
from lakeweir.schemas import WATERMARK
from lakeweir.sources import storage
from lakeweir.sources.paged_json import read_all_pages, record_texts, text_field
from lakeweir.sources.scratch import new_area, staged

# Page sizes and sort directions of the two load modes.
FULL, INCREMENTAL = "full", "incremental"
PER_PAGE = {FULL: 200, INCREMENTAL: 50}
DIRECTION = {FULL: "asc", INCREMENTAL: "desc"}
PARSED = "page BIGINT, n_items BIGINT, record STRING, key STRING"


@dataclass(frozen=True)
class LoadPlan:
    mode: str
    watermark: str | None
    per_page: int
    direction: str


@dataclass(frozen=True)
class Ingested:
    run: str
    mode: str
    rows: int
    watermark: str | None


@dataclass(frozen=True)
class PagedSource:
    """``url`` may hold ``{page}``, ``{per_page}`` and ``{sort}``, which becomes the key and
    a direction, as in ``id:asc``. ``readers`` tasks share the pages. A load that needs more
    than ``max_pages`` pages fails; by default there is no bound."""

    url: str
    key: str = "id"
    max_pages: int | None = None
    readers: int = 8
    options: dict = field(default_factory=dict)


# -- high-water mark -------------------------------------------------------------------


def load_watermark(spark: SparkSession, state: str) -> str | None:
    """The mark saved last; None when nothing was saved. A damaged state raises."""
    if not storage.exists(spark, state):
        return None
    marks = (
        spark.read.schema(WATERMARK)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(state)
    )
    latest = marks.agg(F.max_by("max_id", F.coalesce("timestamp", F.lit(""))).alias("max_id"))
    return latest.first()["max_id"]


def save_watermark(spark: SparkSession, state: str, max_id: str | None) -> None:
    """Append the mark: the commit is atomic, so a crash never loses the one before."""
    moment = datetime.now(UTC).isoformat()
    row = spark.createDataFrame([(max_id, moment)], WATERMARK)
    row.coalesce(1).write.mode("append").json(state)


def plan_load(watermark: str | None) -> LoadPlan:
    """Incremental above a mark; full without one (absent, null or empty)."""
    mode = INCREMENTAL if watermark else FULL
    return LoadPlan(mode, watermark or None, PER_PAGE[mode], DIRECTION[mode])


# -- pages -----------------------------------------------------------------------------


def parsed_pages(pages: DataFrame, key: str) -> DataFrame:
    """One row per record of (page, n_items, body) rows, with its key as text; a page without
    records keeps a row without one."""
    return pages.select("page", "n_items", F.explode_outer(record_texts()).alias("record")).select(
        F.col("page").cast("long").alias("page"),
        F.col("n_items").cast("long").alias("n_items"),
        "record",
        text_field(F.col("record"), key).alias("key"),
    )


def _stop(parsed: DataFrame, plan: LoadPlan) -> DataFrame:
    """The first page that brings nothing new."""
    new = F.col("record").isNotNull() if plan.mode == FULL else F.col("key") > plan.watermark
    counts = parsed.groupBy("page").agg(F.count(F.when(new, 1)).alias("n_new"))
    return stop_page(counts, F.col("n_new"))


def _missing_page(parsed: DataFrame) -> DataFrame:
    """The first page from 1 on that is not there."""
    pages = parsed.select("page").distinct()
    following = pages.select((F.col("page") + 1).alias("page"))
    starts = following.unionByName(parsed.sparkSession.createDataFrame([(1,)], "page long"))
    # a merge join at every size: pages grow with the source
    return starts.join(pages.hint("merge"), "page", "left_anti").agg(F.min("page").alias("stop"))


def fetch_pages(
    spark: SparkSession, source: PagedSource, plan: LoadPlan, area: str
) -> DataFrame:
    """Parsed pages before the stop page, written to ``area``.

    Tasks take turns at the pages and each ends where a page brings nothing new, so no page is
    fetched twice, and as many requests are made past the end as there are tasks. The mark of
    an incremental load is pushed into the reader.
    """
    url = source.url.replace("{sort}", f"{source.key}:{plan.direction}")
    options = {"key": source.key, "readers": source.readers, "per_page": plan.per_page}
    if source.max_pages is not None:
        options["max_page"] = source.max_pages
    pages = read_all_pages(spark, url, **options, **source.options)
    if plan.mode == INCREMENTAL:
        pages = newer_than(pages, "max_key", plan.watermark)
    try:
        parsed_pages(pages, source.key).write.mode("append").parquet(area)
    except Exception as error:
        if "PAGE_FETCH_FAILED" in str(error):
            raise PageFetchError(f"pages of {url}") from error
        raise
    parsed = spark.read.schema(PARSED).parquet(area)
    stop = _missing_page(parsed).first()["stop"]
    if source.max_pages is not None and stop > source.max_pages:
        raise PageBoundReached(f"{url} has new records beyond page {source.max_pages}")
    return parsed.where(F.col("page") < stop)


def land_raw(records: DataFrame, data_root: str, run: str) -> str:
    """Write one run folder as JSON lines; landing the same run again replaces it."""
    path = f"{data_root.rstrip('/')}/{run}"
    records.write.mode("overwrite").json(path)
    return path


def land_texts(texts: DataFrame, data_root: str, run: str) -> str:
    """Like :func:`land_raw` for records that are JSON texts already: nothing is dropped."""
    path = f"{data_root.rstrip('/')}/{run}"
    texts.write.mode("overwrite").text(path)
    return path


def ingest(
    spark: SparkSession, source: PagedSource, data_root: str, state: str, run: str | None = None
) -> Ingested:
    """Fetch what is new, land it as one run, then move the high-water mark."""
    plan = plan_load(load_watermark(spark, state))
    area = new_area(spark, "pages")
    try:
        return _land(fetch_pages(spark, source, plan, area), plan, data_root, state, run)
    finally:
        storage.remove(spark, area)


def ingest_pages(
    pages: DataFrame, key: str, data_root: str, state: str, run: str | None = None
) -> Ingested:
    """Like :func:`ingest` for a relation of (page, n_items, body), in the order of the mode:
    ascending keys for a full load, descending ones above a mark."""
    plan = plan_load(load_watermark(pages.sparkSession, state))
    with staged(parsed_pages(pages, key), "pages") as parsed:
        return _land(before_stop(parsed, _stop(parsed, plan)), plan, data_root, state, run)


def _land(
    parsed: DataFrame, plan: LoadPlan, data_root: str, state: str, run: str | None
) -> Ingested:
    """Land the new records of written pages in one pass, then move the mark.

    What the pass sees decides whether it counts: the records are written beside the runs and
    take their name at the end. A record without a key could never be told from a known one, so
    it stops the load, in either mode, before anything is landed.
    """
    spark = parsed.sparkSession
    run = run or new_run_name()
    pages, landed = Observation(), Observation()
    keyless = F.col("key").isNull() & (F.col("n_items") > 0)
    fresh = parsed.observe(pages, F.count_if(keyless).alias("keyless"))
    fresh = fresh.where(F.col("record").isNotNull())
    if plan.mode == INCREMENTAL:
        fresh = newer_than(fresh, "key", plan.watermark)
    fresh = fresh.observe(
        landed, F.count(F.lit(1)).alias("rows"), F.max("key").alias("max_id")
    )
    hidden = f"{data_root.rstrip('/')}_landing/{run}"
    try:
        fresh.select("record").write.mode("overwrite").text(hidden)
        if pages.get["keyless"]:
            raise MissingKey(f"{pages.get['keyless']} records without a key in run {run}")
        rows, mark = landed.get["rows"], landed.get["max_id"]
        mark = plan.watermark if mark is None else mark
        if rows:
            path = f"{data_root.rstrip('/')}/{run}"
            storage.remove(spark, path)
            storage.rename(spark, hidden, path)
    finally:
        storage.remove(spark, hidden)
    # a full load that finds nothing records that it ran; the next one is full again
    if rows or plan.mode == FULL:
        save_watermark(spark, state, mark)
    return Ingested(run, plan.mode, rows, mark)
