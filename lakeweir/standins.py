"""The operators at work on the generated test tables.

The tables have no site records, so keyed relations with place columns are derived from
them. Every query runs over its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.errors import SchemaCheckFailed
from lakeweir.functions.runs import run_name
from lakeweir.operators import quality
from lakeweir.operators.counts import count_by, rollup_count, rollup_shares
from lakeweir.operators.curate import conform, dedupe_latest, stamp
from lakeweir.operators.increment import (
    assign_pages,
    before_stop,
    new_watermark,
    newer_than,
    pages_until_known,
    stop_page,
)
from lakeweir.operators.upsert import merge_by_key
from lakeweir.plans import flow, ingest
from lakeweir.plans.tables import Table
from lakeweir.schemas import AUDIT, MART_AUDIT, MART_COUNT, MART_DIMENSIONS, raw_of, record
from lakeweir.sources.drift import drift, raw_texts
from lakeweir.sources.raw_json import read_raw_json, salvaged, split_corrupt
from lakeweir.sources.runs import latest_of, latest_run
from lakeweir.sources.scratch import new_area, staged, written
from lakeweir.streaming.upsert import upsert_new_files

# The columns in use, declared so that no job is spent on reading footers.
TABLES = {
    "region": record(r_regionkey="integer", r_name="string"),
    "nation": record(n_nationkey="integer", n_name="string", n_regionkey="integer"),
    "customer": record(
        c_custkey="long",
        c_name="string",
        c_nationkey="integer",
        c_acctbal="double",
        c_mktsegment="string",
    ),
    "supplier": record(s_suppkey="long", s_nationkey="integer", s_acctbal="double"),
    "part": record(p_partkey="long", p_type="string", p_size="integer", p_retailprice="double"),
    "orders": record(
        o_orderkey="long",
        o_custkey="long",
        o_orderstatus="string",
        o_totalprice="double",
        o_orderpriority="string",
    ),
    "lineitem": record(l_orderkey="long", l_returnflag="string", l_linestatus="string"),
    "events": record(
        event_id="long",
        ts="timestamp_ntz",
        user_id="long",
        event_type="string",
        value="double",
        props="string",
    ),
    "documents": record(doc_id="long", text="string", lang="string", n_chars="long"),
    "embeddings": record(vec_id="long"),
    "pages": record(page_id="long"),
    "benchmark": record(item_id="long"),
    "labels": record(doc_id="long"),
    "conversations": record(conv_id="long"),
}
POINT_IN_TIME = "2024_01_15_12_00_00_000000"


# -- relations -------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def padded(prefix: str, number: str, width: int = 12):
    return F.concat(F.lit(prefix), F.lpad(F.col(number).cast("string"), width, "0"))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as sites: one market segment stands for a missing type, and postal codes
    come in every value class."""
    place = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    segment = F.col("c_mktsegment")
    number = F.col("c_custkey").cast("string")
    return (
        table(spark, sf_dir, "customer")
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            padded("b-", "c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.nullif(segment, F.lit("FURNITURE")).alias("brewery_type"),
            F.col("r_name").alias("country"),
            F.col("n_name").alias("state"),
            F.concat("n_name", F.lit("-"), (F.col("c_custkey") % 7).cast("string")).alias("city"),
            F.when(segment == "BUILDING", F.concat(F.lit("0"), number))
            .when(segment == "MACHINERY", F.concat(number, F.lit(".5")))
            .when(segment == "HOUSEHOLD", F.lit("true"))
            .when(segment != "FURNITURE", F.concat(F.lit("PC "), number))
            .alias("postal_code"),
            F.col("c_acctbal").alias("longitude"),
        )
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert target: customers and suppliers; one nation's suppliers have no key."""
    customers = table(spark, sf_dir, "customer").select(
        padded("c-", "c_custkey").alias("id"),
        F.col("c_mktsegment").alias("kind"),
        F.col("c_acctbal").alias("amount"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_nationkey") != 0, padded("s-", "s_suppkey")).alias("id"),
        F.lit("SUPPLIER").alias("kind"),
        F.col("s_acctbal").alias("amount"),
    )
    return customers.unionByName(suppliers)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert source: the newest event per user updates a customer, parts are new, and the
    parts of the smallest size have no key."""
    newest = dedupe_latest(
        table(spark, sf_dir, "events"),
        ["user_id"],
        [F.desc("ts"), F.desc("event_id")],
        keys_set=True,
    ).select(
        padded("c-", "user_id").alias("id"),
        F.col("event_type").alias("kind"),
        F.col("value").alias("amount"),
    )
    parts = table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") != 1, padded("p-", "p_partkey")).alias("id"),
        F.col("p_type").alias("kind"),
        F.col("p_retailprice").alias("amount"),
    )
    return newest.unionByName(parts)


ACCOUNT = record(id="string", kind="string", amount="double")


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("key", padded("e-", "event_id"))


def seen_mark(events: DataFrame) -> DataFrame:
    """One row: the highest key before the last day, as an earlier load would have left it."""
    last_day = events.agg(F.date_trunc("day", F.max("ts")).alias("day")).scalar()
    return events.where(F.col("ts") < last_day).agg(F.max("key").alias("mark"))


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the run folder they arrived in: daily, except for errors, whose folder
    names cannot be read as a time and sort above all others."""
    daily = F.concat(F.lit("data/"), run_name(F.date_trunc("day", F.col("ts"))), F.lit("/"))
    return table(spark, sf_dir, "events").withColumn(
        "folder",
        F.when(F.col("event_type") == "error", F.lit("data/backfill/")).otherwise(daily),
    )


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw text records, with some unreadable numbers and no ``origin`` field."""
    return table(spark, sf_dir, "documents").select(
        padded("d-", "doc_id").alias("id"),
        "text",
        "lang",
        F.when(F.col("lang") == "de", F.lit("n/a"))
        .otherwise(F.col("n_chars").cast("string"))
        .alias("n_chars"),
    )


DOCUMENT = record(
    id="string", lang="string", origin="string", n_chars="double", text="string"
)
SITE_CHECKS = (
    quality.Check("identity").is_unique("id").is_complete("id", "name"),
    quality.Check("places")
    .is_complete("country", "state", "city")
    .has_data_type("String", "id", "country", "state", "city")
    .has_data_type("Fractional", "longitude"),
    quality.Check("optional", quality.WARNING)
    .is_unique("country")
    .is_complete("brewery_type", "postal_code", "latitude")
    .has_data_type("String", "postal_code")
    .has_data_type("Integral", "postal_code"),
)
STRICT_CHECK = quality.Check("strict").is_unique("id").is_complete("brewery_type")


# -- queries: operators on relations ---------------------------------------------------


def count_by_type_location(spark, sf_dir):
    return count_by(sites(spark, sf_dir), MART_DIMENSIONS, MART_COUNT)


def stamped_mart(spark, sf_dir):
    """The mart with its audit time, shown as text."""
    mart = stamp(
        count_by(sites(spark, sf_dir), ["country", "brewery_type"], MART_COUNT),
        MART_AUDIT,
        "2024-05-06 07:08:09",
    )
    return mart.withColumn(MART_AUDIT, F.date_format(MART_AUDIT, "yyyy-MM-dd HH:mm:ss"))


def rollup_region(spark, sf_dir):
    dimensions = ["country", "state", "city", "brewery_type"]
    return rollup_count(sites(spark, sf_dir), dimensions, MART_COUNT)


def region_distribution(spark, sf_dir):
    """The share of each place and type in the group above it."""
    dimensions = ["country", "state", "city", "brewery_type"]
    return rollup_shares(sites(spark, sf_dir), dimensions, MART_COUNT)


def upsert_by_key(spark, sf_dir):
    # the source is read for its keys and for its rows, so it is evaluated once beforehand
    source = written(changes(spark, sf_dir), "changes")
    return merge_by_key(accounts(spark, sf_dir), source, ["id"])


def cast_projection(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        padded("o-", "o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("amount"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderpriority").alias("unlisted"),
    )
    return conform(
        raw, record(id="string", amount="double", customer="string", remark="string")
    )


def dedupe_latest_event(spark, sf_dir):
    return dedupe_latest(
        table(spark, sf_dir, "events"),
        ["user_id"],
        [F.desc("ts"), F.desc("event_id")],
        keys_set=True,
    )


def incremental_filter(spark, sf_dir):
    events = keyed_events(spark, sf_dir)
    return newer_than(events, "key", seen_mark(events).scalar())


def incremental_pages(spark, sf_dir):
    events = keyed_events(spark, sf_dir)
    paged = assign_pages(
        events.select("key", "event_type"),
        [F.desc("key")],
        ingest.PER_PAGE[ingest.INCREMENTAL],
        unique=True,
    )
    return pages_until_known(paged, "key", seen_mark(events).scalar())


def full_load_pages(spark, sf_dir):
    paged = assign_pages(
        sites(spark, sf_dir).select("id", "state"),
        ["id"],
        ingest.PER_PAGE[ingest.FULL],
        unique=True,
    )
    sizes = paged.groupBy("page").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )
    return before_stop(sizes, stop_page(sizes, F.col("n_rows")))


def pages_with_ties(spark, sf_dir):
    """Paging on a column with few values: only the page sizes per value are determined."""
    paged = assign_pages(
        table(spark, sf_dir, "lineitem").select("l_returnflag"),
        ["l_returnflag"],
        5000,
    )
    return paged.groupBy("page", "l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"))


def next_watermark(spark, sf_dir):
    """Per load: the mark after new events, and the old mark kept when nothing is new."""
    events = keyed_events(spark, sf_dir)
    mark = seen_mark(events).scalar()
    moved = new_watermark(newer_than(events, "key", mark), "key", mark)
    top = events.agg(F.max("key")).scalar()
    kept = new_watermark(newer_than(events, "key", top), "key", top)
    return moved.select(F.lit("moved").alias("load"), "max_id").unionByName(
        kept.select(F.lit("kept").alias("load"), "max_id")
    )


def latest_run_rows(spark, sf_dir):
    events = run_events(spark, sf_dir)
    latest = latest_of(events, "folder").scalar()
    return events.where(F.col("folder") == latest).select("event_id", "folder", "value")


def point_in_time_run(spark, sf_dir):
    events = run_events(spark, sf_dir)
    latest = latest_of(events, "folder", as_of=POINT_IN_TIME).scalar()
    return events.where(F.col("folder") == latest).select("event_id", "folder", "value")


def completeness(spark, sf_dir):
    relation = sites(spark, sf_dir)
    return quality.completeness(relation, relation.columns)


def uniqueness(spark, sf_dir):
    relation = sites(spark, sf_dir)
    texts = table(spark, sf_dir, "documents")
    return (
        quality.uniqueness(relation, "id")
        .unionByName(quality.uniqueness(relation, "country"))
        .unionByName(quality.uniqueness(relation, "postal_code"))
        .unionByName(quality.uniqueness(texts, "text", by_digest=True))
    )


def data_type_profile(spark, sf_dir):
    return quality.data_type_profile(
        sites(spark, sf_dir), ["id", "country", "brewery_type", "postal_code", "longitude"]
    )


def verification_report(spark, sf_dir):
    return quality.verify(sites(spark, sf_dir), SITE_CHECKS)


def gated_mart(spark, sf_dir):
    relation = sites(spark, sf_dir)
    report = quality.verify(relation, SITE_CHECKS)
    return quality.publish_if_passed(count_by(relation, MART_DIMENSIONS, MART_COUNT), report)


def gated_mart_refused(spark, sf_dir):
    relation = sites(spark, sf_dir)
    report = quality.verify(relation, [STRICT_CHECK])
    return quality.publish_if_passed(count_by(relation, MART_DIMENSIONS, MART_COUNT), report)


def schema_report(spark, sf_dir):
    """Problems of the sites relation against a schema that does not fit, with the number
    of rows each concerns."""
    relation = sites(spark, sf_dir)
    expected = record(
        id="string",
        name="string",
        brewery_type="string",
        country="string",
        state="string",
        city="string",
        longitude="string",
        latitude="double",
    )
    report = quality.schema_report(relation, expected).select("field", "problem")
    return report.withColumn("n_rows", quality.row_count(relation).scalar())


def row_count(spark, sf_dir):
    counts = [
        quality.row_count(table(spark, sf_dir, name)).select(F.lit(name).alias("table"), "n_rows")
        for name in TABLES
    ]
    total = counts[0]
    for one in counts[1:]:
        total = total.unionByName(one)
    return total


# -- queries: operators with files behind them -----------------------------------------


def raw_json_scan(spark, sf_dir):
    """Land documents as two raw runs and a stray folder, find the latest, scan, conform."""
    root = new_area(spark, "raw-scan")
    raw = raw_documents(spark, sf_dir)
    ingest.land_raw(raw.where(F.col("lang") == "en"), root, "2024_01_01_00_00_00_000000")
    ingest.land_raw(raw, root, "2024_01_02_00_00_00_000000")
    ingest.land_raw(raw.where(F.col("lang") == "fr"), root, "not_a_run")
    scan = read_raw_json(spark, latest_run(spark, root), raw_of(DOCUMENT, audit=None))
    good, _ = split_corrupt(written(scan, "raw"))
    return conform(good, DOCUMENT)


def quarantined_records(spark, sf_dir):
    """Land documents as JSON texts, those in one language cut short, and split them."""
    root = new_area(spark, "raw-damaged")
    text = F.to_json(F.struct("id", "text", "lang", "n_chars"))
    cut = F.when(F.col("lang") == "es", F.expr("left(record, length(record) - 1)"))
    texts = raw_documents(spark, sf_dir).select(text.alias("record"), "lang")
    damaged_texts = texts.select(F.coalesce(cut, F.col("record")).alias("record"))
    path = ingest.land_texts(damaged_texts, root, "2024_01_01_00_00_00_000000")
    scan = read_raw_json(spark, path, raw_of(DOCUMENT, audit=None))
    good, damaged = split_corrupt(written(scan, "raw"))
    return count_by(good, ["lang"], "n_records").unionByName(
        count_by(damaged.select(F.lit("damaged").alias("lang")), ["lang"], "n_records")
    )


def _account_table(spark, **limits) -> Table:
    return Table(
        spark, new_area(spark, "accounts"), ACCOUNT, keys=("id",), partition_by=("kind",), **limits
    )


def snapshot_rewrite(spark, sf_dir):
    """Create, fill, and upsert a partitioned table, then rewrite it as one snapshot."""
    accounts_table = _account_table(spark)
    accounts_table.init_table()
    accounts_table.write_snapshot(accounts(spark, sf_dir))
    with staged(changes(spark, sf_dir), "changes") as source:
        accounts_table.upsert(source)
    accounts_table.compact()
    return accounts_table.read_snapshot()


def snapshot_append(spark, sf_dir):
    """The same upsert kept as increments that the read resolves: parts first, then events,
    then everything once more; the last increments are folded."""
    accounts_table = _account_table(spark, fold_after=2)
    accounts_table.write_snapshot(accounts(spark, sf_dir))
    with staged(changes(spark, sf_dir), "changes") as source:
        with_key = source.where(F.col("id").isNotNull())
        accounts_table.upsert(source.where(F.col("id").isNull()))
        accounts_table.upsert(with_key.withColumn("amount", F.lit(0.0)))
        accounts_table.upsert(with_key)
    return accounts_table.read_snapshot()


def evolved_overwrite(spark, sf_dir):
    """Publish a mart twice; the second one drops a column and brings another."""
    relation = sites(spark, sf_dir)
    mart = Table(spark, new_area(spark, "mart"))
    mart.overwrite(count_by(relation, ["country", "state"], MART_COUNT))
    mart.overwrite(count_by(relation, ["country", "brewery_type"], MART_COUNT), evolve=True)
    return mart.read_snapshot()


def saved_watermark(spark, sf_dir):
    """Save two marks, load the last, and take what is newer."""
    events = keyed_events(spark, sf_dir)
    state = f"{new_area(spark, 'state')}/watermark"
    mark = seen_mark(events).first()["mark"]
    ingest.save_watermark(spark, state, events.agg(F.min("key").alias("mark")).first()["mark"])
    ingest.save_watermark(spark, state, mark)
    plan = ingest.plan_load(ingest.load_watermark(spark, state))
    fresh = newer_than(events, "key", plan.watermark)
    return new_watermark(fresh, "key", plan.watermark).select(
        F.lit(plan.mode).alias("mode"), F.lit(plan.watermark).alias("mark"), "max_id"
    )


def partitioned_overwrite(spark, sf_dir):
    """Publish a mart twice that is partitioned by text values that look like numbers."""
    zone = F.lpad((F.length("state") % 3).cast("string"), 2, "0")
    rows = count_by(sites(spark, sf_dir).withColumn("zone", zone), ["zone", "country"], MART_COUNT)
    mart = Table(spark, new_area(spark, "mart"), partition_by=("zone",))
    for _ in range(2):
        mart.overwrite(rows)
    return mart.read_snapshot()


def schema_refused(spark, sf_dir):
    """The fields for which a table written with another schema is refused before its gate."""
    lake = _site_lake(spark)
    other = sites(spark, sf_dir).drop("name").withColumn("longitude", F.lit("east"))
    kinds = {f.name: f.dataType for f in SITE if f.name != "name"}
    kinds |= {"longitude": T.StringType(), "more": T.IntegerType()}
    declared = T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])
    written_as = Table(spark, lake.path("silver"), declared, lake.keys, lake.partition_by)
    written_as.write_snapshot(other.withColumn("more", F.lit(1)).select(*declared.names))
    try:
        flow.check(spark, lake)
    except SchemaCheckFailed as refused:
        rows = [(p["field"], p["problem"]) for p in refused.problems]
        report = spark.createDataFrame(rows, "field string, problem string")
        return report.withColumn("n_rows", quality.row_count(other).scalar())
    raise AssertionError("a wrong schema passed")


def stamped_now(spark, sf_dir):
    """Rows per region, with whether each has the time of the query as its audit time."""
    stamped = stamp(count_by(sites(spark, sf_dir), ["country"], MART_COUNT), AUDIT)
    recent = F.col(AUDIT).isNotNull() & (F.col(AUDIT) >= F.current_timestamp())
    return stamped.select("country", MART_COUNT, recent.alias("stamped"))


def raw_json_pages(spark, sf_dir):
    """Sites as one JSON array per file, the layout of fetched pages, read and conformed."""
    root = new_area(spark, "raw-pages")
    relation = sites(spark, sf_dir).select("id", "name", "longitude")
    bodies = _bodies(assign_pages(relation, ["id"], ingest.PER_PAGE[ingest.FULL], unique=True))
    path = f"{root}/2024_01_01_00_00_00_000000"
    bodies.select("body").write.option("maxRecordsPerFile", 1).text(path)
    schema = record(id="string", name="string", longitude="double")
    return conform(read_raw_json(spark, path, raw_of(schema, audit=None), "pages"), schema)


def salvaged_pages(spark, sf_dir):
    """Sites as one JSON array per file; every other page is cut inside its 150th record, and
    what is whole before the cut is saved."""
    root = new_area(spark, "raw-cut")
    relation = sites(spark, sf_dir).select("id", "name", "city")
    paged = assign_pages(relation, ["id"], ingest.PER_PAGE[ingest.FULL], unique=True)
    # a page holds per_page records at most
    records = F.sort_array(F.collect_list(F.struct("id", "name", "city")))
    pages = paged.groupBy("page").agg(records.alias("records"))
    head = F.to_json(F.slice("records", 1, 149))
    cut = F.concat(F.substring(head, F.lit(1), F.char_length(head) - 1), F.lit(',{"id":"b-'))
    damaged = (F.col("page") % 2 == 1) & (F.size("records") >= 150)
    body = F.when(damaged, cut).otherwise(F.to_json("records"))
    path = f"{root}/2024_01_01_00_00_00_000000"
    pages.select(body.alias("body")).write.option("maxRecordsPerFile", 1).text(path)
    schema = record(id="string", name="string", city="string")
    raw = raw_of(schema, audit=None)
    good, broken = split_corrupt(written(read_raw_json(spark, path, raw, "pages"), "raw"))
    return conform(good.unionByName(salvaged(broken, raw)), schema)


def raw_drift(spark, sf_dir):
    """Three runs of sites whose fields change: numbers as text, a new field, one that goes."""
    root = new_area(spark, "raw-drift")
    first = sites(spark, sf_dir).select("id", "name", "country", "longitude")
    rating = F.when(F.col("country") == "ASIA", 5)
    second = first.withColumn("longitude", F.col("longitude").cast("string"))
    runs = [first, second.withColumn("rating", rating), first.drop("name")]
    for day, rows in enumerate(runs, 1):
        ingest.land_raw(rows, root, f"2024_01_{day:02d}_00_00_00_000000")
    declared = record(id="string", name="string", country="string", longitude="double")
    return drift(raw_texts(spark, root), declared)


def _bodies(paged: DataFrame) -> DataFrame:
    """(page, n_items, body) of a paged relation, with one empty page after the last."""
    fields = [name for name in paged.columns if name != "page"]
    # a page holds per_page records at most
    bodies = paged.groupBy("page").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.to_json(F.sort_array(F.collect_list(F.struct(*fields)))).alias("body"),
    )
    end = paged.agg((F.coalesce(F.max("page"), F.lit(0)) + 1).alias("page"))
    return bodies.unionByName(
        end.select("page", F.lit(0).cast("long").alias("n_items"), F.lit("[]").alias("body"))
    )


def _paged_load(spark, paged: DataFrame, key: str, mark: str | None, schema) -> DataFrame:
    """Ingest the pages of ``paged`` above ``mark`` and read the landed run."""
    root = new_area(spark, "paged-load")
    state = f"{root}/state"
    if mark is not None:
        ingest.save_watermark(spark, state, mark)
    done = ingest.ingest_pages(_bodies(paged), key, f"{root}/data", state)
    landed = read_raw_json(spark, f"{root}/data/{done.run}", raw_of(schema, audit=None))
    return conform(landed, schema).withColumn(
        "next_mark", F.lit(ingest.load_watermark(spark, state))
    )


def paged_full_load(spark, sf_dir):
    """Sites in pages of 200, loaded without a mark."""
    relation = sites(spark, sf_dir).select("id", "name", "longitude")
    paged = assign_pages(relation, ["id"], ingest.PER_PAGE[ingest.FULL], unique=True)
    schema = record(id="string", name="string", longitude="double")
    return _paged_load(spark, paged, "id", None, schema)


def paged_incremental_load(spark, sf_dir):
    """Events newest first in pages of 50, loaded above the mark of a past load."""
    events = keyed_events(spark, sf_dir).select("key", "event_type", "value", "ts")
    paged = assign_pages(
        events.drop("ts"), [F.desc("key")], ingest.PER_PAGE[ingest.INCREMENTAL], unique=True
    )
    schema = record(key="string", event_type="string", value="double")
    return _paged_load(spark, paged, "key", seen_mark(events).first()["mark"], schema)


SITE = record(
    id="string",
    name="string",
    brewery_type="string",
    city="string",
    postal_code="string",
    country="string",
    longitude="double",
    state="string",
)


def _site_lake(spark) -> flow.Lake:
    return flow.Lake(
        root=new_area(spark, "lake"),
        curated_schema=SITE,
        audit=None,
        partition_by=("country", "state"),
        checks=SITE_CHECKS[:2],
        mart_audit=None,
    )


def _land_two_runs(spark, sf_dir, lake: flow.Lake) -> None:
    """All sites, then the sites of one region again under one type."""
    relation = sites(spark, sf_dir)
    ingest.land_raw(relation, lake.raw_data, "2024_01_01_00_00_00_000000")
    moved = relation.where(F.col("country") == "ASIA").withColumn("brewery_type", F.lit("MOVED"))
    ingest.land_raw(moved, lake.raw_data, "2024_01_02_00_00_00_000000")


def layered_flow(spark, sf_dir):
    """Land two raw runs, then curate both, check the table and publish the mart."""
    lake = _site_lake(spark)
    _land_two_runs(spark, sf_dir, lake)
    return flow.run(spark, lake)


def delta_mart(spark, sf_dir):
    """The mart of a first run, kept up by the rows that a second run changed."""
    lake = _site_lake(spark)
    relation = sites(spark, sf_dir)
    ingest.land_raw(relation, lake.raw_data, "2024_01_01_00_00_00_000000")
    flow.curate(spark, lake)
    flow.publish_changes(spark, lake)
    moved = relation.where(F.col("country") == "ASIA").withColumn("brewery_type", F.lit("MOVED"))
    ingest.land_raw(moved, lake.raw_data, "2024_01_02_00_00_00_000000")
    flow.curate(spark, lake)
    return flow.publish_changes(spark, lake)


def merged_verification(spark, sf_dir):
    """Checks of a first run with broken records, brought up to date by a second one that mends
    them: only what it changed is measured."""
    lake = replace(_site_lake(spark), checks=SITE_CHECKS)
    relation = sites(spark, sf_dir)
    broken = F.col("country") == "AFRICA"
    first = relation.withColumns(
        {
            "name": F.when(~broken, F.col("name")),
            "postal_code": F.when(broken, F.lit("12.5")).otherwise(F.col("postal_code")),
        }
    )
    ingest.land_raw(first, lake.raw_data, "2024_01_01_00_00_00_000000")
    flow.curate(spark, lake)
    lake.checked(spark).report()
    ingest.land_raw(relation.where(broken), lake.raw_data, "2024_01_02_00_00_00_000000")
    flow.curate(spark, lake)
    return lake.checked(spark).report()


def stream_upsert(spark, sf_dir):
    """Drain the later raw run as a stream, then, with the same checkpoint, the earlier one,
    file by file: it changes no row of the later run."""
    lake = _site_lake(spark)
    relation = sites(spark, sf_dir)
    checkpoint = lake.path("_checkpoint")
    moved = relation.where(F.col("country") == "ASIA").withColumn("brewery_type", F.lit("MOVED"))
    ingest.land_raw(moved, lake.raw_data, "2024_01_02_00_00_00_000000")
    upsert_new_files(spark, lake, checkpoint).awaitTermination()
    ingest.land_raw(relation, lake.raw_data, "2024_01_01_00_00_00_000000")
    upsert_new_files(spark, lake, checkpoint, max_files_per_batch=1).awaitTermination()
    return lake.curated(spark).read_snapshot()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "count_by_type_location": count_by_type_location,
    "stamped_mart": stamped_mart,
    "rollup_region": rollup_region,
    "upsert_by_key": upsert_by_key,
    "cast_projection": cast_projection,
    "dedupe_latest": dedupe_latest_event,
    "incremental_filter": incremental_filter,
    "incremental_pages": incremental_pages,
    "full_load_pages": full_load_pages,
    "pages_with_ties": pages_with_ties,
    "new_watermark": next_watermark,
    "latest_run": latest_run_rows,
    "point_in_time_run": point_in_time_run,
    "completeness": completeness,
    "uniqueness": uniqueness,
    "data_type_profile": data_type_profile,
    "verification_report": verification_report,
    "gated_mart": gated_mart,
    "gated_mart_refused": gated_mart_refused,
    "schema_report": schema_report,
    "row_count": row_count,
    "raw_json_scan": raw_json_scan,
    "quarantined_records": quarantined_records,
    "snapshot_rewrite": snapshot_rewrite,
    "snapshot_append": snapshot_append,
    "evolved_overwrite": evolved_overwrite,
    "partitioned_overwrite": partitioned_overwrite,
    "schema_refused": schema_refused,
    "stamped_now": stamped_now,
    "raw_json_pages": raw_json_pages,
    "salvaged_pages": salvaged_pages,
    "raw_drift": raw_drift,
    "saved_watermark": saved_watermark,
    "paged_full_load": paged_full_load,
    "paged_incremental_load": paged_incremental_load,
    "layered_flow": layered_flow,
    "delta_mart": delta_mart,
    "merged_verification": merged_verification,
    "region_distribution": region_distribution,
    "stream_upsert": stream_upsert,
}
