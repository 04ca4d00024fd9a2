"""The linear flow: raw runs, curated table, quality gate, mart."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir import schemas
from lakeweir.errors import NoRunFound
from lakeweir.functions.runs import RUN_FORMAT, run_time
from lakeweir.operators import quality
from lakeweir.operators.counts import apply_counts, count_by, signed_counts
from lakeweir.operators.curate import conform, dedupe_latest, stamp
from lakeweir.operators.upsert import keep_newest
from lakeweir.plans.checked import CheckedTable, made_from, tag_of
from lakeweir.plans.ingest import Ingested, PagedSource, ingest
from lakeweir.plans.presets import SITE_CHECK
from lakeweir.plans.tables import FOLD_AFTER, ORDER, Table
from lakeweir.sources.drift import drift as drift_of
from lakeweir.sources.drift import raw_texts
from lakeweir.sources.raw_json import read_raw_json, salvaged, split_corrupt
from lakeweir.sources.runs import runs_until
from lakeweir.sources.scratch import staged

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Lake:
    """Folders, schemas and rules of one lake. The defaults describe the site lake."""

    root: str
    source: PagedSource | None = None
    curated_schema: T.StructType = field(default_factory=lambda: schemas.CURATED)
    audit: str | None = schemas.AUDIT
    keys: tuple[str, ...] = schemas.KEYS
    partition_by: tuple[str, ...] = schemas.PARTITIONS
    fold_after: int = FOLD_AFTER
    raw_layout: str = "lines"
    salvage: bool = False  # take the whole records of damaged pages, which are kept as well
    run_format: str = RUN_FORMAT
    dedupe_by: Sequence[Column | str] = ()
    checks: tuple[quality.Check, ...] = (SITE_CHECK,)
    mart_dimensions: tuple[str, ...] = schemas.MART_DIMENSIONS
    mart_count: str = schemas.MART_COUNT
    mart_audit: str | None = schemas.MART_AUDIT

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw_data(self) -> str:
        return self.path("bronze", "data")

    @property
    def raw_schema(self) -> T.StructType:
        return schemas.raw_of(self.curated_schema, self.audit)

    def curated(self, spark: SparkSession) -> Table:
        return Table(
            spark,
            self.path("silver"),
            self.curated_schema,
            self.keys,
            self.partition_by,
            self.fold_after,
        )

    def mart(self, spark: SparkSession) -> Table:
        return Table(spark, self.path("gold"))

    def checked(self, spark: SparkSession) -> CheckedTable:
        return CheckedTable(self.curated(spark), self.path("_state", "checks"), self.checks)


def fetch(spark: SparkSession, lake: Lake, run: str | None = None) -> Ingested:
    return ingest(
        spark, lake.source, lake.raw_data, lake.path("_state", "watermark"), run
    )


def source_order(run: Column, run_format: str, file: Column | None = None) -> Column:
    """Place of a record in the order of its source: the run time, then the file, as text
    that sorts."""
    moment = F.date_format(run_time(run, run_format), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return moment if file is None else F.concat_ws("/", moment, file)


def upsert_raw(
    raw: DataFrame, lake: Lake, batch: str, as_of=None, token: str | None = None
) -> None:
    """Conform raw records and upsert them; damaged ones go to the quarantine folder.

    The JSON text is parsed once, into a written copy; the steps after it read columns.
    Where ``raw`` tells the place of its records in the source order, a later one replaces
    an earlier one.
    """
    slots = [raw.schema[n] for n in (schemas.CORRUPT, ORDER) if n in raw.columns]
    rows = conform(raw, T.StructType([*lake.curated_schema, *slots]))
    if lake.audit:
        rows = stamp(rows, lake.audit, as_of)
    table = lake.curated(raw.sparkSession)
    order = F.col(ORDER) if ORDER in rows.columns else F.lit(None).cast("string")
    watched = Observation()
    rows = rows.observe(
        watched,
        F.count(F.lit(1)).alias("all"),
        F.count(schemas.CORRUPT).alias("damaged"),
        (F.min(order) < F.max(order)).alias("several"),
    )
    with staged(rows, "curated") as parsed:
        good, damaged = split_corrupt(parsed)
        seen = watched.get
        if seen["damaged"]:
            target = lake.path("quarantine", batch)
            damaged.write.mode("overwrite").json(target)
            log.warning("%s damaged records of %s went to %s", seen["damaged"], batch, target)
            if lake.salvage:
                good = good.unionByName(_saved(parsed, lake, as_of))
        if seen["all"] == seen["damaged"] and not (seen["damaged"] and lake.salvage):
            log.info("no records in %s", batch)
            table.init_table()
            return
        if lake.dedupe_by:
            later = [F.desc(ORDER)] if seen["several"] else []
            chosen = dedupe_latest(good, lake.keys, [*later, *lake.dedupe_by])
        elif seen["several"]:
            chosen = keep_newest(good, lake.keys, ORDER)
        elif seen["damaged"] and lake.salvage:
            chosen = good
        else:
            table.upsert(good, token)
            return
        with staged(chosen, "chosen") as rows:
            table.upsert(rows, token)


def _saved(parsed: DataFrame, lake: Lake, as_of) -> DataFrame:
    """The whole records of damaged pages, with the columns of the good ones."""
    kept = [name for name in (schemas.CORRUPT, ORDER) if name in parsed.columns]
    records = salvaged(parsed.select(*kept), lake.raw_schema)
    slots = [parsed.schema[ORDER]] if ORDER in kept else []
    rows = conform(records, T.StructType([*lake.curated_schema, *slots]))
    return stamp(rows, lake.audit, as_of) if lake.audit else rows


def drift(spark: SparkSession, lake: Lake) -> DataFrame:
    """Fields of the raw runs that the lake does not declare, or that changed or went."""
    declared = schemas.raw_of(lake.curated_schema, lake.audit)
    return drift_of(raw_texts(spark, lake.raw_data, lake.raw_layout), declared, lake.run_format)


def curate(
    spark: SparkSession, lake: Lake, as_of=None, point_in_time: str | None = None
) -> DataFrame:
    """Upsert every raw run (up to ``point_in_time``) not curated before, oldest first.

    The commit of a run carries its name, so a run counts once, and one that was missed or
    failed is taken by the next call.
    """
    runs = runs_until(spark, lake.raw_data, lake.run_format, point_in_time)
    if not runs:
        raise NoRunFound(f"no run folder under {lake.raw_data}")
    table = lake.curated(spark)
    for run in runs:
        token = f"run-{run}"
        if not table.has_token(token):
            raw = read_raw_json(spark, f"{lake.raw_data}/{run}", lake.raw_schema, lake.raw_layout)
            raw = raw.withColumn(ORDER, source_order(F.lit(run), lake.run_format))
            upsert_raw(raw, lake, run, as_of, token)
    return table.read_snapshot()


def check(spark: SparkSession, lake: Lake, curated: DataFrame | None = None) -> DataFrame:
    """Evaluated quality report; raises on a wrong schema or a failed error-level check."""
    table = lake.curated(spark)
    quality.require_schema(table.stored_schema(), lake.curated_schema)
    rows = table.read_snapshot() if curated is None else curated
    return quality.gate(quality.verify(rows, lake.checks))


def check_changes(spark: SparkSession, lake: Lake) -> DataFrame:
    """Like :func:`check`, measuring only what changed since the last such check."""
    quality.require_schema(lake.curated(spark).stored_schema(), lake.curated_schema)
    return quality.gate(lake.checked(spark).report())


def publish(
    spark: SparkSession,
    curated: DataFrame,
    lake: Lake,
    as_of=None,
    skip_if_empty: bool = False,
    version: int | None = None,
) -> DataFrame:
    """Aggregate the curated table and replace the mart. ``version`` tells which version of the
    table ``curated`` is; :func:`publish_changes` goes on from there."""
    rows = count_by(curated, lake.mart_dimensions, lake.mart_count)
    token = None if version is None else tag_of(version)
    return _replace_mart(spark, lake, rows, as_of, token, skip_if_empty)


def _replace_mart(
    spark: SparkSession, lake: Lake, rows: DataFrame, as_of, token, skip_if_empty: bool = False
) -> DataFrame:
    if lake.mart_audit:
        rows = stamp(rows, lake.mart_audit, as_of)
    mart = lake.mart(spark)
    mart.overwrite(rows, evolve=True, skip_if_empty=skip_if_empty, token=token)
    return mart.read_snapshot()


def publish_changes(
    spark: SparkSession, lake: Lake, as_of=None, skip_if_empty: bool = False
) -> DataFrame:
    """Bring the mart up to the curated table by the rows that changed since it was published.

    Rows that came count one, rows whose place they took count one less; the mart itself is
    groups. Everything is counted anew where the changes cannot be told.
    """
    table, mart = lake.curated(spark), lake.mart(spark)
    version, before = table.newest().version, made_from(mart)
    if before == version:
        return mart.read_snapshot()
    changes = None if before is None else table.changed_since(before)
    if changes is None:
        rows = table.read_snapshot()
        return publish(spark, rows, lake, as_of, skip_if_empty, version)
    dimensions, name = lake.mart_dimensions, lake.mart_count
    delta = signed_counts(*changes, dimensions, name)
    rows = apply_counts(mart.read_snapshot(), delta, dimensions, name)
    return _replace_mart(spark, lake, rows, as_of, tag_of(version), skip_if_empty)


def run(
    spark: SparkSession, lake: Lake, as_of=None, changes_only: bool = False
) -> DataFrame:
    """All stages in order; a failing stage stops the rest. Returns the mart.

    The curated table is resolved once, into a written copy of the columns that the checks
    and the mart read. With ``changes_only`` it is not resolved at all: checks and mart are
    kept up by the rows that changed since the last run of that kind.
    """
    if lake.source is not None:
        fetch(spark, lake)
    curated = curate(spark, lake, as_of)
    if changes_only:
        check_changes(spark, lake)
        return publish_changes(spark, lake, as_of)
    version = lake.curated(spark).newest().version
    read = {c.column for one in lake.checks for c in one.constraints} | set(lake.mart_dimensions)
    with staged(curated.select(*[n for n in curated.columns if n in read]), "checked") as rows:
        check(spark, lake, rows)
        return publish(spark, rows, lake, as_of, version=version)
