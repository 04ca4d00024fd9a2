"""Continuous curation: every raw file is upserted once, whatever run it belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeweir.functions.runs import run_time
from lakeweir.plans.flow import Lake, source_order, upsert_raw
from lakeweir.plans.tables import ORDER
from lakeweir.schemas import CORRUPT


def upsert_new_files(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str,
    name: str = "upsert",
    max_files_per_batch: int | None = None,
    as_of=None,
) -> StreamingQuery:
    """Start a query that drains all raw files not seen before, then ends.

    The checkpoint takes the place of both the high-water mark and the search for the
    latest run. A replayed batch finds its commit token and changes nothing. The later run
    wins, and within a run the file with the higher name, however files are cut into batches
    and whenever they arrive; folders whose name is not a run are ignored.
    """
    lake.curated(spark).init_table()
    reader = (
        spark.readStream.schema(lake.raw_schema)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", lake.raw_layout == "pages")
    )
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def apply(batch: DataFrame, batch_id: int) -> None:
        token = f"{name}-{batch_id}"
        upsert_raw(batch, lake, token, as_of, token)

    parts = F.split(F.col("_metadata.file_path"), "/")
    order = source_order(F.element_at(parts, -2), lake.run_format, F.element_at(parts, -1))
    is_run = run_time(F.element_at(parts, -2), lake.run_format).isNotNull()
    records = reader.json(f"{lake.raw_data}/*").where(is_run).withColumn(ORDER, order)
    return (
        records.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(availableNow=True)
        .start()
    )
