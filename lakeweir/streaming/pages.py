"""Continuous landing of a paged source: the checkpoint keeps the place instead of a mark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeweir.errors import MissingKey
from lakeweir.functions.runs import new_run_name
from lakeweir.plans.ingest import DIRECTION, FULL, PER_PAGE, PagedSource, land_texts
from lakeweir.sources import storage
from lakeweir.sources.paged_json import record_texts, stream_pages
from lakeweir.sources.scratch import staged


def land_new_pages(
    spark: SparkSession, source: PagedSource, data_root: str, checkpoint: str, name: str = "pages"
) -> StreamingQuery:
    """Start a query that lands all records not seen before as one run, then ends.

    The source is read in ascending order, where it only grows at its end. The run of a batch is
    noted before it is landed, so a replayed batch replaces its own run and no record is landed
    twice. Keys may come in any order: nothing is compared with a mark.
    """

    def land(pages: DataFrame, batch_id: int) -> None:
        note = f"{checkpoint.rstrip('/')}/runs/{name}-{batch_id}"
        run = storage.read_text(spark, note)
        if run is None:
            run = new_run_name()
            storage.write_text(spark, note, run)
        with staged(pages, "pages") as fetched:
            seen = fetched.agg(F.sum("n_items"), F.sum("n_keyless")).first()
            if seen[1]:
                raise MissingKey(f"{seen[1]} records without a key in run {run}")
            if seen[0]:
                records = fetched.select(F.explode(record_texts()).alias("record"))
                land_texts(records, data_root, run)

    url = source.url.replace("{sort}", f"{source.key}:{DIRECTION[FULL]}")
    options = {"key": source.key, "per_page": PER_PAGE[FULL], **source.options}
    return (
        stream_pages(spark, url, **options)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(availableNow=True)
        .start()
    )
