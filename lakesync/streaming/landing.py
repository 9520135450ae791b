"""Upsert newly landed files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakesync.plans.store import TableStore
from lakesync.schemas import TableSpec


def landed_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """One ``payload`` per line of the files landing in a folder."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(F.col("value").alias("payload"))


def upsert_stream(payloads: DataFrame, rows: Callable[[DataFrame], DataFrame], store: TableStore, spec: TableSpec,
                  checkpoint: str) -> StreamingQuery:
    """Map each micro-batch with ``rows`` and merge it into the table, then stop when nothing is left.

    No event-time watermark: rows that arrive late or again are absorbed by the
    keyed merge, where a watermark would drop them. Progress is kept only
    after the write, and repeating a batch changes nothing. Files are applied
    in the order they landed; as in batch, a later file's row replaces an
    earlier one whatever its time.
    """
    if not store.merges and not store.buckets:
        raise ValueError("a stream needs a table with buckets: without them every batch writes the whole table anew")
    store.ensure_schema()
    store.ensure(spec)

    def write(batch: DataFrame, batch_id: int) -> None:
        store.upsert(spec, rows(batch))

    return (payloads.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
