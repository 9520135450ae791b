"""The newest row of each key as keyed state: a stream that writes what changed, and nothing else."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from lakesync.operators.windows import instant_micros

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_AGE = ("_at", "_tie")  # order of rows as longs; nulls are oldest


def _older_first(values: Sequence[int | None]) -> tuple:
    return tuple((value is not None, value or 0) for value in values)


class NewestRow(StatefulProcessor):
    """Lets a row through if it is newer than every row of its key before it; the state is that row's age alone."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._newest = handle.getValueState("newest", "at long, tie long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = _older_first(self._newest.get()) if self._newest.exists() else None
        best, age = None, known
        for row in rows:
            its = _older_first([row[name] for name in _AGE])
            if age is None or its > age:
                best, age = row, its
        if best is not None:
            self._newest.update(tuple(best[name] for name in _AGE))
            yield Row(**{name: value for name, value in best.asDict().items() if name not in _AGE})

    def close(self) -> None:
        pass


def _age(df: DataFrame, column: str | None) -> Column:
    if column is None:
        return F.lit(None).cast("long")
    kind = df.schema[column].dataType.typeName()
    return instant_micros(F.col(column)) if kind.startswith("timestamp") else F.col(column).cast("long")


def newest_changes(rows: DataFrame, key: Sequence[str], order_by: str, tie: str | None = None) -> DataFrame:
    """Of a stream of rows those that became the newest of their key, with the same columns.

    ``order_by`` (a time or whole number, missing ones oldest) and ``tie`` (a
    whole number) decide as they do in ``operators.dedup.newest``; a row that is
    late, equally old or repeated changes nothing, so the newest row per key
    among all changes is that of all rows, however they arrive. No event-time
    watermark: state holds two numbers a key and is not given up. Each task
    keeps one row per key of a batch of rows before they are shuffled.
    """
    aged = rows.withColumns({"_at": _age(rows, order_by), "_tie": _age(rows, tie)})
    schema, names = aged.schema, list(key)

    def thinned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            table = pa.Table.from_batches([part])
            at = pc.sort_indices(table, sort_keys=[(name, "descending") for name in _AGE], null_placement="at_end")
            table = table.take(at).append_column("_row", pa.array(range(len(at)), pa.int64()))
            firsts = table.group_by(names).aggregate([("_row", "min")])["_row_min"]
            yield from table.drop_columns("_row").take(firsts.combine_chunks()).to_batches()

    changed = aged.mapInArrow(thinned, schema).groupBy(*names).transformWithState(
        NewestRow(), outputStructType=rows.schema, outputMode="Append", timeMode="None")
    return changed.select(*rows.columns)


def write_changes(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append changes to files, each once over all restarts, and stop when nothing is left; state is kept in RocksDB."""
    conf = changes.sparkSession.conf
    before = conf.get(_PROVIDER)
    conf.set(_PROVIDER, _ROCKS)
    try:
        return (changes.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
                .outputMode("append").trigger(availableNow=True).start())
    finally:
        conf.set(_PROVIDER, before)
