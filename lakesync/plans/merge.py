"""Tables of a provider that has MERGE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.operators import apply
from lakesync.plans.store import COPIES, SEQ, TableStore, Written, observed, tie_of
from lakesync.schemas import TableSpec


class RowLevelStore(TableStore):
    """Tables of a provider with MERGE: deltas are merged in place, nothing else is rewritten."""

    merges = True

    def __init__(self, spark: SparkSession, namespace: str, provider: str = "delta", run_id: str | None = None):
        super().__init__(spark, namespace, provider, None, run_id)

    def ensure(self, spec: TableSpec) -> None:
        if not self.exists(spec.name):
            self.spark.sql(f"CREATE TABLE {self.name(spec.name)} ({spec.ddl}) USING {self.provider}")

    def drop(self, table: str) -> None:
        self._discard(table)

    def _replace(self, spec: TableSpec, result: DataFrame) -> Written:
        watched, outcome = observed(result, spec.order_by)
        (watched.drop(COPIES).write.format(self.provider).mode("overwrite").option("overwriteSchema", "true")
         .saveAsTable(self.name(spec.name)))
        return outcome()

    def upsert(self, spec: TableSpec, rows: DataFrame, marks: DataFrame | None = None, unique: bool = False) -> Written:
        self.ensure(spec)
        with self._staged(spec, rows) as (staged, outcome):
            fresh = (staged if unique else apply.overwrite(staged, spec.key, spec.order_by, tie_of(rows))).drop(SEQ)
            self._merge(spec, fresh, spec.key).whenMatched().updateAll().whenNotMatched().insertAll().merge()
            if marks is not None:
                self.flag_archived(spec, marks)
            return outcome()

    def flag_archived(self, spec: TableSpec, marks: DataFrame) -> int:
        with self._staged(spec, marks, order_by="archived_at", suffix="marks") as (staged, outcome):
            latest = staged.groupBy("id").agg(F.max("archived_at").alias("archived_at"))
            self._merge(spec, latest, ["id"]).whenMatched().update(
                {"archived": F.lit(True), "archived_at": F.col("s.archived_at")}).merge()
            return outcome().rows

    def replace_by_parent(self, spec: TableSpec, rows: DataFrame, parents: DataFrame) -> Written:
        """In one statement: rows that go are part of the merged source, marked so."""
        self.ensure(spec)
        with self._staged(spec, rows) as (staged, outcome):
            fresh = apply.overwrite(staged, spec.key, spec.order_by, tie_of(rows)).select(*spec.names)
            gone = self.read(spec.name).join(parents.select(spec.parent).distinct(), spec.parent, "left_semi").select(*spec.names)
            gone = gone.join(fresh.select(*spec.key), list(spec.key), "left_anti").select(*spec.names)
            source = fresh.withColumn("_gone", F.lit(False)).unionByName(gone.withColumn("_gone", F.lit(True)))
            values = {name: F.col("s." + name) for name in spec.names}
            (self._merge(spec, source, spec.key).whenMatched(F.col("s._gone")).delete()
             .whenMatched().update(values).whenNotMatched().insert(values).merge())
            return outcome()

    def _merge(self, spec: TableSpec, source: DataFrame, key: Sequence[str]):
        same = F.lit(True)
        for column in key:
            same = same & (F.col(f"{self.name(spec.name)}.{column}") == F.col("s." + column))
        return source.alias("s").mergeInto(self.name(spec.name), same)
