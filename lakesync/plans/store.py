"""Committing results to catalog tables.

A table is a view over a data table that holds versions of its buckets. A
write adds versions next to those that are read, and one ``CREATE OR REPLACE
VIEW`` makes them the table: a reader sees the state before or after, never
none, and a write that fails or is cut off leaves the table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, suppress
from dataclasses import dataclass, replace
from datetime import datetime
from itertools import groupby

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakesync.operators import apply
from lakesync.operators.dedup import newest_counted
from lakesync.operators.digest import DIGEST, changed_groups, changed_rows, row_digest
from lakesync.operators.windows import from_micros, instant_micros
from lakesync.schemas import TableSpec

BUCKET, VERSION = "key_bucket", "key_version"
COPIES = "_copies"
SEQ = "seq"  # optional arrival number of landed rows; decides between equal times
STAMP = ("_ingested_at",)  # when a row was read says nothing about its content
_STATE = "lakesync."


@dataclass(frozen=True)
class Written:
    rows: int  # rows handed in, before duplicates were dropped
    newest: datetime | None  # newest value of the table's ordering column among them
    changed: int = 0  # rows that differ from what was stored
    touched: int = 0  # buckets written anew


@dataclass(frozen=True)
class Snapshot:
    """One state of a table: its data table, and the version of each bucket that counts."""

    data: str
    versions: tuple[str, ...]

    def properties(self, when: str) -> dict[str, str]:
        grouped = sorted((version, bucket) for bucket, version in enumerate(self.versions))
        by_version = {version: " ".join(str(b) for _, b in some) for version, some in groupby(grouped, key=lambda pair: pair[0])}
        return {f"{_STATE}{when}.data": self.data, **{f"{_STATE}{when}.version.{v}": buckets for v, buckets in by_version.items()}}

    @staticmethod
    def of(properties: dict[str, str], when: str) -> Snapshot | None:
        prefix = f"{_STATE}{when}.version."
        found = {int(b): k[len(prefix):] for k, buckets in properties.items() if k.startswith(prefix) for b in buckets.split()}
        return Snapshot(properties[f"{_STATE}{when}.data"], tuple(found[b] for b in sorted(found))) if found else None

    def condition(self) -> str:
        by_version: dict[str, list[int]] = {}
        for bucket, version in enumerate(self.versions):
            by_version.setdefault(version, []).append(bucket)
        if len(by_version) == 1:
            return f"{VERSION} = '{self.versions[0]}'"
        return " OR ".join(f"({VERSION} = '{v}' AND {BUCKET} IN ({', '.join(map(str, some))}))" for v, some in by_version.items())


class TableStore:
    """Tables of one schema, in a format without row-level statements (Parquet by default).

    With ``buckets`` rows are dealt by a hash of their key, and a delta writes
    only the buckets anew in which it changes a row; without, the whole table
    is one. A table has one writer at a time. What the state before the last
    commit needs stays until the next one, for readers that have begun.
    """

    merges = False  # whether deltas are merged in place

    def __init__(self, spark: SparkSession, namespace: str, provider: str = "parquet",
                 buckets: int | None = None, run_id: str | None = None):
        self.spark, self.namespace, self.provider, self.buckets = spark, namespace, provider, buckets
        self.run_id = run_id or uuid.uuid4().hex[:8]

    # ---- catalog -------------------------------------------------------------

    def name(self, table: str) -> str:
        return f"{self.namespace}.{table}"

    def ensure_schema(self) -> None:
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.namespace}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def ensure(self, spec: TableSpec) -> None:
        """Create the table if it is not there."""
        if not self.exists(spec.name):
            self._replace(spec, self.spark.createDataFrame([], spec.schema))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table)).drop(BUCKET)

    def drop(self, table: str) -> None:
        """Drop a table with all its states."""
        states = self._snapshots(table)
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name(table)}")
        for state in filter(None, states):
            self._discard(state.data)

    def _discard(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def _snapshots(self, table: str) -> tuple[Snapshot | None, Snapshot | None]:
        """The state of a table and the one before it, from the properties of its view."""
        if not self.exists(table):
            return None, None
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        properties = {r["key"]: r["value"] for r in rows if r["key"].startswith(_STATE)}
        return Snapshot.of(properties, "now"), Snapshot.of(properties, "before")

    def _point(self, table: str, now: Snapshot, before: Snapshot | None) -> None:
        """Commit: from here on the table is ``now``."""
        if self._snapshots(table)[0] != before:
            raise RuntimeError(f"{table} was changed by another writer")
        hidden = {VERSION, DIGEST} | (set() if len(now.versions) > 1 else {BUCKET})
        columns = ", ".join(_quoted(c) for c in self.spark.table(self.name(now.data)).columns if c not in hidden)
        properties = now.properties("now") | (before.properties("before") if before else {})
        listed = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} TBLPROPERTIES ({listed}) AS "
                       f"SELECT {columns} FROM {self.name(now.data)} WHERE {now.condition()}")
        with suppress(Exception):  # the commit stands; what is left now goes with the next one
            self._sweep(table, [state for state in (now, before) if state])

    def _sweep(self, table: str, needed: Sequence[Snapshot]) -> None:
        """Drop what neither the table nor its former state reads, also what runs that were cut off left behind."""
        kinds = tuple(f"{table}__{kind}_" for kind in ("data", "staging", "changed", "marks", "parents"))
        names = [t.tableName for t in self.spark.sql(f"SHOW TABLES IN {self.namespace} LIKE '{table}__*'").collect()]
        for name in names:
            if name.startswith(kinds) and not name.endswith(self.run_id) and name not in {state.data for state in needed}:
                self._discard(name)
        data = needed[0].data
        kept = {f"{BUCKET}={b}/{VERSION}={v}" for state in needed if state.data == data for b, v in enumerate(state.versions)}
        stale = [r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.name(data)}").collect() if r[0] not in kept]
        if stale:
            parts = [dict(part.split("=", 1) for part in one.split("/")) for one in stale]
            listed = ", ".join(f"PARTITION ({BUCKET} = {p[BUCKET]}, {VERSION} = '{p[VERSION]}')" for p in parts)
            self.spark.sql(f"ALTER TABLE {self.name(data)} DROP IF EXISTS {listed}")

    # ---- writes --------------------------------------------------------------

    def replace_all(self, spec: TableSpec, rows: DataFrame, dedup: bool = True) -> Written:
        """The table becomes ``rows``, with their schema; no rows empties it."""
        if dedup:
            rows = newest_counted(rows, spec.key, spec.order_by, tie_of(rows), COPIES)
        return self._replace(spec, rows.drop(SEQ))

    def upsert(self, spec: TableSpec, rows: DataFrame, marks: DataFrame | None = None, unique: bool = False) -> Written:
        """Merge the rows and flag the ids of ``marks`` in one rewrite.

        Rows equal to the stored ones but for the time they were read, and
        marks that change nothing, touch nothing.
        """
        self.ensure(spec)
        with self._staged(spec, rows) as (staged, outcome):
            written = outcome()
            fresh = staged if unique else apply.overwrite(staged, spec.key, spec.order_by, tie_of(rows))
            with self._staged(spec, self._changed(spec, fresh.drop(SEQ)), suffix="changed") as (changed, differing):
                written = replace(written, changed=differing().rows)
                if marks is None:
                    return self._rewrite(spec, changed, lambda old: apply.upsert(
                        old, changed, spec.key, spec.order_by, unique=True, count=written.changed), written)
                needed = apply.needed_marks(self.read(spec.name), marks, changed)
                with self._staged(spec, needed, order_by="archived_at", suffix="marks") as (flags, _):
                    touching = changed.select(*spec.bucket_by).unionByName(flags.select(*spec.bucket_by))
                    return self._rewrite(spec, touching, lambda old: apply.flag_archived(
                        apply.upsert(old, changed, spec.key, spec.order_by, unique=True, count=written.changed), flags), written)

    def flag_archived(self, spec: TableSpec, marks: DataFrame) -> int:
        """Flag the ids of ``marks`` (``id``, ``archived_at``) archived; returns how many rows that changes."""
        needed = apply.needed_marks(self.read(spec.name), marks)
        with self._staged(spec, needed, order_by="archived_at", suffix="marks") as (staged, outcome):
            return self._rewrite(spec, staged, lambda old: apply.flag_archived(old, staged), outcome()).rows

    def replace_by_parent(self, spec: TableSpec, rows: DataFrame, parents: DataFrame) -> Written:
        """All rows of the listed parents give way to the staged ones; parents whose rows are the stored ones touch nothing."""
        self.ensure(spec)
        with self._staged(spec, rows) as (staged, outcome), \
                self._staged(spec, parents, order_by=spec.parent, suffix="parents") as (listed, _):
            fresh = apply.overwrite(staged, spec.key, spec.order_by, tie_of(rows)).drop(SEQ)
            differing = changed_groups(fresh, self._stored(spec, listed), listed, spec.parent, spec.key, STAMP)
            with self._staged(spec, differing, order_by=spec.parent, suffix="changed") as (changed, _):
                new = fresh.join(changed, spec.parent, "left_semi")
                added = fresh.join(listed, spec.parent, "left_anti")  # rows of parents that were not listed are added
                return self._rewrite(spec, changed.unionByName(added.select(spec.parent)), lambda old: apply.replace_by_parent(
                    old, new.unionByName(added), changed, spec.parent, spec.key, spec.order_by), outcome())

    @contextmanager
    def _staged(self, spec: TableSpec, rows: DataFrame, order_by: str | None = None,
                suffix: str = "staging") -> Iterator[tuple[DataFrame, Callable[[], Written]]]:
        """The delta as a table of its own, parsed once and counted while it is written."""
        staging = f"{spec.name}__{suffix}_{self.run_id}"
        try:
            watched, outcome = observed(rows, order_by or spec.order_by)
            watched.write.format(self.provider).mode("overwrite").saveAsTable(self.name(staging))
            yield self.spark.table(self.name(staging)), outcome
        finally:
            self._discard(staging)

    def _stored(self, spec: TableSpec, near: DataFrame) -> DataFrame:
        """Stored rows with their digests, of the buckets that some rows belong to."""
        now, _ = self._snapshots(spec.name)
        stored = self.spark.table(self.name(now.data)).where(now.condition())
        return stored.where(F.col(BUCKET).isin(_buckets_of(spec, near, len(now.versions)))) if len(now.versions) > 1 else stored

    def _changed(self, spec: TableSpec, fresh: DataFrame) -> DataFrame:
        return changed_rows(fresh.select(*self.read(spec.name).columns), self._stored(spec, fresh), spec.key, STAMP)

    def _rewrite(self, spec: TableSpec, delta: DataFrame, new: Callable[[DataFrame], DataFrame], written: Written) -> Written:
        """Write the buckets anew that the delta's rows belong to; none, and nothing happens."""
        now, _ = self._snapshots(spec.name)
        touched = _buckets_of(spec, delta, len(now.versions))
        if touched:
            old = self.spark.table(self.name(spec.name))
            if BUCKET in old.columns:
                old = old.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
            version = uuid.uuid4().hex[:8]
            self._write(now.data, new(old), spec, len(now.versions), version)
            self._point(spec.name, replace(now, versions=tuple(version if b in touched else v for b, v in enumerate(now.versions))), now)
        return replace(written, touched=len(touched))

    def _replace(self, spec: TableSpec, result: DataFrame) -> Written:
        version, buckets = uuid.uuid4().hex[:8], self.buckets or 1
        data = f"{spec.name}__data_{version}"
        try:
            ddl = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in result.schema if f.name != COPIES)
            self.spark.sql(f"CREATE TABLE {self.name(data)} ({ddl}, {DIGEST} BINARY, {BUCKET} INT, {VERSION} STRING) "
                           f"USING {self.provider} PARTITIONED BY ({BUCKET}, {VERSION})")
            outcome = self._write(data, result, spec, buckets, version)
            self._point(spec.name, Snapshot(data, (version,) * buckets), self._snapshots(spec.name)[0])
        except Exception:
            self._discard(data)
            raise
        return replace(outcome(), touched=buckets)

    def _write(self, data: str, result: DataFrame, spec: TableSpec, buckets: int, version: str) -> Callable[[], Written]:
        bucket = _bucket(spec, buckets) if buckets > 1 else F.lit(0)
        rows = result.withColumns({DIGEST: row_digest(result, (*STAMP, COPIES)), BUCKET: bucket, VERSION: F.lit(version)})
        if buckets > 1:
            rows = rows.hint("rebalance", BUCKET)  # whole files per bucket, big buckets split
        watched, outcome = observed(rows, spec.order_by)
        watched.drop(COPIES).write.insertInto(self.name(data))
        return outcome


def observed(rows: DataFrame, order_by: str) -> tuple[DataFrame, Callable[[], Written]]:
    """Count rows and find the newest time while they are written, without another pass.

    Only right next to a write: a stage whose output is shuffled may run again
    after a lost executor and would be counted twice.
    """
    seen = Observation()
    is_time = rows.schema[order_by].dataType.typeName().startswith("timestamp")
    at = instant_micros(F.col(order_by)) if is_time else F.lit(None).cast("bigint")
    handed_in = F.sum(COPIES) if COPIES in rows.columns else F.count(F.lit(1))
    watched = rows.observe(seen, handed_in.alias("rows"), F.max(at).alias("newest"))
    return watched, lambda: Written(seen.get["rows"] or 0, from_micros(seen.get["newest"]))


def tie_of(rows: DataFrame) -> list[str]:
    return [SEQ] if SEQ in rows.columns else []


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _bucket(spec: TableSpec, buckets: int) -> Column:
    return F.pmod(F.hash(*spec.bucket_by), F.lit(buckets)).cast("int")


def _buckets_of(spec: TableSpec, rows: DataFrame, buckets: int) -> list[int]:
    """The buckets some rows belong to: at most ``buckets`` numbers reach the driver."""
    if buckets == 1:
        return [] if rows.isEmpty() else [0]
    return sorted(r[0] for r in rows.select(_bucket(spec, buckets).alias("b")).distinct().collect())
