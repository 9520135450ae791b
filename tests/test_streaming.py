"""Landing files as a stream: same table as one batch, whatever the order, and over restarts."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from lakesync.operators import apply
from lakesync.operators.dedup import newest
from lakesync.plans.store import TableStore
from lakesync.schemas import TableSpec
from lakesync.sources.listing import landed_files
from lakesync.streaming.landing import landed_stream, upsert_stream
from lakesync.streaming.newest import newest_changes, write_changes
from tests.conftest import SF

EVENTS = TableSpec("events", (("user_id", "BIGINT"), ("event_type", "STRING"), ("ts", "TIMESTAMP"), ("value", "DOUBLE")),
                   key=("user_id", "event_type"), order_by="ts")


def event_rows(payloads):
    return payloads.select(F.from_json("payload", EVENTS.ddl).alias("e")).select("e.*")


@pytest.fixture
def lines(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "event_type", "ts", "value").orderBy("ts").collect()
    return [json.dumps({"user_id": r[0], "event_type": r[1], "ts": r[2].isoformat(), "value": r[3]}) for r in events]


def land(folder, number, lines):
    path = folder / f"part-{number}.json"
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + 60 * number,) * 2)  # files are read in the order they landed


def rows(df):
    return sorted(tuple(r) for r in df.select("user_id", "event_type", F.unix_micros("ts"), "value").collect())


def test_ordered_stream_equals_batch_and_restarts(spark, namespace, tmp_path, lines):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = TableStore(spark, namespace, buckets=4)
    third = len(lines) // 3

    def run():
        stream = landed_stream(spark, str(landing), max_files=1)
        query = upsert_stream(stream, event_rows, store, EVENTS, str(tmp_path / "progress"))
        query.awaitTermination()
        return [p["numInputRows"] for p in query.recentProgress]

    land(landing, 0, lines[:third])
    run()
    # overlapping re-reads in later files change nothing
    land(landing, 1, lines[third - 50:2 * third])
    land(landing, 2, lines[2 * third - 50:])
    assert sum(run()) == len(lines) - third + 100  # the first file is not read again
    assert sum(run() or [0]) == 0
    batch = event_rows(landed_files(spark, str(landing)))
    assert rows(store.read("events")) == rows(apply.overwrite(batch, EVENTS.key, EVENTS.order_by))


def test_late_rows_are_kept(spark, namespace, tmp_path, lines):
    """Rows far behind the newest one seen still arrive: nothing is dropped by event time."""
    landing = tmp_path / "landing"
    landing.mkdir()
    unique = {(json.loads(x)["user_id"], json.loads(x)["event_type"]): x for x in lines}
    shuffled = list(unique.values())
    random.Random(5).shuffle(shuffled)
    for i in range(4):
        land(landing, i, shuffled[i::4])
    store = TableStore(spark, namespace, buckets=4)
    stream = landed_stream(spark, str(landing), max_files=1)
    upsert_stream(stream, event_rows, store, EVENTS, str(tmp_path / "progress")).awaitTermination()
    assert store.read("events").count() == len(unique)


def test_failed_batch_is_run_again(spark, namespace, tmp_path, lines):
    landing = tmp_path / "landing"
    landing.mkdir()
    land(landing, 0, lines)
    store = TableStore(spark, namespace, buckets=4)

    def broken(payloads):
        return event_rows(payloads).withColumn("value", F.raise_error(F.lit("no")).cast("double"))

    with pytest.raises(Exception, match="no"):
        upsert_stream(landed_stream(spark, str(landing)), broken, store, EVENTS,
                      str(tmp_path / "progress")).awaitTermination()
    assert store.read("events").count() == 0
    upsert_stream(landed_stream(spark, str(landing)), event_rows, store, EVENTS,
                  str(tmp_path / "progress")).awaitTermination()
    assert store.read("events").count() > 0


def test_changes_of_keyed_state_equal_batch_over_restarts(spark, tmp_path, lines):
    """Late and repeated rows write nothing; what was written holds the newest row of every key, after each run."""
    landing = tmp_path / "landing"
    landing.mkdir()
    numbered = [json.dumps({**json.loads(line), "seq": n}) for n, line in enumerate(lines)]
    missing = [json.dumps({"user_id": n, "event_type": None, "ts": None, "value": n, "seq": 10**6 + at}) for at, n in enumerate((1, 1, None))]
    random.Random(2).shuffle(numbered)
    third = len(numbered) // 3
    ddl = EVENTS.ddl + ", seq BIGINT"

    def read(payloads):
        return payloads.select(F.from_json("payload", ddl).alias("e")).select("e.*")

    written = []
    for number, some in enumerate((numbered[:third] + missing, numbered[third - 40:2 * third], numbered, numbered[:5])):
        land(landing, number, some)
        changes = newest_changes(read(landed_stream(spark, str(landing), max_files=1)), EVENTS.key, "ts", "seq")
        write_changes(changes, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
        log = spark.read.schema(ddl).parquet(str(tmp_path / "out"))
        found = newest(log, EVENTS.key, "ts", ["seq"])
        batch = newest(read(landed_files(spark, str(landing))), EVENTS.key, "ts", ["seq"])
        as_text = lambda df: sorted(repr(tuple(r)) for r in df.select("user_id", "event_type", F.unix_micros("ts"), "value", "seq").collect())
        assert as_text(found) == as_text(batch)
        written.append(log.count())
    assert written[3] == written[2] < len(numbered)  # the last file held nothing new


def test_stream_into_a_table_without_buckets_is_refused(spark, namespace, tmp_path):
    with pytest.raises(ValueError, match="buckets"):
        upsert_stream(landed_stream(spark, str(tmp_path)), event_rows, TableStore(spark, namespace), EVENTS, str(tmp_path / "progress"))
