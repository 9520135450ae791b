"""Reading landed document files."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakesync.operators.windows import from_micros
from lakesync.plans.documents import first_schema
from lakesync.sources import schema_days as days
from lakesync.sources.documents import document_schema, documents_type, read_document_files, read_documents
from lakesync.sources.landing import DAY
from lakesync.sources.listing import landed_files, listing_items


@pytest.fixture
def folder(tmp_path):
    docs = [{"_id": str(i), "n": i, "price": i / 4, "at": f"2026-01-0{i + 1}T00:00:00Z", "tags": ["a", "b"][: i % 3],
             "awards": {"wins": i}} for i in range(6)]
    (tmp_path / "docs.json").write_text("\n".join(json.dumps(d) for d in docs))
    return str(tmp_path)


def test_files_read_with_a_pruned_schema_match_payloads(spark, folder):
    lines = landed_files(spark, folder)
    schema = first_schema(lines, fields=["price", "awards"], watermark_field="at")
    assert schema.names == ["_id", "at", "awards", "price"]
    direct = read_document_files(spark, folder, schema)
    assert sorted(direct.collect()) == sorted(read_documents(lines, schema, "at").collect())
    assert "ReadSchema: struct<_id:string,price:decimal(38,10)>" in direct.select("_id", "price")._jdf.queryExecution(
    ).executedPlan().toString().replace("...", "")


def test_window_over_documents(spark, folder):
    lines = landed_files(spark, folder)
    schema = first_schema(lines, watermark_field="at")
    since, until = from_micros(1767312000000000), from_micros(1767484800000000)  # 2026-01-02, 2026-01-04
    docs = read_documents(lines, schema, "at", since, until, overlap_seconds=0)
    assert sorted(r["_id"] for r in docs.collect()) == ["1", "2", "3"]
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1  # each document is parsed once, window or not


def test_issue_pages_keep_their_place(spark, tmp_path):
    page = {"issues": [{"key": "A-1"}, {"key": "A-2"}], "isLast": True}
    (tmp_path / "page.json").write_text(json.dumps(page))
    items = listing_items(landed_files(spark, str(tmp_path)), "issues", keep=["source"])
    assert sorted((r["item"], r["payload"]) for r in items.collect()) == [(0, '{"key":"A-1"}'), (1, '{"key":"A-2"}')]
    assert all(r["source"].endswith("page.json") for r in items.collect())


def test_dates_in_milliseconds(spark):
    """Exported dates as text, as numbers of milliseconds in either spelling, in lists and objects too."""
    rows = ['{"_id":"1","at":{"$date":{"$numberLong":"1770091506007"}},"o":{"d":{"$date":-1500}},"l":[{"$date":{"$numberLong":"0"}},{"$date":"1970-01-01T00:00:01Z"}]}',
            '{"_id":"2","at":{"$date":"2026-02-03T04:05:06.007Z"},"t":"{\\"$date\\": 5}"}', '{"_id":"3","at":null,"o":null,"l":[]}']
    lines = spark.createDataFrame([(r,) for r in rows], "payload string")
    schema = document_schema(lines)
    assert schema.simpleString() == "struct<_id:string,at:timestamp,l:array<timestamp>,o:struct<d:timestamp>,t:string>"
    micros = F.struct("_id", F.unix_micros("at"), F.transform("l", lambda x: F.unix_micros(x)), F.unix_micros(F.col("o.d")), "t")
    found = sorted(tuple(r[0]) for r in read_documents(lines, schema, "at").select(micros).collect())
    assert found == [("1", 1770091506007000, [0, 1000000], -1500000, None), ("2", 1770091506007000, None, None, '{"$date": 5}'), ("3", None, [], None, None)]


def test_schemas_of_days_merge_and_old_days_are_not_read(spark, tmp_path):
    landed = {date(2026, 1, 1): [{"_id": "1", "n": 1, "o": {"a": 1}, "l": [1]}, {"_id": "2", "mixed": 1}],
              date(2026, 1, 2): [{"_id": "3", "n": 1.5, "o": {"b": "x"}, "l": ["y"], "mixed": "text"}],
              date(2026, 1, 3): [{"_id": "4", "n": 10**12, "z": None, "mixed": [1]}, {"_id": "5", "z": {"$date": 5}}]}
    path = str(tmp_path / "days")

    def land(day):
        rows = spark.createDataFrame([(json.dumps(d), day) for d in landed[day]], f"payload string, {DAY} date")
        rows.write.mode("append").partitionBy(DAY).parquet(path)
        return spark.read.parquet(path)

    known = None
    for number, day in enumerate(landed):
        lines = land(day)
        found = days.day_schemas(lines, known)
        rows = found.collect()
        assert {r["day"] for r in rows} == set(list(landed)[max(0, number - 1):number + 1])  # the last known day may have grown
        fresh = spark.createDataFrame(rows, days.STATE)
        known = fresh if known is None else spark.createDataFrame(days.updated(known, fresh).collect(), days.STATE)
        assert documents_type(days.whole_schema(r["found"] for r in known.collect())) == document_schema(lines)
    plan = days.day_schemas(lines, known)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landed" in plan and "2026-01-03" in plan
