"""Rows parsed from payloads are taken for few bytes; joins of them must not send them through the driver."""

from datetime import datetime

from pyspark.sql import functions as F

from lakesync.mapping.crm import link_rows, open_cursors
from lakesync.operators import apply
from lakesync.plans.crm import linked_names


def planned(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def link_page(n, after=None):
    paging = f',"paging":{{"next":{{"after":"{after}"}}}}' if after else ""
    return f'{{"results":[{{"from":{{"id":"{n}"}},"to":[{{"toObjectId":{n % 2},"associationTypes":[{{"typeId":1,"category":"A"}}]}}]{paging}}}]}}'


def test_answered_cursors_are_not_broadcast(spark):
    rows = [(link_page(1, "a"), None), (link_page(1, "b"), "a"), (link_page(2, "a"), None)]
    found = open_cursors(spark.createDataFrame(rows, "payload string, cursor string"))
    assert "BroadcastHashJoin" not in planned(found)
    assert sorted((r["from_id"], r["cursor"]) for r in found.collect()) == [("1", "b"), ("2", "a")]


def test_links_are_not_broadcast_but_a_small_end_is(spark):
    pages = spark.createDataFrame([(link_page(n),) for n in range(4)], "payload string")
    sources = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit("s").alias("s"))
    targets = spark.range(2).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") == 0, "even").otherwise("odd").alias("t"))
    links = link_rows(pages, "a", "b", datetime(2026, 1, 1))
    found = linked_names(links, sources, targets, "s", "t")
    plan = planned(found)
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
    assert sorted(tuple(r) for r in found.select("from_id", "to_name").collect()) == [("0", "even"), ("1", "odd"), ("2", "even"), ("3", "odd")]


def test_upsert_of_unknown_size_meets_by_one_shuffle(spark):
    ddl = "k string, n int, t int, v string"
    old = spark.createDataFrame([("a", 1, 1, "old"), ("b", 1, 9, "kept"), ("b", 1, 9, "kept"), ("c", None, 1, "kept"), ("c", None, 1, "kept")], ddl)
    new = spark.createDataFrame([("a", 1, 0, "x"), ("a", 1, 5, "y"), ("a", 1, 5, "z"), ("a", 1, None, "w"), ("c", None, 2, "x"), ("c", None, 3, "y")], ddl)
    found = apply.upsert(old, new, ["k", "n"], "t", ["v"])
    assert "Join" not in planned(found) and planned(found).count("WindowGroupLimit") == 2
    assert sorted((r["k"], r["n"] or 0, r["t"], r["v"]) for r in found.collect()) == [
        ("a", 1, 5, "z"), ("b", 1, 9, "kept"), ("b", 1, 9, "kept"), ("c", 0, 1, "kept"), ("c", 0, 1, "kept"), ("c", 0, 3, "y")]


def test_upsert_keeps_one_of_equal_staged_rows(spark):
    old = spark.range(50).select("id", F.lit(0).alias("t"))
    new = spark.range(0, 40, 1, 4).select(F.pmod("id", F.lit(10)).alias("id"), F.lit(1).alias("t"))
    found = [tuple(r) for r in apply.upsert(old, new, ["id"], "t").collect()]
    assert sorted(found) == [(n, 1) for n in range(10)] + [(n, 0) for n in range(10, 50)]
