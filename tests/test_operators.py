"""Operators on small fixtures, with expected rows worked out by hand or by plain Python."""

import json
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from lakesync.operators import apply, quality, ranking, state, tree, windows
from lakesync.operators.dedup import newest
from lakesync.sources import documents, listing

UTC = timezone.utc


def at(minute, second=0, micro=0):
    return datetime(2026, 1, 1, 0, minute, second, micro, tzinfo=UTC)


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


# ---- newest row, upsert and friends --------------------------------------------

def test_newest_row_wins_and_later_arrival_breaks_ties(spark):
    rows = frame(spark, [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4), ("b", 0, 5), ("c", None, 6), ("c", None, 7)],
                 "k string, t int, seq int")
    assert sorted_rows(newest(rows, ["k"], "t", ["seq"])) == [("a", 2, 3), ("b", 0, 5), ("c", None, 7)]


def test_newest_prunes_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("id % 3 as k", "id as t")
    plan = newest(rows, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_upsert_replaces_even_newer_rows_and_adds(spark):
    old = frame(spark, [("a", 9, "old"), ("b", 1, "old")], "k string, t int, v string")
    delta = frame(spark, [("a", 2, "x"), ("a", 3, "y"), ("c", 1, "z")], "k string, t int, v string")
    assert sorted_rows(apply.upsert(old, delta, ["k"], "t")) == [("a", 3, "y"), ("b", 1, "old"), ("c", 1, "z")]


def shuffled_rows(df):
    """Rows each exchange of an executed frame wrote."""
    found, plan = [], df._jdf.queryExecution().executedPlan()

    def look(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return look(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return look(node.plan())
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        for n in range(node.children().size()):
            look(node.children().apply(n))

    look(plan)
    return found


def test_most_rows_pass_by_the_join_with_a_delta_too_big_to_broadcast(spark):
    target = spark.range(200_000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(1).alias("t"))
    delta = spark.range(0, 400_000, 100).select(F.col("id").alias("k"), F.lit("new").alias("v"), F.lit(2).alias("t"))
    nulls = frame(spark, [(None, "null key", 1)], "k bigint, v string, t int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")
    try:
        merged = apply.upsert(target.unionByName(nulls), delta, ["k"], "t", unique=True, count=4000)
        counts = {(r["v"]): r["n"] for r in merged.groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert counts == {"old": 198_000, "new": 4000, "null key": 1}
        kept = apply.without_keys(target, delta, ["k"], 4000)
        assert len(kept.collect()) == 198_000
        assert max(shuffled_rows(kept)) < 200_000 / 4  # the map is built from, and the join moves, thousands of rows
        whole = apply.without_keys(target, delta, ["k"])
        assert len(whole.collect()) == 198_000 and max(shuffled_rows(whole)) == 200_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_null_in_key_never_matches(spark):
    ddl = "k string, n int, t int"
    old = frame(spark, [("a", None, 1), ("b", 1, 1)], ddl)
    delta = frame(spark, [("a", None, 2), ("a", None, 3), ("b", 1, 2)], ddl)
    assert sorted_rows(apply.upsert(old, delta, ["k", "n"], "t")) == [("a", None, 1), ("a", None, 3), ("b", 1, 2)]


def test_flag_archived_touches_only_flag_and_time(spark):
    old = frame(spark, [("a", False, None, "x"), ("b", False, None, "y"), ("c", True, 5, "z")],
                "id string, archived boolean, archived_at int, v string")
    marks = frame(spark, [("a", None), ("a", 7), ("a", 3), ("c", None), ("gone", 1)], "id string, archived_at int")
    assert sorted_rows(apply.flag_archived(old, marks)) == [
        ("a", True, 7, "x"), ("b", False, None, "y"), ("c", True, None, "z")]


def test_replace_by_parent_clears_listed_parents(spark):
    ddl = "page_id string, id string, t int"
    old = frame(spark, [("p", "1", 1), ("p", "2", 1), ("q", "1", 1), ("r", "1", 1)], ddl)
    delta = frame(spark, [("p", "2", 2), ("p", "3", 2)], ddl)
    parents = frame(spark, [("p",), ("q",), ("p",)], "page_id string")
    assert sorted_rows(apply.replace_by_parent(old, delta, parents, "page_id", ["page_id", "id"], "t")) == [
        ("p", "2", 2), ("p", "3", 2), ("r", "1", 1)]


# ---- windows --------------------------------------------------------------------

@pytest.fixture
def dated(spark):
    minutes = [(i, at(0, i // 2, 500_000 * (i % 2))) for i in range(120)] + [(120, None)]
    return frame(spark, minutes, "i int, t timestamp")


def ids(df):
    return [r[0] for r in df.select("i").orderBy("i").collect()]


def test_window_bounds(dated):
    assert ids(windows.closed(dated, "t", at(0, 10), at(0, 12), 5)) == list(range(10, 25))
    assert ids(windows.half_open(dated, "t", at(0, 10), at(0, 12), 5)) == list(range(10, 24))
    assert ids(windows.closed(dated, "t", None, at(0, 12))) == list(range(121))
    assert ids(windows.open_ended(dated, "t", at(0, 59), 1)) == [116, 117, 118, 119]
    assert ids(windows.open_ended(dated, "t", None)) == list(range(120))
    # bounds are cut to the minute: 00:00:59 becomes 00:00:00
    assert ids(windows.by_minute(dated, "t", None, at(0, 59))) == [0]
    assert ids(windows.by_minute(dated, "t", at(0, 30), at(1, 30), 0)) == list(range(120))


def test_window_bound_is_cut_to_the_millisecond(spark):
    df = frame(spark, [(0, at(0, 1, 1_000)), (1, at(0, 1, 1_400)), (2, at(0, 1, 2_000))], "i int, t timestamp")
    assert ids(windows.half_open(df, "t", at(0, 1, 1_900), at(0, 1, 2_900), 0)) == [0, 1]
    assert ids(windows.closed(df, "t", at(0, 1, 1_000), at(0, 1, 1_900), 0)) == [0]


# ---- numbering --------------------------------------------------------------------

def test_ordered_index_with_one_group_holding_most_rows(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", i * 7919 % 100_003) for i in range(5000)]
    df = frame(spark, rows, "g string, o int").repartition(6)
    got = {(r["g"], r["o"]): r["position"] for r in ranking.ordered_index(df, ["o"], ["g"]).collect()}
    groups = {}
    for g, o in sorted(rows):
        groups.setdefault(g, []).append(o)
    assert got == {(g, o): i for g, os in groups.items() for i, o in enumerate(os)}


@pytest.mark.parametrize("cap", [1, 7, 100, 1000, 5000])
def test_keyset_chunks_lose_and_repeat_nothing(spark, cap):
    numbers = sorted(random.Random(cap).sample(range(10 ** 12), 1000))
    df = frame(spark, [(str(n),) for n in numbers], "id string")
    chunks = [r.asDict() for r in ranking.keyset_chunks(df, "id", cap).orderBy("chunk").collect()]
    last, read = None, []
    for chunk in chunks:
        assert chunk["after_id"] == last
        part = [n for n in numbers if (last is None or n > last) and n <= chunk["last_id"]]
        assert part[0] == chunk["first_id"] and len(part) == chunk["n_ids"] <= cap
        read += part
        last = chunk["last_id"]
    assert read == numbers


# ---- tree ---------------------------------------------------------------------------

def block(id, kind="paragraph", has_children=False, **body):
    import json
    return json.dumps({"object": "block", "id": id, "type": kind, "has_children": has_children, **body})


def walk(spark, children, roots=("page",)):
    rows = [(parent, i, payload) for parent, listed in children.items() for i, payload in enumerate(listed)]
    df = spark.createDataFrame(rows, "parent_id string, seq int, payload string")
    pages = spark.createDataFrame([(r,) for r in roots], "page_id string")
    blocks = tree.page_blocks(pages, df).withColumn("id", F.get_json_object("payload", "$.id"))
    return [(r["page_id"], r["id"], r["depth"], r["position"])
            for r in blocks.orderBy("page_id", "path").collect()]


def reference_walk(children, root):
    """Plain depth-first walk, the behaviour to match."""
    import json
    seen, out = set(), []

    def visit(parent, depth):
        for position, payload in enumerate(children.get(parent, [])):
            b = json.loads(payload)
            if b["id"] in seen:
                continue
            seen.add(b["id"])
            out.append((root, b["id"], depth, position))
            if b["has_children"] and b["type"] not in tree.NEVER_DESCEND:
                visit(b["id"], depth + 1)

    visit(root, 0)
    return out


def test_every_block_of_a_full_tree_has_its_place(spark):
    # a node is named by its path, so order, depth and position can be read off its name
    children, names = {}, ["t"]
    for name in names:
        if len(name) < 4:
            below = [name + digit for digit in "012"]
            children[name] = [block(b, has_children=len(b) < 4) for b in below]
            names += below
    expected = sorted(("t", n, len(n) - 2, int(n[-1])) for n in names if n != "t")
    assert walk(spark, children, ["t"]) == expected


def test_walk_ends_when_a_page_is_listed_below_itself(spark):
    children = {"page": [block("mid", has_children=True)], "mid": [block("page", has_children=True)]}
    assert walk(spark, children) == [("page", "mid", 0, 0), ("page", "page", 1, 0)]


def test_lists_landed_twice_and_children_without_order(spark):
    rows = [("p", None, 2, block("n")), ("p", 0, 2, block("x")), ("p", 0, 2, block("y")), ("p", 0, 1, block("gone")), ("q", 5, 1, block("w"))]
    df = spark.createDataFrame(rows, "parent_id string, seq int, landing int, payload string")
    pages = spark.createDataFrame([("p",), ("q",)], "page_id string")
    found = tree.page_blocks(pages, df, landing="landing").withColumn("id", F.get_json_object("payload", "$.id"))
    assert sorted((r["page_id"], r["position"], r["id"]) for r in found.collect()) == [("p", 0, "n"), ("p", 1, "x"), ("p", 2, "y"), ("q", 0, "w")]
    whole = tree.page_blocks(pages, df).withColumn("id", F.get_json_object("payload", "$.id"))
    assert sorted(r["position"] for r in whole.where("page_id = 'p'").collect()) == [0, 1, 2, 3]


def test_walk_stops_at_other_pages_references_and_leaves(spark):
    children = {
        "page": [block("p", "child_page", True), block("d", "child_database", True), block("leaf"),
                 block("copy", "synced_block", True, synced_block={"synced_from": {"block_id": "x"}}),
                 block("original", "synced_block", True, synced_block={"synced_from": None})],
        "p": [block("p1")], "d": [block("d1")], "leaf": [block("l1")], "copy": [block("c1")], "original": [block("o1")]}
    assert [r[1] for r in walk(spark, children)] == ["p", "d", "leaf", "copy", "original", "o1"]


def test_walk_ends_on_cycles_and_keeps_first_occurrence(spark):
    children = {"page": [block("a", has_children=True), block("x"), block("b", has_children=True)],
                "a": [block("b", has_children=True), block("a", has_children=True)], "b": [block("x"), block("a", has_children=True)]}
    assert walk(spark, children) == reference_walk(children, "page")


def test_walk_matches_plain_recursion_on_random_graphs(spark):
    rnd = random.Random(11)
    for _ in range(4):
        names = [f"n{i}" for i in range(12)]
        # one payload per block: what a block is does not depend on where it is listed
        shape = {n: block(n, rnd.choice(["paragraph", "paragraph", "child_page"]), rnd.random() < 0.8) for n in names}
        children = {p: [shape[rnd.choice(names)] for _ in range(rnd.randint(0, 4))] for p in ["page", "other", *names]}
        expected = reference_walk(children, "other") + reference_walk(children, "page")
        assert walk(spark, children, ("page", "other")) == expected


def test_walk_with_pages_listed_as_blocks(spark):
    """Pages that are blocks of themselves or of each other, below and above blocks that are listed once."""
    rnd = random.Random(3)
    for _ in range(3):
        names = [f"n{i}" for i in range(14)]
        shape = {n: block(n, "paragraph", rnd.random() < 0.9) for n in [*names, "page", "other"]}
        children, left = {p: [] for p in ["page", "other", *names]}, [*names, "page", "other"]
        rnd.shuffle(left)
        for child in left + rnd.sample(names, 2):  # most are listed once
            children[rnd.choice([*children])].append(shape[child])
        assert walk(spark, children, ("page", "other")) == reference_walk(children, "other") + reference_walk(children, "page")


def test_long_chain_in_few_rounds(spark, monkeypatch):
    """10,000 blocks below each other, and a repeated one half-way down, in a few joins more than binary digits."""
    scratch = tree.Scratch(spark)
    rounds, cut = [], tree.Scratch.cut
    monkeypatch.setattr(tree.Scratch, "cut", lambda self, df: rounds.append(1) or cut(self, df))
    rows = [("page", "b0", 0, 0, True)] + [(f"b{n}", f"b{n + 1}", n + 1, 0, True) for n in range(9_999)] + [("page", "b5000", 10_000, 1, True)]
    edges = spark.createDataFrame(rows, "parent_id string, id string, edge bigint, position int, descend boolean").repartition(4)
    pages = spark.createDataFrame([("page",)], "page_id string")
    # paths of the chain are as long as it is deep, so only their sizes leave the executors
    found = {r["id"]: r["depth"] for r in tree.walk(pages, edges, scratch).select("id", "depth").collect()}
    assert found == {f"b{n}": n for n in range(10_000)}
    assert len(rounds) <= 20 + 4


# ---- state -------------------------------------------------------------------------

CRM = "object_name string, watermark timestamp, last_mode string, last_status string, last_rows bigint, last_run_at timestamp"
OUTCOME = "object_name string, watermark timestamp, last_mode string, last_rows bigint, last_run_at timestamp, last_error string"


def test_failure_keeps_watermark(spark):
    old = frame(spark, [("a", at(1), "full", "SUCCESS", 5, at(1)), ("z", at(2), "full", "SUCCESS", 1, at(2))], CRM)
    outcome = frame(spark, [("a", None, "incremental", None, at(9), "boom"), ("b", None, "full", None, at(9), "boom")], OUTCOME)
    got = {r["object_name"]: r for r in state.record_failure(old, outcome).collect()}
    assert got["a"]["last_rows"] == 5 and got["a"]["watermark"] is not None and got["a"]["last_status"] == "FAILED"
    assert got["a"]["last_mode"] == "incremental" and got["b"]["watermark"] is None and got["b"]["last_rows"] is None
    assert got["z"]["last_status"] == "SUCCESS"

    with_error = old.withColumn("last_error", F.lit(None).cast("string"))
    got = {r["object_name"]: r for r in state.record_failure(with_error, outcome).collect()}
    assert got["a"]["last_rows"] == 0 and got["a"]["last_error"] == "boom" and got["a"]["watermark"] is not None
    again = state.record_success(
        state.record_failure(with_error, outcome),
        frame(spark, [("a", at(7), "cdc", 3, at(10), None)], OUTCOME))
    row = again.filter("object_name = 'a'").first()
    assert (row["last_status"], row["last_rows"], row["last_error"]) == ("SUCCESS", 3, None)


def test_plans(spark):
    objects = frame(spark, [("users",), ("pages",), ("blocks",)], "object_name string")
    stored = frame(spark, [("users", at(1)), ("pages", at(1))], "object_name string, watermark timestamp")
    rules = dict(always_full=["users"], changed="cdc")
    plan = {r["object_name"]: (r["mode"], r["note"]) for r in state.state_plan(objects, stored, False, **rules).collect()}
    assert plan == {"users": ("full", "no change tracking"), "pages": ("cdc", None), "blocks": ("full", "first run")}
    plan = {r["object_name"]: (r["mode"], r["note"]) for r in state.state_plan(objects, stored, True, **rules).collect()}
    assert plan == {"users": ("full", "no change tracking"), "pages": ("full", None), "blocks": ("full", None)}
    facts = frame(spark, [(True, True, at(1)), (False, False, None), (False, True, None), (False, True, at(1))],
                  "full_requested boolean, table_exists boolean, watermark timestamp")
    assert [r["mode"] for r in state.table_plan(facts).collect()] == ["full refresh", "full", "full re-read", "incremental"]


def test_one_object_without_bound_means_no_bound(spark):
    both = frame(spark, [(3,), (1,)], "t int")
    assert both.agg(state.shared_threshold(F.col("t"))).first()[0] == 1
    assert both.unionByName(frame(spark, [(None,)], "t int")).agg(state.shared_threshold(F.col("t"))).first()[0] is None


# ---- checks and sources -----------------------------------------------------------------

def test_paging_faults(spark):
    pages = frame(spark, [("ok", "1", False), ("ok", None, True), ("rep", "1", False), ("rep", "1", False),
                          ("rep", None, True), ("cut", "1", False), ("cut", None, False), ("open", "1", False)],
                  "listing string, token string, is_last boolean")
    strict = {r["listing"]: r["status"] for r in quality.paging_faults(pages, "listing", True).collect()}
    assert strict == {"ok": "ok", "rep": "repeated token", "cut": "no token on a page that is not last",
                      "open": "no last page"}
    loose = {r["listing"]: r["status"] for r in quality.paging_faults(pages, "listing", False).collect()}
    assert loose == {"ok": "ok", "rep": "ended by repeated cursor", "cut": "ok", "open": "ok"}


def test_key_check_counts_null_keys_out(spark):
    df = frame(spark, [("a", 1), ("a", 1), ("b", None), ("b", 2)], "k string, n int")
    assert tuple(quality.key_check(df, ["k", "n"]).first()) == (4, 2)


def test_untolerated_errors(spark):
    page = '{"errors":[{"category":"OBJECT_NOT_FOUND"},{"category":"VALIDATION_ERROR","message":"m"},{"message":"n"}]}'
    found = quality.untolerated_errors(frame(spark, [(page,), ("{}",)], "payload string"), ["OBJECT_NOT_FOUND"])
    assert sorted(r["message"] for r in found.collect()) == ["m", "n"]
    with pytest.raises(RuntimeError, match="batch read failed"):
        quality.fail_on(found, "batch read failed")


def test_listing_items_keep_payload_text(spark):
    pages = frame(spark, [('{"results":[{"id":"1","n":1.0},{"id":"2"}]}',), ('{"results":[]}',), ("{}",)], "payload string")
    assert sorted_rows(listing.listing_items(pages)) == [(0, '{"id":"1","n":1.0}'), (1, '{"id":"2"}')]


def test_changes_skip_partial_objects(spark):
    feed = frame(spark, [('{"object":"page","id":"1","last_edited_time":"2026-01-01T00:05:00Z"}',),
                         ('{"object":"page","id":"2"}',), ('{"object":"database","id":"3","last_edited_time":"2026-01-01"}',),
                         ('{"object":"page","id":"4","last_edited_time":"2026-01-01T00:04:59Z"}',)], "payload string")
    assert listing.changes_since(feed, "page").count() == 2
    assert listing.changes_since(feed, "page", at(6), 60).count() == 1


def test_read_schema_leaves_room():
    from pyspark.sql import types as T
    for scale, wide in ((0, 10), (10, 10), (11, 11), (38, 38)):
        assert documents.widen(T.DecimalType(38, scale)) == T.DecimalType(38, wide)
    nested = T.StructType.fromDDL("_id string not null, a array<struct<k map<string, array<int>>, f float>> not null, b boolean")
    assert documents.read_schema(nested).simpleString() == "struct<_id:string,a:array<struct<k:map<string,array<bigint>>,f:float>>,b:boolean>"
    assert all(f.nullable for f in documents.read_schema(nested).fields)
    assert documents.read_schema(nested, ["a"], ["a"]).simpleString() == "struct<a:string>"
    with pytest.raises(ValueError, match="missing"):
        documents.read_schema(nested, fields=["b", "missing"])
    assert documents.kept_fields(["x"], ["y", "x"], "z") == ["_id", "x", "y", "z"] and documents.kept_fields([], ["y"], "z") == []


def test_schema_of_every_document(spark):
    few = [(json.dumps({"_id": "late", "n": 2.5, "rare": {"deep": [1, None]}, "OBJECT<x": True}),)]
    lines = frame(spark, [(json.dumps({"_id": str(i), "n": i, "m": i if i % 2 else "odd", "none": None}),) for i in range(300)] + few, "payload string")
    found = documents.read_schema(documents.document_schema(lines))
    assert {f.name: f.dataType.simpleString() for f in found.fields} == {
        "_id": "string", "n": "decimal(38,10)", "m": "string", "none": "string", "rare": "struct<deep:array<bigint>>", "OBJECT<x": "boolean"}
    late = documents.read_documents(lines, found).where("_id = 'late'").first()
    assert float(late["n"]) == 2.5 and late["rare"]["deep"] == [1, None]
    with pytest.raises(Exception):
        documents.read_documents(frame(spark, [('{"n":"text"}',)], "payload string"), found).collect()
    with pytest.raises(ValueError):
        documents.read_documents(lines, found, since=at(1))


def test_a_sample_keeps_what_it_did_not_show(spark):
    from lakesync.plans.documents import first_schema

    seen = frame(spark, [('{"_id":"1","n":1}',)], "payload string")
    schema = first_schema(seen, sample_size=10)
    assert schema.names == ["_id", "n", "_extra"]
    later = frame(spark, [('{"_id":"2","n":2.5,"new":{"a":[1]},"t":"x"}',), ('{"_id":"3","n":3}',)], "payload string")
    rows = {r["_id"]: r for r in documents.read_documents(later, schema).collect()}
    assert float(rows["2"]["n"]) == 2.5 and json.loads(rows["2"]["_extra"]) == {"new": '{"a":[1]}', "t": "x"} and rows["3"]["_extra"] is None


def test_exported_types(spark):
    from pyspark.sql import types as T

    lines = frame(spark, [('{"_id":{"$oid":"64ab"},"at":{"$date":"2026-02-03T04:05:06.007Z"},"list":[{"$numberLong":"7"}],"d":{"$numberDecimal":"1.25"},"t":"{\\"$oid\\":1}"}',)], "payload string")
    schema = documents.document_schema(lines)
    assert schema.simpleString() == "struct<_id:string,at:timestamp,d:decimal(38,10),list:array<bigint>,t:string>"
    row = documents.read_documents(lines, schema).withColumn("at", F.unix_micros("at")).first()
    assert (row["_id"], row["at"], row["list"], float(row["d"]), row["t"]) == ("64ab", 1770091506007000, [7], 1.25, '{"$oid":1}')
    assert isinstance(schema["at"].dataType, T.TimestampType)


def test_newest_counted_agrees_with_newest(spark):
    from lakesync.operators.dedup import newest_counted

    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, 1, 2]), i) for i in range(60)]
    df = frame(spark, rows, "k string, t int, seq int")
    counted = newest_counted(df, ["k"], "t", ["seq"])
    assert sorted_rows(counted.drop("_copies")) == sorted_rows(newest(df, ["k"], "t", ["seq"]))
    assert counted.agg(F.sum("_copies")).first()[0] == 60
