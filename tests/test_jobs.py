"""Whole sync jobs over several runs against a scratch warehouse."""

import json
import threading
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from lakesync.operators.windows import from_micros
from lakesync.plans.crm import CrmLanding, modified_records, sync_crm
from lakesync.plans.documents import sync_documents
from lakesync.plans.issues import changed_issues, preview, sync_issues
from lakesync.plans.run import require_success
from lakesync.plans.merge import RowLevelStore
from lakesync.plans.store import BUCKET, TableStore
from lakesync.plans.workspace import WorkspaceLanding, sync_workspace
from lakesync.schemas import BLOCKS, CONTACTS, CRM_STATE, ISSUES
from lakesync.sources.landing import land, landed, typed_issues, typed_objects, typed_records
from lakesync.sources.listing import changes_since

UTC = timezone.utc
T0 = datetime(2026, 3, 1, 12, tzinfo=UTC)
HOUR = timedelta(hours=1)


def iso(t):
    return t.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


@pytest.fixture(params=[None, 4], ids=["whole", "bucketed"])
def store(request, spark, namespace):
    s = TableStore(spark, namespace, buckets=request.param)
    s.ensure_schema()
    return s


def payloads(spark, records):
    rows = [(json.dumps(r), i) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "payload string, seq bigint")


def leftovers(store):
    """Tables and partitions that neither a table nor the state before it reads."""
    names = {r.tableName for r in store.spark.sql(f"SHOW TABLES IN {store.namespace}").collect()}
    left = {n for n in names if "__" in n}
    for table in names - left:
        states = [s for s in store._snapshots(table) if s]
        left -= {s.data for s in states}
        if states:
            stored = {r[0] for r in store.spark.sql(f"SHOW PARTITIONS {store.name(states[0].data)}").collect()}
            left |= stored - {f"{BUCKET}={b}/key_version={v}" for s in states for b, v in enumerate(s.versions)}
    return sorted(left)


# ---- issues ----------------------------------------------------------------------

def issue(key, updated, summary="s", **fields):
    stamp = updated.strftime("%Y-%m-%dT%H:%M:%S.000+0000")
    return {"key": key, "fields": {"summary": summary, "status": {"name": "Open"}, "updated": stamp, **fields}}


def summaries(store, table="issues"):
    return {r["key"]: r["summary"] for r in store.read(table).collect()}


def test_issue_runs(spark, store):
    landed = [issue("A-1", T0), issue("A-2", T0), issue("A-2", T0, "again"), issue("A-3", T0 + HOUR, "later")]
    first = sync_issues(store, payloads(spark, landed), now=T0 + timedelta(minutes=1))
    assert (first["mode"], first["rows_read"], first["rows_in_table"]) == ("full", 2, 2)
    assert summaries(store) == {"A-1": "s", "A-2": "again"}

    edited = [*landed, issue("A-1", T0 + HOUR, "edited"), issue("A-0", T0 - HOUR, "too old")]
    second = sync_issues(store, payloads(spark, edited), now=T0 + 2 * HOUR)
    assert (second["mode"], second["rows_in_table"]) == ("incremental", 3)
    assert second["since"] == T0.isoformat()
    assert summaries(store) == {"A-1": "edited", "A-2": "again", "A-3": "later"}

    third = sync_issues(store, payloads(spark, []), now=T0 + 3 * HOUR)
    assert (third["mode"], third["rows_read"], third["rows_in_table"]) == ("incremental", 0, 3)

    full = sync_issues(store, payloads(spark, landed[:1]), mode="FULL", now=T0 + 3 * HOUR)
    assert (full["mode"], full["rows_in_table"]) == ("full refresh", 1)
    emptied = sync_issues(store, payloads(spark, []), mode="full", now=T0 + 3 * HOUR)
    assert emptied["rows_in_table"] == 0
    reread = sync_issues(store, payloads(spark, landed), now=T0 + 3 * HOUR)
    assert (reread["mode"], reread["rows_in_table"]) == ("full re-read", 3)
    assert store.read("issues").schema.names == ISSUES.names
    assert not leftovers(store)


def test_issue_filter_and_preview(spark, store):
    landed = payloads(spark, [issue("B-2", T0), issue("B-1", T0), issue("B-3", T0 - HOUR, customfield_1={"b": 1})])
    assert [r["key"] for r in preview(landed, 2).collect()] == ["B-3", "B-1"]
    sync_issues(store, landed, where=F.col("raw_fields").isNull(), now=T0)
    assert set(summaries(store)) == {"B-1", "B-2"}
    with pytest.raises(ValueError):
        sync_issues(store, landed, mode="sometimes")


def test_malformed_issue_leaves_the_table_alone(spark, store):
    sync_issues(store, payloads(spark, [issue("A-1", T0)]), now=T0)
    broken = issue("A-2", T0)
    broken["fields"]["updated"] = "yesterday"
    with pytest.raises(Exception, match="field updated"):
        sync_issues(store, payloads(spark, [issue("A-1", T0, "new"), broken]), now=T0)
    with pytest.raises(Exception, match="field updated"):
        sync_issues(store, payloads(spark, [broken]), mode="full", now=T0)
    assert summaries(store) == {"A-1": "s"} and not leftovers(store)


# ---- CRM -------------------------------------------------------------------------

def record(id, modified, archived=False, archived_at=None, **properties):
    stamp = {"lastmodifieddate": iso(modified), "hs_lastmodifieddate": iso(modified), "hs_object_id": id}
    out = {"id": id, "createdAt": iso(T0), "updatedAt": iso(modified), "archived": archived,
           "properties": {**stamp, **properties}}
    if archived_at:
        out["archivedAt"] = iso(archived_at)
    return out


def links(spark, pairs):
    results = [{"from": {"id": f}, "to": [{"toObjectId": int(t), "associationTypes": types}]} for f, t, types in pairs]
    return payloads(spark, [{"results": results[:1]}, {"results": results[1:]}])


def crm(spark, contacts, companies=(), deals=(), link=()):
    none = links(spark, [])
    return CrmLanding(
        {"contacts": payloads(spark, contacts), "companies": payloads(spark, companies), "deals": payloads(spark, deals)},
        {("contacts", "companies"): links(spark, link) if link else none, ("deals", "contacts"): none,
         ("deals", "companies"): none})


def report(out):
    return {r["object"]: (r["mode"], r["status"], r["rows"]) for r in out.collect()}


def line(out, name):
    """The report's row of one object, its watermark as a time."""
    row = out.withColumn("watermark", F.unix_micros("watermark")).where(F.col("object") == name).first().asDict()
    return row | {"watermark": from_micros(row["watermark"])}


def test_crm_runs(spark, store):
    kind = [{"typeId": 1, "category": "A", "label": None}, {"typeId": 2, "category": "A", "label": "Primary"}]
    first = crm(spark, [record("1", T0, email="a"), record("2", T0), record("3", T0, True, T0)],
                [record("9", T0, name="Co")], [record("5", T0, amount="2.0000025", dealstage="won")],
                [("1", "9", kind), ("3", "9", kind)])
    assert report(sync_crm(store, first, now=T0)) == {
        "contacts": ("full", "SUCCESS", 3), "companies": ("full", "SUCCESS", 1), "deals": ("full", "SUCCESS", 1),
        "associations": ("full", "SUCCESS", 2)}
    assert str(store.read("deals").first()["amount"]) == "2.000002"
    # links of archived sources are not read
    assert {(r["from_id"], r["association_type_id"]) for r in store.read("associations").collect()} == {("1", 1), ("1", 2)}

    # nothing modified since, except what the 300 s overlap reads again
    again = sync_crm(store, first, now=T0 + HOUR)
    assert report(again)["contacts"] == ("incremental", "SUCCESS", 2)
    again = sync_crm(store, first, now=T0 + 2 * HOUR)
    assert report(again)["contacts"] == ("incremental", "SUCCESS", 0)

    # one edit that swallowed record 2, and record 1 archived afterwards
    second = crm(spark, [record("1", T0 + 2 * HOUR, True, T0 + 2 * HOUR),
                         record("4", T0 + 3 * HOUR, hs_merged_object_ids="2; 77;"), record("5", T0 + 4 * HOUR)],
                 [record("9", T0)], [record("5", T0)])
    assert report(sync_crm(store, second, now=T0 + 4 * HOUR))["contacts"] == ("incremental", "SUCCESS", 1)
    rows = {r["id"]: r for r in store.read("contacts").withColumn("at", F.unix_micros("archived_at")).collect()}
    assert set(rows) == {"1", "2", "3", "4"}  # 5 changed at the run start: next run's
    assert rows["1"]["archived"] and rows["1"]["email"] == "a" and rows["2"]["archived"] and not rows["4"]["archived"]
    assert rows["2"]["at"] == int((T0 + 4 * HOUR).timestamp() * 1e6)

    full = sync_crm(store, second, mode="full", now=T0 + 5 * HOUR)
    assert report(full)["contacts"] == ("full", "SUCCESS", 3)
    assert {r["id"] for r in store.read("contacts").collect()} == {"1", "4", "5"}
    assert store.read("associations").count() == 0
    assert not leftovers(store)


def test_one_failing_object_does_not_stop_the_others(spark, store):
    good = crm(spark, [record("1", T0)], [record("9", T0)], [record("5", T0)])
    sync_crm(store, good, now=T0)
    broken = CrmLanding({**good.records, "contacts": spark.createDataFrame([("{not json",)], "payload string")}, good.links)
    out = sync_crm(store, broken, mode="full", now=T0 + HOUR)
    assert report(out)["contacts"][1] == "FAILED" and report(out)["deals"][1] == "SUCCESS"
    state = {r["object_name"]: r for r in store.read(CRM_STATE.name).withColumn("w", F.unix_micros("watermark")).collect()}
    assert state["contacts"]["last_status"] == "FAILED" and state["contacts"]["last_rows"] == 1
    assert state["contacts"]["w"] == int(T0.timestamp() * 1e6)
    assert state["deals"]["w"] == int((T0 + HOUR).timestamp() * 1e6)
    assert store.read("contacts").count() == 1
    with pytest.raises(RuntimeError, match="objects failed.*contacts"):
        require_success(out)
    require_success(out.where("object <> 'contacts'"))


def test_partial_links_merge_and_unreadable_source_fails(spark, store):
    kind = [{"typeId": 1, "category": "A"}]
    landing = crm(spark, [record("1", T0)], [record("9", T0)], [record("5", T0)], [("1", "9", kind)])
    sync_crm(store, landing, now=T0)
    # deals not selected: their pairs are skipped, the rest merges without failing
    other = crm(spark, [record("1", T0)], [record("9", T0)], [], [("1", "8", kind)])
    out = sync_crm(store, other, objects=["contacts", "associations"], now=T0 + HOUR)
    assert report(out)["associations"] == ("full", "SUCCESS", 1)
    assert {r["to_id"] for r in store.read("associations").collect()} == {"8", "9"}
    # a selected source without a table: written, then reported as failed
    store.drop("deals")
    out = sync_crm(store, CrmLanding({"contacts": other.records["contacts"]}, other.links),
                   objects=["contacts", "deals", "associations"], now=T0 + 2 * HOUR)
    assert report(out)["associations"][1] == "FAILED" and "deals->contacts" in line(out, "associations")["error"]


def test_unknown_link_type_is_added_again(spark, store):
    landing = crm(spark, [record("1", T0)], [record("9", T0)], [], [("1", "9", [{"typeId": "x"}, {"typeId": "y"}])])
    for run in range(2):
        sync_crm(store, landing, objects=["contacts", "associations"], now=T0 + run * HOUR)
    assert store.read("associations").count() == 2  # one per run: a NULL key part never matches


# ---- workspace ------------------------------------------------------------------------

def page(id, edited, trashed=False, kind="page"):
    return {"object": kind, "id": id, "last_edited_time": iso(edited), "in_trash": trashed,
            "properties": {"Name": {"type": "title", "title": [{"plain_text": id}]}}}


def children(spark, listed):
    rows = [(p, i, json.dumps({"object": "block", "id": b, "type": "paragraph", "has_children": b in listed,
                               "last_edited_time": iso(T0)})) for p, blocks in listed.items() for i, b in enumerate(blocks)]
    return spark.createDataFrame(rows, "parent_id string, seq int, payload string")


def blocks(store):
    return {(r["page_id"], r["id"], r["depth"], r["position"]) for r in store.read("blocks").collect()}


def test_workspace_runs(spark, store):
    users = payloads(spark, [{"id": "u", "type": "person", "person": {"email": "e"}}, {"id": "v", "type": "bot"}])
    sources = payloads(spark, [page("ds", T0, kind="data_source")])
    tree = {"p": ["a", "b"], "a": ["a1"], "q": ["c"], "r": ["d"]}
    landing = WorkspaceLanding(users, sources, payloads(spark, [page("p", T0), page("q", T0), page("r", T0)]),
                               children(spark, tree))
    out = sync_workspace(store, landing, now=T0 + HOUR)
    assert report(out) == {"users": ("full", "SUCCESS", 2), "data_sources": ("full", "SUCCESS", 1),
                           "pages": ("full", "SUCCESS", 3), "blocks": ("full", "SUCCESS", 5)}
    assert line(out, "pages")["watermark"] == T0 and line(out, "users")["watermark"] is None
    assert blocks(store) == {("p", "a", 0, 0), ("p", "b", 0, 1), ("p", "a1", 1, 0), ("q", "c", 0, 0), ("r", "d", 0, 0)}

    # p edited, q trashed, r edited but no longer readable
    later = T0 + HOUR
    landing = WorkspaceLanding(users, sources, payloads(spark, [page("p", later), page("q", later, True), page("r", later)]),
                               children(spark, {"p": ["b", "x"], "q": ["c"], "r": ["d"]}),
                               spark.createDataFrame([("r",)], "page_id string"))
    out = sync_workspace(store, landing, now=T0 + 2 * HOUR)
    assert report(out)["blocks"] == ("cdc", "SUCCESS", 2)
    assert line(out, "blocks")["note"] == "1 unreadable pages cleared" and line(out, "blocks")["watermark"] == later
    assert blocks(store) == {("p", "b", 0, 0), ("p", "x", 0, 1)}
    assert {r["id"]: r["in_trash"] for r in store.read("pages").collect()} == {"p": False, "q": True, "r": False}

    # nothing new: the stored watermark stays
    quiet = WorkspaceLanding(users, sources, payloads(spark, [page("z", T0 - HOUR)]), children(spark, tree))
    out = sync_workspace(store, quiet, now=T0 + 3 * HOUR)
    assert report(out)["pages"] == ("cdc", "SUCCESS", 0) and line(out, "pages")["watermark"] == later
    assert blocks(store) == {("p", "b", 0, 0), ("p", "x", 0, 1)}
    assert not leftovers(store)


def test_workspace_failure_keeps_watermark(spark, store):
    landing = WorkspaceLanding(pages=payloads(spark, [page("p", T0)]), children=children(spark, {"p": ["a"]}))
    sync_workspace(store, landing, objects=["pages", "blocks"], now=T0)
    broken = WorkspaceLanding(pages=payloads(spark, [{**page("p", T0), "last_edited_time": "soon"}]), children=landing.children)
    out = sync_workspace(store, broken, objects=["pages", "blocks"], now=T0 + HOUR)
    assert {status for _, status, _ in report(out).values()} == {"FAILED"}
    rows = {r["object_name"]: r for r in store.read("workspace_sync_state").collect()}
    assert rows["pages"]["last_rows"] == 0 and "ISO 8601" in rows["pages"]["last_error"]
    assert rows["pages"]["watermark"] is not None
    assert blocks(store) == {("p", "a", 0, 0)}


# ---- documents ----------------------------------------------------------------------------

def test_document_runs(spark, store):
    docs = [{"_id": "1", "n": 1, "at": iso(T0)}, {"_id": "2", "n": 2, "at": iso(T0)}, {"_id": "3", "n": 3}]
    options = dict(watermark_field="at")
    first = sync_documents(store, payloads(spark, docs), "docs", now=T0 - HOUR, **options)
    assert (first["mode"], first["rows_in_table"]) == ("full", 3)  # no bound on the first run
    changed = [{"_id": "1", "n": 10, "at": iso(T0 + HOUR)}, {"_id": "3", "n": 30}, {"_id": "4", "n": 4, "at": iso(T0), "new": 1}]
    second = sync_documents(store, payloads(spark, changed), "docs", now=T0 + 2 * HOUR, **options)
    assert (second["mode"], second["rows_in_table"]) == ("incremental", 4)
    assert {r["_id"]: r["n"] for r in store.read("docs").collect()} == {"1": 10, "2": 2, "3": 3, "4": 4}
    assert "new" not in store.read("docs").columns  # until a full refresh samples the schema again
    full = sync_documents(store, payloads(spark, changed), "docs", mode="full", now=T0 + 2 * HOUR, **options)
    assert (full["mode"], full["rows_in_table"]) == ("full refresh", 3)
    assert "new" in store.read("docs").columns
    reread = sync_documents(store, payloads(spark, docs), "docs")
    assert reread["mode"] == "full re-read" and reread["rows_in_table"] == 4
    quiet = sync_documents(store, payloads(spark, []), "docs", now=T0 + 3 * HOUR, **options)
    assert (quiet["mode"], quiet["rows_in_table"]) == ("incremental", 4)  # nothing landed, nothing written
    for table, mode in (("docs", "full"), ("others", None)):
        with pytest.raises(ValueError, match="no document"):
            sync_documents(store, payloads(spark, []), table, mode=mode)


def test_schema_of_landed_days_is_kept(spark, store):
    def day(number, docs):
        return payloads(spark, docs).withColumn("landed", F.to_date(F.lit(f"2026-03-0{number}")))

    first, second = day(1, [{"_id": "1", "n": 1}]), day(2, [{"_id": "2", "m": "x"}])
    assert sync_documents(store, first, "docs")["rows_in_table"] == 1
    full = sync_documents(store, first.unionByName(second), "docs", mode="full")
    assert full["rows_in_table"] == 2 and store.read("docs").columns == ["_id", "m", "n"]
    kept = {(r["collection"], str(r["day"])): r["found"] for r in store.read("document_schema_days").collect()}
    assert sorted(kept) == [("docs", "2026-03-01"), ("docs", "2026-03-02")] and "m" not in kept["docs", "2026-03-01"]


# ---- committing ------------------------------------------------------------------------------

def contacts(spark, ids, version):
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    return df.select(*[F.col("id") if n == "id" else F.lit(version if n == "email" else None).cast(t).alias(n)
                       for n, t in CONTACTS.columns])


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, namespace):
    store = TableStore(spark, namespace, buckets=8)
    store.ensure_schema()
    store.replace_all(CONTACTS, contacts(spark, [str(i) for i in range(200)], "old"))

    def files():
        table = spark.table(store.name("contacts"))
        return {(r[0], r[1]) for r in table.select(BUCKET, F.input_file_name()).distinct().collect()}

    before = files()
    store.upsert(CONTACTS, contacts(spark, ["7"], "new"))
    assert len({b for b, _ in files() ^ before}) == 1
    table = store.read("contacts")
    assert table.count() == 200 and [r["id"] for r in table.filter("email = 'new'").collect()] == ["7"]


def test_bucket_left_empty_is_dropped(spark, namespace):
    store = TableStore(spark, namespace, buckets=64)
    store.ensure_schema()
    rows = spark.createDataFrame([("p", "1"), ("q", "2")], "page_id string, id string")
    full = rows.select(*[F.col(n) if n in rows.columns else F.lit(None).cast(t).alias(n) for n, t in BLOCKS.columns])
    store.replace_all(BLOCKS, full)
    store.replace_by_parent(BLOCKS, full.filter("false"), spark.createDataFrame([("p",)], "page_id string"))
    assert [r["page_id"] for r in store.read("blocks").collect()] == ["q"]


@pytest.mark.parametrize("write", ["upsert", "replace_all"])
def test_write_cut_off_before_its_commit_changes_nothing(spark, store, monkeypatch, write):
    store.replace_all(CONTACTS, contacts(spark, ["1"], "old"))
    crashed = TableStore(spark, store.namespace, buckets=store.buckets)

    def cut_off(*_):
        raise KeyboardInterrupt  # nothing of the writer runs any more

    monkeypatch.setattr(crashed, "_point", cut_off)
    monkeypatch.setattr(crashed, "_discard", lambda table: None)
    with pytest.raises(KeyboardInterrupt):
        getattr(crashed, write)(CONTACTS, contacts(spark, ["1", "2"], "lost"))
    assert [(r["id"], r["email"]) for r in store.read("contacts").collect()] == [("1", "old")] and leftovers(store)
    later = TableStore(spark, store.namespace, buckets=store.buckets)
    later.upsert(CONTACTS, contacts(spark, ["2"], "new"))
    assert {(r["id"], r["email"]) for r in later.read("contacts").collect()} == {("1", "old"), ("2", "new")} and not leftovers(store)


def test_reader_never_fails_while_a_writer_commits(spark, store):
    store.replace_all(CONTACTS, contacts(spark, [str(i) for i in range(9)], "0"))
    seen, failed, done = [], [], threading.Event()

    def read():
        other = TableStore(spark, store.namespace)
        while not done.is_set():
            try:
                seen.append(sorted({r["email"] for r in other.read("contacts").collect()}))
            except Exception as error:  # what the test is about
                failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 6):
        rows = contacts(spark, [str(i) for i in range(9)], str(n))
        store.upsert(CONTACTS, rows) if n % 2 else store.replace_all(CONTACTS, rows)
    done.set()
    reader.join()
    assert not failed and len(seen) > 3
    assert all(len(emails) == 1 for emails in seen)  # the state before a commit or after, never a mixture
    assert store.read("contacts").select("email").distinct().collect()[0][0] == "5" and not leftovers(store)


def test_second_writer_is_refused(spark, store):
    store.replace_all(CONTACTS, contacts(spark, ["1"], "old"))
    before = store._snapshots("contacts")[0]
    store.upsert(CONTACTS, contacts(spark, ["2"], "new"))
    with pytest.raises(RuntimeError, match="another writer"):
        store._point("contacts", before, before)


def test_rows_read_again_unchanged_touch_nothing(spark, store):
    """The overlap of two windows: rows that come again as they are stored, only read later."""
    def rows(ids, version, at):
        return contacts(spark, ids, version).withColumn("_ingested_at", F.lit(at))

    first = store.upsert(CONTACTS, rows([str(i) for i in range(50)], "a", T0))
    assert (first.rows, first.changed) == (50, 50)
    state = store._snapshots("contacts")
    again = store.upsert(CONTACTS, rows([str(i) for i in range(20, 50)], "a", T0 + HOUR))
    assert (again.rows, again.changed, again.touched) == (30, 0, 0) and store._snapshots("contacts") == state
    mixed = store.upsert(CONTACTS, rows(["20", "21"], "a", T0 + HOUR).unionByName(rows(["22", "new"], "b", T0 + HOUR)))
    assert (mixed.rows, mixed.changed) == (4, 2) and 1 <= mixed.touched <= 2
    stored = {r["id"]: (r["email"], r["_ingested_at"].hour) for r in store.read("contacts").collect()}
    assert len(stored) == 51 and stored["20"] == ("a", 12) and stored["22"] == ("b", 13) and stored["new"] == ("b", 13)


def test_pages_with_the_same_blocks_touch_nothing(spark, namespace):
    store = TableStore(spark, namespace, buckets=16)
    store.ensure_schema()

    def blocks_of(rows):
        frame = spark.createDataFrame(rows, "page_id string, id string, position int")
        return frame.select(*[F.col(n) if n in frame.columns else F.lit(None).cast(t).alias(n) for n, t in BLOCKS.columns])

    def pages(*names):
        return spark.createDataFrame([(n,) for n in names], "page_id string")

    rows = [(f"p{n}", f"b{m}", m) for n in range(12) for m in range(3)]
    store.replace_all(BLOCKS, blocks_of(rows))
    everything = pages(*(f"p{n}" for n in range(12)))
    assert store.replace_by_parent(BLOCKS, blocks_of(rows), everything).touched == 0
    moved = [(p, b, 9 if (p, b) == ("p3", "b1") else m) for p, b, m in rows if (p, b) != ("p5", "b2") and p != "p7"]
    assert 1 <= store.replace_by_parent(BLOCKS, blocks_of(moved), everything).touched <= 3
    assert sorted((r["page_id"], r["id"], r["position"]) for r in store.read("blocks").collect()) == sorted(moved)


def test_marks_that_change_nothing_touch_no_bucket(spark, namespace):
    store = TableStore(spark, namespace, buckets=8)
    store.ensure_schema()
    store.replace_all(CONTACTS, contacts(spark, [str(i) for i in range(40)], "old"))
    marks = spark.createDataFrame([("3", T0), ("5", T0), ("none", T0)], "id string, archived_at timestamp")
    assert store.flag_archived(CONTACTS, marks) == 2

    def files():
        return {r[0] for r in spark.table(store.name("contacts")).select(F.input_file_name()).distinct().collect()}

    before = files()
    assert store.flag_archived(CONTACTS, marks) == 0 and files() == before
    store.upsert(CONTACTS, contacts(spark, ["3", "7"], "new"), marks)  # a replaced row is flagged again, in the same rewrite
    rows = {r["id"]: r for r in store.read("contacts").collect()}
    assert rows["3"]["archived"] and rows["3"]["email"] == "new" and rows["5"]["archived"] and not rows["7"]["archived"]
    assert 0 < len(before - files()) <= 2


# ---- incomplete input ----------------------------------------------------------------------------

def test_incomplete_links_leave_the_table_alone(spark, store):
    kind = [{"typeId": 1, "category": "A"}]
    landing = crm(spark, [record("1", T0)], [record("9", T0)], [record("5", T0)], [("1", "9", kind)])
    sync_crm(store, landing, now=T0)
    result = {"from": {"id": "1"}, "to": [{"toObjectId": 8, "associationTypes": kind}], "paging": {"next": {"after": "k"}}}
    first = payloads(spark, [{"results": [result]}]).withColumn("cursor", F.lit(None).cast("string"))
    rest = payloads(spark, [{"results": [{"from": {"id": "1"}, "to": [{"toObjectId": 7, "associationTypes": kind}]}]}]).withColumn("cursor", F.lit("k"))
    failed = payloads(spark, [{"errors": [{"category": "RATE_LIMIT", "message": "no"}]}])
    for pages, status in ((first, "FAILED"), (failed, "FAILED"), (first.unionByName(rest), "SUCCESS")):
        out = sync_crm(store, CrmLanding(landing.records, {**landing.links, ("contacts", "companies"): pages}), now=T0 + HOUR)
        assert report(out)["associations"][1] == status
        assert {r["to_id"] for r in store.read("associations").collect()} == ({"9"} if status == "FAILED" else {"7", "8"})


def test_partial_answers_and_listings_leave_the_table_alone(spark, store):
    landing = crm(spark, [record("1", T0)])
    sync_crm(store, landing, objects=["contacts"], now=T0)
    for category, status in (("OBJECT_NOT_FOUND", "SUCCESS"), ("VALIDATION_ERROR", "FAILED")):
        answers = {"contacts": payloads(spark, [{"errors": [{"category": category}]}])}
        out = sync_crm(store, CrmLanding(crm(spark, [record("2", T0)]).records, {}, answers), objects=["contacts"], mode="full", now=T0 + HOUR)
        assert report(out)["contacts"][1] == status
        assert [r["id"] for r in store.read("contacts").collect()] == ["2"]
    sync_issues(store, payloads(spark, [issue("A-1", T0)]), now=T0)
    pages = spark.createDataFrame([("issues", "t1", None), ("issues", None, None)], "listing string, token string, is_last boolean")
    with pytest.raises(RuntimeError, match="listing is not complete"):
        sync_issues(store, payloads(spark, [issue("A-2", T0)]), mode="full", now=T0, pages=pages)
    assert set(summaries(store)) == {"A-1"}


@pytest.mark.parametrize("lost", ["first", "middle", "last"])
def test_lost_page_of_a_listing_leaves_the_table_alone(spark, store, lost):
    whole = [("all", None, "a", None), ("all", "a", "b", None), ("all", "b", "c", None), ("all", "c", None, True)]
    pages = spark.createDataFrame(whole, "listing string, asked string, token string, is_last boolean")
    some = pages.where({"first": "asked IS NOT NULL", "middle": "asked IS NULL OR asked <> 'b'", "last": "token IS NOT NULL"}[lost])
    sync_issues(store, payloads(spark, [issue("A-1", T0)]), now=T0, pages=pages)
    with pytest.raises(RuntimeError, match="listing is not complete.*page"):
        sync_issues(store, payloads(spark, [issue("A-2", T0)]), mode="full", now=T0, pages=some)
    assert set(summaries(store)) == {"A-1"}
    for run, (listed, status) in enumerate(((pages, "SUCCESS"), (some, "FAILED"))):
        landing = CrmLanding(crm(spark, [record(str(run), T0)]).records, pages={"contacts": listed})
        assert report(sync_crm(store, landing, objects=["contacts"], mode="full", now=T0))["contacts"][1] == status
        feeds = WorkspaceLanding(pages=payloads(spark, [page(f"p{run}", T0)]), feeds={"pages": listed})
        assert report(sync_workspace(store, feeds, objects=["pages"], mode="full", now=T0))["pages"][1] == status
    assert [r["id"] for r in store.read("contacts").collect()] == ["0"] and [r["id"] for r in store.read("pages").collect()] == ["p0"]


def test_a_page_whose_list_was_not_landed_keeps_its_blocks(spark, store):
    landing = WorkspaceLanding(pages=payloads(spark, [page("p", T0)]), children=children(spark, {"p": ["a"]}))
    sync_workspace(store, landing, objects=["pages", "blocks"], now=T0)
    for listed, status, kept in ((["q"], "FAILED", {("p", "a", 0, 0)}), (["p"], "SUCCESS", set())):
        later = WorkspaceLanding(pages=payloads(spark, [page("p", T0 + HOUR)]), children=landing.children.where("false"),
                                 listed=spark.createDataFrame([(i,) for i in listed], "parent_id string"))
        out = sync_workspace(store, later, objects=["pages", "blocks"], now=T0 + 2 * HOUR)
        assert report(out)["blocks"][1] == status and blocks(store) == kept


# ---- typed landing ---------------------------------------------------------------------------------

def test_windows_reach_the_scan_of_a_typed_landing(spark, tmp_path):
    records = typed_records(payloads(spark, [record(str(i), T0 + i * HOUR) for i in range(20)]), "contacts")
    land(records, str(tmp_path / "crm"), T0.date())
    table = landed(spark, str(tmp_path / "crm"), T0.date())
    changed = modified_records(table, "contacts", T0 + 5 * HOUR, T0 + 9 * HOUR, 0)
    assert sorted(int(r["id"]) for r in changed.collect()) == [5, 6, 7, 8]
    pages = typed_objects(payloads(spark, [page(f"p{i}", T0 + i * HOUR) for i in range(20)]))
    land(pages, str(tmp_path / "pages"), T0.date())
    feed = changes_since(landed(spark, str(tmp_path / "pages")), "page", T0 + 17 * HOUR)
    issues = typed_issues(payloads(spark, [issue(f"A-{i}", T0 + i * HOUR) for i in range(20)]))
    land(issues, str(tmp_path / "issues"), T0.date())
    recent = changed_issues(landed(spark, str(tmp_path / "issues")), T0 + 17 * HOUR, T0 + 30 * HOUR, 0)
    assert feed.count() == 3 and recent.count() == 3
    for frame, column in ((changed, "modified"), (feed, "edited"), (recent, "modified")):
        assert any(f.startswith(f"({column}#") and " >= " in f for f in scan_filters(frame, "dataFilters"))
    assert any("landed#" in f for f in scan_filters(changed, "partitionFilters"))


def test_a_short_window_reads_few_landed_rows(spark, tmp_path):
    """Records land in any order; a window of an hour out of a month skips nearly all of them in the files."""
    rows = spark.range(30 * 24 * 1000).select(
        F.col("id").cast("string").alias("payload"), F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(30 * 86400)) + int(T0.timestamp())).alias("modified"))
    hot = spark.range(50_000).select(F.col("id").cast("string").alias("payload"), F.lit(T0 + 40 * HOUR).alias("modified"))
    land(rows.unionByName(hot).repartition(6), str(tmp_path / "t"), T0.date())
    window = landed(spark, str(tmp_path / "t")).where((F.col("modified") >= T0 + 300 * HOUR) & (F.col("modified") < T0 + 301 * HOUR))
    found = len(window.collect())
    assert 800 < found < 1200

    def read_rows(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return read_rows(node.executedPlan())
        own = node.metrics().apply("numOutputRows").value() if node.nodeName().startswith("Scan parquet") else 0
        return own + sum(read_rows(node.children().apply(n)) for n in range(node.children().size()))

    assert found <= read_rows(window._jdf.queryExecution().executedPlan()) < 770_000 / 10  # pages hold 20,000 rows


def scan_filters(frame, kind):
    """Filters of a frame's file scans, whole: the plan's text shortens them."""
    found = []

    def look(node):
        if node.nodeName().startswith("Scan parquet"):
            filters = getattr(node, kind)()
            found.extend(filters.apply(n).toString() for n in range(filters.size()))
        for n in range(node.children().size()):
            look(node.children().apply(n))

    look(frame._jdf.queryExecution().sparkPlan())
    return found


def test_row_level_store_plans_a_merge(spark, namespace):
    """No provider with MERGE is installed; Parquet must refuse the statement, leaving no staging table."""
    store = RowLevelStore(spark, namespace, provider="parquet")
    store.ensure_schema()
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        store.upsert(CONTACTS, contacts(spark, ["1"], "new"))
    assert not leftovers(store)
