"""Host rules against SQL and by hand."""

from lakesync.llm import rules
from lakesync.llm.queries import ORACLES, QUERIES
from tests.conftest import SF
from tools.compare import connect, differences


def test_query_matches_sql(spark):
    assert differences(spark, connect(SF), QUERIES["op8_host_rules"], ORACLES["op8_host_rules"], SF) == ""


def test_hard_texts(spark):
    eight = "a b c d e f g h"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, f"{eight} {eight}"), (5, f"{eight} x {eight}"), (6, "z " * 30), (7, "l\nl\n\n\nl\n m"), (8, "#*$%&|<>é 漢"), (9, " ".join(map(str, range(40)))),
            (10, f"{eight}\n" * 3), (None, "w " * 3)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_words int")
    got = {r["doc_id"]: tuple(r)[1:] for r in rules.measures(docs).collect()}
    assert got[1] == got[2] == got[3] == (0, 0, 0, 0, 0)
    assert got[4] == (16, 16, 0, 0, 16) and got[5] == (17, 17, 0, 0, 16) and got[6] == (30, 30, 0, 0, 30)
    assert got[7] == (4, 4, 0, 2, 0) and got[8] == (2, 10, 8, 0, 0) and got[9][4] == 0 and got[10] == (24, 24, 0, 2, 24)
    assert rules.measures(docs.limit(0)).count() == 0


def test_hosts_decide_about_their_documents(spark):
    good, bad = " ".join(f"w{n}" for n in range(30)), "too short"
    rows = [("clean", good)] * 50 + [("spam", bad)] * 45 + [("spam", good)] * 5 + [("tiny", bad), (None, good), (None, None)]
    docs = spark.createDataFrame([(n, text, host) for n, (host, text) in enumerate(rows)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in rules.judge(docs).collect()}
    assert all(got[n]["kept"] for n in range(50)) and not any(got[n]["kept"] for n in range(50, 100))
    assert got[95]["base_failed"] is False and got[50]["host_rate"] > 0.5 > got[0]["host_rate"]
    assert got[100]["host_rate"] < 1 and got[101]["host"] is None and not got[102]["kept"]
    assert rules.judge(docs.limit(0)).count() == 0
    one = rules.judge(docs.where("source = 'clean'")).collect()
    assert all(r["kept"] and r["host_rate"] == 0 for r in one)
