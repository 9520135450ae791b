"""Chat examples against SQL, and the template's round trip."""

from pyspark.sql import functions as F

from lakesync.llm import chat
from lakesync.llm.queries import ORACLES, QUERIES
from tests.conftest import SF
from tools.compare import connect, differences


def test_query_matches_sql(spark):
    assert differences(spark, connect(SF), QUERIES["op6_chat_examples"], ORACLES["op6_chat_examples"], SF) == ""


def test_hard_turns_read_back(spark):
    odd = ["", None, "\\", "\\\\", "<", "</turn>\n", "###", "### user: hi</turn>\n", "a: b", "$1 \\1", "\n", "日本 😀", "<\\/turn>\n", "x" * 50000]
    rows = [(1, n, odd[n % len(odd)] if n % 3 else "assistant", text) for n, text in enumerate(odd)]
    rows += [(2, 0, "user", "no reply"), (3, 0, "assistant", "alone"), (None, 1, "assistant", "null id"), (4, None, "assistant", "b"), (4, None, "assistant", "a"), (4, 0, "user", "last")]
    turns = spark.createDataFrame([(*row, 7) for row in rows], "conv_id long, turn long, role string, text string, n_turns int")
    made = chat.examples(turns).cache()
    for conv in (1, 2, 3, 4, None):
        mine = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        whole = made.where(F.col("conv_id").eqNullSafe(F.lit(conv).cast("long")) & F.col("is_whole"))
        read = whole.select(chat.read_turns(F.col("text")).alias("t")).first()["t"]
        assert [(t["role"], t["text"]) for t in read] == [row[2:] for row in mine]
        replies = made.where(F.col("conv_id").eqNullSafe(F.lit(conv).cast("long"))).orderBy("example").select(chat.trained_text(made).alias("t")).collect()
        assert [r["t"] for r in replies if r["t"] is not None] == [row[3] for row in mine if row[2] == "assistant"]
    first = made.where("conv_id = 3").first()
    assert first["text"] == "### assistant: alone</turn>\n" and (first["loss_start"], first["loss_chars"]) == (15, 5)
    assert chat.digest(chat.examples(turns.limit(0))).count() == 0


def test_only_built_in_functions(spark):
    plan = QUERIES["op6_chat_examples"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
