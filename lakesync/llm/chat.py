"""Chat formatting: every assistant turn becomes an example with all turns before it as context and only its reply trainable.

Native: only built-in functions, no Python on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.llm.shared import once

#: A turn is written ``### role: text</turn>\\n``. In roles and texts a backslash goes behind every backslash, ``#`` and
#: ``<`` (in roles also ``:``), so no marker can occur inside them, and dropping those backslashes restores them.
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
_SPECIAL, _SPECIAL_ROLE = r"[\\#<]", r"[\\#<:]"


def escape(text: Column, special: str = _SPECIAL) -> Column:
    return F.regexp_replace(text, f"({special})", r"$1\\")


def unescape(text: Column, special: str = _SPECIAL) -> Column:
    return F.regexp_replace(text, f"({special})" + r"\\", "$1")


def examples(turns: DataFrame) -> DataFrame:
    """One row per assistant turn: ``conv_id, example, n_turns, text, loss_start, loss_chars``.

    ``text`` is the formatted conversation up to and including the reply; the reply alone is trainable, at code points
    ``loss_start`` (from 0) with length ``loss_chars``. Turns after the last assistant turn, or a conversation without
    one, give one more example with a null mask, so that the last example always holds the whole conversation.

    Turns go by ``turn``, ties by role and text, nulls first; null roles and texts are empty; null ids are one
    conversation. Repeated rows are repeated turns. A conversation is gathered in one row (its digest needs it whole);
    examples are made from it one at a time.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("_turns"))
    parts = F.transform("_turns", lambda t: F.struct(
        (t["role"] == "assistant").alias("target"),
        F.concat(F.lit(OPEN), escape(t["role"], _SPECIAL_ROLE), F.lit(MIDDLE)).alias("head"), escape(t["text"]).alias("body")))
    whole = once(whole.withColumn("_count", F.size("_turns")), _parts=parts).drop("_turns")
    written = F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE)))
    whole = once(whole, _written=written)
    last = F.col("_count") - 1
    one = whole.select("conv_id", "_written", "_count", F.posexplode("_parts").alias("_at", "_part"))
    one = one.where(F.col("_part.target") | (F.col("_at") == last))
    one = once(one, _context=F.when(F.col("_at") > 0, F.array_join(F.slice("_written", 1, F.greatest(F.col("_at"), F.lit(1))), "")).otherwise(""))
    target = F.col("_part.target")
    return one.select(
        "conv_id", F.col("_at").cast("long").alias("example"), (F.col("_at") + 1).cast("long").alias("n_turns"),
        F.concat("_context", "_part.head", "_part.body", F.lit(CLOSE)).alias("text"),
        F.when(target, F.length("_context") + F.length("_part.head")).cast("long").alias("loss_start"),
        F.when(target, F.length("_part.body")).cast("long").alias("loss_chars"),
        (F.col("_at") == last).alias("is_whole"))


def trained_text(example: DataFrame) -> Column:
    """The unescaped text under an example's mask; null without one."""
    start, size = example["loss_start"].cast("int"), example["loss_chars"].cast("int")
    return unescape(F.substring(example["text"], start + 1, size))


def read_turns(text: Column) -> Column:
    """Roles and texts read back from a formatted conversation."""
    pieces = F.slice(F.split(text, "</turn>\n", -1), 1, F.size(F.split(text, "</turn>\n", -1)) - 1)
    return F.transform(pieces, lambda piece: F.struct(
        unescape(F.regexp_extract(piece, r"(?s)^### (.*?): ", 1), _SPECIAL_ROLE).alias("role"),
        unescape(F.regexp_replace(piece, r"(?s)^### .*?: ", "")).alias("text")))


def digest(made: DataFrame) -> DataFrame:
    """Per conversation what its examples hold: all turns, the trainable text in order, and the formatted length."""
    rows = once(made, _trained=trained_text(made)).select(
        "conv_id", "example", "_trained", "is_whole", F.when(F.col("is_whole"), F.col("text")).alias("_whole"))
    rows = once(rows, _read=F.when(F.col("is_whole"), read_turns(F.col("_whole"))))
    rows = rows.select(
        "conv_id", "example", "_trained", F.length("_whole").cast("long").alias("_chars"), F.size("_read").cast("long").alias("_size"),
        F.sha2(F.array_join(F.transform("_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("_digest"),
        "is_whole")
    trained = F.transform(F.sort_array(F.collect_list(F.when(F.col("_trained").isNotNull(), F.struct("example", "_trained")))), lambda e: e["_trained"])
    grouped = rows.groupBy("conv_id").agg(
        F.max(F.when(F.col("is_whole"), F.col("_size"))).alias("n_turns"), F.max("_digest").alias("turns_sha256"),
        F.array_join(trained, "").alias("_loss"), F.max("_chars").alias("formatted_chars"))
    return grouped.select("conv_id", "n_turns", "turns_sha256", F.length("_loss").cast("long").alias("loss_chars"),
                          F.sha2("_loss", 256).alias("loss_sha256"), "formatted_chars")
