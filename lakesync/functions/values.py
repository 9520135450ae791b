"""Amounts, link type ids and id lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(38,6)"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def to_amount(text: Column) -> Column:
    """DECIMAL(38,6), ties rounded to even; NULL when it is not a finite number that fits.

    A number with an exponent is first written out, so that every number is
    rounded once, from all its digits. Up to 18 decimals are exact in
    DECIMAL(38,18), which is the quicker way.
    """
    text = F.replace(F.trim(text), F.lit("_"), F.lit(""))
    scaled = F.contains(F.lower(text), F.lit("e"))
    return F.when(scaled & text.rlike(_NUMBER), _bound(_written_out(text), _rounded)).when(~scaled, _rounded(text))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _rounded(text: Column) -> Column:
    dot = F.instr(text, ".")
    short = (dot == 0) | (F.length(text) - dot <= 18)
    narrow = F.bround(text.try_cast("decimal(38,18)"), 6).cast(AMOUNT)
    # looked at before casting: a failed cast costs an exception
    return F.when(text.rlike(_NUMBER), F.coalesce(F.when(short, narrow), _round_digits(text, dot)))


def _written_out(text: Column) -> Column:
    """A number in exponent form as plain digits; NULL if it has more integer digits than fit.

    The point moves within the significant digits; far to the left of them the
    number rounds to zero whatever they are.
    """
    power = F.regexp_extract(text, r"[eE]([+-]?\d+)$", 1)
    whole = F.regexp_extract(text, r"^[+-]?(\d*)", 1)
    digits = F.concat(whole, F.regexp_extract(text, r"^[+-]?\d*\.(\d*)", 1))
    parts = F.struct(
        F.coalesce(power.try_cast("int"), F.when(power.startswith("-"), -1_000_000).otherwise(1_000_000)).alias("power"),
        F.length(whole).alias("whole"), F.length(digits).alias("all"), F.ltrim(digits, F.lit("0")).alias("significant"))

    def placed(p: Column) -> Column:
        size = F.length(p["significant"])
        # digits before the point, negative for zeros behind it
        return F.struct(p["significant"].alias("digits"), size.alias("size"), (p["whole"] + p["power"] - (p["all"] - size)).alias("point"))

    def spelled(p: Column) -> Column:
        digits, size, point = p["digits"], p["size"], p["point"]
        inside = F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)).when(
            point >= size, F.concat(digits, F.repeat(F.lit("0"), point - size))).otherwise(
            F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1)))
        return F.when((size == 0) | (point < -12), F.lit("0")).when(point <= 32, inside)

    return F.concat(F.when(text.startswith("-"), "-").otherwise(""), _bound(parts, lambda p: _bound(placed(p), spelled)))


def _round_digits(text: Column, dot: Column) -> Column:
    """Half-even rounding of a plain number read from its digits after the sixth decimal."""
    kept = F.when(dot > 0, F.substr(text, F.lit(1), dot + 6)).otherwise(text)
    rest = F.when(dot > 0, F.rtrim(F.substr(text, dot + 7), F.lit("0"))).otherwise("")
    odd = F.substr(text, dot + 6, F.lit(1)).isin("1", "3", "5", "7", "9")
    up = (rest > "5") | ((rest == "5") & odd)
    # the step has the number's sign: negating a wide decimal keeps only 34 digits
    step = F.when(~up, "0").when(text.startswith("-"), "-0.000001").otherwise("0.000001").cast(AMOUNT)
    return F.try_add(kept.try_cast(AMOUNT), step).cast(AMOUNT)


def type_id(node: Column) -> Column:
    """INT of a JSON value: numbers are truncated, text must spell an integer, else NULL."""
    spelled = F.to_json(node)
    quoted = F.trim(F.substr(spelled, F.lit(2), F.length(spelled) - 2))
    # looked at before casting: a failed cast costs an exception
    return (F.when(spelled.startswith('"'), F.when(quoted.rlike(r"^[+-]?\d+$"), quoted.try_cast("int")))
            .when(spelled.rlike(r"^-?\d"), spelled.try_cast("double").try_cast("int"))
            .when(spelled == "true", 1).when(spelled == "false", 0))


def id_list(text: Column) -> Column:
    """Ids of a ``;`` separated list: trimmed, blanks dropped, first occurrence kept."""
    ids = F.transform(F.split(text, ";"), lambda i: F.trim(i))
    return F.array_distinct(F.filter(ids, lambda i: i != ""))
