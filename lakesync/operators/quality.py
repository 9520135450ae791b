"""Checks on landed payloads and on written tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.functions.payload import each


def key_check(df: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Row count and distinct key count; they are equal when the key is unique."""
    per_key = df.groupBy(*by, *[c for c in key if c not in by]).agg(F.count(F.lit(1)).alias("_n"))
    complete = F.lit(True)
    for c in key:
        complete = complete & F.col(c).isNotNull()
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count_if(complete).alias("n_keys"))


def paging_faults(pages: DataFrame, listing: str, strict: bool) -> DataFrame:
    """One row per listing with its page count and what is wrong with its paging, if anything.

    Reads ``token`` (cursor of the next page) and ``is_last``. A strict listing
    must say which page is last and never repeat a token; otherwise a missing
    or repeated cursor simply ends the listing.
    """
    said_last = F.coalesce(F.col("is_last"), F.lit(False))
    per_token = pages.groupBy(listing, "token").agg(
        F.count(F.lit(1)).alias("_n"), F.max(said_last).alias("_last"), F.count_if(~said_last).alias("_open"))
    missing = F.sum(F.when(F.col("token").isNull(), F.col("_open")).otherwise(0))
    repeated = F.max(F.when(F.col("token").isNotNull(), F.col("_open"))) > 1
    if strict:
        fault = (F.when(repeated, "repeated token").when(missing > 0, "no token on a page that is not last")
                 .when(~F.max("_last"), "no last page").otherwise("ok"))
    else:
        fault = F.when(repeated, "ended by repeated cursor").otherwise("ok")
    return per_token.groupBy(listing).agg(
        F.sum("_n").alias("n_pages"), F.count("token").alias("n_tokens"), fault.alias("status"))


def untolerated_errors(payloads: DataFrame, tolerated: Sequence[str]) -> DataFrame:
    """Partial errors of landed batch reads outside the tolerated categories."""
    listed = F.from_json("payload", "errors array<struct<status:string,category:string,message:string,"
                                    "context:struct<ids:array<string>>>>")["errors"]
    errors = each(payloads, listed, payloads.columns, item="error").select(*payloads.columns, "error.*")
    return errors.filter(~F.coalesce(F.col("category"), F.lit("")).isin(*tolerated))


def fail_on(rows: DataFrame, message: str) -> None:
    """Raise when there is any row, quoting the first."""
    first = rows.first()
    if first is not None:
        raise RuntimeError(f"{message}: {first.asDict()}")
