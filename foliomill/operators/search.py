"""Keyword search: all terms must occur, case aside; the first rows in a given order come out.

A result is a top-k by design. Defined cases: no terms find nothing; null columns count as ''.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import snippet


def _all_terms(text: Column, terms: list[str]) -> Column:
    low = F.lower(text)
    ok = F.lit(bool(terms))
    for t in terms:
        ok = ok & F.contains(low, F.lit(t.lower()))
    return ok


def search_rows(df: DataFrame, columns: list[str], terms: list[str], order: list[Column], k: int) -> DataFrame:
    text = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return df.where(_all_terms(text, terms)).orderBy(*order).limit(k)


def search_texts(df: DataFrame, key: str, text: str, terms: list[str], k: int) -> DataFrame:
    """(key, snippet) of the first k keys whose text has all terms."""
    hit = df.where(_all_terms(F.coalesce(F.col(text), F.lit("")), terms)).select(key, snippet(text, terms).alias("snippet"))
    return hit.orderBy(key).limit(k)


def search_both(first: DataFrame, then: DataFrame, k: int) -> DataFrame:
    """Rows of the first result, then of the second up to k: both as (key, snippet)."""
    both = first.withColumn("rank", F.lit(0)).unionByName(then.withColumn("rank", F.lit(1)))
    return both.orderBy("rank", "key").limit(k)
