"""Page text: token coverage, page types, quality signals and choices, all as expressions and joins.

Defined cases: null texts count as ''; coverage without native tokens is null (not measurable).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Thresholds of the signals.
EMPTY_CELLS = 100
COLUMNS = 20
INFLATION, INFLATION_BYTES = 4, 20 * 1024
COVERAGE, COVERAGE_TOKENS = 0.5, 50
SPARSE_TOKENS, TEXT_TOKENS, TOC_TOKENS = 15, 30, 50


def _c(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def empty_cells(md: Column | str) -> Column:
    """Cells <td></td> without attributes and with nothing but white space."""
    return F.regexp_count(_c(md), F.lit(r"(?i)<td>\s*</td>"))


def widest_row(md: Column | str) -> Column:
    """Most <td> in one row, 0 without rows."""
    rows = F.regexp_extract_all(_c(md), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(rows, lambda r: F.regexp_count(r, F.lit("(?i)<td[^>]*>")))), F.lit(0))


def inflated(md: Column | str, native: Column | str) -> Column:
    m, n = F.octet_length(_c(md)), F.octet_length(_c(native))
    return (n > 0) & (m >= INFLATION * n) & (m >= INFLATION_BYTES)


def token_counts(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, token, n, first): occurrences of each token of a page and where it first stands, combined on the map side."""
    t = df.select(*keys, F.posexplode(T.tokens(F.coalesce(F.col(text), F.lit("")))).alias("pos", "token"))
    return t.groupBy(*keys, "token").agg(F.count("*").alias("n"), F.min("pos").alias("first"))


def _matched(native: DataFrame, extracted: DataFrame, keys: list[str], text: str) -> DataFrame:
    a = token_counts(native, keys, text)
    b = token_counts(extracted, keys, text).select(*keys, "token", F.col("n").alias("m"))
    return a.join(b, [*keys, "token"], "left").withColumn("m", F.coalesce("m", F.lit(0)))


def coverage(native: DataFrame, extracted: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, tokens, matched, coverage): multiset intersection of a page's native tokens with the extracted ones.

    Both sides are counted by (page, token) before they meet, so a hot page or token is one row
    a token by then. Pages without native tokens don't come out.
    """
    m = _matched(native, extracted, keys, text)
    out = m.groupBy(*keys).agg(F.sum("n").alias("tokens"), F.sum(F.least("n", "m")).alias("matched"))
    return out.withColumn("coverage", F.col("matched") / F.col("tokens"))


def missing_tokens(native: DataFrame, extracted: DataFrame, keys: list[str], k: int = 10, text: str = "text") -> DataFrame:
    """(keys, token, missing, rank): the k tokens that lack most, ties by the first place in the native text."""
    from pyspark.sql import Window as W

    lack = _matched(native, extracted, keys, text).where(F.col("n") > F.col("m")).withColumn("missing", F.col("n") - F.col("m"))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("missing"), "first"))
    return lack.withColumn("rank", rank).where(F.col("rank") <= k).select(*keys, "token", "missing", "rank")


def signals(md: Column | str, native: Column | str, cover: Column | None = None) -> Column:
    """Names of the quality signals that a page shows; ``cover`` is its coverage where it is measured."""
    tests = [
        F.when(empty_cells(md) >= EMPTY_CELLS, "excessive_empty_td"),
        F.when(widest_row(md) >= COLUMNS, "excessive_columns"),
        F.when(inflated(md, native), "volume_inflation"),
    ]
    if cover is not None:
        tests.append(F.when((F.size(T.tokens(_c(native))) >= COVERAGE_TOKENS) & (cover < COVERAGE), "text_coverage_low"))
    return F.array_compact(F.array(*tests))


def better(orig: Column, new: Column) -> Column:
    """fallback, original or review from two structs (empty_td, max_td_per_row, md_bytes, text_coverage, native_table_missing)."""
    o = lambda n, d: F.coalesce(orig[n], F.lit(d))
    f = lambda n, d: F.coalesce(new[n], F.lit(d))
    fewer = (o("empty_td", 0) > 0) & (f("empty_td", 0) < o("empty_td", 0) * 0.5)
    slimmer = (o("max_td_per_row", 0) > 0) & (f("max_td_per_row", 0) < o("max_td_per_row", 0) * 0.8)
    oc, fc = o("text_coverage", 1.0), f("text_coverage", 1.0)
    covered = F.when(fc == oc, True).when(oc < 1.0, fc >= F.greatest(oc * 0.8, F.lit(0.3))).otherwise(True)
    volume = (o("md_bytes", 0) <= 0) | (f("md_bytes", 0) >= o("md_bytes", 0) * 0.8)
    intact = covered & (volume | (fc > oc))
    return (
        F.when(o("native_table_missing", 0) > 0, F.when((f("native_table_missing", 0) == 0) & intact, "fallback").otherwise("review"))
        .when(fewer | slimmer, F.when(intact, "fallback").otherwise("review"))
        .otherwise(F.when(~covered, "original").otherwise("review"))
    )


def is_toc(native: Column | str, elements: Column) -> Column:
    n = _c(native)
    dots = F.regexp_count(n, F.lit(r"[.]{4,}\s*\d+"))
    return (dots >= 3) | (n.contains("目录") & (elements <= 5) & (F.size(T.tokens(n)) > TOC_TOKENS))


def is_sparse(native: Column | str, has_image: Column) -> Column:
    return has_image | (F.size(T.tokens(_c(native))) < SPARSE_TOKENS)


def page_type(native: Column | str, md: Column | str, types: Column) -> Column:
    """no_text_layer, toc, image_or_sparse, table, text or unknown, in this order; ``types`` are the types of the page's elements."""
    n, m = _c(native), _c(md)
    count = F.size(T.tokens(n))
    t = F.coalesce(types, F.array().cast("array<string>"))
    return (
        F.when(count == 0, F.when(F.size(T.tokens(m)) >= 10, "text").otherwise("no_text_layer"))
        .when(is_toc(n, F.size(t)), "toc")
        .when(is_sparse(n, F.array_contains(t, "image")), "image_or_sparse")
        .when(F.array_contains(t, "table") | m.rlike(r"(?m)^\|.+\|$"), "table")
        .when(count >= TEXT_TOKENS, "text")
        .otherwise("unknown")
    )


def page_decision(kind: Column, cover: Column, threshold: float = 0.82) -> Column:
    """pass, rerun, review_only or skip of a page by its type and coverage."""
    enough = F.coalesce(cover >= threshold, F.lit(False))
    return (
        F.when(kind == "no_text_layer", "rerun")
        .when(kind.isin("toc", "image_or_sparse"), "review_only")
        .when(kind == "table", F.when(enough, "pass").otherwise("review_only"))
        .when(cover.isNull(), "skip")
        .otherwise(F.when(enough, "pass").otherwise("rerun"))
    )


def segment_summary(pages: DataFrame, keys: list[str], threshold: float = 0.82) -> DataFrame:
    """(keys, pages, <type>_pages, tokens, matched, coverage, decision) from pages with page_type, decision, tokens, matched."""
    types = ["text", "toc", "table", "image_or_sparse", "no_text_layer", "unknown"]
    out = pages.groupBy(*keys).agg(
        F.count("*").alias("pages"),
        *[F.count_if(F.col("page_type") == t).alias(f"{t}_pages") for t in types],
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum("matched"), F.lit(0)).alias("matched"),
        F.coalesce(F.bool_or(F.col("decision") == "rerun"), F.lit(False)).alias("any_rerun"),
    )
    cover = F.when(F.col("tokens") > 0, F.col("matched") / F.col("tokens"))
    return out.withColumn("coverage", cover).withColumn("decision", F.when(F.col("any_rerun"), "rerun").when(cover < threshold, "review_only").otherwise("pass")).drop("any_rerun")
