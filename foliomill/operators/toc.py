"""Tables of contents: entries, paths, the pages that they cover, and their evidence in page texts.

Entries are (keys, ord, title, page, depth). Null pages and null titles take no part in lookups;
repeated entries of an ord are taken once, the one with the least (title, page).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from .sequences import forward_fill, forward_fill_all, page_runs

#: Depths of an outline that are followed.
DEPTHS = 4


def entries(df: DataFrame, keys: list[str], page: str = "target_page") -> DataFrame:
    """(keys, ord, title, page, depth): one row for each ord."""
    got = df.groupBy(*keys, "ord").agg(F.min(F.struct(F.coalesce("title", F.lit("")).alias("title"), F.col(page).alias("page"), "depth")).alias("e"))
    return got.select(*keys, "ord", "e.title", "e.page", "e.depth")


def paths(e: DataFrame, keys: list[str]) -> DataFrame:
    """The entries with ``path``: titles from the root, each the last of its depth that a shallower one hasn't closed."""
    out = forward_fill_all(e, keys, F.col("ord"), {f"__d{d}": F.when(F.col("depth") == d, F.struct("ord", "title")) for d in range(DEPTHS)})
    parts, after = [], F.lit(-1).cast("int")
    for d in range(DEPTHS):
        x = F.col(f"__d{d}")
        parts.append(F.when((F.col("depth") >= d) & x.isNotNull() & (x["ord"] > after), x["title"]))
        after = F.greatest(after, F.coalesce(x["ord"], F.lit(-1)))
    return out.withColumn("path", F.array_join(F.filter(F.array_compact(F.array(*parts)), lambda t: t != ""), " / ")).drop(*[f"__d{d}" for d in range(DEPTHS)])


def exclusive_ranges(p: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, first, last, path): pages with one entry, up to the page before the next larger page that has any; last is null at the end."""
    pages = p.where(F.col("page").isNotNull()).groupBy(*keys, "page").agg(F.count("*").alias("n"), F.max_by("path", "ord").alias("path"))
    nxt = F.lead("page").over(W.partitionBy(*keys).orderBy("page"))
    return pages.withColumn("last", nxt - 1).where(F.col("n") == 1).select(*keys, F.col("page").alias("first"), "last", "path")


def last_path_asof(pages: DataFrame, p: DataFrame, keys: list[str], page: str) -> DataFrame:
    """The rows of ``pages`` with the path of the last entry at or before their page; null before the first.

    Both sides go into one order and the paths are filled forward: no range join.
    """
    at = F.col(page).cast("long") * 4_000_000
    left = pages.withColumn("__at", at + 3_999_999).withColumn("__path", F.lit(None).cast("string")).withColumn("__row", F.lit(True))
    marks = p.where(F.col("page").isNotNull()).select(*keys, (F.col("page").cast("long") * 4_000_000 + F.col("ord")).alias("__at"), F.col("path").alias("__path"), F.lit(False).alias("__row"))
    both = left.unionByName(marks, allowMissingColumns=True)
    return forward_fill(both, keys, F.col("__at"), F.col("__path"), "path", block=4_000_000 * 64).where("__row").drop("__at", "__path", "__row")


def title_evidence(e: DataFrame, page_text: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ord, evidence): found if the page's text holds the title without white space, partial if at least half of its different signs do, else missing."""
    t = T.title_form("title")
    both = e.where((F.col("title") != "") & F.col("page").isNotNull()).join(page_text.select(*keys, "page", "text"), [*keys, "page"], "left")
    body = T.title_form(F.coalesce("text", F.lit("")))
    signs = F.array_distinct(F.split(t, ""))
    share = F.size(F.array_intersect(signs, F.split(body, ""))) / F.size(signs)
    return both.select(*keys, "ord", F.when(F.contains(body, t), "found").when(share >= 0.5, "partial").otherwise("missing").alias("evidence"))


def evidence_stats(ev: DataFrame, keys: list[str]) -> DataFrame:
    return ev.groupBy(*keys).agg(F.count("*").alias("total"), *[F.count_if(F.col("evidence") == k).alias(k) for k in ("found", "partial", "missing")])


def toc_page_runs(df: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of consecutive pages that hold entries of the table of contents."""
    return page_runs(df, keys, "toc_page")


def main_run(runs: DataFrame, df: DataFrame, keys: list[str]) -> DataFrame:
    """The run with most entries of each key, the earliest of equals."""
    e = df.where(F.col("toc_page").isNotNull()).groupBy(*keys, F.col("toc_page").alias("p")).agg(F.count("*").alias("n"))
    r = runs.select(*keys, "first_page", "last_page", F.explode(F.sequence("first_page", "last_page")).alias("p")).join(e, [*keys, "p"])
    got = r.groupBy(*keys, "first_page", "last_page").agg(F.sum("n").alias("entries"))
    best = got.groupBy(*keys).agg(F.max(F.struct("entries", (-F.col("first_page")).alias("o"), "first_page", "last_page")).alias("b"))
    return best.select(*keys, "b.first_page", "b.last_page", "b.entries")


def markdown_lines(e: DataFrame, keys: list[str], page_label: Column | None = None) -> DataFrame:
    """(keys, ord, line): '- title ... page' lines indented by depth."""
    page = page_label if page_label is not None else F.col("page")
    return e.select(*keys, "ord", F.concat(F.repeat(F.lit("  "), F.greatest(F.col("depth"), F.lit(0))), F.lit("- "), "title", F.coalesce(F.concat(F.lit(" ... "), page.cast("string")), F.lit(""))).alias("line"))


def numbering(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, entries, offset, agreeing, mapping): how printed pages follow the physical ones.

    identity if nearly all entries have offset 0, constant_offset if nearly all share another,
    piecewise otherwise, unknown without a printed page.
    """
    d = df.where(F.col("printed_page").isNotNull() & F.col("target_page").isNotNull()).select(*keys, (F.col("target_page") - F.col("printed_page")).cast("int").alias("o"))
    per = d.groupBy(*keys, "o").agg(F.count("*").alias("n"))
    best = per.groupBy(*keys).agg(F.sum("n").alias("entries"), F.max(F.struct("n", (-F.abs("o")).alias("near"), "o")).alias("b"))
    every = df.select(*keys).distinct().join(best, keys, "left")
    share = F.col("b.n") / F.col("entries")
    kind = F.when(F.col("entries").isNull(), "unknown").when(share >= 0.9, F.when(F.col("b.o") == 0, "identity").otherwise("constant_offset")).otherwise("piecewise")
    return every.select(*keys, F.coalesce("entries", F.lit(0)).alias("entries"), F.col("b.o").alias("offset"), F.coalesce("b.n", F.lit(0)).alias("agreeing"), kind.alias("mapping"))


def depth_distribution(e: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, depths): 'depth:count' pairs in order."""
    per = e.groupBy(*keys, "depth").agg(F.count("*").alias("n"))
    got = per.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("depth", "n"))).alias("x"))
    return got.select(*keys, F.array_join(F.transform("x", lambda s: F.concat(s["depth"].cast("string"), F.lit(":"), s["n"].cast("string"))), ", ").alias("depths"))


def dotted_entries(text_lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, place, title, page) of printed tables of contents: 'title .... 12' in one line, or the title's line followed by that of the page."""
    line = T.strip("line")
    r = text_lines.withColumn("__l", line).where(F.col("__l") != "")
    full, head, foot = r"^(.*?[^.\s].*?)\s*[.]{4,}\s*(\d+)\s*$", r"^(.*?[^.\s].*?)\s*[.]{4,}\s*$", r"^\s*[.]{4,}\s*(\d+)\s*$"
    r = r.withColumn("__title", F.when(F.col("__l").rlike(head) & ~F.col("__l").rlike(foot), F.regexp_extract("__l", head, 1)))
    r = r.withColumn("__sets", F.when(F.col("__title").isNotNull(), F.col("__title")).when(F.col("__l").rlike(full) | F.col("__l").rlike(foot), F.lit("")))
    # What the line before handed on: the last setting strictly before this one.
    part = F.floor(F.col("place") / (1 << 20))
    w = W.partitionBy(*keys, part).orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    r = r.withColumn("__pending", F.last("__sets", True).over(w))
    one = F.col("__l").rlike(full) & ~F.col("__l").rlike(foot)
    two = F.col("__l").rlike(foot) & (F.coalesce("__pending", F.lit("")) != "")
    got = r.where(one | two)
    return got.select(*keys, "place", F.when(one, F.regexp_extract("__l", full, 1)).otherwise(F.col("__pending")).alias("title"), F.when(one, F.regexp_extract("__l", full, 2)).otherwise(F.regexp_extract("__l", foot, 1)).try_cast("int").alias("page"))
