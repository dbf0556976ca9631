"""Corrections of page blocks and repair drafts.

A block's corrections are folded in order inside one expression, so only the corrections are
shuffled to their blocks. Defined cases: an empty before or after, or both equal, is refused;
a text that isn't there but whose replacement is counts as applied already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _occurrences(text: Column, part: Column) -> Column:
    return ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("int")


def apply_fixes(blocks: DataFrame, fixes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, block_no, text, applied, refused) of blocks (keys, block_no, page_first, page_last, text).

    fixes are (keys, page, ord, before, after, expected): each goes to the first block whose range
    holds its page; the first occurrence is replaced, and only if the number of occurrences is the
    expected one where that is given. A fix with a true ``allow_empty``, a column that may be
    missing, may take its text away.

    Blocks meet their fixes by page: the first block of each page is found once, not for each fix.
    """
    empty = F.coalesce("allow_empty", F.lit(False)) if "allow_empty" in fixes.columns else F.lit(False)
    f = fixes.select(*keys, "page", F.struct("ord", "before", "after", "expected", empty.alias("allow_empty")).alias("fix"))
    ranges = blocks.where(F.col("page_first") <= F.col("page_last")).select(*keys, "block_no", F.explode(F.sequence("page_first", "page_last")).alias("page"))
    first = ranges.groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.col("page").alias("_page")).agg(F.min("block_no").alias("block_no"))
    on = F.col("page") == F.col("_page")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    place = f.distinct().join(first, on).select(*keys, "fix", "block_no")
    per = place.groupBy(*keys, "block_no").agg(F.array_sort(F.collect_list("fix")).alias("fixes"))
    start = F.struct(F.col("text").alias("text"), F.lit(0).alias("applied"), F.lit(0).alias("refused"))

    def step(acc: Column, x: Column) -> Column:
        b, a = F.coalesce(x["before"], F.lit("")), F.coalesce(x["after"], F.lit(""))
        n = _occurrences(acc["text"], b)
        usable = (b != "") & ((a != "") | x["allow_empty"]) & (b != a)
        good = usable & (n > 0) & (x["expected"].isNull() | (x["expected"] == n))
        done = usable & (n == 0) & F.contains(acc["text"], a)
        at = F.position(b, acc["text"])
        new = F.concat(F.substring(acc["text"], F.lit(1), at - 1), a, F.substring(acc["text"], at + F.length(b), F.length(acc["text"])))
        return F.struct(F.when(good, new).otherwise(acc["text"]).alias("text"), (acc["applied"] + good.cast("int")).alias("applied"), (acc["refused"] + (~good & ~done).cast("int")).alias("refused"))

    out = blocks.join(per, [*keys, "block_no"], "left").withColumn("r", F.when(F.col("fixes").isNull(), start).otherwise(F.aggregate("fixes", start, step)))
    return out.select(*keys, "block_no", "r.text", "r.applied", "r.refused")


STRUCTURAL = ["excessive_empty_td", "excessive_columns"]
TEXTUAL = ["volume_inflation", "text_coverage_low"]


def _any(signals: Column, names: list[str]) -> Column:
    return F.arrays_overlap(signals, F.array(*map(F.lit, names)))


def candidate_type(signals: Column) -> Column:
    """native_missing, structural, text_omission, mixed or unknown by the signals of a page."""
    native, shape, text = F.array_contains(signals, "native_table_text_missing"), _any(signals, STRUCTURAL), _any(signals, TEXTUAL)
    return F.when(native & shape, "mixed").when(native, "native_missing").when(shape & text, "mixed").when(shape, "structural").when(text, "text_omission").otherwise("unknown")


def repair_types(signals: Column, columns: Column) -> Column:
    """Kinds of repair that the signals call for; a layout is only redone above 20 columns, and structure_warning is what is left."""
    found = F.array_compact(
        F.array(F.when(_any(signals, STRUCTURAL) & (columns > 20), "pretty_print"), F.when(F.array_contains(signals, "native_table_text_missing"), "fill_missing_text"), F.when(_any(signals, TEXTUAL), "structure_warning"))
    )
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("structure_warning")))


def candidates(pages: DataFrame, package: str, page: str, signals: str, html: str) -> DataFrame:
    """(package, page, candidate_id, type, signals): pages with signals; signals of the text alone need a table on the page."""
    s = F.col(signals)
    table = F.coalesce(F.col(html), F.lit("")).rlike("(?i)<table")
    kept = pages.where((F.size(s) > 0) & (table | _any(s, [*STRUCTURAL, "native_table_text_missing"])))
    return kept.select(package, page, F.format_string("%s_p%04d", F.col(package), F.col(page)).alias("candidate_id"), candidate_type(s).alias("type"), F.array_join(s, ",").alias("signals"))


def parent_suggestion(path_parts: Column, key: Column, existing: Column) -> Column:
    """The last part of a section path as the parent of a key; null where there is one, the path is short, or the key is blank or in the path."""
    k = F.trim(F.coalesce(key, F.lit("")))
    ok = (F.coalesce(existing, F.lit("")) == "") & (F.size(path_parts) >= 2) & (k != "") & ~F.array_contains(path_parts, k)
    return F.when(ok, F.element_at(path_parts, -1))


def select_pages(df: DataFrame, page: str, wanted: list[int] | None, most: int) -> DataFrame:
    """The rows of the wanted pages, or of all; more than ``most`` is an error, never a cut."""
    from ..runtime import require

    kept = df.where(F.col(page).isin(wanted)) if wanted is not None else df
    n = kept.select(page).distinct().limit(most + 1).count()
    require(n <= most, f"more than {most} pages are selected")
    return kept
