"""Markdown with page anchors: lines, blocks, page ranges, headings and sections.

A line is addressed by (keys, at): ``place`` numbers the lines of a document in order, with gaps
allowed. Anything that looks back over the lines of a document goes through operators.sequences,
so no document has to fit into one task.

Defined cases: lines before the first anchor have no page range (or, for by_position, the first
range); documents without anchors have none; a null text has no lines, '' has one empty line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .sequences import forward_fill, forward_fill_all, previous, row_numbers, running_min, running_sum

ANCHOR = r"<!--\s*pages?\s*(\d+)\s*[-–—]\s*(\d+)\s*-->"
HEADING = r"^(#{1,6})\s+(.+)$"
#: Room for the lines of one part of a document in ``place``.
PART_LINES = 1 << 20
#: Lines of so many neighbouring parts are one block of operators.sequences; what is handed on is one row a block.
BLOCK = 1000 * PART_LINES


def lines(df: DataFrame, keys: list[str], text: str, part: Column | None = None) -> DataFrame:
    """(keys, place, line, anchor_first, anchor_last, level, title) of the texts, one row a line.

    ``part`` numbers the parts of a document that come as several rows.
    """
    split = df.select(*keys, (part if part is not None else F.lit(0)).cast("long").alias("__part"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("__i", "line"))
    a = F.nullif(F.regexp_extract("line", ANCHOR, 1), F.lit("")).try_cast("int")
    z = F.nullif(F.regexp_extract("line", ANCHOR, 2), F.lit("")).try_cast("int")
    level = F.nullif(F.length(F.regexp_extract("line", HEADING, 1)), F.lit(0))
    title = F.when(level.isNotNull(), T.strip(F.regexp_extract("line", HEADING, 2)))
    return split.select(*keys, (F.col("__part") * PART_LINES + F.col("__i")).alias("place"), "line", a.alias("anchor_first"), z.alias("anchor_last"), level.alias("level"), title.alias("title"))


def page_ranges(rows: DataFrame, keys: list[str], default_first: bool = False) -> DataFrame:
    """The lines with (page_first, page_last) of the last anchor at or before each; ``default_first`` gives the lines before it the first range."""
    here = F.when(F.col("anchor_first").isNotNull(), F.struct("anchor_first", "anchor_last"))
    out = forward_fill(rows, keys, F.col("place"), here, "__range", BLOCK)
    if default_first:
        first = rows.where(F.col("anchor_first").isNotNull()).groupBy(*keys).agg(F.min_by(F.struct("anchor_first", "anchor_last"), "place").alias("__first"))
        out = out.join(first, keys, "left").withColumn("__range", F.coalesce("__range", "__first", F.struct(F.lit(1).alias("anchor_first"), F.lit(1).alias("anchor_last")))).drop("__first")
    return out.withColumn("page_first", F.col("__range.anchor_first")).withColumn("page_last", F.col("__range.anchor_last")).drop("__range")


def blocks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, block_no, page_first, page_last, lines, text): what stands from each anchor to the next; block 0, before the first, is left out."""
    n = running_sum(rows, keys, F.col("place"), F.col("anchor_first").isNotNull().cast("int"), "block_no", BLOCK).where(F.col("block_no") > 0)
    out = n.groupBy(*keys, "block_no").agg(
        F.max("anchor_first").alias("page_first"), F.max("anchor_last").alias("page_last"), F.count("*").alias("lines"), F.array_sort(F.collect_list(F.struct("place", "line"))).alias("x")
    )
    return out.select(*keys, "block_no", "page_first", "page_last", "lines", F.array_join(F.transform("x", lambda s: s["line"]), "\n").alias("text"))


def repeated_anchors(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, anchor_first, anchor_last, first_at, times) of page ranges that are anchored more than once."""
    a = rows.where(F.col("anchor_first").isNotNull())
    return a.groupBy(*keys, "anchor_first", "anchor_last").agg(F.min("place").alias("first_at"), F.count("*").alias("times")).where(F.col("times") > 1)


def heading_paths(rows: DataFrame, keys: list[str], levels: int = 4) -> DataFrame:
    """The lines with ``path``: the open headings at each line, outermost first, as a stack by level.

    A heading of level l closes those of level l and deeper. For each level the last heading is
    filled forward; it is open if no heading of a lower level came after it.
    """
    out = forward_fill_all(rows, keys, F.col("place"), {f"__h{k}": F.when(F.col("level") == k, F.struct("place", "title")) for k in range(1, levels + 1)}, BLOCK)
    parts, after = [], F.lit(-1).cast("long")
    for k in range(1, levels + 1):
        h = F.col(f"__h{k}")
        parts.append(F.when(h.isNotNull() & (h["place"] > after), h["title"]))
        after = F.greatest(after, F.coalesce(h["place"], F.lit(-1)))
    return out.withColumn("path", F.array_join(F.array_compact(F.array(*parts)), " / ")).drop(*[f"__h{k}" for k in range(1, levels + 1)])


def truncated_paths(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The headings with ``path`` by position: a heading of level l follows at most l - 1 of the open ones, also where levels are skipped.

    After the n-th heading as many are open as the least of n and, over all headings t up to it,
    level(t) + n - t; so the depth comes from a running minimum and the path from the stack by depth.
    """
    h = row_numbers(rows.where(F.col("level").isNotNull()), keys, F.col("place"), "__n", BLOCK)
    h = running_min(h, keys, F.col("place"), F.col("level") - F.col("__n"), "__m", BLOCK)
    deep = h.withColumn("__level", F.col("level")).withColumn("level", (F.col("__n") + F.least(F.lit(0), F.col("__m"))).cast("int"))
    return heading_paths(deep, keys, 6).withColumn("level", F.col("__level")).drop("__n", "__m", "__level")


def sections(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, section_no, at, kind, title, text): the text split at '## ' headings and at anchors.

    A split point is a line, so an anchor in the line of a heading makes none of its own.
    A section that begins at an anchor has the title of the last heading before it; a heading
    right after an anchor takes its place; text before the first split point is left out.
    """
    point = F.when(F.col("level") == 2, "h2").when(F.col("anchor_first").isNotNull(), "anchor")
    p = rows.withColumn("__point", point)
    p = running_sum(p, keys, F.col("place"), F.col("__point").isNotNull().cast("int"), "section_no", BLOCK).where(F.col("section_no") > 0)
    p = forward_fill(p, keys, F.col("place"), F.when(F.col("level") == 2, F.col("title")), "__title", BLOCK)
    out = p.groupBy(*keys, "section_no").agg(
        F.min("place").alias("place"), F.max("__point").alias("kind"), F.min_by("__title", "place").alias("title"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda s: s["line"]), "\n").alias("text")
    )
    return out.select(*keys, "section_no", "place", "kind", F.coalesce("title", F.lit("")).alias("title"), T.strip("text").alias("text"))


def read_pages(block_rows: DataFrame, keys: list[str], first: int, last: int) -> DataFrame:
    """(keys, blocks, text): the blocks that overlap the pages, in order; keys without one don't come out."""
    hit = block_rows.where((F.col("page_first") <= last) & (F.col("page_last") >= first))
    got = hit.groupBy(*keys).agg(F.count("*").alias("blocks"), F.array_sort(F.collect_list(F.struct("block_no", "text"))).alias("x"))
    return got.select(*keys, "blocks", F.array_join(F.transform("x", lambda s: s["text"]), "\n").alias("text"))


def merge_parts(df: DataFrame, keys: list[str], order: Column, text: str, sep: str = "\n\n---\n\n", volume: int = 4096) -> DataFrame:
    """(keys, volume, parts, text): texts of a key in order with a separator, in volumes of a bounded number of places.

    Volumes joined with the separator give the whole; no value has to hold a whole document.
    """
    got = df.groupBy(*keys, F.floor(order / volume).cast("int").alias("volume")).agg(F.count("*").alias("parts"), F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col(text).alias("t")))).alias("x"))
    return got.select(*keys, "volume", "parts", F.array_join(F.transform("x", lambda s: s["t"]), sep).alias("text"))


def colon_rows(rows: DataFrame, keys: list[str], skip_numeric: bool = False) -> DataFrame:
    """Candidate records of 'key：value' lines: (keys, place, key, value, unit, role, class, confidence, status, evidence)."""
    s = T.strip("line")
    hit = rows.withColumn("__s", s).where(F.col("__s").rlike(T.COLON_LINE))
    k, v = T.strip(F.regexp_extract("__s", T.COLON_LINE, 1)), T.strip(F.regexp_extract("__s", T.COLON_LINE, 2))
    out = hit.withColumn("key", k).withColumn("__v", v).withColumn("class", T.colon_class("key", "__v")).where(F.col("class") != "non_business")
    if skip_numeric:
        out = out.where(~F.col("key").rlike(r"^\d+$"))
    out = out.withColumn("__u", T.split_unit("__v"))
    sure = (F.col("class") == "business_candidate") & F.col("__u.value").rlike(r"\d") & (F.col("__u.unit") != "")
    return out.select(
        *keys, "place", "key", F.col("__u.value").alias("value"), F.col("__u.unit").alias("unit"), T.key_role("key").alias("role"), "class",
        F.when(sure, "medium").otherwise("low").alias("confidence"), F.when(F.col("class") == "business_candidate", "draft").otherwise("needs_review").alias("status"), F.left("__s", F.lit(200)).alias("evidence"),
    )


def pipe_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, table_at, row_index, header, cells) of Markdown pipe tables: runs of |-lines whose second line is a separator."""
    r = rows.withColumn("__pipe", F.col("line").rlike(r"^\s*\|.*\|\s*$").cast("int"))
    r = forward_fill(r, keys, F.col("place"), F.when(F.col("__pipe") == 0, F.col("place")), "__before", BLOCK)
    p = r.where(F.col("__pipe") == 1).withColumn("table_at", F.coalesce(F.col("__before"), F.lit(-1)) + 1)
    inner = F.regexp_replace(F.regexp_replace(T.strip("line"), r"^\|", ""), r"\|$", "")
    p = p.withColumn("cells", F.transform(F.split(inner, r"\|"), T.strip)).withColumn("row", (F.col("place") - F.col("table_at")).cast("int"))
    rule = F.forall("cells", lambda x: x.rlike(r"^:?-{1,}:?$"))
    head = p.where(F.col("row") == 0).select(*keys, "table_at", F.col("cells").alias("header"))
    ruled = p.where((F.col("row") == 1) & rule).select(*keys, "table_at")
    body = p.where(F.col("row") > 1).join(ruled, [*keys, "table_at"], "left_semi").join(head, [*keys, "table_at"])
    return body.select(*keys, "table_at", (F.col("row") - 2).alias("row_index"), "header", "cells")


def numbered(df: DataFrame, keys: list[str], order: Column, prefix: Column, name: str, width: int = 3) -> DataFrame:
    """``name``: prefix and the zero-padded number of each row within its key."""
    n = row_numbers(df, keys, order, "__n")
    return n.withColumn(name, F.concat(prefix, F.lpad(F.col("__n").cast("string"), F.greatest(F.lit(width), F.length(F.col("__n").cast("string"))), F.lit("0")))).drop("__n")


def previous_line_repeats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Lines equal to the line before them in their document, be it the last one of the part before."""
    return previous(rows, keys, F.col("place"), F.col("line"), "__before", BLOCK).where(F.col("line") == F.col("__before")).drop("__before")
