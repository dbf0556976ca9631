"""Identity of candidates by their source position, their content digests, and checks of what they rely on.

Defined cases: nulls count as ''; a position that can't be read gives no anchor and the name of
the first rule that it breaks; a page without a section, or a range over two sections, has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import toc

#: Kinds of source blocks, and prefixes of the digests.
BLOCK = r"^(html_table|md_table|paragraph):(\d+)$"
ID_PREFIX, HASH_PREFIXES = "candidate-v2", {1: "candidate-content-v1", 2: "candidate-review-v2"}
#: Columns that the digests of contents are made of.
HASH_COLUMNS = {1: ["source_pdf", "model", "section_path", "key", "value", "unit", "evidence_text", "row_hash"], 2: ["candidate_id", "key", "value", "unit", "evidence_text"]}


def _text(c: Column | str) -> Column:
    return F.trim(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")))


def source_anchor(file_hash: Column | str, block: Column | str, table_id: Column | str, row: Column | str) -> Column:
    """struct(anchor, error): 'hash|kind|block|row|slot' of a source position; ``row`` is a row number with an optional '.slot'."""
    h, b, t, r = map(_text, (file_hash, block, table_id, row))
    ref = F.when(t != "", t).otherwise(b)
    kind, number = F.regexp_extract(ref, BLOCK, 1), F.regexp_extract(ref, BLOCK, 2)
    main, dot = F.substring_index(r, ".", 1), F.contains(r, F.lit("."))
    slot = F.when(dot, F.regexp_extract(r, r"^[^.]*\.(.*)$", 1)).otherwise(F.lit("0"))
    paragraph = kind == "paragraph"
    error = (
        F.when(~h.rlike("^[0-9a-fA-F]{64}$"), "source_hash").when(kind == "", "source_position").when((t != "") & (b != "") & (t != b), "positions_differ")
        .when(paragraph & ~r.isin("", "0"), "paragraph_row").when(~paragraph & ~(main.rlike(r"^\d+$") & (F.regexp_replace(main, "^0+", "") != "")), "table_row")
        .when(~paragraph & ~slot.rlike(r"^\d+$"), "slot")
    )
    zero = F.lit("0")
    anchor = F.concat_ws("|", F.lower(h), kind, number, F.when(paragraph, zero).otherwise(main), F.when(paragraph, zero).otherwise(slot))
    return F.struct(F.when(error.isNull(), anchor).alias("anchor"), error.alias("error"))


def anchored_id(anchor: Column) -> Column:
    """The candidate's id by its source position alone; null without an anchor."""
    return F.sha2(F.concat(F.lit(ID_PREFIX + "|"), anchor), 256)


def content_hash(version: int, columns: dict[str, Column] | None = None) -> Column:
    """Digest of a candidate's content, of version 1 or 2; ``columns`` may give expressions for some of HASH_COLUMNS."""
    if version not in HASH_PREFIXES:
        raise ValueError(f"version {version} of a content digest isn't known")
    own = columns or {}
    return F.sha2(F.concat_ws("|", F.lit(HASH_PREFIXES[version]), *[F.coalesce((own[c] if c in own else F.col(c)).cast("string"), F.lit("")) for c in HASH_COLUMNS[version]]), 256)


def numbering_safety(status: Column | str, mapping: Column | str) -> Column:
    """struct(safe, status, warning): whether page targets can be taken as physical pages; a row without both has no numbering block."""
    s, m = (F.col(c) if isinstance(c, str) else c for c in (status, mapping))
    missing = s.isNull() & m.isNull()
    known = F.coalesce(s, F.lit("needs_review"))
    warning = F.when(missing, "numbering_missing").when(known == "verified", F.lit(None).cast("string")).when(F.coalesce(m, F.lit("unknown")) == "unknown", "mapping_unknown").otherwise("offset_unverified")
    return F.struct((~missing & (known == "verified")).alias("safe"), F.when(missing, "missing").otherwise(known).alias("status"), warning.alias("warning"))


def one_section(rows: DataFrame, ranges: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """(row_id, path, error) of rows (keys, row_id, page_first, page_last): the section that holds both ends of the page range.

    ranges: toc.exclusive_ranges(). Both ends of all rows meet the ranges in one as-of pass.
    """
    bad = F.when(F.col("page_first").isNull() | F.col("page_last").isNull(), "missing_page_range").when((F.col("page_first") < 1) | (F.col("page_last") < F.col("page_first")), "invalid_page_range")
    r = rows.select(*keys, row_id, "page_first", "page_last").withColumn("error", bad)
    marks = ranges.select(*keys, F.col("first").alias("page"), F.lit(0).alias("ord"), F.to_json(F.struct("last", "path")).alias("path"))
    ends = r.where("error IS NULL").select(*keys, row_id, F.explode(F.array(F.struct(F.lit(0).alias("end"), F.col("page_first").alias("page")), F.struct(F.lit(1).alias("end"), F.col("page_last").alias("page")))).alias("x")).select(*keys, row_id, "x.end", "x.page")
    at = toc.last_path_asof(ends, marks, keys, "page").withColumn("x", F.from_json("path", "last int, path string"))
    held = F.when(F.col("x.last").isNull() | (F.col("page") <= F.col("x.last")), F.col("x.path"))
    both = at.groupBy(row_id).agg(F.max(F.when(F.col("end") == 0, held)).alias("a"), F.max(F.when(F.col("end") == 1, held)).alias("z"))
    same = (F.coalesce("a", F.lit("")) != "") & F.col("a").eqNullSafe(F.col("z"))
    found = both.select(row_id, F.when(same, F.col("a")).alias("path"), F.when(~same, "section_not_unique").alias("error"))
    return found.unionByName(r.where("error IS NOT NULL").select(row_id, F.lit(None).cast("string").alias("path"), "error"))


def conflicts_by_member(conflicts: DataFrame) -> DataFrame:
    """(member, conflict_ids) of records.conflicts(): the conflicts in which each member stands, in order."""
    m = conflicts.select("conflict_id", F.explode(F.split("members", ";")).alias("member")).distinct()
    return m.groupBy("member").agg(F.array_join(F.array_sort(F.collect_list("conflict_id")), ";").alias("conflict_ids"))


def cell_form(c: Column | str) -> Column:
    """A cell's text with each run of white space as one space, for comparison."""
    return F.trim(F.regexp_replace(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), r"\s+", " "))


def cells_equal(a: Column | str, b: Column | str) -> Column:
    """Whether two cells are equal but for white space; nulls count as ''."""
    bare = [F.regexp_replace(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), r"\s+", "") for c in (a, b)]
    return bare[0] == bare[1]


def pair_groups(cells: Column | str, groups: Column | str) -> Column:
    """Several key/value candidates of one physical row, as array<struct(slot, key, marker, value)>.

    groups: array<struct(key_column, value_columns array<struct(label, column)>, marker_column)>;
    slots count from 1 over all groups. A group with a column outside the row, a blank key or no
    value gives nothing; values are 'label=cell' joined by ';'; a null marker column gives ''.
    """
    row, g = (F.col(c) if isinstance(c, str) else c for c in (cells, groups))
    n = F.size(row)
    inside = lambda k: (k >= 0) & (k < n)
    cell = lambda k: F.trim(F.coalesce(F.get(row, k), F.lit("")))

    def spec(x: Column, i: Column) -> Column:
        values = F.filter(x["value_columns"], lambda v: cell(v["column"]) != "")
        text = F.array_join(F.transform(values, lambda v: F.concat(v["label"], F.lit("="), cell(v["column"]))), "；")
        good = F.coalesce(inside(x["key_column"]) & F.forall(x["value_columns"], lambda v: F.coalesce(inside(v["column"]), F.lit(False))) & (x["marker_column"].isNull() | inside(x["marker_column"])), F.lit(False))
        return F.struct((i + 1).alias("slot"), cell(x["key_column"]).alias("key"), F.when(x["marker_column"].isNull(), F.lit("")).otherwise(cell(x["marker_column"])).alias("marker"), text.alias("value"), good.alias("good"))

    kept = F.filter(F.transform(F.coalesce(g, F.array().cast("array<struct<key_column:int,value_columns:array<struct<label:string,column:int>>,marker_column:int>>")), spec), lambda s: s["good"] & (s["key"] != "") & (s["value"] != ""))
    return F.transform(kept, lambda s: F.struct(s["slot"].alias("slot"), s["key"].alias("key"), s["marker"].alias("marker"), s["value"].alias("value")))


def first_column_parents(rows: DataFrame, table: list[str], first: str, key: str, key_column: str, parent: str) -> DataFrame:
    """The rows with ``parent`` filled from their first cell where the first column repeats values.

    Only for tables of more than two rows whose key stands in a later column; a parent that is
    there stays, and a blank first cell, or one equal to the key, gives none.
    """
    f = F.trim(F.coalesce(F.col(first), F.lit("")))
    per = rows.groupBy(*table, f.alias("__f")).agg(F.count("*").alias("n"))
    per = per.groupBy(*[F.col(c).alias(f"__{c}") for c in table]).agg(F.sum("n").alias("__rows"), F.count("*").alias("__values"))
    on = F.lit(True)
    for c in table:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    use = (F.coalesce(F.col(parent), F.lit("")) == "") & (F.col("__rows") > 2) & (F.col("__values") < F.col("__rows")) & (F.col(key_column) > 0) & (f != "") & (f != F.trim(F.coalesce(F.col(key), F.lit(""))))
    return rows.join(per, on).withColumn(parent, F.when(use, f).otherwise(F.coalesce(F.col(parent), F.lit("")))).drop("__rows", "__values", *[f"__{c}" for c in table])


def distinguished(df: DataFrame, key: str, row_index: str, content: list[str]) -> DataFrame:
    """The rows with ids that several rows share told apart by 16 digits of their content's digest.

    Only where all rows of the id have a row index and all their contents differ; other shared
    ids stay as they are, for review. Ids are counted by content first, so a hot id is a few rows.
    """
    from ..functions.text import digest

    d = df.withColumn("__h", digest(*content)).withColumn("__i", F.trim(F.coalesce(F.col(row_index).cast("string"), F.lit(""))) != "")
    per = d.groupBy(F.col(key).alias("__k"), "__h").agg(F.count("*").alias("n"), F.bool_and("__i").alias("i"))
    per = per.groupBy("__k").agg(F.sum("n").alias("__rows"), F.count("*").alias("__contents"), F.bool_and("i").alias("__all"))
    apart = (F.col("__rows") > 1) & (F.col("__contents") == F.col("__rows")) & F.col("__all")
    j = d.join(per, F.col(key).eqNullSafe(F.col("__k")))
    return j.withColumn(key, F.when(apart, F.concat(F.col(key), F.lit("-"), F.left("__h", F.lit(16)))).otherwise(F.col(key))).select(*df.columns)


def flagged_collisions(df: DataFrame, key: str, notes: str, marker: str = "source_anchor_collision") -> DataFrame:
    """The rows whose id others share, with the marker among their notes, once; for ids of which a position must have one."""
    shared = df.groupBy(F.col(key).alias("__k")).agg(F.count("*").alias("n")).where("n > 1").select("__k")
    old = F.coalesce(F.col(notes), F.lit(""))
    new = F.when(F.array_contains(F.split(old, ";"), marker), old).otherwise(F.concat_ws(";", F.nullif(old, F.lit("")), F.lit(marker)))
    return df.join(shared, F.col(key).eqNullSafe(F.col("__k")), "left_semi").withColumn(notes, new)


def data_fixes(fixes: DataFrame) -> DataFrame:
    """(key, ord, field, action, value, fix_id) of the applied corrections of data among (ord, review_action, status, target_record_id, target_field, field_action, new_value, fix_id); incomplete ones are left out, a missing action is 'amend'."""
    t = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    kept = fixes.where((F.col("review_action") == "fix_data") & (F.col("status") == "applied") & (t("target_record_id") != "") & (t("target_field") != "") & (t("fix_id") != ""))
    return kept.select(t("target_record_id").alias("key"), "ord", t("target_field").alias("field"), F.coalesce(F.trim("field_action"), F.lit("amend")).alias("action"), F.coalesce("new_value", F.lit("")).alias("value"), t("fix_id").alias("fix_id"))


def _page(p: Column) -> Column:
    return F.lpad(p.cast("string"), F.greatest(F.lit(4), F.length(p.cast("string"))), F.lit("0"))


def page_anchor(page: Column | str) -> Column:
    """The anchor of one page in Markdown."""
    p = (F.col(page) if isinstance(page, str) else page).cast("string")
    return F.concat(F.lit("<!-- pages "), p, F.lit("-"), p, F.lit(" -->"))


def table_id(package: Column | str, pages: Column | str) -> Column:
    """The id of a table by its pages: none, one, or the first and the last of several."""
    p, n = (F.col(c) if isinstance(c, str) else c for c in (package, pages))
    of = lambda i: F.concat(F.lit("p"), _page(F.element_at(n, i)))
    size = F.size(F.coalesce(n, F.array().cast("array<int>")))
    return F.concat(p, F.lit("_table_"), F.when(size == 0, "unknown").when(size == 1, of(1)).otherwise(F.concat(of(1), F.lit("-"), of(-1))))


def page_list(c: Column | str) -> Column:
    """The different pages of '13,31' in order; null for a blank list, and an error for anything but positive numbers."""
    s = F.col(c) if isinstance(c, str) else c
    parts = F.transform(F.split(s, ",", -1), lambda x: F.trim(x))
    good = F.forall(parts, lambda x: x.rlike(r"^\d{1,9}$") & (x.try_cast("int") >= 1))
    return F.when(F.trim(F.coalesce(s, F.lit(""))) != "", F.when(good, F.array_sort(F.array_distinct(F.transform(parts, lambda x: x.try_cast("int"))))).otherwise(F.raise_error(F.concat(F.lit("pages: "), s)).cast("array<int>")))
