"""Coverage of source rows by extracted candidates, and rules over files of fixes, candidates and plans.

Defined cases: a source row without text is 'empty'; header rows are 'header'; rows that no
candidate names are 'missing'; nulls in a rule's columns break the rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANCHOR_NAME = r"^.+_p\d{4}(-p\d{4})?$"


def source_rows(cells: DataFrame, key: str) -> DataFrame:
    """(key, table_no, row_no, cells, text, has_th, widest): the rows of grids.cells(), their texts joined by ' | '."""
    g = cells.groupBy(key, "table_no", "row_no").agg(F.array_sort(F.collect_list(F.struct("col_no", "text"))).alias("x"), F.bool_or("is_th").alias("has_th"), F.max("colspan").alias("widest"))
    return g.select(key, "table_no", "row_no", F.size("x").alias("cells"), F.array_join(F.transform("x", lambda s: s["text"]), " | ").alias("text"), "has_th", "widest")


def covered(rows: DataFrame, candidates: DataFrame, key: str, header_rows: int = 1) -> DataFrame:
    """The source rows with their number of candidates and status: header, empty, covered or missing.

    candidates are (key, table_no, row_index) with indices counted after the header rows; they are
    counted by row before they meet the source.
    """
    n = candidates.groupBy(key, "table_no", (F.col("row_index") + header_rows).alias("row_no")).agg(F.count("*").alias("candidates"))
    j = rows.join(n, [key, "table_no", "row_no"], "left").withColumn("candidates", F.coalesce("candidates", F.lit(0)))
    blank = F.trim(F.replace("text", F.lit("|"), F.lit(""))) == ""
    return j.withColumn("status", F.when(F.col("candidates") > 0, "covered").when((F.col("row_no") < header_rows) | F.col("has_th"), "header").when(blank, "empty").otherwise("missing"))


def by_table(audit: DataFrame, key: str) -> DataFrame:
    """(key, table_no, covered, missing, header, empty): rows of each table by status."""
    return audit.groupBy(key, "table_no").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("covered", "missing", "header", "empty")])


def gaps(audit: DataFrame, key: str, handled: DataFrame | None = None) -> DataFrame:
    """Missing rows that an earlier audit hasn't dealt with; handled is (key, table_no, row_no)."""
    m = audit.where("status = 'missing'").select(key, "table_no", "row_no", "text")
    return m if handled is None else m.join(handled.select(key, "table_no", "row_no").distinct(), [key, "table_no", "row_no"], "left_anti")


def unresolved_references(refs: DataFrame, targets: DataFrame, key: str, ref: str) -> DataFrame:
    """(key, ref): references, one a row, that name no target."""
    return refs.where(F.coalesce(F.col(ref), F.lit("")) != "").join(targets.select(F.col(key).alias(ref)).distinct(), ref, "left_anti")


def fix_rules() -> dict[str, Column]:
    """Rules of a correction (fix_id, fix_type, action, status, pages, before, after, expected)."""
    return {
        "id_present": F.coalesce("fix_id", F.lit("")) != "",
        "status_known": F.col("status").isin("draft", "approved", "applied", "rejected"),
        "pages_positive": (F.size("pages") > 0) & F.forall("pages", lambda p: p >= 1),
        "before_present": F.coalesce("before", F.lit("")) != "",
        "change_present": ~F.col("before").eqNullSafe(F.col("after")),
        "expected_positive": F.col("expected").isNull() | (F.col("expected") > 0),
    }


def candidate_rules() -> dict[str, Column]:
    """Rules of a table candidate (candidate_id, page, signals)."""
    known = ["excessive_empty_td", "excessive_columns", "native_table_text_missing", "volume_inflation", "text_coverage_low"]
    return {
        "anchor_format": F.col("candidate_id").rlike(ANCHOR_NAME),
        "page_positive": F.col("page") >= 1,
        "signals_known": (F.size("signals") > 0) & (F.size(F.array_except("signals", F.array(*map(F.lit, known)))) == 0),
    }


def overlapping(targets: DataFrame, owner: str, path: str) -> DataFrame:
    """(path, owners): paths that several owners claim."""
    return targets.select(owner, path).distinct().groupBy(path).agg(F.count("*").alias("owners")).where(F.col("owners") > 1)


def uncovered(changes: DataFrame, targets: DataFrame, path: str) -> DataFrame:
    """Changed paths that neither a target nor a folder that is a target holds: each path meets its own prefixes, no cross join."""
    parts = F.split(F.col(path), "/")
    prefix = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    hit = changes.select(path, F.explode(prefix).alias("__p")).join(targets.select(F.rtrim(F.col(path), F.lit("/")).alias("__p")).distinct(), "__p", "left_semi").select(path).distinct()
    return changes.select(path).distinct().join(hit, path, "left_anti")


def stale(df: DataFrame, key: str, when: str, today: Column, days: int) -> DataFrame:
    """(key, age): rows whose date lies more than so many days back; a null date is stale with a null age."""
    age = F.datediff(today, F.col(when))
    return df.select(key, age.alias("age")).where(F.col("age").isNull() | (F.col("age") > days))
