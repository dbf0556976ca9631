"""Constraint checks: each rule is an expression, each violation a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule): one row for each rule that a row breaks; a rule that is null for a row is broken."""
    tests = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return df.select(F.col(key), F.explode(F.array_compact(F.array(*tests))).alias("rule"))


def summary(v: DataFrame) -> DataFrame:
    return v.groupBy("rule").agg(F.count("*").alias("rows"))


def vlm_rules() -> dict[str, Column]:
    """Rules of an evaluated page image."""
    ok = F.col("parse_status") == "ok"
    return {
        "status_known": F.col("parse_status").isin("ok", "failed"),
        "page_positive": F.col("page") >= 1,
        "summary_present": ~ok | (F.coalesce("page_summary", F.lit("")) != ""),
        "confidence_in_range": ~ok | F.col("confidence").between(0, 1),
        "elements_named": F.forall(F.coalesce("visual_elements", F.array().cast("array<struct<type:string,description:string>>")), lambda e: F.coalesce(e["type"], F.lit("")) != ""),
        "key_text_present": F.forall(F.coalesce("key_text", F.array().cast("array<string>")), lambda t: F.coalesce(t, F.lit("")) != ""),
        "error_only_if_failed": ok | F.col("error").isNotNull(),
    }


def repaired_vlm(df: DataFrame, key: str) -> DataFrame:
    """(key, page_summary, key_text, confidence, valid): null and '' elements away, confidence held within 0 and 1."""
    texts = F.filter(F.coalesce("key_text", F.array().cast("array<string>")), lambda t: F.coalesce(t, F.lit("")) != "")
    conf = F.least(F.greatest(F.col("confidence"), F.lit(0.0)), F.lit(1.0))
    return df.select(key, F.coalesce("page_summary", F.lit("")).alias("page_summary"), texts.alias("key_text"), conf.alias("confidence"), ((F.col("parse_status") == "ok") & F.col("page_summary").isNotNull() & F.col("confidence").between(0, 1)).alias("valid"))


def missing_pages(df: DataFrame, keys: list[str], page: str, last: DataFrame, last_page: str) -> DataFrame:
    """(keys, page): pages from 1 to the last one that no row has."""
    want = last.where(F.col(last_page) >= 1).select(*keys, F.explode(F.sequence(F.lit(1), F.col(last_page).cast("int"))).alias("page"))
    have = df.select(*keys, F.col(page).cast("int").alias("page")).distinct()
    return want.join(have, [*keys, "page"], "left_anti")


def tree_difference(a: DataFrame, b: DataFrame, path: str, content: str) -> DataFrame:
    """(path, change): added, removed or changed between two listings."""
    x, y = a.select(F.col(path).alias("path"), F.col(content).alias("l")), b.select(F.col(path).alias("path"), F.col(content).alias("r"))
    j = x.withColumn("hl", F.lit(1)).join(y.withColumn("hr", F.lit(1)), "path", "full_outer")
    return j.withColumn("change", F.when(F.col("hl").isNull(), "added").when(F.col("hr").isNull(), "removed").when(~F.col("l").eqNullSafe(F.col("r")), "changed")).where(F.col("change").isNotNull()).select("path", "change")
