"""Derived inputs: the given tables in the forms that the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import anchors, toc
from ..runtime import table


def chunk_rows(spark: SparkSession, d: str) -> DataFrame:
    """Chunks once by id, with seq and page_first, page_last."""
    c = table(spark, d, "chunks").dropDuplicates(["id"])
    r = T.page_range("page")
    return c.withColumn("seq", F.regexp_extract("id", r"_(\d+)$", 1).try_cast("int")).withColumn("page_first", r["first"]).withColumn("page_last", r["last"])


def markdown_parts(spark: SparkSession, d: str) -> DataFrame:
    """(package_id, seq, text): each chunk as Markdown with its page anchor and its section as a heading."""
    c = chunk_rows(spark, d)
    anchor = F.when(F.col("page_first").isNotNull(), F.format_string("<!-- pages %d-%d -->\n", "page_first", "page_last")).otherwise("")
    head = F.when(F.coalesce("section", F.lit("")) != "", F.concat(F.lit("## "), F.regexp_replace("section", "[\r\n]+", " "), F.lit("\n"))).otherwise("")
    return c.select("package_id", "seq", F.concat(anchor, head, F.coalesce("content", F.lit(""))).alias("text"))


def markdown_lines(spark: SparkSession, d: str) -> DataFrame:
    return anchors.lines(markdown_parts(spark, d), ["package_id"], "text", F.col("seq"))


def toc_entries(spark: SparkSession, d: str) -> DataFrame:
    return toc.entries(table(spark, d, "toc_tree"), ["package_id"])


def seen_pages(spark: SparkSession, d: str) -> DataFrame:
    """(package_id, page, text, types): the last evaluation of each page, its key texts and the types on it."""
    v = table(spark, d, "vlm_eval").where("parse_status = 'ok'")
    last = v.groupBy("package_id", "page").agg(F.max_by(F.struct("key_text", "visual_elements"), "vlm_id").alias("v"))
    return last.select("package_id", "page", F.array_join("v.key_text", " ").alias("text"), F.transform("v.visual_elements", lambda e: e["type"]).alias("types"))


def page_texts(spark: SparkSession, d: str) -> DataFrame:
    """(package_id, page, text): contents of the chunks that begin on a page, in order."""
    c = chunk_rows(spark, d).where(F.col("page_first").isNotNull() & F.col("content").isNotNull())
    got = c.groupBy("package_id", F.col("page_first").alias("page")).agg(F.array_sort(F.collect_list(F.struct("seq", "content"))).alias("x"))
    return got.select("package_id", "page", F.array_join(F.transform("x", lambda s: s["content"]), "\n").alias("text"))
