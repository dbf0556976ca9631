"""Readers and writers of packages: strict text tables, JSON lines, Markdown, segments.

Every column is text and blank means missing, as in the files themselves. Readers are lazy but
for their checks of uniqueness, which run one aggregate.
"""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from ..operators.records import require_unique
from ..runtime import require


def _strings(names: list[str]) -> S.StructType:
    return S.StructType([S.StructField(n, S.StringType()) for n in names])


DRAFT = _strings("source_pdf model section_path key value unit page_start page_end evidence_text confidence status notes source_block_id table_id row_index parent_key key_role".split())
CONTENT_LIST = S.ArrayType(S.StructType([S.StructField("type", S.StringType()), S.StructField("page_idx", S.IntegerType()), S.StructField("text", S.StringType()), S.StructField("table_body", S.StringType()), S.StructField("img_path", S.StringType())]))
SEGMENT = r"/p(\d{4,})-(\d{4,})/"


def read_csv(spark: SparkSession, path: str, schema: S.StructType | None = None, exact: bool = False) -> DataFrame:
    """A CSV with a header: names trimmed, missing values ''. With ``exact`` the columns must be those of the schema."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", False).csv(path)
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    if schema is not None:
        extra, lack = set(raw.columns) - set(schema.names), set(schema.names) - set(raw.columns)
        require(not lack and not (exact and extra), f"{path}: columns missing {sorted(lack)}, unknown {sorted(extra) if exact else []}")
        raw = raw.select(*schema.names)
    return raw.na.fill("")


def read_keyed_csv(spark: SparkSession, path: str, key: str, schema: S.StructType | None = None) -> DataFrame:
    """A CSV whose key column must be filled and unique."""
    rows = read_csv(spark, path, schema)
    require(rows.where(F.trim(key) == "").limit(1).count() == 0, f"{path}: blank {key}")
    return require_unique(rows, [key], path)


def read_jsonl(spark: SparkSession, path: str, schema: S.StructType, strict: bool = True) -> DataFrame:
    """JSON lines as rows; blank lines are skipped, malformed ones fail (strict) or are left out, and unknown keys fail (strict)."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    row = F.from_json("value", S.StructType([*schema.fields, S.StructField("_bad", S.StringType())]), {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    got = lines.select("value", row.alias("r"), F.json_object_keys("value").alias("keys"))
    bad = F.col("r._bad").isNotNull() | F.col("keys").isNull()
    if strict:
        unknown = F.size(F.array_except("keys", F.array(*map(F.lit, schema.names)))) > 0
        wrong = got.where(bad | unknown).select("value").limit(3).collect()
        require(not wrong, f"{path}: malformed or unknown keys: {[w.value[:80] for w in wrong]}")
    return got.where(~bad).select(*[F.col("r")[n].alias(n) for n in schema.names])


def read_json_document(spark: SparkSession, path: str, schema: S.StructType) -> DataFrame:
    """One JSON document as one row; malformed is an error."""
    return spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(schema).json(path)


def canonical_path(package: str, relative: str | None) -> str:
    """The Markdown file that a manifest names: relative, inside the package, and there."""
    require(bool(relative) and not os.path.isabs(relative), "files.markdown must be a relative path")
    root = Path(package).resolve()
    path = (root / relative).resolve()
    require(path.is_relative_to(root), "files.markdown leaves the package")
    require(path.is_file(), f"{relative} is not there")
    return str(path)


def read_markdown(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, text) of whole files."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_segments(spark: SparkSession, package: str) -> DataFrame:
    """(start_page, end_page, path, text): of each folder pNNNN-MMMM below segments the first Markdown file by path."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(f"{package}/segments", wholetext=True)
    f = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")).where(F.col("path").rlike(SEGMENT))
    f = f.select(F.regexp_extract("path", SEGMENT, 1).try_cast("int").alias("start_page"), F.regexp_extract("path", SEGMENT, 2).try_cast("int").alias("end_page"), "path", "text")
    first = f.groupBy("start_page", "end_page").agg(F.min(F.struct("path", "text")).alias("x"))
    return first.select("start_page", "end_page", "x.path", "x.text")


def read_content_lists(spark: SparkSession, package: str) -> DataFrame:
    """(start_page, end_page, item_no, type, page_idx, text, table_body, img_path) of the first-format content lists of all segments."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*content_list.json").text(f"{package}/segments", wholetext=True)
    raw = raw.select(F.col("_metadata.file_path").alias("path"), F.from_json("value", CONTENT_LIST).alias("items")).where(F.col("path").rlike(SEGMENT) & ~F.col("path").contains("_v2"))
    return raw.select(F.regexp_extract("path", SEGMENT, 1).try_cast("int").alias("start_page"), F.regexp_extract("path", SEGMENT, 2).try_cast("int").alias("end_page"), F.posexplode("items").alias("item_no", "i")).select("start_page", "end_page", "item_no", "i.*")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of all files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """A folder of CSV files with these columns in this order; other columns are left out."""
    df.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """A folder of JSON lines; nulls are kept as null, other scripts as they are."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def publish(staged: str, target: str) -> None:
    """Put a written folder in the place of another: the old one is set aside first and comes back if the move fails."""
    aside = f"{target}.aside"
    if os.path.exists(target):
        os.rename(target, aside)
    try:
        os.rename(staged, target)
    except OSError:
        if os.path.exists(aside):
            os.rename(aside, target)
        raise
    if os.path.exists(aside):
        import shutil

        shutil.rmtree(aside)
