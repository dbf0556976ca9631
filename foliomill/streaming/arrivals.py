"""Pages as they arrive: each page's newest text once, with the state of earlier batches carried over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S


def stream(spark: SparkSession, path: str, schema: S.StructType, files: int = 8) -> DataFrame:
    """A stream of the Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def first_seen(rows: DataFrame, keys: list[str], text: str, time: str, late: str = "30 days") -> DataFrame:
    """The rows without those whose key and text came before; state is dropped ``late`` after the event time."""
    return rows.withWatermark(time, late).withColumn("digest", F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).dropDuplicatesWithinWatermark([*keys, "digest"])


def arrivals_per_hour(rows: DataFrame, key: str, time: str, late: str = "2 hours") -> DataFrame:
    """(hour, key, rows): counts by hour of the event time; rows that come later than ``late`` are left out."""
    w = rows.withWatermark(time, late).groupBy(F.window(time, "1 hour").alias("w"), key).agg(F.count("*").alias("rows"))
    return w.select(F.col("w.start").alias("hour"), key, "rows")


def keep_latest(rows: DataFrame, keys: list[str], order: list[str], target: str, checkpoint: str):
    """Start a query that keeps in a Parquet folder the newest row of each key.

    Each batch is merged with the rows of the last version by one partial aggregate and written as
    the next version, so a batch that is tried again gives the same version.
    """

    def merge(batch: DataFrame, number: int) -> None:
        from ..operators.records import latest

        spark = batch.sparkSession
        if number:
            before = spark.read.schema(batch.schema).parquet(f"{target}/v={number - 1}")
            batch = batch.unionByName(before)
        latest(batch, keys, [F.col(c) for c in order]).select(*batch.columns).write.mode("overwrite").parquet(f"{target}/v={number}")

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
