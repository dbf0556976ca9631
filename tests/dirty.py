"""Tables with nulls in every column, empty and very long texts, repeated rows and extra columns."""

from pyspark.sql import functions as F


def write(spark, source: str, names: list[str], target: str) -> None:
    for name in names:
        t = spark.read.parquet(f"{source}/{name}.parquet").limit(40)
        rows = t
        for k, (c, kind) in enumerate(t.dtypes):
            some = t.limit(3)
            rows = rows.unionAll(some.withColumn(c, F.lit(None).cast(kind)))
            if kind == "string":
                rows = rows.unionAll(t.limit(1).withColumn(c, F.lit(""))).unionAll(t.limit(1).withColumn(c, F.lit("99999999999999 p_9 <" + "a测 " * 9000)))
        empty = t.limit(1).select(*[F.lit(None).cast(kind).alias(c) for c, kind in t.dtypes])
        rows = rows.unionAll(empty).unionAll(t.limit(5)).unionAll(t.limit(5))
        extra = {c: F.lit("clash") for c in ("text", "n", "line", "key", "model", "block", "bin", "size", "share", "source", "place", "page", "kind", "path", "cut") if c not in t.columns}
        rows.withColumns(extra).coalesce(2).write.parquet(f"{target}/{name}.parquet")
