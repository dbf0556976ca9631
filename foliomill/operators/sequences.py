"""Order-dependent operators that hold up where one key has a third of all rows.

A window over a whole package would put that package into one task. Here the rows of a key are
dealt into blocks of neighbouring places; windows run within a block, and what a block hands on
to the next ones is one row for each block, joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Places of a block: rows of a key whose order numbers share the quotient by this number stay together.
BLOCK = 1 << 16


def _blocked(df: DataFrame, order: Column, block: int) -> DataFrame:
    return df.withColumn("__at", order.cast("long")).withColumn("__block", F.floor(F.col("__at") / block))


def _carry_join(df: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    c = carry.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__block").alias("__b"), "__carry")
    on = F.col("__block") == F.col("__b")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return df.join(c, on, "left").drop("__b", *[f"__{k}" for k in keys])


def forward_fill(df: DataFrame, keys: list[str], order: Column, value: Column, name: str, block: int = BLOCK) -> DataFrame:
    """``name``: the last value that isn't null at or before each row of a key; null before the first.

    Ties in the order take the greatest value of the tied rows.
    """
    return forward_fill_all(df, keys, order, {name: value}, block)


def forward_fill_all(df: DataFrame, keys: list[str], order: Column, values: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """forward_fill of several values in one pass: the rows are read and dealt into blocks once for all of them."""
    v = {n: f"__v{k}" for k, n in enumerate(values)}
    d = _blocked(df, order, block).withColumns({v[n]: c for n, c in values.items()})
    ends = d.groupBy(*keys, "__block").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("__at", c))).alias(c) for c in v.values()])
    before = W.partitionBy(*keys).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    carry = ends.withColumn("__carry", F.struct(*[F.last(c, True).over(before).alias(c) for c in v.values()])).select(*keys, "__block", "__carry")
    local = {f"__l{c}": F.last(c, True).over(W.partitionBy(*keys, "__block").orderBy("__at", F.col(c).asc_nulls_first())) for c in v.values()}
    out = _carry_join(d.withColumns(local), carry, keys)
    return out.withColumns({n: F.coalesce(f"__l{c}", F.col("__carry")[c]) for n, c in v.items()}).drop("__at", "__block", "__carry", *v.values(), *local)


def previous(df: DataFrame, keys: list[str], order: Column, value: Column, name: str, block: int = BLOCK) -> DataFrame:
    """``name``: the value of the row before each one of a key; null for the first. The order must be unique within a key."""
    d = _blocked(df, order, block).withColumn("__v", value)
    last = d.groupBy(*keys, "__block").agg(F.max_by("__v", "__at").alias("__last"))
    before = F.lag("__last").over(W.partitionBy(*keys).orderBy("__block"))
    out = _carry_join(d, last.withColumn("__carry", before).select(*keys, "__block", "__carry"), keys)
    w = W.partitionBy(*keys, "__block").orderBy("__at")
    return out.withColumn(name, F.when(F.row_number().over(w) == 1, F.col("__carry")).otherwise(F.lag("__v").over(w))).drop("__v", "__at", "__block", "__carry")


def _null_safe(keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return on


def running_sum(df: DataFrame, keys: list[str], order: Column, value: Column, name: str, block: int = BLOCK) -> DataFrame:
    """``name``: the sum of the values of a key up to each row; the order must be unique within a key."""
    d = _blocked(df, order, block).withColumn("__v", F.coalesce(value, F.lit(0)).cast("long"))
    local = F.sum("__v").over(W.partitionBy(*keys, "__block").orderBy("__at").rowsBetween(W.unboundedPreceding, 0))
    sums = d.groupBy(*keys, "__block").agg(F.sum("__v").alias("__s"))
    before = F.sum("__s").over(W.partitionBy(*keys).orderBy("__block").rowsBetween(W.unboundedPreceding, -1))
    carry = sums.withColumn("__carry", F.coalesce(before, F.lit(0)))
    return _carry_join(d.withColumn("__local", local), carry, keys).withColumn(name, F.col("__local") + F.coalesce("__carry", F.lit(0))).drop("__v", "__at", "__block", "__local", "__carry")


def running_min(df: DataFrame, keys: list[str], order: Column, value: Column, name: str, block: int = BLOCK) -> DataFrame:
    """``name``: the least value of a key up to each row, nulls left out; the order must be unique within a key."""
    d = _blocked(df, order, block).withColumn("__v", value)
    local = F.min("__v").over(W.partitionBy(*keys, "__block").orderBy("__at").rowsBetween(W.unboundedPreceding, 0))
    least = d.groupBy(*keys, "__block").agg(F.min("__v").alias("__s"))
    before = F.min("__s").over(W.partitionBy(*keys).orderBy("__block").rowsBetween(W.unboundedPreceding, -1))
    carry = least.withColumn("__carry", before).select(*keys, "__block", "__carry")
    return _carry_join(d.withColumn("__local", local), carry, keys).withColumn(name, F.least("__local", "__carry")).drop("__v", "__at", "__block", "__local", "__carry")


def row_numbers(df: DataFrame, keys: list[str], order: Column, name: str, block: int = BLOCK) -> DataFrame:
    """``name``: 1, 2, ... within a key; the order must be unique within a key."""
    return running_sum(df, keys, order, F.lit(1), name, block)


def page_runs(df: DataFrame, keys: list[str], page: str) -> DataFrame:
    """(keys, first_page, last_page, pages): maximal runs of consecutive different pages.

    A run begins where the page before isn't there: an anti join instead of a window over the key;
    the run's end is then found over the beginnings and ends only.
    """
    p = df.select(*keys, F.col(page).cast("long").alias("p")).where(F.col("p").isNotNull()).distinct()
    near = p.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("p").alias("_p"))
    begin = p.join(near, _null_safe(keys) & (F.col("_p") == F.col("p") - 1), "left_anti").select(*keys, "p", F.lit(1).alias("b"))
    end = p.join(near, _null_safe(keys) & (F.col("_p") == F.col("p") + 1), "left_anti").select(*keys, "p", F.lit(0).alias("b"))
    number = lambda d: row_numbers(d, keys, F.col("p"), "run")
    a = number(begin).select(*keys, "run", F.col("p").alias("first_page"))
    z = number(end).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("run").alias("_run"), F.col("p").alias("last_page"))
    both = a.join(z, _null_safe(keys) & (F.col("run") == F.col("_run")))
    return both.select(*keys, F.col("first_page").cast("int").alias("first_page"), F.col("last_page").cast("int").alias("last_page"), (F.col("last_page") - F.col("first_page") + 1).cast("int").alias("pages"))


def cluster_1d(df: DataFrame, keys: list[str], x: str, gap: float = 8.0) -> DataFrame:
    """(keys, x, depth): values whose neighbours are at most ``gap`` apart form a cluster; depth is the rank of the nearest centroid.

    Works on the different values of a key, rounded to a tenth, of which a page has few.
    """
    d = df.select(*keys, F.round(F.col(x), 1).alias("x")).where(F.col("x").isNotNull()).distinct()
    w = W.partitionBy(*keys).orderBy("x")
    d = d.withColumn("new", F.when(F.col("x") - F.lag("x").over(w) > gap, 1).otherwise(0))
    d = d.withColumn("cluster", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    centre = d.groupBy(*keys, "cluster").agg(F.avg("x").alias("c"))
    pair = d.select(*keys, "x").join(centre.select(*[F.col(k).alias(f"_{k}") for k in keys], "cluster", "c"), _null_safe(keys))
    best = pair.groupBy(*keys, "x").agg(F.min_by("cluster", F.struct(F.abs(F.col("x") - F.col("c")), "cluster")).alias("depth"))
    return best.select(*keys, "x", F.col("depth").cast("int").alias("depth"))
