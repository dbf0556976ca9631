"""Problem 7: filling fixed-capacity containers with items.

Sum-of-squares packing: with N(g) open containers of each residual gap g, an item goes where
the sum of N(g)² becomes smallest. The items of a block are taken from the largest to the
smallest, so that ties, which the narrowest gap wins, close containers early. A text above the
capacity is divided: its full pieces fill containers of their own, the rest is an item.

Scale: the rows are dealt into blocks of a fixed number of tokens on average by a hash of
their id, so neither one source nor one group of copies can make a block larger than another;
each block is packed by one task. What a block leaves in containers that are not nearly full
is dealt again into fewer, equally large blocks, level by level, until one block is left or
another level promises nothing.

Defined cases: null and '' have size 0 and come out with piece 1, size 0 and the first
container of their block; no rows give no containers; ties in size are taken by id and piece.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import settle
from . import bpe

CAPACITY = 2048
#: Rows of a block, on average. The sum of squares needs many items to fill gaps well.
BLOCK_ROWS = 20_000
#: Containers with more unused tokens than this are opened again at the next level.
SLACK = 8
#: A level that leaves more than this share of its rows in such containers is the last one.
STUCK = 0.7
ITEM = "doc_id long, piece int, size int"
PLACED = "block long, bin int, doc_id long, piece int, size int, gap int"


def pack(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """The container of each item, numbered from 0, and the gap each container is left with.

    ``sizes`` are taken in the order given; none may exceed the capacity. Putting an item of
    size s into a gap h changes the sum by 2 (N(h - s) - N(h)) + 2, where neither the full nor
    the unopened containers count.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.zeros(len(sizes), np.int64)
    gaps: list[int] = []
    far = np.int64(1) << 60
    for k, s in enumerate(sizes.tolist()):
        if s <= 0:
            bins[k] = -1
            continue
        h = capacity
        if s < capacity:
            # Change of the sum by gap h = s ... capacity - 1; a container filled to the brim leaves the sum.
            change = 2 * (count[: capacity - s] - count[s:capacity]) + 2
            change[0] = 1 - 2 * count[s]
            change[count[s:capacity] == 0] = far
            i = int(change.argmin())
            if change[i] < far and change[i] <= 2 * count[capacity - s] + 1:
                h = s + i
        if h == capacity:
            b = len(gaps)
            gaps.append(capacity)
        else:
            b = open_at[h].pop()
            count[h] -= 1
        bins[k] = b
        left = h - s
        gaps[b] = left
        if left:
            open_at[left].append(b)
            count[left] += 1
    return bins, np.array(gaps, np.int64)


def _pack_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["size", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
    bins, gaps = pack(rows["size"].to_numpy())
    if not len(gaps):
        gaps = np.array([CAPACITY])
    bins[bins < 0] = 0
    return pd.DataFrame({"block": np.int64(key[0]), "bin": bins.astype(np.int32), "doc_id": rows["doc_id"].to_numpy(), "piece": rows["piece"].to_numpy(), "size": rows["size"].to_numpy(), "gap": gaps[bins].astype(np.int32)})


def items(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, size) from (doc_id, size): texts above the capacity in full pieces and a rest."""
    n = F.greatest(F.lit(1), F.ceil(F.col("size") / capacity)).cast("int")
    cut = sizes.select("doc_id", "size", F.explode(F.sequence(F.lit(1), n)).alias("piece"))
    return cut.select("doc_id", F.col("piece").cast("int").alias("piece"), F.least(F.lit(capacity), F.col("size") - (F.col("piece") - 1) * capacity).cast("int").alias("size"))


def packed(sizes: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(container, doc_id, piece, size) from (doc_id, size)."""
    every = settle(items(sizes))
    full = every.where(F.col("size") == CAPACITY).select(F.concat_ws("-", F.lit("f"), "doc_id", "piece").alias("container"), "doc_id", "piece", "size")
    rest = every.where(F.col("size") < CAPACITY)
    n, level, out = rest.count(), 0, full
    while n:
        blocks = math.ceil(n / block_rows)
        dealt = rest.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", F.lit(level)), F.lit(blocks)))
        # So many partitions by name: small as the blocks are in bytes, adaptive execution would put them into one task.
        placed = settle(dealt.repartition(blocks, "block").groupBy("block").applyInPandas(_pack_block, PLACED))
        again = (F.col("gap") > SLACK) & (F.col("size") > 0)
        left = placed.where(again).count() if blocks > 1 else 0
        # Sizes that leave gaps of this kind in large blocks leave them in any block: then all containers stay.
        last = left == 0 or left > STUCK * n
        closed = placed if last else placed.where(~again)
        out = out.unionAll(closed.select(F.concat_ws("-", F.lit(f"{level}"), "block", "bin").alias("container"), "doc_id", "piece", "size"))
        rest = placed.where(again).select("doc_id", "piece", "size")
        n, level = (0 if last else left), level + 1
    return out


def p7_containers(documents: DataFrame) -> DataFrame:
    """Containers of CAPACITY tokens of byte_bpe_50k for all documents."""
    return packed(bpe.token_counts(documents, "doc_id", "text"))


def p7_fill(documents: DataFrame) -> DataFrame:
    """One row: containers, tokens, the least number of containers possible and the share of unused space."""
    per = p7_containers(documents).groupBy("container").agg(F.sum("size").alias("used"))
    total = per.agg(F.count("*").alias("containers"), F.coalesce(F.sum("used"), F.lit(0)).alias("tokens"), F.coalesce(F.max("used"), F.lit(0)).alias("fullest"))
    return total.withColumn("least", F.ceil(F.col("tokens") / CAPACITY)).withColumn("unused", F.when(F.col("containers") > 0, 1 - F.col("tokens") / (F.col("containers") * CAPACITY)))
