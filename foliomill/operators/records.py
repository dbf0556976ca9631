"""Records by identity: digests, conflicts, collisions, keyed corrections, asserted lookups.

Strings only: null and '' are the same in every identity. Groups are reduced to sets or counts
before they are shuffled; where a list of members comes out it is one of digests or ids, and
group sizes come out beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import digest
from ..runtime import require, settle


def with_identity(df: DataFrame, content: list[str], place: list[str]) -> DataFrame:
    """Adds row_hash over the content columns and record_id over the place columns and that hash."""
    d = df.withColumn("row_hash", digest(*content))
    return d.withColumn("record_id", digest(*place, "row_hash"))


def candidate_id(prefix: str, location: list[Column | str], content_hash: Column | str, needed_from: int = 2) -> Column:
    """Digest of a prefix and the location; where the location says nothing beyond its first parts, of the content too."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in location]
    blank = F.concat(*parts[needed_from:]) == ""
    h = F.col(content_hash) if isinstance(content_hash, str) else content_hash
    joined = F.concat_ws("|", F.lit(prefix), *parts)
    return F.sha2(F.when(blank, F.concat_ws("|", joined, h)).otherwise(joined), 256)


def conflicts(df: DataFrame, identity: list[str], value: str, member: str) -> DataFrame:
    """(conflict_id, identity, values, members, member_count): identities with more than one value.

    Members with equal values are one before the group is built, so a hot identity that always
    says the same is one row of it.
    """
    ids = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in identity]
    slim = df.select(*ids, F.coalesce(F.col(value), F.lit("")).alias("v"), F.col(member).alias("m"))
    per = slim.groupBy(*identity, "v").agg(F.count("*").alias("n"), F.min("m").alias("first"))
    got = per.groupBy(*identity).agg(F.array_sort(F.collect_list("v")).alias("values"), F.array_sort(F.collect_list("first")).alias("members"), F.sum("n").alias("member_count")).where(F.size("values") > 1)
    return got.select(digest(*identity, F.array_join("values", "|")).alias("conflict_id"), *identity, F.array_join("values", ";").alias("values"), F.array_join("members", ";").alias("members"), "member_count")


def collisions(df: DataFrame, key: list[str], content: list[str]) -> DataFrame:
    """(key, rows, contents, kind): keys held by several rows, 'same' if their contents are equal, else 'different'."""
    per = df.groupBy(*key, digest(*content).alias("h")).agg(F.count("*").alias("n"))
    got = per.groupBy(*key).agg(F.sum("n").alias("rows"), F.count("*").alias("contents")).where(F.col("rows") > 1)
    return got.withColumn("kind", F.when(F.col("contents") == 1, "same").otherwise("different"))


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the last by the order; a partial aggregate, not a window."""
    rest = [c for c in df.columns if c not in key]
    got = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return got.select(*key, *[F.col("__r")[c].alias(c) for c in rest])


def amend(df: DataFrame, fixes: DataFrame, key: str) -> DataFrame:
    """The rows with corrections (key, ord, field, action, value) applied in order.

    set puts a value into a field (the last wins), drop takes the row away, move gives it another
    key: the old row stays with status 'superseded' and the new one is appended.
    """
    fields = [c for c in df.columns if c != key]
    last = fixes.groupBy(F.col(key).alias("__k")).agg(
        *[F.max_by(F.when((F.col("action") == "set") & (F.col("field") == c), F.col("value")), F.when((F.col("action") == "set") & (F.col("field") == c), F.col("ord"))).alias(f"__{c}") for c in fields],
        F.coalesce(F.bool_or(F.col("action") == "drop"), F.lit(False)).alias("__drop"),
        F.max_by(F.when(F.col("action") == "move", F.col("value")), F.when(F.col("action") == "move", F.col("ord"))).alias("__move"),
    )
    j = df.join(last, F.col(key) == F.col("__k"), "left").where(~F.coalesce("__drop", F.lit(False)))
    old = j.select(key, *[F.coalesce(F.when(F.col("__move").isNull(), F.col(f"__{c}")), F.col(c)).alias(c) for c in fields], F.when(F.col("__move").isNotNull(), "superseded").otherwise("current").alias("status"))
    new = j.where(F.col("__move").isNotNull()).select(F.col("__move").alias(key), *[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) for c in fields], F.lit("current").alias("status"))
    return old.unionByName(new)


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """(key, n) of keys that stand in more than one row."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, key: list[str], what: str) -> DataFrame:
    """The frame, if its key is unique; else an error that names up to ten of the repeated keys."""
    bad = duplicates(df, key).limit(10).collect()
    require(not bad, f"{what}: repeated keys {[tuple(r)[:-1] for r in bad]}")
    return df


def checked_lookup(df: DataFrame, ref: DataFrame, key: str, what: str) -> DataFrame:
    """Left join to a reference with a unique key; rows of the reference that hit nothing are an error."""
    require_unique(ref, [key], what)
    lost = ref.join(df.select(key), key, "left_anti").limit(10).collect()
    require(not lost, f"{what}: unknown keys {[r[key] for r in lost]}")
    return df.join(ref, key, "left")


def carried(new: DataFrame, old: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The new rows with columns of an earlier run taken over where the key is the same."""
    o = old.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    return new.join(o, key, "left").select(*[c for c in new.columns if c not in columns], *[F.coalesce(F.col(f"__{c}"), F.col(c) if c in new.columns else F.lit(None)).alias(c) for c in columns])


def same_but(df: DataFrame, other: DataFrame, key: str, stable: list[str]) -> DataFrame:
    """(key, differing): columns that differ for keys on both sides, null-safe."""
    a, b = df.alias("a"), other.alias("b")
    tests = F.array_compact(F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in stable]))
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}")).select(F.col(f"a.{key}").alias(key), tests.alias("d")).where(F.size("d") > 0).select(key, F.array_join("d", ",").alias("differing"))


def batch_id(df: DataFrame, package: str, key: str, buckets: int = 1 << 16) -> DataFrame:
    """(package, records, batch_id): a digest of all ids of a package, built as digests of sorted buckets, so no list of all ids is held."""
    b = F.conv(F.substring(F.sha2(F.coalesce(key, F.lit("")), 256), 1, 4), 16, 10).cast("long") % buckets
    part = df.groupBy(package, b.alias("b")).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list(key)), ","), 256).alias("h"))
    got = part.groupBy(package).agg(F.sum("n").alias("records"), F.array_sort(F.collect_list(F.struct("b", "h"))).alias("x"))
    return got.select(package, "records", F.sha2(F.concat_ws("|", F.coalesce(F.col(package), F.lit("")), F.array_join(F.transform("x", lambda s: s["h"]), ",")), 256).alias("batch_id"))


def _peeled(left: DataFrame) -> DataFrame:
    """Edges of nodes that have an edge in and an edge out, until nothing falls away."""
    n = left.count()
    while n:
        kept = left.join(left.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi")
        left = settle(kept.select("src", "dst").join(kept.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").select("src", "dst"))
        m = left.count()
        if m == n:
            break
        n = m
    return left


def _colours(edges: DataFrame) -> DataFrame:
    """(node, c): the greatest node from which each node can be reached, itself included."""
    at = settle(edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct().withColumn("c", F.col("node")))
    while True:
        came = edges.join(at, F.col("src") == F.col("node")).groupBy(F.col("dst").alias("d")).agg(F.max("c").alias("best"))
        new = settle(at.join(came, F.col("node") == F.col("d"), "left").select("node", F.greatest("c", "best").alias("c"), (F.coalesce("best", "c") > F.col("c")).alias("moved")))
        at = new.select("node", "c")
        if new.where("moved").isEmpty():
            return at


def cycles(edges: DataFrame) -> DataFrame:
    """(node): the nodes that lie on a cycle of (src, dst); nodes that only lead to one, from one, or from one to another don't.

    Nodes without an edge in, or without one out, are peeled away. Then each node takes the
    greatest node that reaches it; the nodes that go back to that one through nodes of the same
    colour are its strongly connected component, and lie on a cycle if they are several or it
    points at itself. They are taken out, and what is left is peeled again, until no edge is left.
    The lineage is cut at every step; rows with nulls are no edges.
    """
    left = _peeled(settle(edges.select("src", "dst").where(F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct()))
    found = left.select(F.col("src").alias("node")).limit(0)
    while not left.isEmpty():
        colour = _colours(left)
        a, b = (colour.select(F.col("node").alias(n), F.col("c").alias(f"c_{n}")) for n in ("src", "dst"))
        own = settle(left.join(a, "src").join(b, "dst").where(F.col("c_src") == F.col("c_dst")).select("src", "dst"))
        part = settle(colour.where(F.col("node") == F.col("c")).select("node"))
        size = part.count()
        while True:  # back along the edges of one colour
            more = own.join(part, F.col("dst") == F.col("node"), "left_semi").select(F.col("src").alias("node"))
            part = settle(part.union(more).distinct())
            if part.count() == size:
                break
            size = part.count()
        inside = own.join(part, F.col("src") == F.col("node"), "left_semi").join(part, F.col("dst") == F.col("node"), "left_semi")
        found = found.union(inside.select("src")).union(inside.select("dst"))
        rest = left.join(part, F.col("src") == F.col("node"), "left_anti").join(part, F.col("dst") == F.col("node"), "left_anti")
        left = _peeled(settle(rest))
    return found.distinct()


def rank_within(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows of each key by an order that must be total. Spark keeps k rows a partition and key before the shuffle."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)
