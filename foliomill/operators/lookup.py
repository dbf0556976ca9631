"""Lookups that go by content: keys to the exact pages that hold them, titles to the pages of the printed table.

Defined cases: blank keys and titles find nothing; nulls count as ''; pages without text hold
nothing; of equal candidates the earliest page is taken.
"""

from __future__ import annotations

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .records import rank_within

#: Entries of a key that one task folds; what a block does to the page that it starts from is handed on as a small map.
ENTRY_BLOCK = 4096
#: Pages that one task holds against the titles of their document.
PAGE_DEAL = 2048


def _score(evidence: Column, key: Column, text: Column) -> Column:
    """How many different words of the evidence, or of the key without one, stand in the text."""
    words = F.filter(F.array_distinct(F.split(F.when(F.coalesce(evidence, F.lit("")) != "", evidence).otherwise(key), r"\s+")), lambda w: w != "")
    return F.size(F.filter(words, lambda w: F.contains(text, w)))


def exact_pages(rows: DataFrame, pages: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """(row_id, page, scoped): the page whose text holds the row's key, within its page range if any page there does.

    rows: (keys, row_id, key, page_first, page_last, evidence); pages: (keys, page, text). Within
    the range the pages are listed and joined by number. Rows without a hit there meet the pages
    of their document by the rarest token of their key, so only pages that can hold it are read.
    """
    r = rows.select(*keys, F.col(row_id).alias("__r"), F.coalesce("key", F.lit("")).alias("key"), "page_first", "page_last", "evidence").where("key <> ''")
    p = pages.select(*keys, "page", F.coalesce("text", F.lit("")).alias("text"))
    near = r.where("page_first IS NOT NULL AND page_last >= page_first").withColumn("page", F.explode(F.sequence("page_first", "page_last"))).join(p, [*keys, "page"]).where(F.contains("text", F.col("key")))
    best = lambda d: d.groupBy("__r").agg(F.max_by("page", F.struct(_score(F.col("evidence"), F.col("key"), F.col("text")), -F.col("page"))).alias("page"))
    scoped = best(near)
    left = r.join(scoped.select("__r"), "__r", "left_anti")
    index = p.select(*keys, "page", F.explode(F.array_distinct(T.tokens("text"))).alias("token"))
    often = index.groupBy(*keys, "token").agg(F.count("*").alias("n"))
    wanted = left.select(*keys, "__r", F.explode(F.array_distinct(T.tokens("key"))).alias("token")).join(often, [*keys, "token"])
    rare = wanted.groupBy(*keys, "__r").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    at = rare.join(index, [*keys, "token"]).select("__r", "page").join(left, "__r")
    far = best(at.join(p, [*keys, "page"]).where(F.contains("text", F.col("key"))))
    return scoped.withColumn("scoped", F.lit(True)).unionAll(far.withColumn("scoped", F.lit(False))).withColumnRenamed("__r", row_id)


def _take(hits: list[int], own: int | None, last: int) -> tuple[int | None, int]:
    """The page of one entry and the last page after it."""
    if own is not None and not pd.isna(own):
        return int(own), last
    if len(hits) == 1:
        return hits[0], max(last, hits[0])
    later = [h for h in hits if h >= last]
    return (later[0], later[0]) if len(hits) > 1 and later else (None, last)


def physical_pages(entries: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ord, page): where each entry stands in the printed table of contents; null where that can't be told.

    entries: (keys, ord, title, toc_page); listed: (keys, page, title) as printed. An entry keeps
    its own page; a title printed on one page stands there; one printed on several stands on the
    first that isn't before the page of the entries before it. That order is a fold: blocks of
    entries first say what page each possible start leads to, then run with the start they get.
    """
    e = entries.select(*keys, "ord", "toc_page", T.title_form(F.coalesce("title", F.lit(""))).alias("t"))
    hit = listed.select(*keys, F.col("page").cast("int").alias("p"), T.title_form(F.coalesce("title", F.lit(""))).alias("t")).where("t <> '' AND p IS NOT NULL").groupBy(*keys, "t").agg(F.array_sort(F.collect_set("p")).alias("hits"))
    first = listed.groupBy(*keys).agg(F.array_sort(F.collect_set(F.col("page").cast("int"))).alias("starts"))
    e = e.join(hit, [*keys, "t"], "left").join(first, keys, "left").withColumn("hits", F.coalesce("hits", F.array().cast("array<int>"))).withColumn("starts", F.coalesce("starts", F.array().cast("array<int>")))
    e = e.withColumn("blk", F.floor(F.col("ord") / ENTRY_BLOCK)).drop("t")
    types = dict(e.dtypes)
    head = ", ".join(f"`{k}` {types[k]}" for k in keys)

    def lead(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ord")
        out = []
        for start in [0, *rows["starts"].iloc[0]]:
            last = int(start)
            for h, own in zip(rows["hits"], rows["toc_page"]):
                last = _take(list(h), own, last)[1]
            out.append((*(rows[k].iloc[0] for k in keys), rows["blk"].iloc[0], int(start), last))
        return pd.DataFrame(out, columns=[*keys, "blk", "start", "last"])

    steps = e.groupBy(*keys, "blk").applyInPandas(lead, f"{head}, blk bigint, start int, last int")
    maps = steps.groupBy(*keys, "blk").agg(F.map_from_entries(F.collect_list(F.struct("start", "last"))).alias("m"))
    chain = maps.groupBy(*keys).agg(F.array_sort(F.transform(F.collect_list(F.struct("blk", F.map_entries("m").alias("m"))), lambda x: F.struct(x["blk"], F.array_sort(x["m"]).alias("m")))).alias("c"))
    empty = F.struct(F.lit(0).alias("last"), F.array().cast("array<struct<blk:bigint,start:int>>").alias("done"))

    def follow(acc: Column, x: Column) -> Column:
        after = F.coalesce(F.try_element_at(F.transform(F.filter(x["m"], lambda y: y["key"] == acc["last"]), lambda y: y["value"]), F.lit(1)), acc["last"])
        return F.struct(after.alias("last"), F.concat(acc["done"], F.array(F.struct(x["blk"].alias("blk"), acc["last"].alias("start")))).alias("done"))

    begin = chain.select(*keys, F.explode(F.aggregate("c", empty, follow, lambda acc: acc["done"])).alias("d")).select(*keys, "d.blk", "d.start")

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ord")
        last, pages = int(rows["start"].iloc[0]), []
        for h, own in zip(rows["hits"], rows["toc_page"]):
            page, last = _take(list(h), own, last)
            pages.append(page)
        return rows[[*keys, "ord"]].assign(page=pd.array(pages, "Int32"))

    return e.drop("starts").join(begin, [*keys, "blk"]).groupBy(*keys, "blk").applyInPandas(place, f"{head}, ord int, page int")


def title_recall(entries: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, page, found, titles, recall): share of a document's different titles that stand on each page of its printed table.

    An automaton over the titles of a document reads each of its pages once, so no page is held
    against each title. The pages of a document are dealt over tasks of PAGE_DEAL pages; keys are
    null for none.
    """
    t = entries.select(*keys, "title").where("title <> ''").distinct()
    deals = pages.groupBy(*keys).agg(F.ceil(F.count("*") / PAGE_DEAL).alias("__deals"))
    p = pages.select(*keys, "page", F.coalesce("text", F.lit("")).alias("text")).join(deals, keys).withColumn("__deal", F.pmod(F.xxhash64("page"), F.col("__deals"))).drop("__deals")
    t = t.join(deals, keys).withColumn("__deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__deals") - 1))).drop("__deals")
    types = dict(p.dtypes)
    head = ", ".join(f"`{k}` {types[k]}" for k in keys)

    def read(rows: pd.DataFrame, titles: pd.DataFrame) -> pd.DataFrame:
        if titles.empty or rows.empty:
            return rows.iloc[:0][[*keys, "page"]].assign(found=0, titles=0)
        words = ahocorasick.Automaton()
        for k, title in enumerate(titles["title"]):
            words.add_word(title, k)
        words.make_automaton()
        found = [len({k for _, k in words.iter(text)}) for text in rows["text"]]
        return rows[[*keys, "page"]].assign(found=found, titles=len(titles))

    got = p.groupBy(*keys, "__deal").cogroup(t.groupBy(*keys, "__deal")).applyInPandas(read, f"{head}, page {types['page']}, found long, titles long")
    return got.withColumn("recall", F.round(F.col("found") / F.col("titles"), 4))


def best_pages(scores: DataFrame, keys: list[str], score: str, k: int) -> DataFrame:
    """The k pages with the highest score of each key, the earliest of equals first."""
    return rank_within(scores, keys, [F.desc(score), F.asc("page")], k)
