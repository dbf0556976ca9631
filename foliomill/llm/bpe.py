"""Problem 6: encoding with a public byte-level BPE vocabulary.

A pretoken starts as a doubly linked list of byte symbols. The adjacent pairs wait in a
priority queue by (rank, position); the least is merged and the pairs with its neighbours are
put in; an entry whose symbols have changed meanwhile is stale and skipped. A pretoken of n
bytes so takes O(n log n) steps, however long it is. Decoding joins the vocabulary's strings.

Defined cases: both null and '' have the empty list; special tokens are never produced, their
strings are ordinary text; a text of any length is encoded as a whole.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterable
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the public vocabulary files; every function takes it as a parameter.
FOLDER = os.environ.get("FOLIOMILL_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k"

# Fixed value: the public pattern that splits a text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Entries of a worker's cache of encoded pretokens; it is emptied when full, which changes no result.
CACHE = 200_000
#: Only pretokens of at most so many bytes are kept in the cache, so that its size is bounded.
CACHED_BYTES = 48
SLICE = 512


class Encoder:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.strings = {b: a for a, b in self.ranks.items()}
        self.cut = regex.compile(PATTERN).findall
        self.cache: dict[str, tuple[int, ...]] = {}

    def pretoken(self, data: bytes) -> tuple[int, ...]:
        ranks = self.ranks
        if data in ranks:
            return (ranks[data],)
        n = len(data)
        if n == 2:
            return (ranks[data[:1]], ranks[data[1:]])
        end = list(range(1, n + 1))  # of the symbol that starts here; 0 where none starts any more
        prev = list(range(-1, n - 1))
        queue: list[tuple[int, int, int]] = []
        get = ranks.get
        for i in range(n - 1):
            r = get(data[i : i + 2])
            if r is not None:
                queue.append((r, i, i + 2))
        queue.sort()
        while queue:
            _, i, stop = heappop(queue)
            mid = end[i]
            if not mid or mid >= stop or end[mid] != stop:
                continue  # stale: a symbol of the pair has been merged meanwhile
            end[i], end[mid] = stop, 0
            if stop < n:
                prev[stop] = i
                after = end[stop]
                r = get(data[i:after])
                if r is not None:
                    heappush(queue, (r, i, after))
            before = prev[i]
            if before >= 0:
                r = get(data[before:stop])
                if r is not None:
                    heappush(queue, (r, before, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        cache = self.cache
        for piece in self.cut(text):
            ids = cache.get(piece)
            if ids is None:
                data = piece.encode("utf-8", "replace")
                ids = self.pretoken(data)
                if len(data) <= CACHED_BYTES:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[piece] = ids
            out += ids
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(4)
def encoder(name: str = VOCABULARY, folder: str = FOLDER) -> Encoder:
    """One encoder for each Python worker; the file is read on the executor and never shipped."""
    return Encoder(os.path.join(folder, f"{name}.tiktoken"))


def encoded(df: DataFrame, key: str, text: str, name: str = VOCABULARY, folder: str = FOLDER) -> DataFrame:
    """(key, ids): one row for each row, in place, without a shuffle."""
    arrow = pa.schema([(key, pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        enc = encoder(name, folder).encode
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                ids = [enc(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))], schema=arrow)

    return df.select(F.col(key).cast("long").alias(key), F.col(text).alias("text")).mapInArrow(run, f"{key} bigint, ids array<int>")


def token_counts(df: DataFrame, key: str, text: str, name: str = VOCABULARY, folder: str = FOLDER) -> DataFrame:
    """(key, size): numbers of tokens, without giving the ids out of Python."""
    arrow = pa.schema([(key, pa.int64()), ("size", pa.int32())])

    def run(batches):
        enc = encoder(name, folder).encode
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                n = [len(enc(t)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(n, pa.int32())], schema=arrow)

    return df.select(F.col(key).cast("long").alias(key), F.col(text).alias("text")).mapInArrow(run, f"{key} bigint, size int")


def decoded(df: DataFrame, key: str, ids: str = "ids", name: str = VOCABULARY, folder: str = FOLDER) -> DataFrame:
    """(key, text) from (key, ids)."""
    arrow = pa.schema([(key, pa.int64()), ("text", pa.string())])

    def run(batches):
        dec = encoder(name, folder).decode
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([dec(x or []) for x in batch.column(1).to_pylist()], pa.string())], schema=arrow)

    return df.select(F.col(key).cast("long").alias(key), F.col(ids).alias("ids")).mapInArrow(run, f"{key} bigint, text string")


def p6_ids(documents: DataFrame) -> DataFrame:
    """doc_id and token ids of every document."""
    return encoded(documents, "doc_id", "text")
