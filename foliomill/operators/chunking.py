"""Token-bounded chunks of sections: paragraphs are packed in order, with a short overlap of sentences.

Packing depends on the order within one section only, so each section is one Arrow value and
nothing is shuffled. Defined cases: null and blank sections give no chunk; a sentence above the
limit is cut into slices of LIMIT characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 384
OVERLAP_SENTENCES = 2

_HAN = re.compile(r"[一-鿿㐀-䶿]")
_WORD = re.compile(r"[a-zA-Z0-9]+")
_SENTENCE_END = re.compile(r"(?<=[。！？.!?])\s*")


def count(text: str) -> int:
    return len(_HAN.findall(text)) + len(_WORD.findall(text))


def _tail(text: str, sep: str) -> str:
    return sep.join(_SENTENCE_END.split(text)[-OVERLAP_SENTENCES:]) if text else ""


def _packed(units: list[str], glue: str, tail_glue: str, limit: int, too_long) -> Iterator[str]:
    """Units in order, joined as long as they fit; after a full piece the next one begins with its last sentences if they fit."""
    held, size = "", 0
    for u in units:
        n = count(u)
        if n > limit:
            if held:
                yield held
            yield from too_long(u)
            held, size = "", 0
        elif size + n <= limit:
            held, size = (held + glue + u if held else u), size + n
        else:
            yield held
            before = _tail(held, tail_glue)
            if before and count(before) + n <= limit:
                held = (before + glue + u).strip()
                size = count(held)
            else:
                held, size = u, n
    if held:
        yield held


def chunk(text: str | None, limit: int = LIMIT) -> list[str]:
    """Chunks of one section."""
    if not text or not text.strip():
        return []
    if count(text) <= limit:
        return [text.strip()]

    def slices(sentence: str) -> Iterator[str]:
        yield from (sentence[k : k + limit].strip() for k in range(0, len(sentence), limit))

    def by_sentence(paragraph: str) -> Iterator[str]:
        yield from _packed([s.strip() for s in _SENTENCE_END.split(paragraph) if s.strip()], " ", " ", limit, slices)

    paragraphs = [p.strip() for p in re.split(r"\n\n+", text) if p.strip()]
    return [c for c in _packed(paragraphs, "\n\n", "\n", limit, by_sentence) if c]


def chunks(df: DataFrame, keys: list[str], text: str, limit: int = LIMIT) -> DataFrame:
    """(keys, chunk_no, content, token_count) of each row's section text, numbered from 1."""
    arrow = pa.schema([("n", pa.list_(pa.struct([("chunk_no", pa.int32()), ("content", pa.string()), ("token_count", pa.int32())])))])

    @F.arrow_udf("array<struct<chunk_no:int,content:string,token_count:int>>")
    def pack(col: pa.Array) -> pa.Array:
        made = [[{"chunk_no": k + 1, "content": c, "token_count": count(c)} for k, c in enumerate(chunk(t, limit))] for t in col.to_pylist()]
        return pa.array(made, arrow.field("n").type)

    return df.select(*keys, F.explode(pack(F.col(text))).alias("c")).select(*keys, "c.chunk_no", "c.content", "c.token_count")


def export(made: DataFrame, path: str, keys: list[str], limit: int = LIMIT) -> int:
    """Write chunks as JSON lines and return how many; a chunk above the limit, a blank one or a repeated key is an error, and nothing is written."""
    from ..runtime import require, settle
    from ..sources.files import write_jsonl

    kept = settle(made)
    bad = kept.where((F.col("token_count") > limit) | (F.trim(F.coalesce("content", F.lit(""))) == "")).select(*keys).limit(3).collect()
    require(not bad, f"chunks out of bounds: {[tuple(r) for r in bad]}")
    twice = kept.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").limit(3).collect()
    require(not twice, f"chunks repeated: {[tuple(r) for r in twice]}")
    write_jsonl(kept, path)
    return kept.count()
