"""Words and ideographs of whole batches of texts as 64-bit numbers, without a loop over the texts."""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
MULT = np.uint64(0xBF58476D1CE4E5B9)
GAP, WORD, SIGN = 0, 1, 2


class Units(NamedTuple):
    """Units of texts in order: their hashes, texts, places in the texts put together, lengths and whether each is an ideograph."""

    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    size: np.ndarray
    sign: np.ndarray


@lru_cache(1)
def classes() -> np.ndarray:
    """Of each code point: 0 between units, 1 inside a word, 2 an ideograph that is a unit."""
    table = np.fromiter((chr(c).isalnum() for c in range(0x110000)), np.uint8, 0x110000)
    table[0x3400:0x4DC0] = SIGN
    table[0x4E00:0xA000] = SIGN
    return table


def codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def units(texts: list[str]) -> Units:
    """Words and single ideographs of the texts. A word is hashed by its signs and their places in it."""
    code = codes(texts)
    kind = classes()[code]
    at = np.flatnonzero(kind)
    if not len(at):
        return Units(np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, bool))
    # Texts stand side by side, so a word also begins where a text does.
    bounds = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    edge = np.zeros(len(code) + 1, bool)
    edge[bounds] = True
    kind = kind[at]
    begins = (kind == SIGN) | edge[at]
    begins[0] = True
    begins[1:] |= (at[1:] - at[:-1] != 1) | (kind[:-1] == SIGN)
    first = np.flatnonzero(begins)
    size = np.diff(np.append(first, len(at)))
    offset = np.arange(len(at)) - np.repeat(first, size)
    with np.errstate(over="ignore"):
        h = code[at].astype(np.uint64) * MIX + offset.astype(np.uint64) * MULT
        h ^= h >> np.uint64(29)
        h *= MULT
        h ^= h >> np.uint64(32)
        start = at[first]
        return Units(np.add.reduceat(h, first), np.searchsorted(bounds, start, side="right"), start, size, kind[first] == SIGN)


def once_each(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Places of the first of each key in each text."""
    with np.errstate(over="ignore"):
        both = (keys ^ (keys >> np.uint64(31))) * MULT + doc.astype(np.uint64) * MIX
    return np.unique(both, return_index=True)[1]


def word_hash(words: list[str]) -> np.ndarray:
    """The hashes of single words, as units() gives them."""
    got = units([w + " " for w in words])
    out = np.zeros(len(words), np.uint64)
    out[got.doc] = got.hash
    return out


def portions(texts: list[str], signs: int = 200_000):
    """The texts in portions of about so many signs, which a processor's cache can hold, as (first, end) places."""
    at = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= signs:
            yield at, k + 1
            at, size = k + 1, 0
    if at < len(texts):
        yield at, len(texts)
