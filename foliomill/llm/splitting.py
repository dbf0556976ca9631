"""Problem 3: splitting oversized items at natural boundaries.

A token is one ideograph or one unbroken run of ASCII letters and digits. A dynamic programme
over the boundary positions of a text chooses the cuts with the least sum of cut penalties
and squared unused space, where no piece may hold more than LIMIT tokens and each piece after
the first begins with the last OVERLAP tokens of the piece before it.

Defined cases: a null, empty or small text is no item to split and gives no piece; a stretch
without natural boundaries may be cut between any two tokens; a token itself is never cut;
text before the first and after the last token stays with the first and the last piece. The
parts from ``core_start`` to ``core_end`` joined give the text exactly.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textio import map_slices, once

LIMIT = 384
OVERLAP = 32
TOKEN = r"[一-鿿㐀-䶿]|[a-zA-Z0-9]+"
#: Penalty of a cut by what stands between the two tokens.
PENALTY = {"start": 0.0, "paragraph": 0.0, "line": 0.15, "sentence": 0.3, "clause": 1.5, "space": 3.0, "hard": 6.0, "end": 0.0}
NATURAL = ("paragraph", "line", "sentence")

_TOKEN = re.compile(TOKEN)
_PARAGRAPH = re.compile(r"\n[ \t\r]*\n")
_SENTENCE = re.compile(r"[。！？；…]|[.!?][\"'”’»)\]]*\s")


def boundary(gap: str) -> str:
    """What kind of boundary the text between two tokens is."""
    if not gap:
        return "hard"
    if gap == " ":
        return "space"
    if "\n" in gap or "\r" in gap:
        return "paragraph" if _PARAGRAPH.search(gap.replace("\r\n", "\n")) else "line"
    if _SENTENCE.search(gap):
        return "sentence"
    if any(c in gap for c in "，、：,;:"):
        return "clause"
    return "space" if gap[:1].isspace() or gap[-1:].isspace() else "hard"


def cuts(kinds: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> list[int]:
    """The chosen cuts, as numbers of tokens before the cut; kinds[i] is what stands before token i + 1.

    Candidates are the natural boundaries; where two of them stand more than half a piece apart,
    the clause ends between them are candidates too, then the spaces, then all positions.
    """
    n = len(kinds) + 1
    room = limit - overlap
    spots = [0, *(i + 1 for i, k in enumerate(kinds) if k in NATURAL), n]
    for finer in (("clause",), ("space",), ("hard",)):
        more: list[int] = []
        for a, b in zip(spots, spots[1:]):
            if b - a > room // 2:
                more += (i + 1 for i in range(a, b - 1) if kinds[i] in finer)
        spots = sorted({*spots, *more})
    spots = [0, *(s for s in spots if s > overlap)]
    pieces = max(1, -(-(n - overlap) // room))
    ideal = (n - overlap) / pieces
    place = np.array(spots, float)
    own = place.copy()  # from here on a piece's tokens are new; the first piece gives OVERLAP of its room to none before it
    own[0] = overlap
    best = np.full(len(spots), np.inf)
    best[0] = 0.0
    back = [0] * len(spots)
    low = 0
    for j in range(1, len(spots)):
        end = spots[j]
        while end - spots[low] > (room if spots[low] else limit):
            low += 1
        total = best[low:j] + ((end - own[low:j]) / ideal - 1) ** 2
        i = int(total.argmin())
        best[j] = total[i] + (0.0 if end == n else PENALTY[kinds[end - 1]])
        back[j] = low + i
    out, j = [], len(spots) - 1
    while j:
        out.append(spots[j])
        j = back[j]
    return out[::-1]


def split(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[dict]:
    """Pieces of one text; a text of at most ``limit`` tokens is one piece."""
    spans = [m.span() for m in _TOKEN.finditer(text)]
    if len(spans) <= limit:
        return [{"core_start": 0, "core_end": len(text), "start": 0, "tokens": len(spans), "boundary": "end"}]
    kinds = [boundary(text[a[1] : b[0]]) for a, b in zip(spans, spans[1:])]
    out, done, at = [], 0, 0
    for cut in cuts(kinds, limit, overlap):
        end = spans[cut][0] if cut < len(spans) else len(text)
        begin = max(0, done - overlap) if done else 0
        out.append({"core_start": at, "core_end": end, "start": spans[begin][0] if done else 0, "tokens": cut - begin, "boundary": kinds[cut - 1] if cut < len(spans) else "end"})
        done, at = cut, end
    return out


_ARROW = pa.schema([("id", pa.string()), ("page", pa.string()), ("piece", pa.int32()), ("pieces", pa.int32()), ("content", pa.string()), ("token_count", pa.int32()), ("core_start", pa.int32()), ("core_end", pa.int32()), ("boundary", pa.string())])


def _pieces(rows: dict[str, list]) -> dict[str, list]:
    out: dict[str, list] = {f.name: [] for f in _ARROW}
    for key, page, text in zip(rows["id"], rows["page"], rows["content"]):
        made = split(text)
        for k, p in enumerate(made):
            for name, value in (("id", key), ("page", page), ("piece", k + 1), ("pieces", len(made)), ("content", text[p["start"] : p["core_end"]]), ("token_count", p["tokens"]), ("core_start", p["core_start"]), ("core_end", p["core_end"]), ("boundary", p["boundary"])):
                out[name].append(value)
    return out


def oversized(chunks: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(id, page, content) of the items above the limit, each id once.

    A token has at least one character, so the length prunes most rows before the count.
    """
    c = F.col("content")
    found = chunks.select("id", "page", "content").where((F.length(c) > limit) & (F.regexp_count(c, F.lit(TOKEN)) > limit))
    return once(found, "id")


def p3_pieces(chunks: DataFrame) -> DataFrame:
    """Numbered pieces of every oversized chunk; the only shuffle is that of the oversized rows by id."""
    return map_slices(oversized(chunks), _pieces, "id string, page string, piece int, pieces int, content string, token_count int, core_start int, core_end int, boundary string", _ARROW)


def p3_found(chunks: DataFrame) -> DataFrame:
    """Ids of the chunks that the splitter cuts."""
    return p3_pieces(chunks).where((F.col("piece") == 1) & (F.col("pieces") > 1)).select("id")
