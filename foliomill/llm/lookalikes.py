"""Problem 5: visually identical text with different characters.

A longest-match transducer over grapheme clusters. Its mapping is computed once, from rules of
the Unicode database and from a short list of look-alike letters, checked for conflicts, and
compiled into one pattern; a text is then rewritten in one pass from left to right:

- widths and presentation forms of letters, digits and ideographs become the ordinary ones;
- a letter followed by its accents becomes the composed letter;
- invisible characters go away; spaces other than U+0020 become U+0020, line breaks stay;
- letters of another script inside a word become the look-alikes of the word's own script.

Chinese full-width punctuation, superscripts, single Greek symbols and whole words of another
script stay as they are.

Defined cases: null stays null and is no case; '' stays ''; a text that has nothing to map is
returned as it is; the result of the transducer is mapped to itself.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing
from .textio import keyed, map_slices, once

# Latin letters and the Cyrillic and Greek letters that look the same.
LATIN_CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТХУЬасеіјорхуѕһԁԛԝ", "ABESIJKMHOPCTXYbaceijopxyshdqw"))
LATIN_GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοναρυχι", "ABEZHIKMNOPTYXovapuxi"))
#: Greek letters that stand for themselves beside Latin letters, as in units.
GREEK_SYMBOLS = set("αβγδεζηθικλμνπρστφχψωΓΔΘΛΞΠΣΦΨΩ") - set("οΟνΝ")

# The unified ideographs of the CJK radical supplement, where the database has no decomposition.
RADICALS = dict(
    zip(
        "⺁⺅⺇⺈⺉⺊⺋⺌⺍⺎⺒⺓⺔⺕⺖⺗⺘⺙⺛⺜⺝⺞⺠⺡⺢⺣⺤⺦⺨⺩⺪⺫⺬⺭⺯⺰⺱⺲⺶⺹⺺⺻⺼⺽⺾⺿⻀⻁⻂⻃⻄⻅⻆⻇⻈⻉⻋⻌⻍⻎⻏⻐⻑⻒⻓⻔⻖⻗⻘⻙⻚⻛⻜⻝⻟⻠⻡⻢⻣⻤⻥⻦⻧⻨⻩⻪⻫⻬⻭⻮⻯⻰⻱⻲",
        "厂亻几刀刂卜㔾小小兀巳幺彑彐忄㣺扌攵旡日月歺民氵氺灬爫丬犭王疋目示礻糹纟罓罒羊耂肀聿月臼艹艹艹虎衤覀西见角角讠贝车辶辶辶阝钅長镸长门阝雨青韦页风飞食飠饣首马骨鬼鱼鸟卤麦黄黾斉齐歯齿竜龙龜亀",
    )
)

INVISIBLE = "­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁤⁦-⁯ㅤ︀-️﻿ﾠ\U000e0000-\U000e007f\U000e0100-\U000e01ef"
SPACES = "\t   -   　"

_RANGES = (
    (0x0149, 0x0149), (0x01C4, 0x01CC), (0x01F1, 0x01F3), (0x0132, 0x0133), (0x2102, 0x2102), (0x210A, 0x2115), (0x2118, 0x211D), (0x2124, 0x2124),
    (0x2126, 0x2126), (0x2128, 0x212D), (0x212F, 0x2134), (0x2139, 0x2139), (0x2160, 0x217F), (0x2E9F, 0x2E9F), (0x2EF3, 0x2EF3), (0x2F00, 0x2FD5), (0x3131, 0x318E),
    (0xF900, 0xFAFF), (0xFB00, 0xFB06), (0xFB13, 0xFB17), (0xFB1D, 0xFDFB), (0xFE70, 0xFEFC), (0xFF10, 0xFF19), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A), (0xFF66, 0xFFDC),
    (0x1D400, 0x1D7FF), (0x1F100, 0x1F10A), (0x2F800, 0x2FA1D),
)


def _expand(spec: str) -> list[str]:
    out, k = [], 0
    while k < len(spec):
        if k + 2 < len(spec) and spec[k + 1] == "-":
            out += map(chr, range(ord(spec[k]), ord(spec[k + 2]) + 1))
            k += 3
        else:
            out.append(spec[k])
            k += 1
    return out


@lru_cache(1)
def mapping() -> dict[str, str]:
    """Single characters to their ordinary form, checked: one target each, and every target final."""
    table: dict[str, str] = {}

    def put(key: str, value: str) -> None:
        if table.setdefault(key, value) != value:
            raise ValueError(f"two targets for U+{ord(key):04X}")

    for c in _expand(INVISIBLE):
        put(c, "")
    for c in _expand(SPACES):
        put(c, " ")
    for c, to in RADICALS.items():
        put(c, to)
    for a, b in _RANGES:
        for c in map(chr, range(a, b + 1)):
            to = unicodedata.normalize("NFKC", c)
            if to != c and unicodedata.category(c) != "Cn" and c not in table:
                put(c, to)
    for key, value in list(table.items()):
        final = "".join(table.get(c, c) for c in value)
        table[key] = final
        if any(c in table for c in final):
            raise ValueError(f"U+{ord(key):04X} has no final form")
    return table


def _class(chars) -> str:
    """A regular-expression class of the characters, as ranges."""
    codes, out = sorted(map(ord, chars)), []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(re.escape(chr(a)) + (("-" + re.escape(chr(b))) if b > a else "") for a, b in out)


_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_CYRILLIC = "Ѐ-ԯ"
_GREEK = "ͰͱͲͳͶͷͻ-ͽΆΈ-ώϏ-Ͽ"
_MARKS = "̀-ͯ᪰-᫿⃐-⃰҃-゙゚҇"


@lru_cache(1)
def _machine() -> tuple:
    single = _class(mapping())
    letter = _LATIN + _CYRILLIC + _GREEK
    # What may need work: any mapped character, any accent on its own; two scripts side by side.
    odd = frozenset(mapping()) | frozenset(_expand(_MARKS))
    others = frozenset(_expand(_CYRILLIC + _GREEK))
    mixed = re.compile(f"[{_LATIN}][{_CYRILLIC}{_GREEK}]|[{_CYRILLIC}][{_LATIN}{_GREEK}]|[{_GREEK}][{_LATIN}{_CYRILLIC}]")
    # A cluster is a character with its accents; a word is a run of letter clusters, with what is invisible inside it.
    hidden = _class(k for k, v in mapping().items() if v == "")
    wide = _class(k for k, v in mapping().items() if v and v[0].isalnum() and unicodedata.normalize("NFD", v[0])[0].isascii())
    word = f"[{letter}{wide}0-9](?:[{_MARKS}{hidden}]*[{letter}{wide}0-9])*[{_MARKS}{hidden}]*"
    whole = regex.compile(f"{word}|.[{_MARKS}]+|[{single}{_MARKS}]", regex.DOTALL)
    cyr, gre = re.compile(f"[{_CYRILLIC}]"), re.compile(f"[{_GREEK}]")
    return odd, others, whole, cyr, gre, mixed


_BACK_CYRILLIC = {b: a for a, b in LATIN_CYRILLIC.items() if a not in "ѕһԁԛԝіјЅІЈЬ"}
_HAS_LATIN = re.compile(f"[{_LATIN}]")
_OTHER_LETTER = re.compile(f"[{_LATIN}{_CYRILLIC}]")


def _among_letters(word: str, k: int) -> bool:
    """Whether two letters of another script stand directly before or behind a sign, as they don't beside the symbol of a unit."""
    return any(len(x) == 2 and all(_OTHER_LETTER.match(c) for c in x) for x in (word[max(0, k - 2) : k], word[k + 1 : k + 3]))


def _one_script(word: str) -> str:
    """Letters of another script to those of the word's own, which most of its unmistakable letters show."""
    _, _, _, cyr, gre, _ = _machine()
    latin, other = len(_HAS_LATIN.findall(word)), len(cyr.findall(word))
    if gre.search(word) and latin + other > 0:
        greek = sum(1 for c in word if gre.match(c))
        if latin + other > greek or not any(c in GREEK_SYMBOLS for c in word):
            word = "".join(LATIN_GREEK.get(c, c) if c not in GREEK_SYMBOLS or _among_letters(word, k) else c for k, c in enumerate(word))
            latin = len(_HAS_LATIN.findall(word))
    if latin and other:
        plain_cyrillic = sum(1 for c in word if cyr.match(c) and c not in LATIN_CYRILLIC)
        plain_latin = sum(1 for c in word if _HAS_LATIN.match(c) and c not in _BACK_CYRILLIC)
        if plain_cyrillic > plain_latin:
            return "".join(_BACK_CYRILLIC.get(c, c) for c in word)
        if not plain_cyrillic:
            return "".join(LATIN_CYRILLIC.get(c, c) for c in word)
    return word


def _cluster(m) -> str:
    table = mapping()
    got = m.group()
    if got.isascii():
        return table.get(got, got) if len(got) == 1 else got
    out = unicodedata.normalize("NFC", "".join(table.get(c, c) for c in got))
    return _one_script(out) if len(out) > 1 else out


def unify(text: str | None) -> str | None:
    """The consistent form of a text."""
    if not text or text.isascii() and "\t" not in text:
        return text
    odd, others, whole, _, _, mixed = _machine()
    signs = set(text)  # far fewer than the text is long, so most texts are settled by it
    if signs.isdisjoint(odd) and (signs.isdisjoint(others) or not mixed.search(text)):
        return text
    # No word reaches over a space.
    return " ".join([x if x.isascii() and "\t" not in x else whole.sub(_cluster, x) for x in text.split(" ")])


@lru_cache(1)
def _kinds() -> np.ndarray:
    """Of each code point: 8 if it may need work, else 1, 2 or 4 for a Latin, Cyrillic or Greek letter."""
    odd = _machine()[0]
    table = np.zeros(0x110000, np.uint8)
    for k, letters in ((1, _LATIN), (2, _CYRILLIC), (4, _GREEK)):
        table[[ord(c) for c in _expand(letters)]] = k
    table[[ord(c) for c in odd]] = 8
    return table


def unify_all(texts: list[str | None]) -> list[str | None]:
    """unify() of many texts; which of them need work is seen for all of them at once."""
    out = list(texts)
    filled = [k for k, t in enumerate(out) if t]
    for a, b in hashing.portions([out[k] for k in filled]):
        some = [out[k] for k in filled[a:b]]
        kind = _kinds()[hashing.codes(some)]
        before, after = kind[:-1], kind[1:]
        mixed = (before | after > 2) & (before != after) & (before > 0) & (after > 0)  # the last sign of a text may stand beside the first of the next one: no harm
        hit = np.union1d(np.flatnonzero(kind == 8), np.flatnonzero(mixed))
        bounds = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
        for k in np.unique(np.searchsorted(bounds, hit, side="right")).tolist():
            out[filled[a + k]] = unify(some[k])
    return out


_ARROW = pa.schema([("src", pa.string()), ("row_key", pa.string()), ("text", pa.string()), ("changed", pa.bool_())])


def _rewrite(rows: dict[str, list]) -> dict[str, list]:
    new = unify_all(rows["text"])
    return rows | {"text": new, "changed": [a != b for a, b in zip(rows["text"], new)]}


def unified(texts: DataFrame) -> DataFrame:
    """(src, row_key, text, changed) of texts in the form of textio.keyed; a narrow operation."""
    return map_slices(texts, _rewrite, "src string, row_key string, text string, changed boolean", _ARROW)


def inputs(chunks: DataFrame, toc_tree: DataFrame) -> DataFrame:
    return keyed(chunks, "chunks", "id", F.col("content")).unionAll(keyed(toc_tree, "toc_tree", "toc_id", F.col("title")))


def p5_text(chunks: DataFrame, toc_tree: DataFrame) -> DataFrame:
    """The consistent form of every title and chunk, one row for each key."""
    return once(unified(inputs(chunks, toc_tree)), "src", "row_key").select("src", "row_key", "text")


def p5_found(chunks: DataFrame, toc_tree: DataFrame) -> DataFrame:
    """Keys of the rows that the transducer changes; only these keys are shuffled."""
    return unified(inputs(chunks, toc_tree)).where("changed").select("src", "row_key").distinct()
