"""Problem 8: text cut off by field limits.

Each text runs through a pushdown automaton over its structural signs (tags, fences, formulas,
brackets, quotes, escapes, broken characters). What is left on its stack, what stands at its
very end, and the terminator of its last line decide:

- a structure left open, a bracket or quote of the last paragraph left open, or a sign broken
  at the very end is a cut; a table row or table that is closed is whole;
- a last line without a terminator is a cut where lines of its kind are terminated in its
  source: the source's baseline of terminators by kind of line, taken over all its lines that
  aren't the last of their text;
- lines of kinds that go without terminators (items, values, headings, short lines) are held
  against the baseline of what such lines end in: the last word and the last phrase, or the
  last ideographs, must be known to end lines, as the fragments of words and the middles of
  phrases are not;
- short lines with which many different texts close are whole: a signature, a reference, a
  remark;
- texts as long as a limit of their source, a length that stands out among those of its
  different texts, are judged strictly: neither closing line nor kind excuses them.

Every rule is a share, of lines, of occurrences or of different texts; copies of a text count
as one where texts are counted, so copying rows or whole tables changes no verdict (tested).
Counts and baselines are taken over all texts. Words are counted by 64-bit hashes, computed for
whole batches at once; what is not the end of an open text is dropped before the counts meet the
texts. Sources, phrases and lines that many rows share meet them in SALTS parts.

Defined cases: null, '' and blank texts are whole; a null source counts as a source of its own;
repeated texts under several ids each come out.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import settle
from .textio import fold_slices, map_slices

#: Prose and steps need a terminator in a source where at least this share of such lines has one.
TERMINATED = 0.5
#: An end of a line that ends one in less than this share of its occurrences stops short.
COMPLETE = 0.01
#: The same for texts as long as a limit of their source.
COMPLETE_AT_LIMIT = 0.9
#: Lines (codes and numbers aside) that close at least this share of the different texts of the sources that have them are whole.
CLOSING_SHARE = 0.001
#: A length is a limit of a source if at least this share of its different texts have it.
LIMIT_SHARE = 0.02
#: Either needs so many different texts as evidence; more texts need no more than their share.
EVIDENCE = 5
#: What is shared by many rows, as a source or a phrase, meets them in so many parts.
SALTS = 8

_STOPS = set(".!?。！？；;…")
_CLOSERS = "\"'”’»“‘)]）】」』"
_CLOSE_TAG = re.compile(r"</\w+>$")
_HAN = "一-鿿㐀-䶿"
_NUMBER = re.compile(r"\d+(?:[.,]\d+)*")
_CODE = re.compile(r"(?<!\S)[A-Z]9[A-Z]?(?!\S)")
_SIGNS = re.compile(
    r"```|\$\$|\\(begin|end)\{(\w+\*?)\}|<(/?)(table|tr|td|th|thead|tbody|ul|ol|pre|code|blockquote|div|span)\b[^<>]*?(/?)>|<!--|-->|[(（\[【{«“„‚‘」』「『»}】\])）”]|’(?!\w)"
    r"|(?<!\d)\"|(?<![^\s(（\[{\"“„])'(?=\w)|(?<=[\w.!?,])'(?!\w)",
    re.I,
)
#: Texts without any of these signs have nothing to open.
_ANY_SIGN = re.compile("[`$\\\\<(（\\[【{«“„‚‘「『\"']")
#: Signs that are cut in two at the end of a line, and tags that are not ended.
_BROKEN = re.compile(r"�$|&#?\w{0,8}$|\\u[0-9a-fA-F]{0,3}$|\\x[0-9a-fA-F]?$|%[0-9A-F]?$|\\$|[ÃÂâ]$|[\ud800-\udfff]$")
_BROKEN_SIGNS = 10
_BROKEN_TAG = re.compile(r"<(?:[/!]?[a-zA-Z][^<>]*)?$")
_PAIR = {")": "(", "）": "（", "]": "[", "】": "【", "}": "{", "»": "«", "”": "“", "’": "‘", "」": "「", "』": "『"}
_QUOTES = "\"'“„‚‘«「『"
_OPENS = "(（[【{" + _QUOTES
_BLOCKS = ("<table", "```", "<pre", "<!--", "<ul", "<ol", "$$")


def open_structures(text: str) -> list[tuple[str, int]]:
    """What the automaton still has on its stack at the end of the text, with places.

    Quotes: ``"`` opens and closes in turn unless it stands behind a digit (inches); ``'`` opens
    only before a word and closes only behind one, so apostrophes are none; ``“`` closes ``„``
    and ``‘`` closes ``‚`` where these are open, and else they open; ``’`` inside a word is an
    apostrophe.
    """
    stack: list[tuple[str, int]] = []
    if not _ANY_SIGN.search(text):
        return stack
    for m in _SIGNS.finditer(text):
        sign = m.group()
        top = stack[-1][0] if stack else ""
        if top == "```" and sign != "```" or top == "<!--" and sign != "-->":
            continue
        if sign in ("```", "$$", '"', "'"):
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == sign), -1)
            if at >= 0:
                del stack[at:]
            elif sign != "'" or m.start() + 1 < len(text) and text[m.start() + 1].isalnum():
                stack.append((sign, m.start()))
            continue
        if sign == "“" and any(s == "„" for s, _ in stack) or sign == "‘" and any(s == "‚" for s, _ in stack):
            close = "„" if sign == "“" else "‚"
        elif sign == "<!--" or sign in _OPENS:
            stack.append((sign, m.start()))
            continue
        elif sign == "-->":
            close = "<!--"
        elif sign in _PAIR:
            close = _PAIR[sign]
        elif m.group(1):
            if m.group(1).lower() == "begin":
                stack.append(("\\" + m.group(2), m.start()))
                continue
            close = "\\" + m.group(2)
        else:
            name = "<" + m.group(4).lower()
            if m.group(5):
                continue
            if not m.group(3):
                stack.append((name, m.start()))
                continue
            close = name
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == close:
                del stack[k:]
                break
            if stack[k][0][0] not in _OPENS + "<":
                break
    return stack


_WHOLE_NUMBER = re.compile(r"(?:^|[^\w.,])\d+\.$")
_LONE_MARKER = re.compile(r"[-*•]|\d{1,3}[.)]?|#+")
_LISTED = re.compile(r"\d+[.)]\s")
_HEADED = re.compile(r"#|=+ ")
_SENTENCES = re.compile(r"[。！？]\S|[.!?]\s+\S")


def _kind(s: str) -> str:
    """The kind of a stripped line."""
    c = s[:1]
    if c == "|" or s[-1:] == "|" or s.endswith("</table>"):
        return "row"
    if c in ("-", "*", "•", "·") and s[1:2].isspace():
        return "bullet"
    if c.isdigit() and _LISTED.match(s):
        return "number"
    if c in ("#", "=") and _HEADED.match(s):
        return "heading"
    if len(s) > 120 or _SENTENCES.search(s):
        return "prose"
    return "value" if ":" in s or "：" in s else "short"


# --- ends of lines as numbers ---------------------------------------------------------------

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MULT = np.uint64(0xBF58476D1CE4E5B9)
_GAP, _WORD, _SIGN, _BREAK = 0, 1, 2, 3


@lru_cache(1)
def _classes() -> np.ndarray:
    """Of each code point: a gap, part of a word, an ideograph or a line break."""
    table = np.full(0x110000, _WORD, np.uint8)
    table[[c for c in range(0x3001) if chr(c).isspace()]] = _GAP
    table[[ord(c) for c in "，。！？；：、（）“”"]] = _GAP
    table[0x3400:0x4DC0] = _SIGN
    table[0x4E00:0xA000] = _SIGN
    table[[10, 13]] = _BREAK
    return table


@lru_cache(1)
def _digits() -> np.ndarray:
    return np.fromiter((chr(c).isdecimal() for c in range(0x110000)), bool, 0x110000)


@lru_cache(1)
def _stops() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[ord(c) for c in ".,;:!?…"]] = True
    return table


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (a >> np.uint64(29))) * _MULT + b * _MIX
    return h ^ (h >> np.uint64(32))


def grams(texts: list[str]) -> tuple[np.ndarray, ...]:
    """(g1, g2, closes, doc): of each place in the texts where a phrase may end, in order.

    g1: the word, or the last two ideographs; g2: the word with the one before it in its line,
    or the last four ideographs. Numbers and the letters of codes are put alike and signs behind
    a word are left out. closes: the last place of its line; doc: the text.
    """
    none = np.zeros(0, np.uint64)
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    n = len(codes)
    kind = _classes()[codes]
    digit = _digits()[codes]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = digit[:-1], digit[1:]
    number = digit | ((codes == 46) | (codes == 44)) & before & after
    before[1:], after[:-1] = number[:-1], number[1:]
    inner = number & before
    codes = np.where(number, 57, np.where((codes >= 65) & (codes <= 90) & (before | after), 65, codes))
    stop = _stops()[codes] & (kind == _WORD) & ~number
    place = np.arange(n)
    follower = np.minimum.accumulate(np.where(stop, n - 1, place)[::-1])[::-1]
    stop &= kind[follower] != _WORD
    sign = kind == _SIGN
    starts = np.ones(n, bool)
    starts[1:] = (kind[1:] != _WORD) | (kind[:-1] != _WORD)
    at = np.flatnonzero((kind == _WORD) & ~inner & ~stop | sign)
    if not len(at):
        return none, none, np.zeros(0, bool), np.zeros(0, np.int64)
    token = np.cumsum(starts)[at]
    begins = np.ones(len(at), bool)
    begins[1:] = token[1:] != token[:-1]
    first = np.flatnonzero(begins)
    k = len(first)
    offset = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    with np.errstate(over="ignore"):
        h = codes[at].astype(np.uint64) * _MIX + offset.astype(np.uint64) * _MULT
        h ^= h >> np.uint64(29)
        h *= _MULT
        h ^= h >> np.uint64(32)
        word = np.add.reduceat(h, first)
        pos = at[first]
        han = sign[pos]
        line = np.cumsum(kind == _BREAK)[pos]
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        doc = np.searchsorted(np.cumsum(sizes), pos, side="right")
        same = np.zeros(k, bool)
        same[1:] = line[1:] == line[:-1]
        run = np.zeros(k, bool)
        run[1:] = han[1:] & han[:-1] & (np.diff(pos) == 1)
        lag = np.zeros(k, np.uint64)
        lag[1:] = word[:-1]
        g1 = np.where(run, _mixed(lag, word), word)
        g2 = _mixed(np.where(same, lag, np.uint64(0)), word)
        back = np.zeros(k, np.uint64)  # the pair of ideographs that ends two places before
        back[2:] = g1[:-2]
        chained = run.copy()
        chained[2:] &= run[1:-1]
        chained[:2] = False
        g2 = np.where(chained, _mixed(back, g1), np.where(han, g1, g2))
    closes = np.ones(k, bool)
    closes[:-1] = ~same[1:]
    return g1, g2, closes, doc


def tails(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """g1 and g2 at the end of each line; 0 where there is none."""
    g1, g2, _, doc = grams([re.sub(r"[\r\n]+", " ", x) for x in lines])
    out = np.zeros((2, len(lines)), np.uint64)
    out[:, doc] = g1, g2  # of several places of a line the last one stays
    out &= ~np.uint64(1)  # as they are counted
    return out[0].view(np.int64), out[1].view(np.int64)


# --- reading --------------------------------------------------------------------------------


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _without_mark(body: str) -> str:
    """A text without the mark of omission at its end, in brackets or not."""
    s = body.removesuffix("]")
    if s.endswith("..."):
        s = s[:-3]
    elif s.endswith("…"):
        s = s.rstrip("…")
    else:
        return body
    return (s.removesuffix("[") if body.endswith("]") else s).rstrip()


def _last_line(body: str) -> int:
    """Where the last line of a text begins."""
    return max(body.rfind("\n"), body.rfind("\r")) + 1


def _masked(line: str) -> str:
    """A line with its numbers and code letters put alike."""
    return " ".join(_CODE.sub("A9A", _NUMBER.sub("9", line)).split())


def _terminated(s: str) -> bool:
    """Whether a line without blanks at its end closes with a terminator, whatever closes behind it."""
    while s:
        if s[-1] in _STOPS:
            return True
        if s[-1] == ">" and (m := _CLOSE_TAG.search(s, s.rfind("<"))):
            s = s[: m.start()]
        elif s[-1] in _CLOSERS:
            s = s.rstrip(_CLOSERS)
        else:
            return False
    return False


def _broken(s: str) -> bool:
    at = s.rfind("<")
    return _BROKEN.search(s, max(0, len(s) - _BROKEN_SIGNS)) is not None or at >= 0 and _BROKEN_TAG.match(s, at) is not None


def read_end(text: str | None) -> tuple:
    """(chars, bytes, state, kind, ended, marked, line, bare, rest) of one text.

    state: blank, broken (a sign cut in two), open (a structure that isn't closed), bracket (a
    bracket or quote of the last paragraph that isn't closed), comma (a sign after which more
    must follow), marker (a list marker alone), decimal (a number with a point), closed (a row or
    table that is closed) or plain. line: the last line, masked where it has no terminator; bare: the last line without a
    mark of omission; rest: a hash of the text before it.
    """
    if not text or not text.strip():
        return (len(text or ""), len((text or "").encode("utf-8", "replace")), "blank", "short", True, False, "", "", 0)
    body = text.rstrip()
    bare = _without_mark(body) or body
    marked = len(bare) < len(body)
    start = _last_line(bare)
    last = bare[start:]
    stripped = last.strip()
    left = open_structures(body)
    kind = _kind(stripped)
    ended = not marked and _terminated(last)
    state = "plain"
    row = stripped.startswith("|")
    if _broken(last):
        state = "broken"
    elif any(s in _BLOCKS or s[0] == "\\" for s, _ in left) or row and (marked or not stripped.endswith("|")):
        state = "open"
    elif any(s in _OPENS for s, _ in left) and max(at for s, at in left if s in _OPENS) >= _paragraph(body):
        state = "bracket"
    elif kind == "row" and not marked:
        state = "closed"
    elif last[-1] in ",，、:：(（[«“„/~～–&=+" or last[-1] == "-" and last[-2:-1] != "-":
        state = "comma"
    elif _LONE_MARKER.fullmatch(stripped):
        state = "marker"
    elif ended and last[-1] == "." and last[-2:-1].isdigit() and _WHOLE_NUMBER.search(last):
        state = "decimal"  # a sentence may end so, but so may a number that is cut after its point
    return (len(text), len(text.encode("utf-8", "replace")), state, kind, ended, marked, stripped if ended else _masked(stripped), last, _hash(bare[:start].strip()))


def _paragraph(body: str) -> int:
    """Where the last paragraph of a text begins."""
    at = 0
    for m in re.finditer(r"\n[ \t\r]*\n", body):
        at = m.end()
    return at


_READ = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("chars", pa.int32()), ("bytes", pa.int32()), ("state", pa.string()), ("kind", pa.string()), ("ended", pa.bool_()), ("marked", pa.bool_()), ("line", pa.int64()), ("chars_of_line", pa.int32()), ("g1", pa.int64()), ("g2", pa.int64()), ("rest", pa.int64())])
_READ_SQL = "doc_id long, source string, chars int, bytes int, state string, kind string, ended boolean, marked boolean, line long, chars_of_line int, g1 long, g2 long, rest long"


def _ends(rows: dict[str, list]) -> dict[str, list]:
    got = [read_end(t) for t in rows["text"]]
    chars, size, state, kind, ended, marked, line, bare, rest = zip(*got) if got else ([],) * 9
    g1, g2 = tails(list(bare))
    return {"doc_id": rows["doc_id"], "source": rows["source"], "chars": chars, "bytes": size, "state": state, "kind": kind, "ended": ended, "marked": marked, "line": [_hash(x) for x in line], "chars_of_line": [len(x) for x in line], "g1": g1, "g2": g2, "rest": rest}


def ends(documents: DataFrame) -> DataFrame:
    slim = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    return map_slices(slim, _ends, _READ_SQL, _READ)


class Tally:
    """Occurrences of phrases and their ends of lines, and lines of a source and kind with their terminators."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.size = 0
        self.lines: Counter = Counter()

    def __len__(self) -> int:
        return self.size + len(self.lines)

    def add(self, keys: np.ndarray, closes: np.ndarray) -> None:
        """Count the keys, and how many of each close their line, which the lowest bit says while they are sorted."""
        both = np.sort(keys & ~np.uint64(1) | closes.astype(np.uint64))
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        n = np.diff(np.append(first, len(both)))
        both = both[first]
        got = np.stack([(both & ~np.uint64(1)).view(np.int64), n, np.where(both & np.uint64(1), n, 0)])
        self.parts.append(got)
        self.size += len(first)

    def merged(self) -> np.ndarray:
        if not self.parts:
            return np.zeros((3, 0), np.int64)
        every = np.concatenate(self.parts, axis=1)
        order = np.argsort(every[0], kind="stable")
        every = every[:, order]
        first = np.flatnonzero(np.append(True, np.diff(every[0]) != 0))
        return np.stack([every[0][first], np.add.reduceat(every[1], first), np.add.reduceat(every[2], first)])


def _count(state: Tally, rows: dict[str, list]) -> None:
    """A text's own last end is counted neither as seen nor as an end, nor its last line as a line."""
    texts = [t.rstrip() if t else "" for t in rows["text"]]
    g1, g2, closes, doc = grams(texts)
    if len(doc):
        own = np.append(doc[1:] != doc[:-1], True)
        both = np.concatenate([g1[~own], g2[~own]])
        state.add(both, np.tile(closes[~own], 2))
    lines: list[tuple] = []
    for source, text in zip(rows["source"], texts):
        for line in text[: _last_line(text)].splitlines():
            s = line.strip()
            if s:
                lines.append((source, _kind(s), _terminated(s)))
    state.lines.update(lines)


_TALLY_SQL = "source string, kind string, gram long, n long, ends long"


def _tallied(state: Tally):
    """Phrases have no kind; lines have no gram, and their terminated ones as ends."""
    gram, n, closing = state.merged()
    names = ["source", "kind", "gram", "n", "ends"]
    if len(gram):
        none = pa.nulls(len(gram), pa.string())
        yield pa.RecordBatch.from_arrays([none, none, pa.array(gram), pa.array(n), pa.array(closing)], names=names)
    if state.lines:
        per: dict[tuple, list[int]] = {}
        for (source, kind, ended), count in state.lines.items():
            got = per.setdefault((source, kind), [0, 0])
            got[0] += count
            got[1] += count * ended
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in per], pa.string()), pa.array([k for _, k in per], pa.string()), pa.nulls(len(per), pa.int64()), pa.array([x for x, _ in per.values()], pa.int64()), pa.array([x for _, x in per.values()], pa.int64())], names=names)


def counts(documents: DataFrame) -> DataFrame:
    """(source, kind, gram, n, ends) over all texts, pre-aggregated in each partition."""
    part = fold_slices(documents.select("source", "text"), Tally, _count, _tallied, _TALLY_SQL, every=2_000_000)
    return part.groupBy("source", "kind", "gram").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))


# --- judging --------------------------------------------------------------------------------


def limits(read: DataFrame) -> DataFrame:
    """(source, unit, length): the lengths that stand out among those of a source's different texts."""
    texts = read.where("state <> 'blank'").select("source", "chars", "bytes", F.xxhash64("line", "rest").alias("t")).distinct()
    both = texts.select("source", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")))).alias("x")).select("source", "x.unit", "x.length")
    per = both.groupBy("source", "unit", "length").agg(F.count("*").alias("n"))
    whole = per.groupBy("source", "unit").agg(F.sum("n").alias("texts")).select(F.col("source").alias("s"), F.col("unit").alias("u"), "texts")
    got = per.join(whole, F.col("source").eqNullSafe(F.col("s")) & (F.col("unit") == F.col("u")))
    return got.where((F.col("n") >= EVIDENCE) & (F.col("n") >= LIMIT_SHARE * F.col("texts"))).select("source", "unit", "length")


def closing_lines(read: DataFrame, candidates: DataFrame) -> DataFrame:
    """(c_line, closers): the lines that close enough different texts of the sources that have them.

    candidates: (source, line, rest) of the texts that may show a closing line.
    """
    texts = read.where("state <> 'blank'").select("source", F.xxhash64("line", "rest").alias("t")).distinct().groupBy(F.col("source").alias("t_source")).agg(F.count("*").alias("texts"))
    # A text that several sources have counts once, too.
    once = candidates.select("line", "rest").distinct().groupBy(F.col("line").alias("c_line")).agg(F.count("*").alias("closers")).where(F.col("closers") >= EVIDENCE)
    per = candidates.select("source", "line").distinct().join(once, F.col("line") == F.col("c_line")).select("source", "c_line", "closers")
    per = per.join(texts, F.col("source").eqNullSafe(F.col("t_source"))).groupBy("c_line", "closers").agg(F.sum("texts").alias("texts"))
    return per.where(F.col("closers") >= CLOSING_SHARE * F.col("texts")).select("c_line", "closers")


def profiles(read: DataFrame, stats: DataFrame) -> DataFrame:
    """(p_source, chars_at, bytes_at, baseline): the limits of each source and its share of terminated lines by kind.

    A source has few limits, as each of them needs LIMIT_SHARE of its texts, and few kinds of line.
    """
    kinds = stats.where(F.col("kind").isNotNull()).select("source", F.struct("kind", (F.col("ends") / F.col("n")).alias("share")).alias("line"), F.lit(None).cast("struct<unit:string,length:int>").alias("limit"))
    every = kinds.unionByName(limits(read).select("source", F.lit(None).cast(kinds.schema["line"].dataType).alias("line"), F.struct("unit", "length").alias("limit")))
    per = every.groupBy(F.col("source").alias("p_source")).agg(F.map_from_entries(F.collect_list("line")).alias("baseline"), F.collect_list("limit").alias("l"))
    of = lambda unit: F.transform(F.filter("l", lambda x: x["unit"] == unit), lambda x: x["length"])
    return per.select("p_source", of("chars").alias("chars_at"), F.flatten(F.transform(of("bytes"), lambda x: F.sequence(x - 3, x))).alias("bytes_at"), "baseline")


def _parts(df: DataFrame) -> DataFrame:
    """Each row once for each part of what it meets."""
    return df.withColumn("p_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def judged(documents: DataFrame) -> DataFrame:
    """(doc_id, source, cut, ...): the verdict on every text with what led to it."""
    read = settle(ends(documents))
    # Most texts are settled by the automaton and their terminator; only the others meet the baselines.
    unsettled = ~F.col("state").isin("blank", "broken", "open", "closed") & (~F.col("ended") | F.col("state").isin("decimal", "bracket"))
    settled = read.where(~unsettled).select("doc_id", "source", F.col("state").isin("broken", "open").alias("cut"), "state", "kind", "ended", *(F.lit(None).cast(t).alias(n) for n, t in (("at_limit", "boolean"), ("complete", "double"), ("baseline", "double"), ("closers", "long"))))
    left = settle(read.where(unsettled).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))))
    stats = settle(counts(documents).join(left.select(F.explode(F.array("g1", "g2")).alias("w_gram")).distinct(), F.col("gram") == F.col("w_gram"), "left").where("kind IS NOT NULL OR w_gram IS NOT NULL").drop("w_gram"))
    p = _parts(profiles(read, stats))
    out = left.join(p, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("salt") == F.col("p_salt")), "left").drop("p_source", "p_salt")
    at_limit = F.coalesce(F.array_contains("chars_at", F.col("chars")), F.lit(False)) | F.coalesce(F.array_contains("bytes_at", F.col("bytes")), F.lit(False))
    out = out.withColumn("at_limit", at_limit).withColumn("share", F.coalesce(F.element_at("baseline", F.col("kind")), F.lit(0.0))).drop("chars_at", "bytes_at", "baseline")
    close = _parts(closing_lines(read, out.where("chars_of_line >= 4 AND NOT ended AND NOT at_limit").select("source", "line", "rest")))
    out = out.join(close, (F.col("line") == F.col("c_line")) & (F.col("salt") == F.col("p_salt")), "left").drop("p_salt")
    for g in ("g1", "g2"):
        s = _parts(stats.where("kind IS NULL").select(F.col("gram").alias(f"k_{g}"), F.col("n").alias(f"n_{g}"), F.col("ends").alias(f"ends_{g}")))
        out = out.join(s, (F.col(g) == F.col(f"k_{g}")) & (F.col("salt") == F.col("p_salt")), "left").drop("p_salt")
    known = lambda g: F.coalesce(F.col(f"ends_{g}") / F.col(f"n_{g}"), F.lit(0.0))
    out = out.withColumn("complete", F.greatest(known("g1"), known("g2")))
    needs = F.col("kind").isin("number", "prose") & (F.col("marked") | (F.col("share") >= TERMINATED))
    closing = F.col("kind").isin("short", "value", "heading", "bullet") & F.col("c_line").isNotNull() & ~F.col("at_limit")
    cut = F.when((F.col("state") == "decimal") | F.col("ended"), F.col("at_limit")).when(F.col("state").isin("bracket", "comma", "marker"), True)
    cut = cut.when(closing, False).when(needs, True).when(F.col("at_limit"), F.col("complete") < COMPLETE_AT_LIMIT).otherwise(F.col("complete") < COMPLETE)
    here = out.select("doc_id", "source", cut.alias("cut"), "state", "kind", "ended", "at_limit", "complete", F.col("share").alias("baseline"), F.coalesce("closers", F.lit(0)).cast("long").alias("closers"))
    return settled.unionByName(here)


def p8_found(documents: DataFrame) -> DataFrame:
    """doc_id of every cut text."""
    return judged(documents).where("cut").select("doc_id")


def p8_sources(documents: DataFrame) -> DataFrame:
    """(source, texts, cut_texts, cut_share): how often each source cuts; texts that are null or blank count as texts."""
    return judged(documents).groupBy("source").agg(F.count("*").alias("texts"), F.count_if("cut").alias("cut_texts"), F.round(F.count_if("cut") / F.count("*"), 6).alias("cut_share"))
