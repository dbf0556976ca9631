"""Problem 2: markup residue in text documents.

A text is read into a tree of candidate nodes: tags, comments, character references, Markdown,
wiki and LaTeX signs. Boosted trees over features of the nodes (subtree length and density,
attribute tokens, depth, statistics of siblings, what stands around a sign) give each node the
odds of being markup with its meaning rather than plain characters. A dynamic programme over
the tree then picks the most likely set of nodes in which no two contradict each other: what
stands inside code, a formula or a comment is literal if that ancestor is markup. The chosen
nodes are taken out; headings, list items, code, formulas and table cells stay as blocks.

Training: SAMPLE_TEXTS synthetic texts, made below by a fixed seed from templates with known
labels; a bounded sample whose size doesn't depend on the data.

Defined cases: null stays null with no blocks; '' has no blocks; ragged tables keep the cells
they have; a tag left open ends with the text; a text of any length is read as a whole.
"""

from __future__ import annotations

import html
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted
from .textio import keyed, map_slices, once

SAMPLE_TEXTS = 8000
SEED = 20
#: Rounds and depth of the trees.
ROUNDS, DEPTH = 60, 5

#: Signs nested in one line deeper than this are read as plain text; tags may be nested to any depth.
INLINE_DEPTH = 100

_GATE = re.compile(r"[<&*#`\[{\\$|~_]|^[ \t]*>|^==|''|^-{3,}[ \t]*$", re.M)
_NODE = re.compile(
    # Every alternative begins with one of these signs or at the start of a line.
    r"""(?:(?=[<&*\#`\[!{\\$|~_'=]|[ \t]+&)|^)(?:(?P<comment><!--.*?(?:-->|\Z))
    |(?P<fence>^[ \t]*(?P<tick>```|~~~)[^\n`]*\n(?P<fenced>.*?)(?:^[ \t]*(?P=tick)[ \t]*$|\Z))
    |(?P<autolink><(?:https?|mailto|ftp):[^<>\s]*>)
    |(?P<tag><(?P<slash>/?)(?P<name>[A-Za-z][\w:-]*)(?P<attrs>(?:\s[^<>]*)?)(?P<self>/?)>)
    |(?P<entity>&(?:\#\d{1,7}|\#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});)
    |(?P<wikitable>^\{\|[^\n]*$|^\|-+[^\n|]*$|^\|\}[ \t]*$|^\|\+[^\n]*$)
    |(?P<wikirow>^[|!][ \t]*[^|!\n]*(?:(?:\|\||!!)[^\n]*)+$)
    |(?P<piperow>^[ \t]*\|[^\n]*\|[ \t]*$)
    |(?P<pipecell>^[|!][ \t]+[^\n]*$)
    |(?P<mdhead>^[ \t]{0,3}\#{1,6}[ \t]+\S[^\n]*$)
    |(?P<wikihead>^(?P<eq>={2,6})[ \t]*[^=\n]+?[ \t]*(?P=eq)[ \t]*$)
    |(?P<quote>^[ \t]{0,3}(?:>[ \t]?)+(?=\S))
    |(?P<rule>^[ \t]*(?:-{3,}|\*{3,}|_{3,})[ \t]*$)
    |(?P<mathblock>\$\$.+?\$\$|\\\[.+?\\\])
    |(?P<math>\\\([^\n]+?\\\)|(?<![\\A-Za-z0-9_$])\$(?=[^\s$])[^$\n]+?(?<=[^\s\\])\$(?![A-Za-z0-9_$]))
    |(?P<env>\\(?P<be>begin|end)\{(?P<envname>[A-Za-z]+\*?)\}(?:\{[^{}\n]*\})?)
    |(?P<tex>~?\\(?P<cmd>[A-Za-z]+)\*?(?P<args>(?:\[[^\]\n]*\])?(?:\{(?:[^{}\n]|\{[^{}\n]*\})*\})*))
    |(?P<texrow>[ \t]*&[^\n&]*(?:&[^\n&]*)*\\\\[ \t]*$|\\\\[ \t]*$)
    |(?P<image>!\[(?P<alt>[^\]\n]*)\]\((?P<isrc>[^()\n]*)\))
    |(?P<wikilink>\[\[(?P<wl>[^\[\]\n]+)\]\])
    |(?P<template>\{\{(?P<tpl>[^{}\n]+)\}\})
    |(?P<link>\[(?P<label>[^\[\]\n]+)\]\((?P<href>[^()\s]+)\))
    |(?P<footnote>\[\^[\w-]+\]:?)
    |(?P<code>(?P<bt>`{1,2})(?!`)(?P<inner>[^\n]+?)(?<!`)(?P=bt)(?!`))
    |(?P<strong>(?P<st>\*{1,3}|(?<![A-Za-z0-9À-ɏЀ-ԯ](?=_{1,3}[A-Za-z0-9À-ɏЀ-ԯ]))_{1,3}|~~|'{2,5})(?=[^\s*_~'])(?P<mid>[^\n]*?[^\s*_~'])(?P=st)(?![*_~'])(?!(?:(?<=[A-Za-z0-9À-ɏЀ-ԯ]_)|(?<=[A-Za-z0-9À-ɏЀ-ԯ]__)|(?<=[A-Za-z0-9À-ɏЀ-ԯ]___))[A-Za-z0-9À-ɏЀ-ԯ]))
    |(?P<escape>\\[*_\#`\[\]{}|>~$%&])
    |(?P<stray>\*{2,3}|~~|`{3}))
    """,
    re.X | re.M | re.S,
)

#: Kinds that are nearly always markup stand first, so that few splits of a tree tell them from the doubtful ones.
KINDS = [
    "comment", "fence", "mdhead", "wikihead", "mathblock", "env", "image", "wikilink", "template", "link", "footnote", "code", "autolink", "wikitable", "wikirow", "piperow", "texrow",
    "math", "tex", "entity", "strong", "tag", "escape", "stray", "quote", "rule", "pipecell",
]
_KIND = {k: i for i, k in enumerate(KINDS)}
_FAMILY = {"comment": 0, "tag": 0, "entity": 0, "autolink": 1, "wikitable": 2, "wikirow": 2, "wikihead": 2, "wikilink": 2, "template": 2, "pipecell": 2, "mathblock": 3, "math": 3, "env": 3, "tex": 3, "texrow": 3}

# Names of HTML elements, by what they do to the text.
BLOCK_TAGS = {"p", "div", "section", "article", "header", "footer", "main", "aside", "nav", "blockquote", "dl", "dt", "dd", "figure", "figcaption", "center", "form", "fieldset", "body", "html", "head", "title", "address", "br", "hr", "ul", "ol", "caption", "colgroup", "col"}
INLINE_TAGS = {"b", "i", "em", "strong", "u", "s", "del", "ins", "sub", "sup", "span", "font", "a", "small", "big", "tt", "kbd", "samp", "var", "cite", "q", "abbr", "mark", "label", "img", "input", "button", "nowiki", "ref", "references", "strike", "wbr", "bdi", "bdo", "time", "center", "link", "meta"}
GRID_TAGS = {"table", "thead", "tbody", "tfoot", "tr", "td", "th"}
HEAD_TAGS = {f"h{k}" for k in range(1, 7)}
CODE_TAGS = {"pre", "code", "math", "nowiki"}
DROP_TAGS = {"script", "style"}
VOID_TAGS = {"br", "hr", "img", "input", "wbr", "col", "meta", "link"}
_OTHER_BLOCKS = BLOCK_TAGS | HEAD_TAGS | {"li"}
KNOWN_TAGS = BLOCK_TAGS | INLINE_TAGS | GRID_TAGS | HEAD_TAGS | CODE_TAGS | DROP_TAGS | {"li"}
# LaTeX commands by what is done with their arguments.
HEAD_COMMANDS = {"part", "chapter", "section", "subsection", "subsubsection", "paragraph", "subparagraph", "title", "caption"}
GONE_COMMANDS = {"cite", "citep", "citet", "label", "ref", "eqref", "pageref", "index", "vspace", "hspace", "includegraphics", "footnotemark", "hline", "toprule", "midrule", "bottomrule", "centering", "newpage", "noindent", "usepackage", "documentclass", "maketitle", "bibliography", "input"}
CODE_ENVS = {"verbatim", "lstlisting", "equation", "equation*", "align", "align*", "math", "displaymath", "minted"}

# Signs that hold a block's kind while a text is rewritten: half surrogates, which no text from a table can hold.
_HEAD, _ITEM, _CODE, _UNCODE, _MATH, _UNMATH, _CELL, _ROW = map(chr, range(0xD800, 0xD808))
_OWN = dict.fromkeys(range(0xD800, 0xD808))
_GRID = re.compile(r"</?(?:table|thead|tbody|tfoot|tr|td|th)\b[^<>]*>?", re.I)


class Node:
    __slots__ = ("kind", "s", "e", "inner", "name", "attrs", "close", "children", "depth", "paired", "m", "chosen", "odds", "end_tag", "parent", "best", "soft")

    def __init__(self, kind, s, e, depth, name="", attrs="", inner=None, m=None, end_tag=False):
        self.kind, self.s, self.e, self.depth, self.name, self.attrs, self.inner, self.m = kind, s, e, depth, name, attrs, inner, m
        self.close, self.children, self.paired, self.chosen, self.odds, self.end_tag, self.parent = None, [], False, False, 0.0, end_tag, None
        self.best = self.soft = 0.0  # of decode(): the odds of the node's subtree, and of what still counts of its children inside code

    @property
    def stop(self) -> int:
        return self.close[1] if self.close else self.e


_INSIDE = {"strong": "mid", "link": "label", "mdhead": None, "wikihead": None, "piperow": None, "wikirow": None, "pipecell": None, "wikilink": "wl", "tex": "args", "math": None, "mathblock": None, "texrow": None, "template": "tpl"}


def _scan(text: str, at: int, stop: int, depth: int) -> list[Node]:
    out = []
    for m in _NODE.finditer(text, at, stop):
        kind = m.lastgroup if m.lastgroup in _KIND else next(k for k in KINDS if m.group(k) is not None)
        if kind == "tag":
            out.append(Node(kind, m.start(), m.end(), depth, m.group("name"), m.group("attrs") or "", m=m, end_tag=bool(m.group("slash"))))
            continue
        node = Node(kind, m.start(), m.end(), depth, m.group("cmd") or m.group("envname") or "", m=m)
        if kind == "env":
            node.end_tag = m.group("be") == "end"
        elif kind == "tex":
            node.attrs = m.group("args") or ""
        if kind in _INSIDE:
            group = _INSIDE[kind]
            a, b = (m.start(group), m.end(group)) if group else (m.start() + 1, m.end() - (kind in ("math", "mathblock", "piperow", "texrow")))
            node.inner = (a, b)
            if a < b and (kind not in ("mdhead", "piperow", "wikirow", "pipecell") or True):
                node.children = _scan_inline(text, a, b, depth + 1)
        elif kind in ("code", "fence"):
            node.inner = (m.start("inner"), m.end("inner")) if kind == "code" else (m.start("fenced"), m.end("fenced"))
            node.children = _scan_inline(text, *node.inner, depth + 1)
        out.append(node)
    return out


def _scan_inline(text: str, a: int, b: int, depth: int) -> list[Node]:
    """Nodes within a node; ^ matches only at the starts of real lines."""
    return _scan(text, a, b, depth) if depth < INLINE_DEPTH and _GATE.search(text, a, b) else []


def tree(text: str) -> list[Node]:
    """Top nodes of a text: pairs of tags and environments take what stands between them as children."""
    return _pair(_scan(text, 0, len(text), 0))


def _pair(flat: list[Node]) -> list[Node]:
    """The tree of nodes in the order of the text, in one pass.

    The open nodes of each kind and name are kept, so that an end finds its beginning at once. A
    tag that is never closed holds nothing: its children stand beside it.
    """
    stack: list[Node] = []
    open_at: dict[tuple[str, str], list[int]] = {}
    order: list[Node] = []

    def shut(k: int) -> None:
        for n in stack[k:]:
            open_at[n.kind, n.name.lower()].pop()
        del stack[k:]

    for node in flat:
        if node.children:
            node.children = _pair(node.children)
        name = node.name.lower()
        if node.end_tag:
            at = open_at.get((node.kind, name))
            if at:
                stack[at[-1]].close, stack[at[-1]].paired = (node.s, node.e), True
                shut(at[-1])
            else:
                node.parent = stack[-1] if stack else None
                order.append(node)
            continue
        node.depth += len(stack)
        opens = node.kind == "env" or node.kind == "tag" and not node.m.group("self") and name not in VOID_TAGS
        if opens and node.kind == "tag" and name == "li":
            at = open_at.get(("tag", "li"))
            if at and at[-1] > max(open_at.get(("tag", x), [-1])[-1] if open_at.get(("tag", x)) else -1 for x in ("ul", "ol")):
                shut(at[-1])
        node.parent = stack[-1] if stack else None
        order.append(node)
        if opens:
            open_at.setdefault((node.kind, name), []).append(len(stack))
            stack.append(node)
    root: list[Node] = []
    for n in order:
        if n.parent and not n.parent.paired:
            n.parent = n.parent.parent  # the parent stands before its children, so its own is settled
        (n.parent.children if n.parent else root).append(n)
    return root


def _char(text: str, at: int) -> int:
    if at < 0 or at >= len(text) or text[at] == "\n":
        return 0
    c = text[at]
    if c.isspace():
        return 1
    if c.isdigit():
        return 2
    if c.isalpha():
        return 4 if c >= "⺀" else 3
    return 6 if c in ":\\/._-" else 5


def walk(nodes: list[Node]):
    """All nodes, each before its children."""
    todo = nodes[::-1]
    while todo:
        n = todo.pop()
        yield n
        todo += n.children[::-1]


FEATURES = 25
#: Numbers of nodes from here on mean the same, so that texts with more signs than the sample has are judged alike.
FEW = 5
#: Likewise the logarithm of a length, and a number of words.
LONG, WORDY = 5.0, 12


@lru_cache(1)
def _signs() -> np.ndarray:
    """Of each code point: 1 for a blank, 2 for a digit, 4 for a sign that is frequent in commands and formulas."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        x = chr(c)
        if x.isspace():
            table[c] = 1
        elif x.isdigit():
            table[c] = 2
    table[[ord(c) for c in "{=\\^"]] = 4
    return table


def features(text: str, nodes: list[Node], out: list[list[float]], order: list[Node]) -> None:
    """Append a row of features for each node of the tree, in the order of walk().

    What is counted inside a node comes from sums over the text up to each place, so the work
    grows with the text and its nodes, however deep they are.
    """
    every = list(walk(nodes))
    kinds: dict[str, int] = {}
    family: dict[int, int] = {}
    same: dict[tuple, int] = {}
    for n in every:
        kinds[n.kind] = kinds.get(n.kind, 0) + 1
        f = _FAMILY.get(n.kind, 1)
        family[f] = family.get(f, 0) + 1
    ids: dict[int, int] = {}
    within = dict.fromkeys(map(id, nodes), False)  # whether an ancestor would make the node literal
    for group, mute in ((nodes, False), *((n.children, n) for n in every)):
        mute = mute and (within[id(mute)] or _closed(mute))
        for n in group:
            ids[id(n)] = id(group)
            within[id(n)] = mute
            same[id(group), n.kind, n.name] = same.get((id(group), n.kind, n.name), 0) + 1
    kind = _signs()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = np.append((kind & 1).astype(bool), True)
    starts = ~blank
    starts[1:] &= blank[:-1]
    begins, digits, counted = (np.concatenate(([0], x.cumsum())) for x in (starts[:-1], kind & 2 > 0, kind & 4 > 0))
    for n in every:
        low = n.name.lower()
        a, b = n.inner or ((n.e, n.close[0]) if n.close else (n.s + 1, n.e - 1))
        b = max(a, b)
        marks = sum(c.stop - c.s for c in n.children)
        known = 3 if low in GRID_TAGS else 2 if low in _OTHER_BLOCKS else 1 if low in KNOWN_TAGS else 0
        if n.kind == "tex":
            known = 2 if low in HEAD_COMMANDS | GONE_COMMANDS else 1 if "{" in n.attrs else 0
        elif n.kind == "entity":
            known = int(html.unescape(text[n.s : n.e]) != text[n.s : n.e])
        line = text.rfind("\n", 0, n.s) + 1
        words = begins[b] - begins[a] + (a > 0 and a < b and not blank[a] and not blank[a - 1])
        out.append([
            _KIND[n.kind], n.depth, min(LONG, np.log1p(n.stop - n.s)), (b - a - marks) / max(1, n.stop - n.s), min(FEW, len(n.children)), min(FEW, same[ids[id(n)], n.kind, n.name]),
            min(FEW, len(every)), known, float(n.name.isupper() and len(n.name) > 1), n.attrs.count("=") + n.attrs.count("{"), float(n.paired or n.end_tag), _char(text, n.s - 1),
            _char(text, n.stop), _char(text, a), _char(text, b - 1), float(words != 1), (digits[b] - digits[a]) / max(1, b - a), float(begins[n.s] == begins[line] and (line == n.s or blank[line])),
            len(n.name), min(FEW, family[_FAMILY.get(n.kind, 1)]), min(WORDY, words), min(FEW, kinds[n.kind]), counted[b] - counted[a], float(len(n.attrs) > 0), float(within[id(n)]),
        ])
        order.append(n)


def _closed(n: Node) -> bool:
    """Whether what stands inside the node is literal if the node is markup."""
    low = n.name.lower()
    if n.kind in ("comment", "fence", "code", "math", "mathblock"):
        return True
    return n.kind == "tag" and low in CODE_TAGS | DROP_TAGS or n.kind == "env" and n.name in CODE_ENVS


def decode(nodes: list[Node]) -> None:
    """Set ``chosen`` to the most likely assignment without contradictions.

    A dynamic programme from the leaves: ``best`` is the odds of a node's subtree where nothing
    forbids its markup, ``soft`` that of its children which still count inside code (character
    references and nested code tags inside <pre> and <code>). Each node is visited twice.
    """
    every = list(walk(nodes))
    for n in reversed(every):
        free = sum(c.best for c in n.children)
        n.soft = sum(c.best for c in n.children if _soft(c)) if n.kind == "tag" else 0.0
        n.best = max(n.odds + (n.soft if _closed(n) else free), free)
        n.chosen = n.best > free
    todo = [(n, False, False) for n in nodes]
    while todo:
        n, mute, soft = todo.pop()
        n.chosen = n.chosen and (not mute or soft and _soft(n))
        closed = n.chosen and _closed(n)
        todo += [(c, mute or closed, soft or closed and n.kind == "tag") for c in n.children]


def _soft(n: Node) -> bool:
    return n.kind == "entity" or n.kind == "tag" and n.name.lower() in CODE_TAGS | INLINE_TAGS


# --- training -----------------------------------------------------------------------------

_SYLLABLES = "ba de fi go lu ma ne pi ro su ta ve wi zo kal mor tin sel dra ver nor gel hin".split()
_HANZI = "测量固定检查外侧内部螺栓压力温度转动之后方可使用安装位置标记距离应为"
_RU = "проверка нижняя верхняя крышка панель трубка снимается ставится после минут левая".split()


def _pick(r: random.Random, some):
    return some[int(r.random() * len(some))]


@lru_cache(3)
def _vocabulary(script: int) -> list[str]:
    r = random.Random(SEED + script)
    if script == 0:
        return ["".join(r.choice(_HANZI) for _ in range(r.randint(2, 4))) for _ in range(800)]
    if script == 1:
        return _RU
    made = ("".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(1500))
    return [w.capitalize() if r.random() < 0.2 else w for w in made]


def _word(r: random.Random, script: int) -> str:
    return _pick(r, _vocabulary(script))


def _phrase(r: random.Random, script: int, n: int | None = None) -> str:
    words = _vocabulary(script)
    return ("" if script == 0 else " ").join([_pick(r, words) for _ in range(n or r.randint(1, 5))])


def _inline(r: random.Random, script: int) -> str:
    w, n, k = _phrase(r, script, r.randint(1, 2) if r.random() < 0.9 else r.randint(3, 40)), r.randint(1, 99), _word(r, 2).lower()
    return r.choice([
        f"**{w}**", f"__{w}__", f"*{w}*", f"***{w}***", f"_{w}_", f"~~{w}~~", f"`{w}`", f"``{k}``", f"[{w}](https://{k}.example/{n})", f"![{w}](img/{k}{n}.png)", f"[[{w}]]", f"[[{k}|{w}]]",
        f"{{{{{k}|{w}}}}}", f"{{{{{k}|p={n}}}}}", f"'''{w}'''", f"''{w}''", f"<b>{w}</b>", f"<i>{w}</i>", f"<em>{w}</em>", f"<strong>{w}</strong>", f'<span style="color:#{n}ab">{w}</span>', f"<font size={n % 7}>{w}</font>",
        f'<a href="https://{k}.example/{n}">{w}</a>', f"<sup>{n}</sup>", f"<sub>{n}</sub>", f"{w}<br>", f"{w}<br/>", f"&lt;em&gt;{w}&lt;/em&gt;", "&nbsp;", "&amp;", f"&#{n + 100};", "&quot;" + w + "&quot;", "&#x2013;", f"<!-- {k} {n} -->",
        f'<ref name="{k}"/>', f"<ref>{w}</ref>", f"\\emph{{{w}}}", f"\\textbf{{{w}}}", f"~\\cite{{{k}{n}}}", f"\\ref{{{k}:{n}}}", f"\\SI{{{n}}}{{\\newton\\metre}}", f"$x = y \\cdot z_{{{n}}}$", f"$\\alpha_{{{n}}} + {n}$", f"$\\frac{{F_{{{n}}}}}{{A}}$", f"${k[0]}_{{max}} = {n} \\times 10^{{{n}}}$", f"\\(\\sqrt{{x^{{2}} + {n}}}\\)", f"$\\Delta {k[0]} \\leq {n}^{{\\circ}}$", f"\\( a = b_{{{n}}} \\)", f"$v^{n % 9}$",
        f"$\\sum_{{i=1}}^{{{n}}} {k[0]}_{{i}} \\cdot {k[-1]}_{{i}} + \\frac{{{n}}}{{{k[0]}_{{0}}^{{2}}}}$", f"$\\int_{{0}}^{{{n}}} {k[0]}(t)\\,dt = {k[-1]}_{{{n}}} - \\mathrm{{{k}}}_{{max}} \\left( 1 + {n} \\right)$", f"\\( \\sum_{{j}} {k[0]}_{{j}}^{{2}} \\)", "$x_{1}" + f" + {k[0]}_{{{n}}}" * (n % 30) + "$",
        f"<code>{k}</code>", f"<kbd>{k}</kbd>", f"<u>{w}</u>", f"<small>{w}</small>", f"<font size={n % 7}>{w}", f"<i>{w}", f"</span>{w}", f"[^{n % 9}]", f"<https://{k}.example>", f"<del>{w}</del>", f"<I>{w}</I>", f"<B>{w}</B>", f"<SPAN>{w}</SPAN>", f'<P class="{k}">{w}</P>',
    ])


def _rich(r: random.Random, script: int, n: int) -> str:
    """A phrase that may hold signs of its own, as what stands in a block does."""
    joint = "" if r.random() < (0.7 if script == 0 else 0.15) else " "
    return joint.join([_phrase(r, script, n), _inline(r, script) + r.choice(["", "", ".", ":", "。"]), *([_phrase(r, script, 1)] if r.random() < 0.5 else [])]) if r.random() < 0.3 else _phrase(r, script, n)


def _block(r: random.Random, script: int) -> str:
    w, n, k = _rich(r, script, r.randint(1, 5)), r.randint(1, 99), _word(r, 2).lower()
    cell = lambda: _rich(r, script, r.randint(1, 3))
    rows = range(r.randint(1, 4))
    return r.choice([
        lambda: f"{'#' * r.randint(1, 6)} {w}", lambda: f"{'=' * (e := r.randint(2, 5))} {w} {'=' * e}", lambda: f"> {w}", lambda: f"```\n{k} = {k}({n}, \"a\")\n{k}[{n}] = *p_{n}\n```", lambda: f"```{k}\nif a < {n}: b_{n} = 2\n```", lambda: f"$$ M = F \\cdot r_{{{n}}} $$", lambda: f"\\[ a = {n} \\]", lambda: f"$$ \\sum_{{i=1}}^{{{n}}} {k[0]}_{{i}} {k[-1]}_{{i}} + \\int_{{0}}^{{{n}}} f(t)\\,dt $$", lambda: f"$$\n\\begin{{aligned}}\n{k[0]}_{{{n}}} &= {n} \\\\\n{k[-1]} &= \\frac{{a_{{i}}}}{{b}}\n\\end{{aligned}}\n$$", lambda: f"\\[ \\prod_{{j}} x_{{j}}^{{{n}}} \\]",
        lambda: f"\\section{{{w}}}", lambda: f"\\subsection{{{w}}}", lambda: f"\\paragraph{{{w}}}", lambda: "\\begin{itemize}\n" + "\n".join(f"\\item {cell()}" for _ in rows) + "\n\\end{itemize}", lambda: f"\\begin{{equation}}\na_{n} = b\n\\end{{equation}}", lambda: f"\\begin{{equation}}\n\\Delta {k[0]} \\leq {n}^{{\\circ}}\n\\end{{equation}}", lambda: f"\\begin{{equation}}\n\\frac{{{k[0]}_{{{n}}}}}{{b}} \\cdot {n}\n\\end{{equation}}",
        lambda: "\\begin{tabular}{ll}\n" + "\n".join(f"{cell()} & {n} mm \\\\" for _ in rows) + "\n\\end{tabular}", lambda: "| a | b |\n|---|---|\n" + "\n".join(f"| {cell()} | {cell()} |" for _ in rows), lambda: "{| class=\"grid\"\n" + "\n".join(f"|-\n| {cell()} || {cell()}" for _ in rows) + "\n|}",
        lambda: "{|\n" + "\n".join(f"|-\n! {cell()}\n| {cell()}" for _ in rows) + "\n|}", lambda: f"[[File:{k}{n}.png|thumb|{w}]]", lambda: f"<h{r.randint(1, 6)}>{w}</h{r.randint(1, 6)}>", lambda: f"<h2>{w}</h2>", lambda: "<ul>\n" + "\n".join(f"<li>{cell()}</li>" for _ in rows) + "\n</ul>", lambda: "<ol>\n" + "\n".join(f"<li>{cell()}" for _ in rows) + "\n</ol>",
        lambda: f"<p>{w}</p>", lambda: f"<div>{w}</div>", lambda: f'<div class="{k}"><p>{w}</p></div>', lambda: f"<pre><code>{k} = {k}({n}, \"b\")\nx < {n}</code></pre>", lambda: "<table><tr><td>" + "</td><td>".join(cell() for _ in rows) + "</td></tr></table>", lambda: f"<hr>\n{w}", lambda: f"<blockquote>{w}</blockquote>", lambda: f"<P>{w}</P>", lambda: f"<!--\n{w}\n-->"])()


def _plain(r: random.Random, script: int) -> str:
    """What looks like signs but has no such meaning."""
    w, n, k, m = _phrase(r, script, 1), r.randint(1, 99), _word(r, 2).lower(), r.randint(1, 99)
    K = r.choice(["OK", "SET", "MENU", "ESC", "ENTER", "F1", "MODE", "Esc", "Enter", "Start", "RES", "Stop", "Power", "PLUS"])
    return r.choice([
        f"<{K}>", f"<{K}>", f"<{K}>{w}<SET>", f"x < {n}", f"x < {n} y > {m}", f"a<b {w} c>d", f"{n} * {m}", f"{n}*{m}*{n}", f"a * b * {w}", f"${n}", f"${n} {w} ${m}", f"${n} {w}, ${m}.", f"{k}_v{n}_{m}.bin", f"{k}_{n}.txt", f"__{k}.py {w}", f"C:\\{k}\\{k}{n}", f"D:\\{k}\\{w}", f"\\\\{k}\\{k}",
        f"a_{n} + b_{m}", f"{k}_{_word(r, 2).lower()}_{k}", f"{k}_{n}_{k} {w}", f"_{k}", f"{k}_", f"k = a_{n} + {m}", f"{n}# {w}", f"#{n}", f"[{n}]", f"[{w}]", f"[{w}] ({n})", f"| {n}", f"{n} | {w}", f"R&D", f"A & B", f"{k} & {w}", f"{w} ~{n} mm", f"~{n}", f"{n}~{m}", f"* {w}", f"- {w}", f"{n}. {w}", f"{{{w}}}", f"{{{n}, {m}}}", f"{w}'s", f"{n}'' {w} {m}''", f"{k}*", f"*) {w}",
        f"M{n}x{m}*{n}", f"/{k}/{k}_{n}/{m}_x", f"{k}@{k}.example", f"=> {w}", f"{n} = {m}", f"== {n}", f"<- {w} ->", f"<{n}>", f"< {w} >", f"&{k}", f"{k}&{k};", f"^{n}", f"--- {n} ---", f"· {n} ·",
    ])


def _furniture(r: random.Random, script: int) -> str:
    """Lines of their own that are no markup."""
    n, w = r.randint(1, 400), _phrase(r, script)
    return r.choice([f"| {n}", f"{n} |", f"- {n} -", f"· {n} ·", f"[{n}]", f"| {w}", f"{w} | {n}", f"- {w}", f"{n}. {w}", f"* {w}", f"= {n}", f"-- {w}", f"#{n}", f"{n}# {w}", f"> {n}" if r.random() < 0.2 else f"< {n}"])


def sample(texts: int = SAMPLE_TEXTS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of synthetic texts."""
    r = random.Random(seed)
    rows: list[list[float]] = []
    label: list[int] = []
    for _ in range(texts):
        script = r.choice([0, 0, 1, 2, 2, 2])
        parts: list[tuple[str, bool]] = []
        rate, decoys = r.choice([(0, 1), (0.3, 0.1), (0.15, 0.25), (0.5, 0.0), (0.05, 0.5)])
        if r.random() < 0.55:  # one sign in a plain text
            sign = r.choice([_block, _block, _inline, _inline, _plain, _furniture])
            lone = sign in (_block, _furniture)
            if r.random() < 0.8:
                parts.append((_phrase(r, script) + ("\n" * r.randint(1, 2) if lone else r.choice([" ", ""])), False))
            parts.append((sign(r, script), sign in (_block, _inline)))
            if r.random() < 0.8:
                parts.append((("\n" * r.randint(1, 2) if lone else r.choice([" ", "", ", ", ". ", ": ", "。"])) + _phrase(r, script), False))
            rows_of = 0
        else:
            rows_of = r.randint(1, 5) if r.random() < 0.85 else r.randint(8, 30)  # long texts have many signs
        for _ in range(rows_of):
            if parts:
                parts.append((r.choice(["\n", "\n\n"]), False))
            draw = r.random()
            if draw < rate:
                parts.append((_block(r, script), True))
                continue
            if draw < rate + decoys / 3:
                parts.append((_furniture(r, script), False))
                continue
            for _ in range(r.randint(1, 4)):
                joint = "" if r.random() < (0.7 if script == 0 else 0.15) else " "
                parts.append((_phrase(r, script) + joint, False))
                draw = r.random()
                if draw < rate:
                    parts.append((_inline(r, script), True))
                    parts.append((joint if r.random() < 0.7 else r.choice([",", "。", ".", ":", "、", ")"]) + joint, False))
                elif draw < rate + decoys:
                    parts.append((_plain(r, script), False))
                    parts.append((joint if r.random() < 0.8 else r.choice([",", "。", "."]) + joint, False))
        text = "".join(p for p, _ in parts)
        good = np.repeat([m for _, m in parts], [len(p) for p, _ in parts])
        order: list[Node] = []
        features(text, nodes := tree(text), rows, order)
        mute: set[int] = set()
        for n in walk(nodes):
            if _closed(n) and good[n.s]:
                mute |= {id(x) for x in walk(n.children) if n.kind != "tag" or not _soft(x)}
        for n in order:
            own = slice(n.s, n.e if n.kind in ("tag", "env") else n.stop)
            label.append(int(good[own].mean() > 0.5 and id(n) not in mute))
    return np.array(rows, float), np.array(label, float)


@lru_cache(1)
def model() -> Boosted:
    x, y = sample()
    return Boosted(ROUNDS, DEPTH).fit(x, y)


# --- reading ------------------------------------------------------------------------------


def read(texts: list[str | None], trees: Boosted) -> list[list[Node]]:
    """The decoded trees of a batch of texts; the odds of all its nodes are computed at once."""
    rows: list[list[float]] = []
    order: list[Node] = []
    out: list[list[Node]] = []
    for text in texts:
        nodes = tree(text) if text and _GATE.search(text) else []
        if nodes:
            features(text, nodes, rows, order)
        out.append(nodes)
    if order:
        for n, odds in zip(order, trees.score(np.array(rows)).tolist()):
            n.odds = odds
    for nodes in out:
        decode(nodes)
    return out


def _edits(text: str, nodes: list[Node], out: list[tuple[int, int, str]]) -> None:
    """Append what the chosen nodes replace, in any order."""
    todo = [(n, "") for n in nodes]
    while todo:
        n, inside = todo.pop()
        if not n.chosen:
            todo += [(c, inside) for c in n.children]
            continue
        k, m, low = n.kind, n.m, n.name.lower()
        deeper = True
        if k == "tag":
            a, b = "", ""
            if low in DROP_TAGS or low == "ref":
                out.append((n.s, n.stop, ""))
                continue
            if low in HEAD_TAGS:
                a, b = "\n" + _HEAD, "\n"
            elif low == "li":
                a, b = "\n" + _ITEM, "\n"
            elif low in ("pre",) or low == "code" and inside != "pre" and n.paired and "\n" in text[n.e : n.close[0]]:
                a, b = "\n" + _CODE, _UNCODE + "\n"
            elif low in ("td", "th"):
                a = _CELL
            elif low in BLOCK_TAGS or low in GRID_TAGS:
                a = b = "\n"
            out.append((n.s, n.e, a if not n.end_tag else b))
            if n.close:
                out.append((n.close[0], n.close[1], b))
            todo += [(c, low if low in CODE_TAGS else inside) for c in n.children]
            continue
        if k == "env":
            code, math = n.name in CODE_ENVS, n.name.rstrip("*") in ("equation", "align", "math", "displaymath")
            out.append((n.s, n.e, "\n" + ((_MATH if math else _CODE) if code and not n.end_tag else "")))
            if n.close:
                out.append((*n.close, (_UNMATH if math else _UNCODE) + "\n" if code else "\n"))
        elif k == "comment":
            out.append((n.s, n.e, ""))
        elif k == "fence":
            out += [(n.s, n.inner[0], _CODE), (n.inner[1], n.e, _UNCODE)]
            deeper = False
        elif k == "code":
            out += [(n.s, n.inner[0], ""), (n.inner[1], n.e, "")]
            deeper = False
        elif k in ("math", "mathblock"):
            wide = 2 if text[n.s] == "\\" or k == "mathblock" else 1
            out += [(n.s, n.s + wide, _MATH), (n.e - wide, n.e, _UNMATH)]
            deeper = False
        elif k == "entity":
            out.append((n.s, n.e, html.unescape(text[n.s : n.e])))
        elif k == "autolink":
            out += [(n.s, n.s + 1, ""), (n.e - 1, n.e, "")]
        elif k == "mdhead":
            out.append((n.s, n.s + re.match(r"[ \t]*#+[ \t]+", text[n.s : n.e]).end(), _HEAD))
            tail = re.search(r"[ \t]+#+[ \t]*$", text[n.s : n.e])
            if tail:
                out.append((n.s + tail.start(), n.e, ""))
        elif k == "wikihead":
            x = re.match(r"(=+)[ \t]*(.*?)[ \t]*=+[ \t]*$", text[n.s : n.e])
            out += [(n.s, n.s + x.start(2), _HEAD), (n.s + x.end(2), n.e, "")]
        elif k in ("quote", "rule", "footnote", "stray"):
            out.append((n.s, n.e, ""))
        elif k == "escape":
            out.append((n.s, n.s + 1, ""))
        elif k == "wikitable":
            caption = text[n.s : n.s + 2] == "|+"
            out.append((n.s, n.s + 2, "") if caption else (n.s, n.e, _ROW))
        elif k in ("wikirow", "pipecell", "piperow"):
            if re.fullmatch(r"[ \t]*\|?[ \t:|-]+\|?[ \t]*", text[n.s : n.e]):
                out.append((n.s, n.e, _ROW))
                deeper = False
            else:
                for x in re.finditer(r"[ \t]*(?:\|\||!!|\||^!)[ \t]*", text[n.s : n.e]):
                    if not any(c.s < n.s + x.end() and n.s + x.start() < c.stop for c in n.children if c.chosen):
                        out.append((n.s + x.start(), n.s + x.end(), "" if n.s + x.end() >= n.e else _CELL))
        elif k == "texrow":
            for x in re.finditer(r"[ \t]*&[ \t]*|\\\\[ \t]*$", text[n.s : n.e]):
                out.append((n.s + x.start(), n.s + x.end(), _CELL if "&" in x.group() else ""))
        elif k == "tex":
            start, parts = m.start("args"), list(re.finditer(r"\{((?:[^{}]|\{[^{}]*\})*)\}|\[[^\]]*\]", m.group("args") or ""))
            args = [x for x in parts if x.group().startswith("{")]
            if low in GONE_COMMANDS or text[n.s] == "~":
                out.append((n.s, n.e, ""))
                continue
            if low == "item":
                out.append((n.s, n.e, _ITEM))
                continue
            if low == "footnote" and args:
                out.append((n.s, n.e, f" ({args[-1].group(1)})"))
                continue
            if low == "si" or low == "qty":
                out.append((n.s, n.e, " ".join(x.group(1).replace("\\", " ").strip() for x in args)))
                continue
            if not args:
                out.append((n.s, n.e, ""))
                continue
            keep = args[-1]
            a, b = start + keep.start(1), start + keep.end(1)
            out += [(n.s, a, "\n" + _HEAD if low in HEAD_COMMANDS else ""), (b, n.e, "\n" if low in HEAD_COMMANDS else "")]
            todo += [(c, inside) for c in n.children if c.s >= a and c.stop <= b]
            continue
        elif k == "image":
            out.append((n.s, n.e, m.group("alt")))
            deeper = False
        elif k == "link":
            a, b = n.inner
            out += [(n.s, a, ""), (b, n.e, "")]
        elif k == "wikilink":
            a, b = n.inner
            at = text.rfind("|", a, b)
            out += [(n.s, at + 1 if at >= 0 else a, ""), (b, n.e, "")]
            todo += [(c, inside) for c in n.children if c.s > at]
            continue
        elif k == "template":
            a, b = n.inner
            at = text.rfind("|", a, b)
            last = text[at + 1 : b]
            if at < 0 or "=" in last:
                out.append((n.s, n.e, ""))
                continue
            out += [(n.s, at + 1, ""), (b, n.e, "")]
            todo += [(c, inside) for c in n.children if c.s > at]
            continue
        elif k == "strong":
            a, b = n.inner
            out += [(n.s, a, ""), (b, n.e, "")]
        if deeper:
            todo += [(c, inside) for c in n.children]


_SPLIT = re.compile(f"({_HEAD}|{_ITEM}|{_CODE}[^{_UNCODE}]*{_UNCODE}?|{_MATH}[^{_UNMATH}]*{_UNMATH}?|{_CELL}|{_ROW}|\n[ \t]*\n|\n)")


def blocks(marked: str) -> list[dict[str, str]]:
    """Blocks of a rewritten text: heading, item, code, formula, cell and text, in order."""
    out: list[dict[str, str]] = []
    kind, grow = "text", False
    for part in _SPLIT.split(marked):
        if not part:
            continue
        c = part[0]
        if c == _CODE:
            out.append({"kind": "code", "text": part.strip(_CODE + _UNCODE).strip("\n")})
            grow, kind = False, "text"
        elif c == _MATH:
            out.append({"kind": "formula", "text": part.strip(_MATH + _UNMATH).strip()})
            grow = False
        elif c == _HEAD:
            kind, grow = "heading", False
        elif c == _ITEM:
            kind, grow = "item", False
        elif c in (_CELL, _ROW):
            kind, grow = "cell", False
        elif c == "\n":
            grow = False
            kind = "text"
        else:
            t = part.strip()
            if not t:
                continue
            if kind == "text" and (x := re.match(r"(?:[-*•]|\d{1,3}[.)])\s+", t)):
                out.append({"kind": "item", "text": t[x.end() :]})
            elif grow:
                out[-1]["text"] += " " + t
            else:
                out.append({"kind": kind, "text": t})
                grow = kind == "text"
    for b in out:
        b["text"] = b["text"].translate(_OWN)
    return [b for b in out if b["text"]]


def clean(text: str, nodes: list[Node], table: bool = False) -> tuple[str, list[dict[str, str]]]:
    edits: list[tuple[int, int, str]] = []
    _edits(text, nodes, edits)
    out, at = [], 0
    for s, e, new in sorted(edits):
        if s < at:
            continue
        out += [text[at:s], new]
        at = e
    out.append(text[at:])
    marked = "".join(out)
    made = blocks(marked)
    plain = marked.replace(_ITEM, "- ").replace(_CELL, "\t").translate(_OWN)
    if edits or table:
        plain = re.sub(r"[ \t]+\n", "\n", plain)
        plain = re.sub(r"\n\n+(?=- |\t)", "\n", re.sub(r"\n{3,}", "\n\n", plain)).strip("\n")
    return plain, made


def grid(body: str) -> str:
    """A table body with its grid tags as signs, so that only other markup is left to judge."""

    def sign(m: re.Match) -> str:
        tag = m.group().lower()
        return "\n" + _CELL if tag.startswith(("<td", "<th")) and not tag.startswith("<thead") else "\n" + _ROW if tag.startswith("<tr") else ""

    return _GRID.sub(sign, body)


_BLOCK = pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string())]))
_ARROW = pa.schema([("src", pa.string()), ("row_key", pa.string()), ("text", pa.string()), ("blocks", _BLOCK), ("marked", pa.bool_())])


def _clean_all(trees: Boosted, full: bool):
    def run(rows: dict[str, list]) -> dict[str, list]:
        texts = []
        for src, t in zip(rows["src"], rows["text"]):
            texts.append(grid(t) if t and src == "content_list" else t)
        read_in = read(texts, trees)
        marked = [any(n.chosen for n in walk(nodes)) for nodes in read_in]
        if not full:
            return {"src": rows["src"], "row_key": rows["row_key"], "marked": marked}
        done = [(None, []) if t is None else clean(t, nodes, src == "content_list") for src, t, nodes in zip(rows["src"], texts, read_in)]
        return {"src": rows["src"], "row_key": rows["row_key"], "text": [d[0] for d in done], "blocks": [d[1] for d in done], "marked": marked}

    return run


def cleaned(texts: DataFrame) -> DataFrame:
    """(src, row_key, text, blocks, marked) of texts in the form of textio.keyed; a narrow operation."""
    return map_slices(texts, _clean_all(model(), True), "src string, row_key string, text string, blocks array<struct<kind:string,text:string>>, marked boolean", _ARROW)


def inputs(chunks: DataFrame, content_list: DataFrame) -> DataFrame:
    tables = content_list.where(F.col("table_body").isNotNull())
    return keyed(chunks, "chunks", "id", F.col("content")).unionAll(keyed(tables, "content_list", "item_id", F.col("table_body")))


def p2_text(chunks: DataFrame, content_list: DataFrame) -> DataFrame:
    """Clean text and blocks of every chunk and every table, one row for each key."""
    return once(cleaned(inputs(chunks, content_list)), "src", "row_key").drop("marked")


def p2_found(chunks: DataFrame, content_list: DataFrame) -> DataFrame:
    """Keys of the rows in which the decoded trees have markup; only these keys are shuffled."""
    arrow = pa.schema([("src", pa.string()), ("row_key", pa.string()), ("marked", pa.bool_())])
    judged = map_slices(inputs(chunks, content_list), _clean_all(model(), False), "src string, row_key string, marked boolean", arrow)
    return judged.where("marked").select("src", "row_key").distinct()
