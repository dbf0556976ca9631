"""Problem 4: noise in text from scanned pages.

Words and pairs of ideographs are counted over all rows. A rare word is held against the
vocabulary by intersecting its Levenshtein automaton with a trie of the common words that share a
part with it, which finds every word within the distance; the candidates are ranked by how alike
the letters look, then by what usually stands beside them. Ideographs are corrected where both pairs they form
are rare and a similar ideograph makes common ones. Then running headers and page numbers are
taken out, broken words joined, ideographs set together, and the lines reflowed to paragraphs.

"Rare" and "common" are relative: a reading counts as a misreading of another only if that is
RATIO times as frequent, so the rules are the same at every size. The correction tables grow
with the number of different misreadings; they are broadcast below BROADCAST_ROWS and joined
to the words of the rows above it, with the same result.

Defined cases: null stays without paragraphs and is no case, as are '' and null elements;
nothing is corrected where a table is too small to have common words; a text without noise
keeps its paragraphs; texts of any length are read as a whole.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import settle
from . import hashing
from .lookalikes import unify, unify_all
from .textio import fold_slices, map_slices, once

#: How much more frequent a word or pair must be than its misreading.
RATIO = 20
#: Words of this length and more may differ by two edits from their candidates, shorter ones by one.
TWO_EDITS = 6
LEAST_LETTERS = 4
#: Costs of an edit between signs that look alike, and of any other; the highest cost of a correction.
ALIKE, OTHER, ACCEPT = 0.4, 1.0, 0.8
#: A row needs this many misread words or ideographs to be a case by them alone.
SEVERAL = 2
#: Rows of the correction tables and of the pairs beside tied readings, together, up to which they are broadcast (about 100 bytes each).
BROADCAST_ROWS = 300_000
#: Keys of rare words that one task holds against the vocabulary, on average, and the least number of such tasks.
TASK_WORDS = 50_000
LEAST_TASKS = 24

# Letters and digits that scanners confuse; of each group any for any other.
CONFUSED = "ceo0 o0DQO il1I!|tj ft hb g9q s5S z2Z b6 B8 nu uv vy l1I a4 rn| 0О0о сео пнил щшц зэ3 бб6 гт ьъы кх ао".split()
CONFUSED_PAIRS = {("rn", "m"), ("vv", "w"), ("cl", "d"), ("li", "h"), ("ri", "n"), ("nn", "m"), ("ii", "u"), ("ni", "m"), ("iii", "m"), ("fi", "ﬁ"), ("ck", "dk"), ("lc", "k")}
# Ideographs of similar shape that scanners confuse.
SIMILAR = (
    "土士上工 未末 由油田甲申曲 夜液 剂制刮 勤动 内肉丙 于干千 走定 右石左 左在 车东 承丞 后启 卞下 困因固囤 轴铀 开井并 前剪 线钱浅 关矢失 量童重 查杳 检栓桧 大犬太 日曰目 人入八 己已巳 木本术 天夫无 王玉主 自白百 刀力 侯候 "
    "拔拨 折拆析 面而 处外 间问 换挟 按接 池地 阀闽 录泵 管菅 弹禅 簧黄璜 螺蝶 钉订 母毋 垫热执 密蜜 扎孔 销梢 钢铜铟 灯打 杆扦 板扳 支文 叉又 架驾 臂臀 轮抡 胎抬 杀刹 盘盆 片斤 缸缶 塞寨 气汽 滤泸 清请 风凤 扇肩 "
    "散敝 冷泠 劫却 水永 箱葙 电由 拼瓶 束柬東 保堡 险验 继绊 传转 迷速述 表衷 向问 指措 不示 测侧 压庄 高亮 灰友 准淮 型刑 变娈 度庋 紧繁 安女 装袋 位泣 置直 固围 体休 系糸 统充 进迸 排徘 排非 导异 护炉 盖益 "
    "使便 用甩 手毛 松枱 机杌 门闩 火灭 光先 发友 令今 仅仪 从丛 旦且 弓引 专传 午牛 厂广 厉历 名各 吉古 合台 吸呼 员贡 坏环 均圴 埋理 处夊 存在 完宗 官宫 实买 宽觅 小少 尺尸 层屋 巾布 帽帼 平乎 年午 应座 "
    "弯湾 归旧 形彤 往住 心必 忘志 思恩 悬县 成戍 户尸 抓爪 报服 担但 持待 挡档 损揖 摇遥 擦察 收牧 改攻 放枚 教救 数教 料科 旋施 时吋 明朋 星皇 是足 更吏 有冇 材村 条务 来米 极级 枪抢 查香 标杯 样祥 根很 模膜 "
    "次决 正止 每母 比此 民氏 汁汗 法去 注往 洁浩 活话 流琉 消肖 深探 渗参 温湿 滑骨 漏雨 点占 烧浇 然燃 片爿 物扬 状壮 环坏 现观 瓦互 生主 申电 的旳 皮波 直真 相柏 看着 知和 研砑 破坡 磨摩 示禾 离禽 种神 秒抄 程埕 "
    "空穴 突实 端瑞 第弟 筒简 类粪 粗租 精情 红江 级极 终络 组阻 细绌 经轻 结洁 给络 绝绯 缓援 缝逢 网冈 罩置 老考 联职 胶跤 能熊 腔控 自目 至到 船般 色巴 节芍 花化 苗田 范泛 荷何 药约 行衍 衬衫 被披 补朴 装裴 西酉 见贝 "
    "规现 角甪 解鲜 触蚀 计讣 记纪 设没 证征 诊珍 试拭 该孩 详样 语悟 说税 读续 调凋 负贞 贴站 起赴 超招 距拒 跟限 路跳 踏蹈 身射 较校 载截 输愉 辅铺 边迈 达迖 过辽 运远 近折 还坏 连莲 适话 送迭 选洗 通桶 遇偶 道首 部剖 配酏 金全 针什 钩钓 铁佚 铃钤 链琏 锁销 错借 键健 长氏 闪问 防妨 阴阳 除徐 随隋 隔融 集隼 雷雪 需雷 非韭 页贝 顶项 顺须 颜额 高髙 黑墨 齿龄"
).split()

_WORD = re.compile(r"[^\W_一-鿿㐀-䶿]+")
_HANS = re.compile(r"[一-鿿㐀-䶿]+")
_HAN = re.compile(r"[一-鿿㐀-䶿]").match
_NONE: dict[int, str] = {}
_SPACED = re.compile(r"(?:[一-鿿㐀-䶿][  　]){3,}[一-鿿㐀-䶿]")
_TWO_APART = re.compile(r" [一-鿿㐀-䶿] [一-鿿㐀-䶿]")  # begins with a sign that can be looked up fast
_APART = re.compile(r"(?<=[一-鿿㐀-䶿，。、；：！？（）《》“”])[  　]+(?=[一-鿿㐀-䶿，。、；：！？（）《》“”0-9A-Za-z])|(?<=[0-9A-Za-z%°Ω])[  　]+(?=[一-鿿㐀-䶿，。、；：！？])")
_BROKEN = re.compile(r"([^\W\d_]{1,})[-‐­¬][ \t]*\r?\n[ \t]*([^\W\d_]+)")
#: Words that follow a hyphen of their own after a line end, as in "Vorder-\nund Hinterrad". Fixed values.
JOINERS = {"und", "oder", "bzw", "sowie", "bis", "and", "or", "to", "и", "или", "as"}

_PAGE = re.compile(r"[-–—·•*|\[(（/~_. ]*\d{1,4}[-–—·•*|\])）/~_. ]*|[-–—·•| ]*(?:page|seite|стр(?:аница|\.)?|pag\.?|p\.|S\.|с\.)\s*\d{1,4}(?:\s*(?:of|von|из|/)\s*\d{1,4})?[-–—·•| ]*|[-–—·•| ]*第\s*\d{1,4}\s*页(?:\s*[,，/]?\s*共\s*\d{1,4}\s*页)?[-–—·•| ]*|\d{1,4} / \d{1,4}", re.I)
_DIGIT = re.compile(r"\d")
_HYPHEN_END = re.compile(r"[-‐­¬][ \t]*\r?\n")
_MODEL = re.compile(r"[A-ZА-Я][A-Za-zА-Яа-я]+-\d+[A-Z]*(?:-\w+)*")
_AROUND = re.compile(r"[\s|·•–—/\[\]()（）:-]*(?:(?:chapter|kapitel|глава|section|abschnitt|раздел|part|teil|часть|rev(?:ision)?\.?|ausgabe|stand|edition|issue|ver(?:sion)?\.?|manual|handbuch|page|seite|стр\.?|第\s*[一二三四五六七八九十百\d]+\s*[章节部]|第\s*\d+\s*页)\s*[A-Z]?\d{0,4}[.\d]*[\s|·•–—/:-]*)*[\d\s|·•–—/\[\]()-]{0,12}", re.I)
#: Around the model name: page numbers at the outer edges of a line, and the words of a title.
_FIRST_PAGES = re.compile(r"^(?:[\s|·•–—/\[\]()-]*\d{1,4}(?=[\s|·•–—/)\]-]))+")
_LAST_PAGES = re.compile(r"(?:(?<=[\s|·•–—/(\[-])\d{1,4}[\s|·•–—/\[\]()-]*)+$")
_BETWEEN = re.compile(r"[\s|·•–—/\[\]()（）-]+")
_TITLE_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*['’]?")
TITLE_WORDS = 6
# Words and ideographs of the closed classes that make a clause, and so no title.
_CLAUSE = re.compile(
    r"\b(?:the|an?|is|are|was|were|be|been|has|have|had|must|may|can|could|should|shall|will|would|does|do|not|it|this|that|these|those|when|if|where|after|before|until|which|so|than"
    r"|der|die|das|den|dem|des|eine?[nmrs]?|ist|sind|wird|werden|wurden?|muss|müssen|kann|können|darf|dürfen|soll|sollen|hat|haben|nicht|wenn|nachdem|bevor|damit|dass|sich|bis"
    r"|не|если|когда|что|чтобы|это|был[аои]?|есть|нужн[аоы]?|должн[аоы]|должен|надо|можно|нельзя)\b|[的了将把被应须请在是时并则若当至]",
    re.I,
)
_LISTED = re.compile(r"\s*(?:[-*•·]\s|\d{1,3}[.)]\s|#|\||>|<)")
_STOP = re.compile(r"[.!?。！？:：;；…][\"'”’»)\]）]*$")


def furniture(line: str, model: str | None = None, inside: bool = True) -> bool:
    """Whether a line is a running header or a page number.

    The name of the row's own model beside any title is a header: inside a text as it is, at its
    edge or alone (where it may be the title of the text) only with a page number.
    """
    s = line.strip()
    if not s or len(s) > 70 or not _DIGIT.search(s):
        return False  # each of them has a number of a page or of the model
    if _PAGE.fullmatch(s) and not re.fullmatch(r"\d{1,3}[.)]|\d+\.\d+|[-–—·•*|/~_. ]+", s):
        return True
    if model and (at := s.find(model)) >= 0:
        name = model
    elif "-" in s and (m := _MODEL.search(s)):
        name, at = m.group(), m.start()
    else:
        return False
    before, after = s[:at], s[at + len(name) :]
    if s == name == model or s != name and _AROUND.fullmatch(before + " " + after) is not None:
        return True
    return name == model and _titled(before, after, inside)


def _titled(before: str, after: str, inside: bool) -> bool:
    """Whether what stands around the model name is a title, on one side or on both, with or without page numbers."""
    if before[-1:].isalnum() or before[-1:] == "-" or after[:1].isalnum() or after[:1] == "-" or _LISTED.match(before) or _CLAUSE.search(f"{before} {after}"):
        return False
    words: list[str] = []
    numbered = False
    for side, pages in ((before, _FIRST_PAGES), (after, _LAST_PAGES)):
        if _AROUND.fullmatch(side):
            numbered = numbered or _DIGIT.search(side) is not None
        else:
            bare = pages.sub("", side, count=1)
            numbered = numbered or bare != side
            words += [w for w in _BETWEEN.split(bare) if w]
    return 0 < len(words) <= TITLE_WORDS and all(map(_TITLE_WORD.fullmatch, words)) and (inside or numbered)


# --- counting -------------------------------------------------------------------------------


class Tally:
    """Rows in which each word and each pair of ideographs stands; words by their hashes, with one reading each."""

    def __init__(self) -> None:
        self.words: Counter = Counter()
        self.names: dict[int, str] = {}
        self.pairs: Counter = Counter()

    def __len__(self) -> int:
        return len(self.words) + len(self.pairs)


def pair_codes(u: hashing.Units, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of neighbouring ideographs as numbers, and the text of each."""
    if len(u.start) < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = np.flatnonzero(u.sign[1:] & u.sign[:-1] & (np.diff(u.start) == 1) & (u.doc[1:] == u.doc[:-1]))
    a, b = u.start[k], u.start[k + 1]
    return code[a].astype(np.uint64) << np.uint64(21) | code[b].astype(np.uint64), u.doc[k]


def _count(state: Tally, rows: dict[str, list]) -> None:
    texts: list[str] = []
    owner: list[int] = []
    for k, parts in enumerate(rows["parts"]):
        for part in parts or ():
            if part:
                texts.append(part)
                owner.append(k)
    texts = [_APART.sub("", t) if _spaced(t) else t for t in unify_all(texts)]
    for a, b in _portions(owner, texts):
        _count_rows(state, texts[a:b], np.array(owner[a:b]))


def _portions(owner: list[int], texts: list[str]) -> Iterator[tuple[int, int]]:
    """Portions of the texts that keep the texts of a row together."""
    at = 0
    for _, b in hashing.portions(texts):
        while b < len(owner) and owner[b] == owner[b - 1]:
            b += 1
        if b > at:
            yield at, b
            at = b


def _count_rows(state: Tally, texts: list[str], row: np.ndarray) -> None:
    u = hashing.units(texts)
    word = np.flatnonzero(~u.sign & (u.size >= LEAST_LETTERS))
    if len(word):
        word = word[hashing.once_each(u.hash[word], row[u.doc[word]])]
        key, at, n = np.unique(u.hash[word], return_index=True, return_counts=True)
        whole = "".join(texts)
        for h, i, m in zip(key.tolist(), word[at].tolist(), n.tolist()):
            if h not in state.names:
                state.names[h] = whole[u.start[i] : u.start[i] + u.size[i]]
            state.words[h] += m
    pair, doc = pair_codes(u, hashing.codes(texts))
    if len(pair):
        pair = pair[hashing.once_each(pair, row[doc])]
        key, n = np.unique(pair, return_counts=True)
        for h, m in zip(key.tolist(), n.tolist()):
            state.pairs[h] += m


def _tallied(state: Tally) -> Iterator[pa.RecordBatch]:
    """Keys are words after 'w' and pairs after 'z'."""
    got = [("w" + state.names[h], n) for h, n in state.words.items()]
    got += [(f"z{chr(h >> 21)}{chr(h & 0x1FFFFF)}", n) for h, n in state.pairs.items()]
    if got:
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.string()), pa.array([n for _, n in got], pa.int64())], names=["key", "n"])


def _counted(state: Counter) -> Iterator[pa.RecordBatch]:
    if state:
        yield pa.RecordBatch.from_arrays([pa.array(list(state), pa.string()), pa.array(list(state.values()), pa.int64())], names=["key", "n"])


def counts(texts: DataFrame) -> DataFrame:
    """(key, n): in how many rows each word and pair stands, pre-aggregated in each partition."""
    part = fold_slices(texts.select("parts"), Tally, _count, _tallied, "key string, n long", every=400_000)
    return part.groupBy("key").agg(F.sum("n").alias("n"))


# --- candidates -----------------------------------------------------------------------------


def build_trie(words) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = w
    return root


def within(trie: dict, word: str, edits: int) -> list[str]:
    """All words of the trie within so many edits: the trie is walked along with the word's Levenshtein automaton.

    A state of the automaton is one bit set for each number of edits: bit i says that i signs
    of the word are read.
    """
    n = len(word)
    masks: dict[str, int] = {}
    for i, c in enumerate(word):
        masks[c] = masks.get(c, 0) | 1 << i
    full, final = (1 << (n + 1)) - 1, 1 << n
    out: list[str] = []
    stack = [(trie, tuple((1 << (e + 1)) - 1 for e in range(edits + 1)))]
    while stack:
        node, state = stack.pop()
        for c, child in node.items():
            if c == "":
                if any(s & final for s in state):
                    out.append(child)
                continue
            m = masks.get(c, 0)
            before = state[0]
            now = (before & m) << 1
            new = [now]
            for s in state[1:]:
                now = ((s & m) << 1 | before | before << 1 | now << 1) & full
                new.append(now)
                before = s
            if new[-1] or any(new):
                stack.append((child, tuple(new)))
    return out


def _alike() -> set[tuple[str, str]]:
    got = {(a, b) for g in CONFUSED for a in g for b in g if a != b}
    for g in ("сeе", "пн", "ни", "пл", "щш", "0о", "3з", "6б", "ce", "ft", "li", "hb"):
        got |= {(a, b) for a in g for b in g if a != b}
    got |= CONFUSED_PAIRS | {(b, a) for a, b in CONFUSED_PAIRS}
    return {(a, b) for a, b in got if a.lower() != b.lower()}  # a capital is no misreading


_ALIKE = _alike()


def unlikeness(read: str, meant: str) -> float:
    """Least cost of reading one word as the other, where edits between signs that look alike are cheap."""
    n, m = len(read), len(meant)
    cost = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if not i and not j:
                continue
            best = 99.0
            if i:
                best = cost[i - 1][j] + OTHER
            if j:
                best = min(best, cost[i][j - 1] + OTHER)
            if i and j:
                a, b = read[i - 1], meant[j - 1]
                best = min(best, cost[i - 1][j - 1] + (0 if a == b else ALIKE if (a, b) in _ALIKE else OTHER))
                if i > 1 and (read[i - 2 : i], b) in _ALIKE:
                    best = min(best, cost[i - 2][j - 1] + ALIKE)
                if j > 1 and (a, meant[j - 2 : j]) in _ALIKE:
                    best = min(best, cost[i - 1][j - 2] + ALIKE)
            cost[i][j] = best
    return cost[n][m]


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, size) of the edits + 1 parts of a word of this length; so many edits leave one of them whole."""
    small, more = divmod(length, edits + 1)
    out, at = [], 0
    for k in range(edits + 1):
        size = small + (k > edits - more)
        out.append((at, size))
        at += size
    return out


def index_keys(word: str) -> list[str]:
    """Under what a word of the vocabulary is found: each of its parts, with its number and the word's length."""
    n = len(word)
    return [f"{e}{k} {n} {word[at : at + size]}" for e in (1, 2) if (n < TWO_EDITS + 1 if e == 1 else n >= TWO_EDITS - 2) for k, (at, size) in enumerate(segments(n, e))]


def probe_keys(word: str) -> list[str]:
    """Under what the words within the edits of a rare word are looked up.

    The k-th part of a word that is whole in the rare word stands there at its own place, moved by
    as many edits as may be before it (k) and after it (edits - k).
    """
    m, e = len(word), 2 if len(word) >= TWO_EDITS else 1
    out = []
    for n in range(max(LEAST_LETTERS - 1, m - e), m + e + 1):
        gap = m - n
        for k, (at, size) in enumerate(segments(n, e)):
            first, last = max(0, at - k, at + gap - (e - k)), min(m - size, at + k, at + gap + (e - k))
            out += {f"{e}{k} {n} {word[x : x + size]}" for x in range(first, last + 1)}
    return out


_KEYED_SQL = "key string, word string, n long"
_KEYED = pa.schema([("key", pa.string()), ("word", pa.string()), ("n", pa.int64())])


def _keyed(keys_of):
    def run(rows: dict[str, list]) -> dict[str, list]:
        got = [(k, w, n) for w, n in zip(rows["word"], rows["n"]) for k in keys_of(w)]
        return {name: [g[i] for g in got] for i, name in enumerate(("key", "word", "n"))}

    return run


def _search(rare: pd.DataFrame, common: pd.DataFrame) -> pd.DataFrame:
    """The accepted readings of the rare words under each key, by the automaton of each on the trie of the key's vocabulary."""
    out: set[tuple] = set()
    if len(rare) and len(common):
        asked: dict[str, list[tuple[str, int]]] = defaultdict(list)
        for key, word, n in zip(rare["key"], rare["word"], rare["n"]):
            asked[key].append((word, n))
        known: dict[str, dict[str, int]] = defaultdict(dict)
        for key, word, n in zip(common["key"], common["word"], common["n"]):
            if key in asked:
                known[key][word] = n
        for key, freq in known.items():
            trie = build_trie(freq)
            for word, n in asked[key]:
                for v in within(trie, word, 2 if len(word) >= TWO_EDITS else 1):
                    if v.lower() != word.lower() and freq[v] >= RATIO * n and (word, v) not in out and (c := unlikeness(word, v)) <= ACCEPT:
                        out.add((word, v, float(c), int(freq[v])))
    return pd.DataFrame(sorted(out), columns=["word", "meant", "cost", "n"])


def word_fixes(stats: DataFrame) -> DataFrame:
    """(word, meant, cost, n): every accepted reading of the rare words.

    A rare word meets only the words of the vocabulary that share a part with it, as all within its
    edits do; both come under a few keys each. The keys share the tasks by their hash, and a key
    under which many rare words stand is dealt over several of them.
    """
    w = stats.where(F.col("key").startswith("w")).select(F.expr("substring(key, 2)").alias("word"), "n")
    common = w.where((F.col("n") >= RATIO) & F.col("word").rlike(r"^[^\d]+$"))
    top = common.agg(F.max("n")).first()[0]
    rare = w.where((F.col("n") * RATIO <= F.lit(top or 0)) & (F.length("word") >= LEAST_LETTERS) & (F.length(F.regexp_replace("word", r"\d", "")) >= F.length("word") - 2) & F.col("word").rlike(r"\p{Ll}"))
    asked = settle(map_slices(rare, _keyed(probe_keys), _KEYED_SQL, _KEYED))
    known = map_slices(common, _keyed(index_keys), _KEYED_SQL, _KEYED)
    hot = asked.groupBy(F.col("key").alias("h_key")).agg(F.count("*").alias("words")).where(F.col("words") > TASK_WORDS).select("h_key", F.ceil(F.col("words") / TASK_WORDS).alias("deals"))
    deals = F.coalesce("deals", F.lit(1))
    asked = asked.join(hot, F.col("key") == F.col("h_key"), "left").withColumn("deal", F.pmod(F.xxhash64("word"), deals))
    known = known.join(hot, F.col("key") == F.col("h_key"), "left").withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), deals - 1)))
    # So many partitions by name: small as they are in bytes, adaptive execution would put them into one task.
    tasks = LEAST_TASKS + asked.count() // TASK_WORDS
    sides = [x.select("key", "word", "n", F.pmod(F.xxhash64("key", "deal"), F.lit(tasks)).alias("task")).repartition(tasks, "task").groupBy("task") for x in (asked, known)]
    return sides[0].cogroup(sides[1]).applyInPandas(_search, "word string, meant string, cost double, n long").distinct()


_SIMILAR_OF: dict[str, list[int]] = defaultdict(list)
for _k, _g in enumerate(SIMILAR):
    for _c in _g:
        _SIMILAR_OF[_c].append(_k)

_PAIR_ARROW = pa.schema([("rest", pa.string()), ("place", pa.int32()), ("sign", pa.string()), ("n", pa.int64())])


def _masked(rows: dict[str, list]) -> dict[str, list]:
    """Each pair under what it becomes if one ideograph, or both, are put as their groups of similar ones."""
    out: dict[str, list] = {"rest": [], "place": [], "sign": [], "n": []}

    def put(rest: str, place: int, sign: str, n: int) -> None:
        for name, v in (("rest", rest), ("place", place), ("sign", sign), ("n", n)):
            out[name].append(v)

    for key, n in zip(rows["key"], rows["n"]):
        a, b = key[1], key[2]
        for g in _SIMILAR_OF.get(a, ()):
            put(f"{g} {b}", 0, a + b, n)
            for h in _SIMILAR_OF.get(b, ()):
                put(f"{g} {h}", 2, a + b, n)
        for h in _SIMILAR_OF.get(b, ()):
            put(f"{a} {h}", 1, a + b, n)
    return out


def sign_fixes(stats: DataFrame) -> DataFrame:
    """(pair, place, meant): in this pair of ideographs the one at this place has a similar one RATIO times as common.

    A group has one row for each combination of a few similar ideographs, so it can't grow.
    """
    z = map_slices(stats.where(F.col("key").startswith("z")), _masked, "rest string, place int, sign string, n long", _PAIR_ARROW)
    best = z.groupBy("rest", "place").agg(F.max(F.struct("n", "sign")).alias("best"), F.collect_list(F.struct("n", "sign")).alias("all"))
    each = best.select("place", "best", F.explode("all").alias("x")).where((F.col("x.n") * RATIO <= F.col("best.n")) & (F.col("best.n") >= RATIO))
    each = each.select(F.col("x.sign").alias("pair"), F.col("best.sign").alias("good"), F.col("best.n").alias("n"), F.explode(F.array(F.lit(0), F.lit(1))).alias("at"), "place")
    changed = F.substr("pair", F.col("at") + 1, F.lit(1)) != F.substr("good", F.col("at") + 1, F.lit(1))
    both = (F.substr("pair", F.lit(1), F.lit(1)) != F.substr("good", F.lit(1), F.lit(1))) & (F.substr("pair", F.lit(2), F.lit(1)) != F.substr("good", F.lit(2), F.lit(1)))
    each = each.where(changed & ((F.col("place") < 2) | both))
    return each.groupBy("pair", F.col("at").cast("int").alias("place")).agg(F.max_by(F.substr("good", F.col("at") + 1, F.lit(1)), F.struct(-F.col("place"), "n")).alias("meant"))


def context(texts: DataFrame, meant: set[str] | None) -> DataFrame:
    """(pair, n): in how many rows each pair of words stands that has a word of ``meant`` (None: each pair), over all rows."""
    shared = texts.sparkSession.sparkContext.broadcast(meant)

    def count(state: Counter, rows: dict[str, list]) -> None:
        wanted = shared.value
        few = list(wanted) if wanted is not None and len(wanted) <= 64 else None
        filled = [[p for p in parts or () if p] for parts in rows["parts"]]
        texts = iter(unify_all([p for parts in filled for p in parts]))  # spaces beside ideographs part no words of their own, so they can stay
        for parts in filled:
            seen: set[str] = set()
            for text in islice(texts, len(parts)):
                if few and not any(w in text for w in few):
                    continue
                words = _WORD.findall(text)
                if wanted is None:
                    seen.update(f"{a} {b}" for a, b in zip(words, words[1:]))
                elif not wanted.isdisjoint(words):
                    seen.update(f"{a} {b}" for a, b in zip(words, words[1:]) if a in wanted or b in wanted)
            state.update(seen)

    part = fold_slices(texts.select("parts"), Counter, count, _counted, "key string, n long", every=400_000)
    return part.groupBy(F.col("key").alias("pair")).agg(F.sum("n").alias("n"))


def context_joined(texts: DataFrame, words: DataFrame) -> DataFrame:
    """context() of the readings of equal cost, for more of them than can be broadcast."""
    tied = words.groupBy("word", F.round("cost", 3).alias("c")).count().where("count > 1").select("word").distinct()
    meant = settle(words.join(tied, "word", "left_semi").select(F.col("meant").alias("m")).distinct())
    pairs = settle(context(texts, None))
    sides = [pairs.join(meant, F.split("pair", " ")[k] == F.col("m"), "left_semi") for k in (0, 1)]
    return sides[0].unionByName(sides[1]).distinct()


# --- repair ---------------------------------------------------------------------------------


class Fixes:
    """The corrections that a text may need: words with their readings, pairs of ideographs, and context."""

    def __init__(self, words: dict[str, list[tuple[str, float, int]]], signs: dict[str, dict[int, str]], beside: dict[str, int]):
        self.words, self.signs, self.beside = words, signs, beside
        self.odd = re.compile("[" + "".join(sorted({p[k] for p, places in signs.items() for k in places})) + "]") if signs else None

    @cached_property
    def word_keys(self) -> np.ndarray:
        return np.sort(hashing.word_hash(list(self.words)))

    @cached_property
    def pair_keys(self) -> np.ndarray:
        return np.array(sorted(ord(p[0]) << 21 | ord(p[1]) for p in self.signs), np.uint64)

    def word(self, word: str, before: str, after: str) -> str:
        got = self.words[word]
        if len(got) == 1:
            return got[0][0]
        near = self.beside.get
        return max(got, key=lambda x: (-round(x[1], 3), near(f"{before} {x[0]}", 0) + near(f"{x[0]} {after}", 0), x[2], x[0]))[0]


def fix_words(text: str, fixes: Fixes) -> tuple[str, int]:
    words = fixes.words
    if not words or words.keys().isdisjoint(_WORD.findall(text)):
        return text, 0
    found = list(_WORD.finditer(text))
    hits = [k for k, m in enumerate(found) if m.group() in words]
    if not hits:
        return text, 0
    out, at = [], 0
    for k in hits:
        m = found[k]
        new = fixes.word(m.group(), found[k - 1].group() if k else "", found[k + 1].group() if k + 1 < len(found) else "")
        out += [text[at : m.start()], new]
        at = m.end()
    return "".join(out) + text[at:], len(hits)


def fix_signs(text: str, fixes: Fixes) -> tuple[str, int]:
    """Ideographs whose pairs all name the same better one."""
    if not fixes.signs:
        return text, 0
    signs = fixes.signs
    new: dict[int, str] = {}
    for m in fixes.odd.finditer(text):
        k = m.start()
        votes = []
        if k and _HAN(text[k - 1]):
            votes.append(signs.get(text[k - 1 : k + 1], _NONE).get(1))
        if k + 1 < len(text) and _HAN(text[k + 1]):
            votes.append(signs.get(text[k : k + 2], _NONE).get(0))
        if votes and votes[0] and votes[0] == votes[-1]:
            new[k] = votes[0]
    if not new:
        return text, 0
    return "".join(new.get(k, c) for k, c in enumerate(text)), len(new)


def _spaced(text: str) -> bool:
    """Whether ideographs of a unified text are set apart by spaces."""
    return not text.isascii() and _TWO_APART.search(text) is not None and _SPACED.search(text) is not None


def prepared(body: str, model: str | None = None) -> tuple[str, bool]:
    """Of a unified text: the text in which words and ideographs are corrected, without furniture and broken words, and whether it had any."""
    lines = body.split("\n")
    odd = [False]
    if len(lines) > 1 or len(body) <= 70:
        odd = [furniture(x, model) for x in lines]
        if odd[0] or odd[-1] or not lines[0].strip() or not lines[-1].strip():
            # Only at the edges of a text does it matter that a title may be its own.
            filled = [k for k, x in enumerate(lines) if x.strip()]
            for k in {*filled[:1], *filled[-1:]}:
                odd[k] = odd[k] and furniture(lines[k], model, False)
    noisy = any(odd)
    if noisy:
        kept: list[str] = []
        hole = False
        for x, f in zip(lines, odd):
            if f:
                while kept and not kept[-1].strip():
                    kept.pop()
                hole = True
                continue
            if hole and not x.strip():
                continue
            if hole and kept:
                # The furniture stood within a paragraph, or between two.
                if _STOP.search(kept[-1].rstrip()) or _LISTED.match(x):
                    kept.append("")
                kept.append(x)
            else:
                kept.append(x)
            hole = False
        lines = kept
        body = "\n".join(lines)
    broken = 0

    def join(m: re.Match) -> str:
        nonlocal broken
        if m.group(2).lower() in JOINERS or m.group(2)[0].isupper():
            return m.group()
        broken += 1
        return m.group(1) + m.group(2)

    if "\n" in body and _HYPHEN_END.search(body):
        body = _BROKEN.sub(join, body)
    apart = _spaced(body)
    if apart:
        body = _APART.sub("", body)
    return body, noisy or broken > 0 or apart


def mend(text: str, fixes: Fixes, model: str | None = None, full: bool = True) -> tuple[list[str], bool]:
    """The paragraphs of a text and whether it had noise; without ``full`` the paragraphs aren't made."""
    body, noisy = prepared(unify(text), model)
    body, hits = corrected(body, fixes)
    noisy = noisy or hits >= SEVERAL
    return reflow(body, noisy) if full else [], noisy


def corrected(body: str, fixes: Fixes) -> tuple[str, int]:
    """A text with its ideographs and words corrected, and how many were."""
    hits = 0
    if not body.isascii():
        body, hits = fix_signs(body, fixes)
    body, n = fix_words(body, fixes)
    return body, hits + n


def reflow(body: str, wrapped: bool) -> list[str]:
    """Paragraphs of a text; in text from a scan, lines within a paragraph are joined to one."""
    out: list[str] = []
    for block in re.split(r"\n[ \t\r]*\n", body):
        lines = [x.strip() for x in block.split("\n") if x.strip()]
        if not lines:
            continue
        if not wrapped:
            out.append("\n".join(lines))
            continue
        whole = lines[0]
        for x in lines[1:]:
            short = re.search(r"[:：]", x) and len(x) < 60 or re.search(r"[:：]", whole.split("\n")[-1]) and len(whole.split("\n")[-1]) < 60
            if _LISTED.match(x) or short or _STOP.search(whole) and len(x) < 20:
                whole += "\n" + x
            else:
                tight = re.search(r"[一-鿿，。、；：！？]$", whole) and re.match(r"[一-鿿，。、；：！？]", x)
                whole += ("" if tight else " ") + x
        out.append(whole)
    return out


def _found(texts: list[str], fixes: Fixes) -> np.ndarray:
    """Which texts have a word or pair of ideographs that the corrections name."""
    hit = np.zeros(len(texts), bool)
    for a, b in hashing.portions(texts):
        u = hashing.units(texts[a:b])
        hit[a + np.unique(u.doc[~u.sign][np.isin(u.hash[~u.sign], fixes.word_keys)])] = True
        pair, doc = pair_codes(u, hashing.codes(texts[a:b]))
        hit[a + np.unique(doc[np.isin(pair, fixes.pair_keys)])] = True
    return hit


def _mender(shared, full: bool):
    """Repair a batch with corrections that all its rows share: only texts in which they can apply are read word by word."""

    def run(rows: dict[str, list]) -> dict[str, list]:
        fixes: Fixes = shared.value
        noise = [False] * len(rows["parts"])
        hits = [0] * len(noise)
        paragraphs: list[list[str]] = [[] for _ in noise]
        at: list[int] = []
        raw: list[str] = []
        bodies: list[str] = []
        dirty: list[bool] = []
        for k, parts in enumerate(rows["parts"]):
            for p in parts or ():
                if p:
                    at.append(k)
                    raw.append(p)
        for k, p in zip(at, unify_all(raw)):
            body, noisy = prepared(p, rows["model"][k])
            noise[k] = noise[k] or noisy
            bodies.append(body)
            dirty.append(noisy)
        known = _found(bodies, fixes).tolist()
        # Elements are also counted together, as they stand.
        single = [len(rows["parts"][k]) == 1 for k in at]
        also = _found(["" if one else p for one, p in zip(single, raw)], fixes).tolist()
        for k, p, body, noisy, apply, count in zip(at, raw, bodies, dirty, known, also):
            if not full and noise[k]:
                continue
            if apply:
                body, n = corrected(body, fixes)
                noisy = noisy or n >= SEVERAL
            if count and not noisy:
                hits[k] += corrected(p, fixes)[1]
            if full:
                paragraphs[k] += reflow(body, noisy)
            noise[k] = noise[k] or noisy or hits[k] >= SEVERAL
        out = {"src": rows["src"], "row_key": rows["row_key"], "noisy": noise}
        return out | {"paragraphs": paragraphs} if full else out

    return run


def _mender_alone(fixes_of, full: bool):
    """Repair rows that each bring their own corrections."""

    def run(rows: dict[str, list]) -> dict[str, list]:
        paragraphs, noise = [], []
        for k, parts in enumerate(rows["parts"]):
            got: list[str] = []
            bad = False
            fixes, hits = fixes_of(rows, k), 0
            for p in parts or ():
                if p:
                    new, b = mend(p, fixes, rows["model"][k], full)
                    got += new
                    bad = bad or b
                    if not b and len(parts) > 1:
                        hits += corrected(p, fixes)[1]
            paragraphs.append(got)
            noise.append(bad or hits >= SEVERAL)
        out = {"src": rows["src"], "row_key": rows["row_key"], "noisy": noise}
        return out | {"paragraphs": paragraphs} if full else out

    return run


_KEYS = [("src", pa.string()), ("row_key", pa.string()), ("noisy", pa.bool_())]


def _joined(texts: DataFrame, words: DataFrame, signs: DataFrame, beside: DataFrame, run, schema: str, arrow: pa.Schema) -> DataFrame:
    """The way for correction tables that are too large to broadcast: the words of each row, and what may stand beside their readings, meet them by joins."""
    tokens = pa.schema([("src", pa.string()), ("row_key", pa.string()), ("token", pa.string()), ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))])

    def spread(rows: dict[str, list]) -> dict[str, list]:
        """What mend() and the count over whole elements look up."""
        out: dict[str, list] = {f.name: [] for f in tokens}
        for src, key, model, parts in zip(rows["src"], rows["row_key"], rows["model"], rows["parts"]):
            seen: dict[str, tuple[set, set]] = defaultdict(lambda: (set(), set()))
            for p in parts or ():
                if p:
                    body = prepared(unify(p), model)[0]
                    found = _WORD.findall(body)
                    for k, w in enumerate(found):
                        if len(w) >= LEAST_LETTERS:
                            seen[w][0].update(found[k - 1 : k] if k else ())
                            seen[w][1].update(found[k + 1 : k + 2])
                    whole = [body]
                    if len(parts) > 1:
                        whole.append(p)
                        for w in _WORD.findall(p):
                            if len(w) >= LEAST_LETTERS:
                                seen[w]
                    for t in whole:
                        for r in _HANS.findall(t):
                            for k in range(len(r) - 1):
                                seen[r[k : k + 2]]
            out["src"] += [src] * len(seen)
            out["row_key"] += [key] * len(seen)
            out["token"] += seen
            out["before"] += [list(x) for x, _ in seen.values()]
            out["after"] += [list(x) for _, x in seen.values()]
        return out

    w = words.groupBy(F.col("word").alias("token")).agg(F.collect_list(F.struct("meant", "cost", "n")).alias("words")).withColumn("signs", F.lit(None).cast("array<struct<place:int,meant:string>>"))
    z = signs.groupBy(F.col("pair").alias("token")).agg(F.collect_list(F.struct("place", "meant")).alias("signs")).select("token", F.lit(None).cast("array<struct<meant:string,cost:double,n:bigint>>").alias("words"), "signs")
    spread_rows = map_slices(texts, spread, "src string, row_key string, token string, before array<string>, after array<string>", tokens)
    hit = settle(spread_rows.join(w.unionByName(z), "token"))
    own = hit.groupBy("src", "row_key").agg(F.collect_set(F.struct("token", "words", "signs")).alias("own"))
    asked = hit.where(F.size("words") > 1).select("src", "row_key", "before", "after", F.explode("words.meant").alias("m"))
    around = F.concat(F.transform("before", lambda x: F.concat(x, F.lit(" "), F.col("m"))), F.transform("after", lambda x: F.concat(F.col("m"), F.lit(" "), x)))
    asked = asked.select("src", "row_key", F.explode(around).alias("pair")).distinct()
    near = asked.join(beside, "pair").groupBy("src", "row_key").agg(F.collect_list(F.struct("pair", "n")).alias("beside"))
    out = texts
    for got in (own, near):
        got = got.withColumnsRenamed({"src": "k_src", "row_key": "k_row_key"})
        out = out.join(got, F.col("src").eqNullSafe(F.col("k_src")) & F.col("row_key").eqNullSafe(F.col("k_row_key")), "left").drop("k_src", "k_row_key")
    return map_slices(out, run, schema, arrow)


def mended(texts: DataFrame, full: bool, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(src, row_key, noisy[, paragraphs]) of (src, row_key, model, parts)."""
    stats = settle(counts(texts))
    words = settle(word_fixes(stats))
    signs = settle(sign_fixes(stats))
    schema = "src string, row_key string, noisy boolean" + (", paragraphs array<string>" if full else "")
    arrow = pa.schema(_KEYS + ([("paragraphs", pa.list_(pa.string()))] if full else []))

    def by_join(beside: DataFrame) -> DataFrame:
        def own(rows: dict[str, list], k: int) -> Fixes:
            w, z = {}, defaultdict(dict)
            for x in rows["own"][k] or ():
                if x["words"]:
                    w[x["token"]] = [(y["meant"], y["cost"], y["n"]) for y in x["words"]]
                for y in x["signs"] or ():
                    z[x["token"]][y["place"]] = y["meant"]
            return Fixes(w, z, {x["pair"]: x["n"] for x in rows["beside"][k] or ()})

        return _joined(texts, words, signs, beside, _mender_alone(own, full), schema, arrow)

    n = words.count() + signs.count()
    if n > broadcast_rows:
        return by_join(context_joined(texts, words))
    table: dict[str, list] = defaultdict(list)
    for r in words.collect():
        table[r["word"]].append((r["meant"], r["cost"], r["n"]))
    pairs: dict[str, dict[int, str]] = defaultdict(dict)
    for r in signs.collect():
        pairs[r["pair"]][r["place"]] = r["meant"]
    several = {x[0] for got in table.values() if len({round(y[1], 3) for y in got}) < len(got) for x in got}
    beside: dict[str, int] = {}
    if several:
        # Only pairs that can decide between readings of a rare word: what stands around these words here.
        near = settle(context(texts, several))
        if n + near.count() > broadcast_rows:
            return by_join(near)
        beside = dict(near.collect())
    shared = texts.sparkSession.sparkContext.broadcast(Fixes(dict(table), dict(pairs), beside))
    return map_slices(texts, _mender(shared, full), schema, arrow)


def inputs(chunks: DataFrame, vlm_eval: DataFrame, packages: DataFrame) -> DataFrame:
    """(src, row_key, model, parts) of the chunks and of the elements of key_text."""
    model = F.regexp_extract("id", r"^(.*)@seq_\d+$", 1)
    c = chunks.select(F.lit("chunks").alias("src"), F.col("id").alias("row_key"), model.alias("model"), F.array("content").alias("parts"))
    p = packages.select(F.col("package_id").alias("p_id"), F.col("model").alias("p_model"))
    v = vlm_eval.select("vlm_id", "package_id", "key_text").join(p, F.col("package_id") == F.col("p_id"), "left")
    v = v.select(F.lit("vlm_eval").alias("src"), F.col("vlm_id").cast("string").alias("row_key"), F.col("p_model").alias("model"), F.col("key_text").alias("parts"))
    return c.unionAll(v)


def p4_found(chunks: DataFrame, vlm_eval: DataFrame, packages: DataFrame) -> DataFrame:
    """Keys of the rows with scan noise; only these keys are shuffled."""
    return mended(inputs(chunks, vlm_eval, packages), False).where("noisy").select("src", "row_key").distinct()


def p4_text(chunks: DataFrame, vlm_eval: DataFrame, packages: DataFrame) -> DataFrame:
    """The repaired paragraphs of every chunk and of every row's key_text, one row for each key."""
    return once(mended(inputs(chunks, vlm_eval, packages), True), "src", "row_key").select("src", "row_key", "paragraphs")
