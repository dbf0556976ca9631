"""The training-data operators against brute force, round trips and their defined cases."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliomill.llm import bpe, lookalikes, markup, packing, queries, repetition, scans, splitting, truncation
from foliomill.runtime import table

CHUNKS = "id string, package_id string, content string, page string, extra string"
DOCS = "doc_id long, text string, source string, ids string"


def chunks(spark, texts, page="1"):
    return spark.createDataFrame([(f"M-1A@seq_{k:03d}", f"pk{k % 2}", t, page, "x") for k, t in enumerate(texts)], CHUNKS)


def keys(df):
    return sorted(r[0] for r in df.collect())


# 1 repetition


def brute_repeats(text, run=repetition.RUN):
    u, seen, rep = repetition.units(text), set(), set()
    for i in range(len(u) - run + 1):
        g = tuple(u[i : i + run])
        if g in seen:
            rep |= set(range(i, i + run))
        seen.add(g)
    return len(u), len(rep)


def test_repeats_match_brute_force():
    r = random.Random(1)
    texts = [None, "", "  !? ", "x", "测量" * 40]
    for _ in range(200):
        base = [r.choice("ab cd ef gh 测 量 油 x1".split()) for _ in range(r.randint(1, 60))]
        texts.append(r.choice(["", " ", ", "]).join(base * r.randint(1, 4)))
    size, rep = repetition.repeat_counts(texts)
    assert [(int(a), int(b)) for a, b in zip(size, rep)] == [brute_repeats(t) for t in texts]


def test_repetition_query(spark):
    long = "Turn the shaft by nine degrees and hold the cover with a soft mallet until it stops. "
    df = chunks(spark, [long * 5, long, None, "", long * 300])
    df = df.unionAll(df)
    assert keys(repetition.p1_found(df)) == ["M-1A@seq_000", "M-1A@seq_004"]
    shares = {r["id"]: r["share"] for r in repetition.repetition(df, "id", "content", "package_id").collect()}
    assert len(shares) == 5 and shares["M-1A@seq_002"] == 0.0


def brute_threshold(shares):
    q = [0.0, *np.quantile(sorted(x for x in shares if x > 0), np.arange(repetition.STEPS + 1) / repetition.STEPS, method="inverted_cdf")]
    return max((hi - lo, (hi + lo) / 2) for lo, hi in zip(q, q[1:]))[1]


def test_thresholds_follow_the_data(spark):
    r = random.Random(3)
    groups = {("en", "a"): (0.05, 0.15, 0.5), ("en", "b"): (0.1, 0.3, 0.8), ("de", "a"): (0.02, 0.06, 0.3)}
    rows = [(f"{g}{k}", *g, r.uniform(lo, mid) if k % 3 else r.uniform(top, top + 0.1)) for g, (lo, mid, top) in groups.items() for k in range(600)]
    rows += [(f"z{k}", *g, 0.0) for g in groups for k in range(900)] + [("n1", "de", None, 0.1), ("n2", "de", None, 0.35), ("u", "und", None, 0.9)]
    shares = spark.createDataFrame(rows, "id string, lang string, source string, share double")
    got = {(x["lang"], x["source"]): x["threshold"] for x in repetition.thresholds(shares).collect()}
    for g, (_, mid, top) in groups.items():
        exact = brute_threshold([x[3] for x in rows if x[1:3] == g])
        assert mid < exact < top and got[g] == pytest.approx(exact, abs=0.02)
    assert got["de", None] == pytest.approx(got["de", "a"], abs=0.05) and 0 < got["und", None] < 0.8  # too few of their own
    found = {x["id"] for x in repetition.unusual(shares).collect()}
    want = {x[0] for x in rows if x[3] >= got[x[1], x[2]]}
    assert found == want and len(found) == 602
    assert repetition.thresholds(shares.where("share = 0")).select("threshold").distinct().first()[0] == repetition.ALWAYS
    assert repetition.thresholds(shares.limit(0)).count() == 0


def test_found_asks_no_threshold(spark):
    """The groups' threshold lies above 0.5 and decides in unusual(); p1_found neither follows nor makes one."""
    part, rest = [f"h{k}" for k in range(20)], [f"r{k}" for k in range(34)]
    kinds = [" ".join(x) for x in (part * 2 + rest, part * 3 + rest[:15], part * 25)]
    df = chunks(spark, [t for t in kinds for _ in range(60)] + [" ".join(rest), None, ""])
    df = df.unionAll(df)
    shares = repetition.repetition(df, "id", "content", "package_id")
    assert {round(x["share"], 3) for x in shares.collect()} == {0.0, 0.27, 0.533, 0.96}
    assert keys(repetition.unusual(shares).select("id")) == [f"M-1A@seq_{k:03d}" for k in range(120, 180)]
    found = repetition.p1_found(df)
    assert keys(found) == [f"M-1A@seq_{k:03d}" for k in range(60, 180)]
    assert keys(found) == keys(shares.where("share >= 0.5").select("id"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [w for w in ("Join", "kll", "threshold", "lang", "source") if w in plan], plan


# 3 splitting


def test_split_round_trip_and_limits():
    r = random.Random(2)
    for _ in range(60):
        n = r.randint(1, 1500)
        text = "".join(r.choice(["word ", "测", "量", "x1, ", "end. ", "\n\n", "\n", "3.5 ", "。", "-"]) for _ in range(n))
        pieces = splitting.split(text)
        assert "".join(text[p["core_start"] : p["core_end"]] for p in pieces) == text
        spans = [m.span() for m in splitting._TOKEN.finditer(text)]
        before = None
        for p in pieces:
            own = [s for s in spans if p["start"] <= s[0] < p["core_end"]]
            assert len(own) == p["tokens"] <= splitting.LIMIT or len(pieces) == 1
            if before:
                assert own[: splitting.OVERLAP] == before[-splitting.OVERLAP :]
            before = own


def brute_cost(kinds, cuts):
    n, room = len(kinds) + 1, splitting.LIMIT - splitting.OVERLAP
    ideal = (n - splitting.OVERLAP) / max(1, -(-(n - splitting.OVERLAP) // room))
    total, at = 0.0, splitting.OVERLAP
    for c in cuts:
        total += ((c - at) / ideal - 1) ** 2 + (0 if c == n else splitting.PENALTY[kinds[c - 1]])
        at = c
    return total


def test_cuts_are_the_cheapest():
    r = random.Random(3)
    for _ in range(20):
        n = r.randint(400, 700)
        kinds = [r.choice(["sentence"] + ["hard"] * 40) for _ in range(n - 1)]
        got = brute_cost(kinds, splitting.cuts(kinds))
        nat = [i + 1 for i, k in enumerate(kinds) if k == "sentence" and i + 1 > splitting.OVERLAP]
        room = splitting.LIMIT - splitting.OVERLAP
        two = [brute_cost(kinds, [c, n]) for c in nat if c <= splitting.LIMIT and n - c <= room]
        if two:
            assert got <= min(two) + 1e-9


def test_split_query(spark):
    df = chunks(spark, ["w " * 384, "w " * 385, None, "", "测" * 1000], "3")
    assert keys(splitting.p3_found(df.unionAll(df))) == ["M-1A@seq_001", "M-1A@seq_004"]
    rows = splitting.p3_pieces(df).collect()
    assert all(r["token_count"] <= 384 and r["page"] == "3" for r in rows)
    assert splitting.boundary(".") == "hard" and splitting.boundary(". ") == "sentence" and splitting.boundary("\n \n") == "paragraph"


# 5 look-alikes


@pytest.mark.parametrize(
    "text, want",
    [
        ("Sсhwingenlаgerung", "Schwingenlagerung"), ("ｏｕｔｅｒ ２３", "outer 23"), ("Pru\u0308fwerte", "Prüfwerte"), ("a\u200bb\u00a0c\u2009d", "ab c d"), ("\u2ecb主\u2f64", "车主用"), ("ﬁlter", "filter"),
        ("\u041dижняя рама", "Нижняя рама"), ("5 mm² / α，测量（外侧）：kΩ", "5 mm² / α，测量（外侧）：kΩ"), ("Inѕрeсting the рrimаrу", "Inspecting the primary"), ("и\u0306", "й"), ("line\nbreak", "line\nbreak"),
        (None, None), ("", ""), ("Ignition cοil", "Ignition coil"), ("Αpply", "Apply"), ("5 kΩ, 3 μm and χ2", "5 kΩ, 3 μm and χ2"), ("teχt", "text"), ("ρump", "pump"), ("χv", "χv"),
    ],
)
def test_unify(text, want):
    assert lookalikes.unify(text) == want
    assert lookalikes.unify(want) == want


def test_mapping_is_consistent():
    table_ = lookalikes.mapping()
    assert all(not any(c in table_ for c in to) for to in table_.values()) and len(table_) > 2000


def test_lookalike_query(spark):
    toc = spark.createDataFrame([(1, "Ｄｉｅ Steuerkette"), (1, "Ｄｉｅ Steuerkette"), (2, "plain"), (3, None), (4, "")], "toc_id long, title string")
    assert sorted(tuple(r) for r in lookalikes.p5_found(chunks(spark, ["a\ufeffb", "ok", None]), toc).collect()) == [("chunks", "M-1A@seq_000"), ("toc_tree", "1")]


# 6 tokens


def test_bpe_matches_the_public_library():
    import tiktoken

    e = bpe.encoder()
    ref = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=e.ranks, special_tokens={})
    r = random.Random(4)
    texts = ["", "a", "  x\n\n y", "<|endoftext|>", "测量" * 300, "ab" * 3000, "é" * 50] + ["".join(r.choice("ab cdé测\n 1.,'st") for _ in range(r.randint(1, 200))) for _ in range(300)]
    for t in texts:
        ids = e.encode(t)
        assert ids == ref.encode_ordinary(t) and e.decode(ids) == t


def test_ids_query(spark):
    df = spark.createDataFrame([(1, "Turn it.", "s", "clash"), (2, None, None, None), (3, "", "s", "x")], DOCS)
    got = {r["doc_id"]: r["ids"] for r in bpe.p6_ids(df).collect()}
    assert got[2] == got[3] == [] and bpe.encoder().decode(got[1]) == "Turn it."
    assert {r["text"] for r in bpe.decoded(bpe.p6_ids(df), "doc_id").collect()} == {"Turn it.", ""}


# 7 packing


def test_packing_rule_is_the_least_sum_of_squares():
    r = random.Random(5)
    cap = 20
    sizes = [r.randint(1, cap - 1) for _ in range(300)]
    bins, gaps = packing.pack(np.array(sizes), cap)
    count, where = Counter(), {}
    for s, b in zip(sizes, bins.tolist()):
        def cost(h):
            c = Counter(count)
            if h < cap:
                c[h] -= 1
            if h - s:
                c[h - s] += 1
            return sum(v * v for v in c.values())

        options = [h for h in range(s, cap) if count[h]] + [cap]
        h = where.get(b, cap)
        assert h in options and cost(h) == min(map(cost, options))
        if h < cap:
            count[h] -= 1
        where[b] = h - s
        if h - s:
            count[h - s] += 1
    assert [where[b] for b in range(len(gaps))] == gaps.tolist()


def test_packing_keeps_everything(spark):
    r = random.Random(6)
    rows = [(k, r.choice([0, 1, 5, 700, 1500, 2047, 2048, 2049, 5000])) for k in range(400)]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, size int"), block_rows=100).collect()
    per, used = Counter(), Counter()
    for c, d, p, s in got:
        per[d] += s
        used[c] += s
    assert {d: s for d, s in rows} == {d: per[d] for d, _ in rows} and max(used.values()) <= packing.CAPACITY
    assert all(Counter(d for _, d, _, _ in got)[d] == max(1, -(-s // packing.CAPACITY)) for d, s in rows)
    assert packing.packed(spark.createDataFrame([], "doc_id long, size int")).count() == 0


# 2 markup


@pytest.mark.parametrize(
    "text, marked",
    [
        ("Turn the **shaft** now.", True), ("Mit <OK> bestätigen.", False), ("x < 5 and y > 7, 5 * 3, $40 or $55", False), ("map_v2_77.bin in C:\\cal\\k6", False), ("# Heading\ntext", True), ("a &amp; b", True),
        ("[第44页] 2# 气缸", False), ("- one\n- two\n1. three", False), ("{{cite|p=3}}", True), ("\\section{Rear} text", True), ("<b>x</b>", True), ("as shown\n\n| 449\nnext", False), (None, False), ("", False),
    ],
)
def test_markup_found(text, marked):
    nodes = markup.read([text], markup.model())[0]
    assert any(n.chosen for n in markup.walk(nodes)) is marked


def test_markup_held_out_accuracy():
    x, y = markup.sample(600, seed=99)
    assert ((markup.model().score(x) > 0) == (y > 0)).mean() > 0.97


def test_code_keeps_its_signs():
    text = '<h2>Top</h2><ul><li>one<li>two</ul>\n```\na = **p_1**\n```\n$x_{1} \\cdot y$ &nbsp;end'
    nodes = markup.read([text], markup.model())[0]
    plain, made = markup.clean(text, nodes)
    kinds = [b["kind"] for b in made]
    assert kinds[:4] == ["heading", "item", "item", "code"] and made[3]["text"] == "a = **p_1**" and "formula" in kinds and "<" not in plain


@pytest.mark.parametrize(
    "text, want, kinds",
    [
        ("$$ \\sum_{i=1}^{n} x_{i} y_{i} + \\frac{a_{0}}{b_{1}} - \\int_{0}^{1} f(t)\\,dt + \\alpha \\cdot \\beta_{max} $$", "\\sum_{i=1}^{n} x_{i} y_{i} + \\frac{a_{0}}{b_{1}} - \\int_{0}^{1} f(t)\\,dt + \\alpha \\cdot \\beta_{max}", ["formula"]),
        ("Set snake_case_name and other_long_name to 5.", "Set snake_case_name and other_long_name to 5.", ["text"]),
        ("The *" + "long words " * 100 + "end* of it.", "The " + "long words " * 100 + "end of it.", ["text"]),
        ("a \ue003 b **c** \ue000d", "a \ue003 b c \ue000d", ["text"]),
        ("备用__链条张紧器__Q7D与车架。", "备用链条张紧器Q7D与车架。", ["text"]),
        ("$x_{1} + " + "y_{2} + " * 60 + "z$", "x_{1} + " + "y_{2} + " * 60 + "z", ["formula"]),
    ],
)
def test_what_is_kept(text, want, kinds):
    plain, made = markup.clean(text, markup.read([text], markup.model())[0])
    assert plain.strip() == want and [b["kind"] for b in made] == kinds


def test_deep_trees_take_time_in_proportion():
    import time

    trees = markup.model()
    for text in ("<div>" * 500 + "x" + "</div>" * 500, "<p>a " * 3000, "<li>b </i>" * 3000):
        start = time.time()
        nodes = markup.read([text], trees)[0]
        plain, _ = markup.clean(text, nodes)
        assert "<" not in plain and time.time() - start < 3


def test_decoding_is_the_best_without_contradictions():
    r = random.Random(4)
    for _ in range(60):
        text = "".join(r.choice(["<pre>", "</pre>", "<b>", "</b>", "&lt;", "**w** ", "`c *d*` ", "<code>", "</code>", "x "]) for _ in range(9))
        nodes = markup.tree(text)
        every = list(markup.walk(nodes))[:12]
        if len(every) < 2 or len(list(markup.walk(nodes))) > 12:
            continue
        for n in every:
            n.odds = r.uniform(-3, 3)

        def allowed(group, mute, soft, chosen):
            for n in group:
                if id(n) in chosen and mute and not (soft and markup._soft(n)):
                    return False
                closed = id(n) in chosen and markup._closed(n)
                if not allowed(n.children, mute or closed, soft or closed and n.kind == "tag", chosen):
                    return False
            return True

        best = max(sum(n.odds for k, n in enumerate(every) if mask >> k & 1) for mask in range(1 << len(every)) if allowed(nodes, False, False, {id(n) for k, n in enumerate(every) if mask >> k & 1}))
        markup.decode(nodes)
        got = {id(n) for n in every if n.chosen}
        assert allowed(nodes, False, False, got) and sum(n.odds for n in every if n.chosen) == pytest.approx(best)


def test_clean_text_of_planted_signs():
    """Texts with planted inline signs come out as they were before."""
    r = random.Random(12)
    words = "shaft cover pump rotor 阀门 Kette муфта lever".split()
    wrong = total = 0
    for _ in range(150):
        plain = [f"{r.choice(words)} {r.choice(words)} {r.randint(1, 99)} mm" for _ in range(4)]
        text = []
        for line in plain:
            a, b, rest = line.split(" ", 2)
            sign = r.choice(["**{}**", "<b>{}</b>", "`{}`", "''{}''", "\\textbf{{{}}}", "[{}](https://a.example/1)", "[[{}]]", "<i>{}</i>", "{}", "{}"])
            text.append(f"{a} {sign.format(b)} {rest}")
        got, _ = markup.clean("\n".join(text), markup.read(["\n".join(text)], markup.model())[0])
        total += 4
        wrong += sum(x != y for x, y in zip(got.split("\n"), plain))
    assert wrong <= 0.01 * total


def test_markup_query(spark):
    cl = spark.createDataFrame([(7, "<TABLE><tr><td>x < 5<td>$40</tr></TABLE>"), (8, "<table><tr><td><b>x</b></td></tr>"), (9, None), (10, "")], "item_id long, table_body string")
    assert sorted(tuple(r) for r in markup.p2_found(chunks(spark, ["a `b` c", "plain"]), cl).collect()) == [("chunks", "M-1A@seq_000"), ("content_list", "8")]
    rows = {r["row_key"]: r for r in markup.p2_text(chunks(spark, [None, ""]), cl).collect()}
    assert [b["text"] for b in rows["7"]["blocks"]] == ["x < 5", "$40"] and rows["M-1A@seq_000"]["text"] is None


# 4 scans


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, last = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
    return row[-1]


def test_retrieval_is_complete():
    r = random.Random(8)
    words = {"".join(r.choice("abcd") for _ in range(r.randint(1, 8))) for _ in range(300)}
    trie = scans.build_trie(words)
    for _ in range(100):
        w = "".join(r.choice("abcde") for _ in range(r.randint(1, 8)))
        for k in (1, 2):
            assert sorted(scans.within(trie, w, k)) == sorted(v for v in words if levenshtein(w, v) <= k)


def test_words_within_their_edits_share_a_key():
    r = random.Random(5)
    for _ in range(4000):
        v = "".join(r.choice("abc") for _ in range(r.randint(4, 11)))
        w = v
        for _ in range(r.randint(1, 2)):
            k = r.randrange(len(w) + 1)
            w = r.choice([w[:k] + r.choice("abc") + w[k:], w[:k] + w[k + 1 :], w[:k] + r.choice("abc") + w[k + 1 :]])
        if len(w) >= scans.LEAST_LETTERS and levenshtein(w, v) <= (2 if len(w) >= scans.TWO_EDITS else 1):
            assert set(scans.index_keys(v)) & set(scans.probe_keys(w)), (v, w)


def test_word_fixes_match_brute_force(spark):
    r = random.Random(6)
    common = {"".join(r.choice("celou") for _ in range(r.randint(4, 9))): r.randint(20, 90) for _ in range(150)}
    alike = {"c": "eo", "e": "co", "l": "1i", "o": "0c", "u": "vn"}
    rare = {}
    for w in sorted(common) * 3:
        for k in r.sample(range(len(w)), r.randint(1, 2)):
            w = w[:k] + r.choice(alike.get(w[k], "x")) + w[k + 1 :]
        rare[w] = r.randint(1, 3)
    stats = spark.createDataFrame([("w" + w, n) for w, n in {**rare, **common}.items()], "key string, n long")
    got = {(x["word"], x["meant"]) for x in scans.word_fixes(stats).collect()}
    every = {**rare, **common}
    want = set()
    for w, n in every.items():
        if n * scans.RATIO <= max(every.values()) and sum(c.isdigit() for c in w) <= 2:
            for v, m in common.items():
                if v.isalpha() and v != w and m >= scans.RATIO * n and levenshtein(w, v) <= (2 if len(w) >= scans.TWO_EDITS else 1) and scans.unlikeness(w, v) <= scans.ACCEPT:
                    want.add((w, v))
    assert got == want and want


@pytest.mark.parametrize("line, is_furniture", [("207", True), ("· 9 ·", True), ("Page 3 of 12", True), ("第 9 页", True), ("Kapitel 4 | Marlo-530GT-1A   7", True), ("10W40", False), ("17 V / 26 A", False), ("T39A: K87E", False), ("Clutch cover: 7 mL", False), ("O-ring 10x1.5", False), ("", False)])
def test_furniture(line, is_furniture):
    assert scans.furniture(line, "Velora-250R") is is_furniture


@pytest.mark.parametrize("line, inside, alone", [("Velora-250R workshop edition", True, False), ("Velora-250R Owner's Manual   20", True, True), ("Velora-250R SERVICE MANUAL", True, False), ("Velora-250R Betriebsanleitung   7", True, True), ("14 | WARTUNGSBUCH · Velora-250R", True, True), ("Velora-250R 维修手册", True, False), ("Velora-250R руководство   236", True, True), ("Velora-250R 使用说明书   606", True, True), ("Velora-250R Field Service Companion", True, False), ("四章 Velora-250R 保养手册  3", True, True), ("Velora-250R must be lifted", False, False), ("- Velora-250R shield", False, False), ("Velora-250R: front shield", False, False), ("Velora-250R 12 mm", False, False), ("Velora-250R-X shield", False, False), ("Marlo-530GT front shield", False, False), ("对Velora-250R进行检查", False, False), ("Velora-250R 的后减震器", False, False)])
def test_headers_with_any_title(line, inside, alone):
    assert scans.furniture(line, "Velora-250R") is inside and scans.furniture(line, "Velora-250R", False) is alone


def test_titled_header_is_taken_out():
    none = scans.Fixes({}, {}, {})
    assert scans.mend("the radiator\n\nVelora-250R SERVICE MANUAL\n\ncap with care.", none, "Velora-250R") == (["the radiator cap with care."], True)
    assert scans.mend("Velora-250R SERVICE MANUAL\n\nThe radiator cap.", none, "Velora-250R") == (["Velora-250R SERVICE MANUAL", "The radiator cap."], False)


def scan_rows(spark):
    good = "Tighten the rear clutch cover and inspect the auxiliary sprocket, then replace the coupling. 左侧离合器盖由技师固定在上部车架之后"
    bad = "Tightcn the rcar clutch c0ver and inspcct the auxiliary spr0cket, then replace the coup1ing."
    zh = "左侧离合器盖由技师困定在土部车架之启"
    return chunks(spark, [good] * 60 + [bad, zh, "bro-\nken words and exha-\nust pipe", "测 量 外 侧 压 力 。", "Vorder-\nund Hinterrad", None, "", "text one\n\n| 33\n\ncontinues here"])


def test_scan_noise(spark):
    vlm = spark.createDataFrame([(1, "pk0", ["Page 7", "x"]), (2, "pk0", [None, "", "10W40"]), (3, "none", [])], "vlm_id long, package_id string, key_text array<string>")
    packages = spark.createDataFrame([("pk0", "M-1A")], "package_id string, model string")
    rows = scan_rows(spark)
    got = sorted(tuple(r) for r in scans.p4_found(rows, vlm, packages).collect())
    assert got == [("chunks", f"M-1A@seq_{k:03d}") for k in (60, 61, 62, 63, 67)] + [("vlm_eval", "1")]
    text = {r["row_key"]: r["paragraphs"] for r in scans.p4_text(rows, vlm, packages).collect()}
    assert text["M-1A@seq_060"][0].startswith("Tighten the rear clutch cover and inspect") and text["M-1A@seq_061"] == ["左侧离合器盖由技师固定在上部车架之后"]
    assert text["M-1A@seq_062"] == ["broken words and exhaust pipe"] and text["M-1A@seq_067"] == ["text one continues here"] and text["M-1A@seq_065"] == []


def test_join_way_equals_broadcast(spark):
    vlm = spark.createDataFrame([], "vlm_id long, package_id string, key_text array<string>")
    texts = scans.inputs(scan_rows(spark), vlm, spark.createDataFrame([], "package_id string, model string"))
    a, b = (sorted((r["row_key"], r["noisy"], tuple(r["paragraphs"])) for r in scans.mended(texts, True, n).collect()) for n in (scans.BROADCAST_ROWS, -1))
    assert a == b


def both_ways(texts):
    return [sorted((str(r["row_key"]), r["noisy"], tuple(r["paragraphs"])) for r in scans.mended(texts, True, n).collect()) for n in (scans.BROADCAST_ROWS, -1)]


def test_join_way_looks_up_what_is_corrected(spark):
    good = ["push the lever down"] * 40 + ["call the lover back"] * 60 + ["Ober und Grenze, coupling rod"] * 120
    bad = ["pull the lcver down", "the couplinq rod", "at Obcr-\nGrenze it is", "Obcr-\nund Grenze", "push the coup-\n\n207\n\nlinq rod"]
    rows = [("chunks", f"g{k:03d}", "M-1A", [t]) for k, t in enumerate(good)] + [("chunks", f"x{k}", "M-1A", [t]) for k, t in enumerate(bad)]
    rows += [("vlm_eval", "e", "M-1A", ["lcver\u200ba and Obcr\u200ba", "x"]), ("chunks", None, None, ["pull the lcver down, Obcr"])]
    a, b = both_ways(spark.createDataFrame(rows, "src string, row_key string, model string, parts array<string>"))
    assert a == b
    got = {k: (noisy, p) for k, noisy, p in a}
    assert got["x0"][1] == ("pull the lever down",) and got["x2"][1] == ("at Ober-\nGrenze it is",) and got["x3"][1] == ("Ober-\nund Grenze",)
    assert got["x4"] == (True, ("push the coupling rod",)) and got["e"][0] and got["None"] == (True, ("pull the lever down, Ober",))


def test_context_of_few_rows_decides(spark):
    # "lover" is the more frequent reading; beside "bent" stands "lever", in 3 rows, two of them in wide letters.
    good = ["a lever"] * 40 + ["a lover"] * 60 + ["bent lever"] + ["ｂｅｎｔ ｌｅｖｅｒ"] * 2
    texts = spark.createDataFrame([("chunks", f"k{k:03d}", "M-1A", [t]) for k, t in enumerate([*good, "bent lcver"])], "src string, row_key string, model string, parts array<string>")
    ways = [sorted((r["row_key"], tuple(r["paragraphs"])) for r in scans.mended(texts, True, n).collect()) for n in (scans.BROADCAST_ROWS, 3, -1)]  # 3: two readings fit, their context doesn't
    assert ways[0] == ways[1] == ways[2] and ways[0][-1] == ("k103", ("bent lever",))


# 8 truncation


@pytest.mark.parametrize("text, state", [("<table><tr><td>a", "open"), ("```\nx", "open"), ("caf\ufffd", "broken"), ("a &am", "broken"), ("ends (here", "bracket"), ("one, two,", "comma"), ("Text.\n4.", "marker"), ("whole.", "plain"), (None, "blank"), (" \n", "blank"), ("<p>a<p>b.", "plain"),
    ('He said "turn the key', "bracket"), ("Sie sagt „den Hebel lösen", "bracket"), ("Sie sagt „den Hebel“ zu lösen.", "plain"), ("press ‚Start", "bracket"), ("the 'long key", "bracket"), ("the driver's own key's head", "plain"), ("a 5\" bolt and a 6\" bolt", "plain"), ("the drivers' tools", "plain"), ("<table><tr><td>a</td></tr></table>", "closed"), ("| a | b |", "closed"), ("| a | b", "open"), ("rock 'n' roll", "plain")])
def test_automaton(text, state):
    assert truncation.read_end(text)[2] == state


def test_truncation_query(spark):
    r = random.Random(9)
    parts = ["Tighten the rear cover", "inspect the upper shaft", "replace the main valve", "drain the lower tank"]
    whole = [" ".join(f"{r.choice(parts)} with the long key.".capitalize() for _ in range(6)) for _ in range(120)]
    rows = [(k, t, "a", "") for k, t in enumerate(whole)] + [(1000 + k, t[: len(t) - 12], "a", "") for k, t in enumerate(whole[:5])] + [(2000, None, None, ""), (2001, "", "a", "")]
    df = spark.createDataFrame(rows, DOCS)
    assert keys(truncation.p8_found(df)) == list(range(1000, 1005))
    by = {r["source"]: (r["texts"], r["cut_texts"]) for r in truncation.p8_sources(df).collect()}
    assert by == {"a": (126, 5), None: (1, 0)}


def test_closing_lines_are_of_different_texts(spark):
    r = random.Random(9)
    parts = ["Tighten the rear cover", "inspect the upper shaft", "replace the main valve", "drain the lower tank"]
    whole = [" ".join(f"{r.choice(parts)} with the long key.".capitalize() for _ in range(6)) for _ in range(120)]
    rows = [(k, t, "a", "") for k, t in enumerate(whole)]
    rows += [(1000 + k, whole[0] + "\nTighten the rear", "a", "") for k in range(6)]  # copies of one cut text
    limited = [f"{whole[k]}\nInspect the upper" for k in range(1, 7)]  # different texts, all as long as their source's limit
    rows += [(2000 + k, f"{'x' * (400 - len(t))} {t}", "b", "") for k, t in enumerate(limited)]
    rows += [(3000 + k, t + "\nSigned by the workshop", "a", "") for k, t in enumerate(whole[10:20])]
    df = spark.createDataFrame(rows, DOCS)
    assert keys(truncation.p8_found(df)) == [*range(1000, 1006), *range(2000, 2006)]


def test_copies_of_all_documents_change_no_verdict(spark):
    d = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "source")
    copies = d.crossJoin(spark.range(8).withColumnRenamed("id", "k")).withColumn("doc_id", F.col("doc_id") * 8 + F.col("k"))
    once = keys(truncation.p8_found(d))
    assert once and keys(truncation.p8_found(copies)) == sorted(8 * i + k for i in once for k in range(8))


def test_phrases_are_counted_as_one_by_one():
    texts = ["Turn the key.\nTurn the lever 12,5 mm", "", "检查外侧油泵\n检查Q12F油", "a ... b;\r\n- x M1A y", "\n\n"]
    g1, g2, closes, doc = truncation.grams(texts)
    assert [int(x) for x in np.bincount(doc, minlength=5)] == [8, 0, 10, 6, 0]
    assert g1[0] == g1[3] and g1[1] == g1[4] and g2[1] == g2[4] and g2[0] == g2[3] and g2[2] != g2[5]  # "Turn the" begins both lines
    assert [int(k) for k in np.flatnonzero(closes)] == [2, 7, 13, 17, 19, 23]
    assert truncation.tails(["weiter M2B y.", "x"])[0][0] == truncation.tails(["y"])[0][0]
    assert truncation.tails(["a Q77F y"])[1][0] == truncation.tails(["b R1F y"])[1][0] != truncation.tails(["a Q77F. z y"])[1][0]
    assert truncation.tails(["to R5A"])[1][0] == truncation.tails(["to Z9A"])[1][0]


def test_every_query_runs_on_the_smallest_data_and_on_nothing(spark, sf, tmp_path):
    for name in ("chunks", "content_list", "vlm_eval", "toc_tree", "documents", "packages"):
        table(spark, sf, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, q in queries.queries().items():
        assert q(spark, sf).count() > 0, name
        assert q(spark, str(tmp_path)).count() == (name in ("p7_fill",)), name


def test_every_query_takes_dirty_tables(spark, sf, tmp_path):
    from dirty import write

    write(spark, sf, ["chunks", "content_list", "vlm_eval", "toc_tree", "documents", "packages"], str(tmp_path))
    for name, q in queries.queries().items():
        q(spark, str(tmp_path)).write.format("noop").mode("overwrite").save()
