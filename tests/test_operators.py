"""Operators against brute force, truth tables and their defined cases."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliomill.functions import text as T
from foliomill.operators import anchors, audit, checks, chunking, cleaning, grids, lookup, pages, patches, records, search, sequences, toc, words


def one(spark, expr, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(expr.alias("x")).first().x


# sequences


def test_blocked_operators_equal_plain_windows(spark):
    r = random.Random(1)
    data = [(r.choice(["a", "b", None]), k, r.choice([None, None, k]), "x") for k in range(500)]
    df = spark.createDataFrame(data, "k string, at long, v long, local string")
    w = W.partitionBy("k").orderBy("at")
    want = df.withColumn("f", F.last("v", True).over(w)).withColumn("s", F.sum(F.coalesce("v", F.lit(0))).over(w)).withColumn("n", F.row_number().over(w))
    got = sequences.forward_fill(df, ["k"], F.col("at"), F.col("v"), "f", 16)
    got = sequences.running_sum(got, ["k"], F.col("at"), F.col("v"), "s", 16)
    got = sequences.row_numbers(got, ["k"], F.col("at"), "n", 16)
    key = lambda x: (x["at"], x["f"], x["s"], x["n"], x["local"])
    assert sorted(map(key, got.collect()), key=str) == sorted(map(key, want.collect()), key=str)


def test_page_runs(spark):
    df = spark.createDataFrame([("a", p) for p in (1, 2, 2, 3, 7, 9, 10, None)] + [(None, 4)], "k string, p int")
    got = sorted((str(r.k), r.first_page, r.last_page, r.pages) for r in sequences.page_runs(df, ["k"], "p").collect())
    assert got == [("None", 4, 4, 1), ("a", 1, 3, 3), ("a", 7, 7, 1), ("a", 9, 10, 2)]


def test_cluster_depths(spark):
    df = spark.createDataFrame([("a", x) for x in (10.0, 12.0, 40.0, 41.0, 80.0)], "k string, x double")
    assert {r.x: r.depth for r in sequences.cluster_1d(df, ["k"], "x").collect()} == {10.0: 0, 12.0: 0, 40.0: 1, 41.0: 1, 80.0: 2}


# text functions


@pytest.mark.parametrize("value, want", [("12 mm", ("12", "mm")), ("0.9L", ("0.9", "L")), ("110/70-12 47L", ("110/70-12 47L", "")), ("TRIP A", ("TRIP A", "")), ("SOHC", ("SOHC", "")), ("85 (kPa)", ("85", "kPa")), ("", ("", "")), ("mm", ("mm", "")), ("20 °C", ("20 °C", ""))])
def test_split_unit(spark, value, want):
    assert tuple(one(spark, T.split_unit("v"), v=("string", value))) == want


@pytest.mark.parametrize("key, role", [("", "marker"), (None, "marker"), ("●", "marker"), ("FM", "state_label"), ("M8", "spec_value"), ("12", "local_label"), ("12 mm", "local_label"), ("油量", "business_key")])
def test_key_role(spark, key, role):
    assert one(spark, T.key_role("k"), k=("string", key)) == role


@pytest.mark.parametrize("k, v, want", [("注意", "x", "non_business"), ("邮箱", "a@b.cn", "non_business"), ("电话", "010-12345678", "non_business"), ("k", "v", "ambiguous"), ("信号词", "v1", "ambiguous"), ("油量", "12 L", "business_candidate")])
def test_colon_class(spark, k, v, want):
    assert one(spark, T.colon_class("k", "v"), k=("string", k), v=("string", v)) == want


def test_small_functions(spark):
    assert one(spark, T.collapse_lines("t"), t=("string", "a\na\nb\na")) == "a\nb\na"
    assert one(spark, T.uniform_row("c"), c=("array<string>", ["x"] * 6)) and not one(spark, T.uniform_row("c"), c=("array<string>", ["x"] * 5))
    assert one(spark, T.pages_listed("p"), p=("string", "31, 13,13")) == [13, 31] and one(spark, T.pages_listed("p"), p=("string", "3,x")) is None
    assert one(spark, T.strip_html("h"), h=("string", "<style>p{}</style><p>a&lt;b</p><p>c</p>")) == "a<b c"
    assert one(spark, T.strip("t"), t=("string", "\t a　\n")) == "a"
    assert one(spark, T.guess_column("h", T.VALUE_WORDS, F.lit(1)), h=("array<string>", ["名称", "说明"])) == 1
    assert one(spark, T.digest("a", "b"), a=("string", None), b=("string", "x")) == one(spark, F.sha2(F.lit("|x"), 256), a=("string", None))
    assert one(spark, T.snippet("t", ["nine"]), t=("string", None)) in (None, "")


# grids


CELL = st.text("ab &<", max_size=3)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(CELL, min_size=1, max_size=4), min_size=1, max_size=4))
def test_cells_round_trip(rows):
    import html

    body = "<table>" + "".join("<tr>" + "".join(f"<td>{html.escape(c)}</td>" for c in r) + "</tr>" for r in rows) + "</table>"
    assert [[c[0] for c in r] for r in grids.read_tables(body)[0]] == [[c.strip() for c in r] for r in rows]


@pytest.mark.parametrize(
    "body, filled",
    [
        ("<table><tr><td colspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>", [["a", "a", "b"], ["c", "", ""]]),
        ("<table><tr><td rowspan='2'>a</td><td>b</td></tr><tr><td>c</td></tr></table>", [["a", "b"], ["a", "c"]]),
        ("<TABLE><TR><TD>a<TD>b<TR><TD>c", [["a", "b"], ["c", ""]]),
        ("<table><thead><tr><th>h</th></tr></thead><tbody><tr><td>&amp; x</td></tr></tbody></table>", [["h"], ["& x"]]),
    ],
)
def test_fill_spans(body, filled):
    assert grids.fill_spans(grids.read_tables(body)[0]) == filled


def test_grid_cases(spark):
    df = spark.createDataFrame([(1, "<table></table>", "x"), (2, None, "x"), (3, "", "x"), (4, "no table", "x"), (5, "<table><tr><td>a</td><td></td></tr><tr><td>b</td></tr></table>", "x")], "id long, body string, rows string")
    got = {r.id: (r.status, r.cells, r.empty_cells) for r in grids.structure(df, "id", "body").collect()}
    assert got == {1: ("empty", 0, 0), 5: ("malformed", 3, 1)}
    assert grids.read_tables(None) == []
    assert grids.to_sentences(grids.read_tables("<table><tr><td>油量</td><td>1 L</td></tr><tr><td>压力</td><td>2</td><td>bar</td></tr></table>")[0]) == "油量：1 L；压力：2 / bar"
    assert grids.to_sentences(grids.read_tables("<table><tr><td>警告</td></tr><tr><td>高温</td></tr></table>")[0]) == "警告 — 高温"
    text = "a\n<table><tr><td>x</td></tr></table>\n```\n<table><tr><td>y</td></tr></table>\n```\n"
    assert grids.pretty(grids.pretty(text)) == grids.pretty(text) and "```\n<table><tr><td>y" in grids.pretty(text)


# pages


@pytest.mark.parametrize(
    "o, n, want",
    [
        ((100, 5, 1000, 0.9, 0), (40, 5, 900, 0.9, 0), "fallback"), ((0, 30, 1000, 0.9, 0), (0, 20, 900, 0.9, 0), "fallback"), ((100, 5, 1000, 0.9, 0), (40, 5, 900, 0.5, 0), "review"), ((100, 5, 1000, 0.5, 0), (40, 5, 100, 0.9, 0), "fallback"),
        ((10, 5, 1000, 0.9, 0), (10, 5, 900, 0.2, 0), "original"), ((10, 5, 1000, 0.9, 0), (10, 5, 900, 0.9, 0), "review"), ((10, 5, 1000, 0.9, 2), (10, 5, 900, 0.9, 0), "fallback"), ((10, 5, 1000, 0.9, 2), (1, 5, 900, 0.9, 1), "review"),
    ],
)
def test_choice_of_readings(spark, o, n, want):
    t = "struct<empty_td:int,max_td_per_row:int,md_bytes:int,text_coverage:double,native_table_missing:int>"
    assert one(spark, pages.better(F.col("o"), F.col("n")), o=(t, o), n=(t, n)) == want


@pytest.mark.parametrize("native, md, types, want", [("", "", [], "no_text_layer"), ("", "w " * 12, [], "text"), ("a .... 1 b .... 2 c .... 3", "", [], "toc"), ("w " * 40, "", ["image"], "image_or_sparse"), ("w " * 5, "", [], "image_or_sparse"), ("w " * 40, "", ["table"], "table"), ("w " * 40, "| a | b |", [], "table"), ("w " * 40, "", [], "text"), ("w " * 20, "", None, "unknown"), (None, None, None, "no_text_layer")])
def test_page_type(spark, native, md, types, want):
    assert one(spark, pages.page_type("n", "m", F.col("t")), n=("string", native), m=("string", md), t=("array<string>", types)) == want


def test_inflation_boundary(spark):
    for n, want in ((20479, False), (20480, True)):
        assert one(spark, pages.inflated("m", "n"), m=("string", "x" * n), n=("string", "y" * 5120)) is want
    assert one(spark, pages.inflated("m", "n"), m=("string", "x" * 30000), n=("string", "")) is False


# anchors and tables of contents


MD = "before\n<!-- pages 1-2 -->\n# A\n## B\nkey one：12 mm\n<!-- pages 3-3 -->\ntext\n| a | b |\n|---|---|\n| 1 | 2 |\n### C\n## D\nend"


def test_anchored_markdown(spark):
    df = spark.createDataFrame([("p", MD, "x"), ("q", None, "x"), ("r", "", "x")], "k string, t string, path string")
    rows = anchors.lines(df, ["k"], "t")
    r = {x.place: (x.page_first, x.page_last) for x in anchors.page_ranges(rows, ["k"]).where("k = 'p'").collect()}
    assert r[0] == (None, None) and r[4] == (1, 2) and r[12] == (3, 3)
    assert {x.place: x.page_first for x in anchors.page_ranges(rows, ["k"], True).where("k = 'p'").collect()}[0] == 1
    assert [(b.block_no, b.lines) for b in anchors.blocks(rows, ["k"]).orderBy("block_no").collect()] == [(1, 4), (2, 8)]
    p = {x.place: x.path for x in anchors.heading_paths(rows, ["k"]).where("k = 'p'").collect()}
    assert p[1] == "" and p[4] == "A / B" and p[10] == "A / B / C" and p[12] == "A / D"
    s = anchors.sections(rows, ["k"]).orderBy("section_no").collect()
    assert [(x.kind, x.title) for x in s] == [("anchor", ""), ("h2", "B"), ("anchor", "B"), ("h2", "D")]
    assert [(x.key, x.value, x.unit, x.confidence) for x in anchors.colon_rows(rows, ["k"]).collect()] == [("key one", "12", "mm", "medium")]
    assert [(x.row_index, x.header, x.cells) for x in anchors.pipe_rows(rows, ["k"]).collect()] == [(0, ["a", "b"], ["1", "2"])]
    assert [(x.k, x.blocks) for x in anchors.read_pages(anchors.blocks(rows, ["k"]), ["k"], 2, 2).collect()] == [("p", 1)]


def test_toc_paths_and_lookups(spark):
    e = spark.createDataFrame([("p", 0, "A", 1, 0), ("p", 1, "B", 3, 1), ("p", 2, "C", 3, 1), ("p", 3, "D", 6, 0), ("p", 4, "E", None, 1)], "k string, ord int, title string, page int, depth int")
    p = toc.paths(e, ["k"])
    assert [r.path for r in p.orderBy("ord").collect()] == ["A", "A / B", "A / C", "D", "D / E"]
    assert sorted((r.first, r.last, r.path) for r in toc.exclusive_ranges(p, ["k"]).collect()) == sorted([(1, 2, "A"), (6, None, "D")], key=str)
    q = spark.createDataFrame([("p", n) for n in range(0, 8)] + [("z", 1)], "k string, page int")
    got = {(r.k, r.page): r.path for r in toc.last_path_asof(q, p, ["k"], "page").collect()}
    assert got["p", 0] is None and got["p", 2] == "A" and got["p", 5] == "A / C" and got["p", 7] == "D" and got["z", 1] is None


def test_dotted_entries(spark):
    df = spark.createDataFrame([("p", "Top ........ 3\nLeft part .....\n..... 4\n....... 9\nplain\nEnd ..... 5")], "k string, t string")
    assert [(r.title, r.page) for r in toc.dotted_entries(anchors.lines(df, ["k"], "t"), ["k"]).orderBy("place").collect()] == [("Top", 3), ("Left part", 4), ("End", 5)]


# chunking, records, checks, patches, words


def test_chunks_stay_below_the_limit():
    r = random.Random(3)
    text = "\n\n".join("".join(r.choice(["word ", "测量", "end. ", "3.5 "]) for _ in range(r.randint(1, 400))) for _ in range(8)) + "\n\n" + "长" * 900
    made = chunking.chunk(text)
    assert made and all(chunking.count(c) <= chunking.LIMIT for c in made) and chunking.chunk(None) == chunking.chunk("  ") == []


def test_conflicts_and_amendments(spark):
    df = spark.createDataFrame([("a", "k", "1", "r1"), ("a", "k", "2", "r2"), ("a", "k", "2", "r3"), ("b", None, "1", "r4"), ("b", None, "1", "r5")], "p string, key string, v string, id string")
    got = records.conflicts(df, ["p", "key"], "v", "id").collect()
    assert [(r["values"], r["members"], r["member_count"]) for r in got] == [("1;2", "r1;r2", 3)]
    fixes = spark.createDataFrame([("r1", 1, "v", "set", "7"), ("r1", 2, "v", "set", "8"), ("r2", 1, None, "drop", None), ("r3", 1, None, "move", "r9")], "id string, ord int, field string, action string, value string")
    out = {(r.id, r.v, r.status) for r in records.amend(df, fixes, "id").collect()}
    assert ("r1", "8", "current") in out and not any(x[0] == "r2" for x in out) and ("r3", "2", "superseded") in out and ("r9", "2", "current") in out
    with pytest.raises(ValueError):
        records.require_unique(df, ["p"], "df")
    with pytest.raises(ValueError):
        records.checked_lookup(df, spark.createDataFrame([("zz", 1)], "id string, extra int"), "id", "lookup")


def test_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("x", "x"), (None, "a")], "src string, dst string")
    assert sorted(r.node for r in records.cycles(e).collect()) == ["a", "b", "c", "x"]


def test_a_long_chain_is_no_cycle(spark):
    e = spark.createDataFrame([(f"n{k:03d}", f"n{k + 1:03d}") for k in range(99)] + [("x", "y"), ("y", "x")], "src string, dst string").coalesce(1)
    assert sorted(r.node for r in records.cycles(e).collect()) == ["x", "y"]


def test_checks_and_search(spark):
    df = spark.createDataFrame([(1, "ok"), (2, None)], "id int, s string")
    assert [(r.id, r.rule) for r in checks.violations(df, "id", {"s_ok": F.col("s") == "ok"}).collect()] == [(2, "s_ok")]
    last = spark.createDataFrame([("p", 3), ("q", None)], "k string, last int")
    assert [r.page for r in checks.missing_pages(spark.createDataFrame([("p", 2)], "k string, page int"), ["k"], "page", last, "last").orderBy("page").collect()] == [1, 3]
    t = spark.createDataFrame([("b", "A fuse Holder"), ("a", "fuse"), ("c", None)], "k string, t string")
    assert [r.k for r in search.search_texts(t, "k", "t", ["FUSE", "holder"], 5).collect()] == ["b"] and search.search_texts(t, "k", "t", [], 5).count() == 0


def test_apply_fixes(spark):
    b = spark.createDataFrame([("p", 1, 1, 2, "old one, old two"), ("p", 2, 3, 3, "new text")], "k string, block_no int, page_first int, page_last int, text string")
    f = spark.createDataFrame([("p", 1, 1, "old", "new", None), ("p", 2, 2, "old", "x", 5), ("p", 3, 3, "was", "new", None), ("p", 3, 4, "", "y", None)], "k string, page int, ord int, before string, after string, expected int")
    got = [(r.block_no, r.text, r.applied, r.refused) for r in patches.apply_fixes(b, f, ["k"]).orderBy("block_no").collect()]
    assert got == [(1, "new one, old two", 1, 1), (2, "new text", 0, 1)]


def test_visual_lines_and_omissions(spark):
    w = [(10.0, 10.0, 40.0, 20.0, "Lost"), (50.0, 11.0, 70.0, 21.0, "a1"), (10.0, 40.0, 30.0, 50.0, "k2"), (50.0, 41.0, 70.0, 51.0, "b2"), (10.0, 95.0, 20.0, 99.0, "foot"), (90.0, 12.0, 95.0, 19.0, "7")]
    t = "array<struct<x0:double,y0:double,x1:double,y1:double,text:string>>"
    lines = one(spark, words.visual_lines(F.col("w"), F.lit(100.0)), w=(t, w))
    assert [[x["text"] for x in ln] for ln in lines] == [["Lost", "a1"], ["k2", "b2"]]
    md = "<table><tr><td>k1</td><td>a1</td></tr><tr><td>k2</td><td>b2</td></tr><tr><td>k3</td><td>c3</td></tr></table>"
    df = spark.createDataFrame([(1, md, w, 100.0, 100.0), (2, None, None, 1.0, 1.0)], f"id int, md string, w {t}, x double, y double")
    assert {r.id: r.missing for r in words.table_omissions(df, ["id"], "md", "w", "x", "y").collect()} == {1: ["Lost"], 2: []}


def test_cleaning(spark):
    md = "# T\n![](img/rear_brake.png) and ![Alt](x.png) **b** [l](u) <b>x</b> &amp; <table><tr><td>k</td><td>v</td></tr></table>"
    assert one(spark, cleaning.clean_markdown("t"), t=("string", md)) == "T\n[示意图：刹车] and [示意图：Alt] b l x & k：v"
    df = spark.createDataFrame([(1, '{"a":[{"type":"text","content":"x","sub":{"html":"<p>"}}]}'), (2, "{bad"), (3, None)], "id int, j string")
    assert {r.id: r.texts for r in cleaning.json_texts(df, ["id"], "j").collect()} == {1: ["x", "<p>"], 2: [], 3: []}


def test_physical_pages_in_blocks(spark, monkeypatch):
    r = random.Random(4)
    titles = [r.choice("ABCDEFGH") for _ in range(60)]
    listed = [("p", r.randint(1, 5), t) for t in "ABCDEFGH" for _ in range(r.randint(0, 3))] + [("q", 2, "A")]
    own = [r.choice([None, None, 3]) for _ in titles]
    e = spark.createDataFrame([("p", k, t, o) for k, (t, o) in enumerate(zip(titles, own))] + [("z", 0, "A", None), ("q", 0, "A", None)], "k string, ord int, title string, toc_page int")
    li = spark.createDataFrame(listed, "k string, page int, title string")
    hits = {t: sorted({p for k, p, x in listed if k == "p" and x == t}) for t in "ABCDEFGH"}
    want, last = [], 0
    for t, o in zip(titles, own):
        page, last = lookup._take(hits[t], o, last)
        want.append(page)
    monkeypatch.setattr(lookup, "ENTRY_BLOCK", 7)
    got = {(x.k, x.ord): x.page for x in lookup.physical_pages(e, li, ["k"]).collect()}
    assert [got["p", k] for k in range(60)] == want and got["z", 0] is None and got["q", 0] == 2


def test_exact_pages(spark):
    p = spark.createDataFrame([("p", 1, "brake fluid DOT"), ("p", 2, "brake fluid and oil"), ("p", 5, "brake"), ("p", 6, None)], "k string, page int, text string")
    rows = spark.createDataFrame([("p", "a", "brake", 5, 6, "x"), ("p", "b", "fluid", 5, 6, "fluid oil"), ("p", "c", "none", 1, 2, ""), ("p", "d", None, 1, 2, ""), ("p", "e", "brake", 1, 2, None)], "k string, r string, key string, page_first int, page_last int, evidence string")
    got = {x.r: (x.page, x.scoped) for x in lookup.exact_pages(rows, p, ["k"], "r").collect()}
    assert got == {"a": (5, True), "b": (2, False), "e": (1, True)}


def test_audit(spark):
    df = spark.createDataFrame([(1, "<table><tr><th>名称</th><th>值</th></tr><tr><td>k</td><td>v</td></tr><tr><td></td><td></td></tr><tr><td>only</td><td></td></tr></table>")], "id int, body string")
    rows = audit.source_rows(grids.cells(df, "id", "body"), "id")
    a = audit.covered(rows, grids.key_values(df, "id", "body", key_words=T.KEY_WORDS), "id")
    assert [r.status for r in a.orderBy("row_no").collect()] == ["header", "covered", "empty", "missing"]
    assert audit.by_table(a, "id").first().asDict() == {"id": 1, "table_no": 0, "covered": 1, "missing": 1, "header": 1, "empty": 1}
    done = spark.createDataFrame([(1, 0, 3)], "id int, table_no int, row_no int")
    assert audit.gaps(a, "id").count() == 1 and audit.gaps(a, "id", done).count() == 0


def test_rules_and_paths(spark):
    f = spark.createDataFrame([("a", "draft", [1], "x", "y", None), (None, "odd", [], "", "", 0)], "fix_id string, status string, pages array<int>, before string, after string, expected int")
    got = checks.violations(f.withColumn("id", F.monotonically_increasing_id()), "id", audit.fix_rules())
    assert got.select("rule").distinct().count() == 6 and got.select("id").distinct().count() == 1
    c = spark.createDataFrame([("m_p0003", 3, ["excessive_columns"]), ("m3", 0, ["other"])], "candidate_id string, page int, signals array<string>")
    assert sorted(r.rule for r in checks.violations(c, "candidate_id", audit.candidate_rules()).collect()) == ["anchor_format", "page_positive", "signals_known"]
    t = spark.createDataFrame([("p", "a/b"), ("q", "a/b"), ("p", "c/")], "o string, path string")
    assert [(r.path, r.owners) for r in audit.overlapping(t, "o", "path").collect()] == [("a/b", 2)]
    ch = spark.createDataFrame([("a/b/x",), ("c/y",), ("d",)], "path string")
    assert [r.path for r in audit.uncovered(ch, t, "path").collect()] == ["d"]
    d = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-03-01"), ("c", None)], "k string, w string")
    assert {(r.k, r.age) for r in audit.stale(d, "k", "w", F.lit("2024-03-02").cast("date"), 30).collect()} == {("a", 61), ("c", None)}
