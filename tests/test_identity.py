"""Identity by source position, pair groups, first-column parents and sections of page ranges."""

import hashlib

import pytest
from pyspark.sql import functions as F

from foliomill.operators import anchors, chunking, identity, lookup, patches, records, sequences

HASH = "AB" * 32


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(
    "file_hash, block, table, row, anchor, error",
    [
        (HASH, "html_table:7", "html_table:7", "2", f"{HASH.lower()}|html_table|7|2|0", None), (HASH, None, "md_table:1", "3.1", f"{HASH.lower()}|md_table|1|3|1", None),
        (HASH, "paragraph:4", "", None, f"{HASH.lower()}|paragraph|4|0|0", None), (HASH, "paragraph:4", None, "1", None, "paragraph_row"), ("xx", "paragraph:4", None, "", None, "source_hash"),
        (HASH, "html_table:7", "html_table:8", "2", None, "positions_differ"), (HASH, "figure:7", "", "2", None, "source_position"), (HASH, None, None, None, None, "source_position"),
        (HASH, "html_table:7", "", "0", None, "table_row"), (HASH, "html_table:7", "", "", None, "table_row"), (HASH, "html_table:7", "", "2.x", None, "slot"), (HASH, "html_table:7", "", "2.", None, "slot"),
        (HASH, "html_table:7", "", "99999999999999999999", f"{HASH.lower()}|html_table|7|99999999999999999999|0", None),
    ],
)
def test_source_anchor(spark, file_hash, block, table, row, anchor, error):
    df = spark.createDataFrame([(file_hash, block, table, row)], "h string, b string, t string, r string")
    got = df.select(identity.source_anchor("h", "b", "t", "r").alias("a")).select("a.*", identity.anchored_id(F.col("a.anchor")).alias("id")).first()
    assert (got.anchor, got.error) == (anchor, error)
    assert got.id == (sha("candidate-v2|" + anchor) if anchor else None)


def test_content_hash(spark):
    df = spark.createDataFrame([("f", "m", "s", "k", None, "u", "e", "h", "c")], "source_pdf string, model string, section_path string, key string, value string, unit string, evidence_text string, row_hash string, candidate_id string")
    got = df.select(identity.content_hash(1).alias("a"), identity.content_hash(2).alias("b")).first()
    assert got.a == sha("candidate-content-v1|f|m|s|k||u|e|h") and got.b == sha("candidate-review-v2|c|k||u|e")
    with pytest.raises(ValueError):
        identity.content_hash(3)


def brute_groups(row, groups):
    out = []
    for k, (key, values, marker) in enumerate(groups, 1):
        used = [key, *[c for _, c in values], *([] if marker is None else [marker])]
        if any(not 0 <= c < len(row) for c in used):
            continue
        value = "；".join(f"{label}={(row[c] or '').strip()}" for label, c in values if (row[c] or "").strip())
        if (row[key] or "").strip() and value:
            out.append((k, row[key].strip(), (row[marker] or "").strip() if marker is not None else "", value))
    return out


def test_pair_groups(spark):
    rows = [["a", "1", "b", "2", "*"], ["a", " ", "b", None, ""], [], ["a", "1"], [None, "1", " b ", "2", " m "]]
    sets = [[(0, [("v", 1)], None), (2, [("v", 3), ("w", 1)], 4)], [(9, [("v", 1)], None)], [(0, [("v", 1)], 7)], [], [(2, [], None)], [(-1, [("v", 1)], None)]]
    every = [(r, g) for r in rows for g in sets]
    df = spark.createDataFrame([(k, r, g) for k, (r, g) in enumerate(every)], "k int, cells array<string>, groups array<struct<key_column:int,value_columns:array<struct<label:string,column:int>>,marker_column:int>>")
    got = {x.k: [tuple(s) for s in x.g] for x in df.select("k", identity.pair_groups("cells", "groups").alias("g")).collect()}
    assert got == {k: brute_groups(r, g) for k, (r, g) in enumerate(every)}
    assert df.select(identity.pair_groups("cells", F.lit(None).cast(df.schema["groups"].dataType)).alias("g")).where(F.size("g") > 0).isEmpty()


def test_first_column_parents(spark):
    rows = [("t", "A", "x", 1, ""), ("t", "A", "y", 1, "P"), ("t", "B", "B", 1, None), ("t", "", "z", 1, ""), ("u", "A", "x", 1, ""), ("u", "A", "y", 1, ""), (None, "C", "q", 1, ""), (None, "C", "r", 0, ""), (None, "D", "s", 1, "")]
    df = spark.createDataFrame(rows, "t string, first string, key string, key_column int, parent string")
    got = {(r.t, r.key): r.parent for r in identity.first_column_parents(df, ["t"], "first", "key", "key_column", "parent").collect()}
    assert got == {("t", "x"): "A", ("t", "y"): "P", ("t", "B"): "", ("t", "z"): "", ("u", "x"): "", ("u", "y"): "", (None, "q"): "C", (None, "r"): "", (None, "s"): "D"}


def test_one_section(spark):
    ranges = spark.createDataFrame([("p", 1, 4, "A"), ("p", 5, None, "B"), ("q", 3, 3, "C")], "k string, first int, last int, path string")
    rows = [(1, "p", 2, 4), (2, "p", 4, 5), (3, "p", 7, 900), (4, "q", 1, 2), (5, "q", 3, 3), (6, "q", 4, 4), (7, "p", None, 3), (8, "p", 3, 2), (9, "p", 0, 2), (10, None, 1, 1)]
    got = {r.id: (r.path, r.error) for r in identity.one_section(spark.createDataFrame(rows, "id int, k string, page_first int, page_last int"), ranges, ["k"], "id").collect()}
    none, bad = (None, "section_not_unique"), (None, "invalid_page_range")
    assert got == {1: ("A", None), 2: none, 3: ("B", None), 4: none, 5: ("C", None), 6: none, 7: (None, "missing_page_range"), 8: bad, 9: bad, 10: none}


def test_numbering_and_cells(spark):
    df = spark.createDataFrame([(None, None), ("verified", None), (None, "offset"), ("proposed", "unknown")], "s string, m string")
    got = [tuple(r.x) for r in df.select(identity.numbering_safety("s", "m").alias("x")).collect()]
    assert got == [(False, "missing", "numbering_missing"), (True, "verified", None), (False, "needs_review", "offset_unverified"), (False, "proposed", "mapping_unknown")]
    c = spark.createDataFrame([(" a \n b", "ab"), (None, ""), ("a", "b")], "a string, b string").select(identity.cell_form("a").alias("f"), identity.cells_equal("a", "b").alias("e")).collect()
    assert [tuple(r) for r in c] == [("a b", True), ("", True), ("a", False)]


def test_conflicts_by_member(spark):
    c = spark.createDataFrame([("c2", "m1;m2"), ("c1", "m1;m1;m3")], "conflict_id string, members string")
    assert {r.member: r.conflict_ids for r in identity.conflicts_by_member(c).collect()} == {"m1": "c1;c2", "m2": "c2", "m3": "c1"}


def test_a_bridge_between_cycles_is_on_none(spark):
    e = [("a", "b"), ("b", "a"), ("b", "m"), ("m", "n"), ("n", "x"), ("x", "y"), ("y", "z"), ("z", "x"), ("q", "q"), ("q", "a"), ("z", "t")]
    df = spark.createDataFrame(e, "src string, dst string").coalesce(1)
    assert sorted(r.node for r in records.cycles(df).collect()) == ["a", "b", "q", "x", "y", "z"]


def test_previous_row_over_blocks(spark):
    df = spark.createDataFrame([("p", k * 7, k % 5) for k in range(60)] + [("q", 3, None), ("q", 9, 1), (None, 1, 4)], "k string, at int, v int")
    got = {(r.k, r.at): r.b for r in sequences.previous(df, ["k"], F.col("at"), F.col("v"), "b", 40).collect()}
    assert all(got["p", k * 7] == ((k - 1) % 5 if k else None) for k in range(60)) and got["q", 9] is None and got[None, 1] is None


def test_fixes_may_empty_a_text_where_allowed(spark):
    b = spark.createDataFrame([("p", 1, 1, 2, "one two"), ("p", 2, 2, 3, "three")], "k string, block_no int, page_first int, page_last int, text string")
    f = spark.createDataFrame([("p", 2, 1, "two", "", None, True), ("p", 3, 2, "three", "", None, False), ("p", 9, 3, "x", "y", None, True)], "k string, page int, ord int, before string, after string, expected int, allow_empty boolean")
    assert {r.block_no: (r.text, r.applied, r.refused) for r in patches.apply_fixes(b, f, ["k"]).collect()} == {1: ("one ", 1, 0), 2: ("three", 0, 1)}


def test_title_recall(spark):
    e = spark.createDataFrame([("p", t) for t in ("Oil", "Oil pump", "Filter", "", None, "Oil")] + [("q", "x")], "k string, title string")
    p = spark.createDataFrame([("p", 1, "Oil pumps"), ("p", 2, None), ("p", 3, "Filters, Oil"), ("r", 1, "x")], "k string, page int, text string")
    assert sorted((r.k, r.page, r.found, r.titles, r.recall) for r in lookup.title_recall(e, p, ["k"]).collect()) == [("p", 1, 2, 3, 0.6667), ("p", 2, 0, 3, 0.0), ("p", 3, 2, 3, 0.6667)]


def test_truncated_paths(spark):
    import random

    r = random.Random(2)
    rows, want = [], {}
    for doc in range(6):
        path = []
        for n in range(40):
            level = r.choice([1, 1, 2, 3, 3, 4, 6]) if r.random() < 0.7 else None
            rows.append((doc, n * 3, level, f"t{n}" if level else None))
            if level:
                path = [*(path[: level - 1] if len(path) >= level else path), f"t{n}"]
                want[doc, n * 3] = " / ".join(path)
    df = spark.createDataFrame(rows, "d int, place long, level int, title string")
    assert {(x.d, x.place): x.path for x in anchors.truncated_paths(df, ["d"]).collect()} == want
    assert {(x.d, x.at): x.m for x in sequences.running_min(spark.createDataFrame([(1, k, [5, 3, None, 4, 2, 9][k]) for k in range(6)], "d int, at int, v int"), ["d"], F.col("at"), F.col("v"), "m", 2).collect()} == {(1, k): [5, 3, 3, 3, 2, 2][k] for k in range(6)}


def test_shared_ids(spark):
    rows = [("a", "1", "x", ""), ("a", "2", "y", ""), ("b", "1", "x", "old"), ("b", "", "y", "source_anchor_collision;z"), ("c", "1", "x", None), ("c", "2", "x", None), ("d", "1", "x", None), (None, "1", "p", None), (None, "2", "q", None)]
    df = spark.createDataFrame(rows, "id string, r string, v string, notes string")
    got = sorted((x.id or "-", x.r) for x in identity.distinguished(df, "id", "r", ["v"]).collect())
    assert got == sorted([(f"a-{sha('x')[:16]}", "1"), (f"a-{sha('y')[:16]}", "2"), ("b", "1"), ("b", ""), ("c", "1"), ("c", "2"), ("d", "1"), ("-", "1"), ("-", "2")])
    notes = sorted((x.id or "-", x.notes) for x in identity.flagged_collisions(df, "id", "notes").collect())
    m = "source_anchor_collision"
    assert notes == sorted([("a", m), ("a", m), ("b", "old;" + m), ("b", m + ";z"), ("c", m), ("c", m), ("-", m), ("-", m)])


def test_data_fixes_and_builders(spark):
    f = [(1, "fix_data", "applied", " r1 ", "value", None, "5", "f1"), (2, "fix_data", "draft", "r1", "value", "set", "6", "f2"), (3, "fix_data", "applied", "r1", "", "set", "6", "f3"), (4, "other", "applied", "r1", "value", "set", "6", "f4"), (5, "fix_data", "applied", "r2", "unit", "rekey", None, "f5")]
    df = spark.createDataFrame(f, "ord int, review_action string, status string, target_record_id string, target_field string, field_action string, new_value string, fix_id string")
    assert [tuple(r) for r in identity.data_fixes(df).orderBy("ord").collect()] == [("r1", 1, "value", "amend", "5", "f1"), ("r2", 5, "unit", "rekey", "", "f5")]
    one = spark.createDataFrame([("pk", [3], "31, 13,13"), ("pk", [7, 8, 12345], " "), ("pk", None, None)], "p string, n array<int>, s string")
    got = [tuple(r) for r in one.select(identity.table_id("p", "n"), identity.page_list("s")).collect()]
    assert got == [("pk_table_p0003", [13, 31]), ("pk_table_p0007-p12345", None), ("pk_table_unknown", None)]
    for bad in ("3,,4", "0", "a", "1.5"):
        with pytest.raises(Exception, match="pages"):
            spark.createDataFrame([(bad,)], "s string").select(identity.page_list("s")).collect()


def test_export_of_chunks(spark, tmp_path):
    made = chunking.chunks(spark.createDataFrame([("a", "one two. " * 300), ("b", None)], "k string, t string"), ["k"], "t")
    assert chunking.export(made, str(tmp_path / "c"), ["k", "chunk_no"]) == made.count() == spark.read.json(str(tmp_path / "c")).count() > 1
    for bad in (made.unionAll(made), made.withColumn("token_count", F.lit(385)), made.withColumn("content", F.lit(" "))):
        with pytest.raises(ValueError):
            chunking.export(bad, str(tmp_path / "d"), ["k", "chunk_no"])
    assert not (tmp_path / "d").exists()
