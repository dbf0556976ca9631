import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as S

from foliomill.sources import files
from foliomill.streaming import arrivals


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x "q", y\nz', "drop"), ("b", "", "drop")], "key string, value string, other string")
    files.write_csv(df, f"{tmp_path}/c", ["key", "value"])
    back = {r.key: r.value for r in files.read_csv(spark, f"{tmp_path}/c").collect()}
    assert back == {"a": 'x "q", y\nz', "b": ""}
    with pytest.raises(ValueError):
        files.read_csv(spark, f"{tmp_path}/c", files.DRAFT)
    with pytest.raises(ValueError):
        (tmp_path / "d.csv").write_text("key,v\na,1\na,2\n")
        files.read_keyed_csv(spark, f"{tmp_path}/d.csv", "key")


def test_jsonl(spark, tmp_path):
    schema = S.StructType([S.StructField("id", S.StringType()), S.StructField("n", S.IntegerType())])
    (tmp_path / "a.jsonl").write_text('{"id":"x","n":1}\n\n{"id":"测"}\n')
    assert sorted((r.id, r.n) for r in files.read_jsonl(spark, f"{tmp_path}/a.jsonl", schema).collect()) == [("x", 1), ("测", None)]
    (tmp_path / "b.jsonl").write_text('{"id":"x"}\nnot json\n')
    with pytest.raises(ValueError):
        files.read_jsonl(spark, f"{tmp_path}/b.jsonl", schema)
    assert files.read_jsonl(spark, f"{tmp_path}/b.jsonl", schema, strict=False).count() == 1
    files.write_jsonl(spark.createDataFrame([("测", None)], schema), f"{tmp_path}/out")
    assert json.loads(spark.read.text(f"{tmp_path}/out").first().value) == {"id": "测", "n": None}


def test_package_files(spark, tmp_path):
    for name, text in (("p0001-0002/b.md", "B"), ("p0001-0002/a.md", "A"), ("p0003-0003-rerun/a.md", "no"), ("p0003-0003/x.md", "C")):
        (tmp_path / "segments" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "segments" / name).write_text(text)
    (tmp_path / "segments/p0001-0002/x_content_list.json").write_text('[{"type":"table","page_idx":0,"table_body":"<table>"},{"type":"text","text":"t"}]')
    assert [(r.start_page, r.end_page, r.text) for r in files.read_segments(spark, str(tmp_path)).orderBy("start_page").collect()] == [(1, 2, "A"), (3, 3, "C")]
    assert [(r.item_no, r.type) for r in files.read_content_lists(spark, str(tmp_path)).orderBy("item_no").collect()] == [(0, "table"), (1, "text")]
    (tmp_path / "m.md").write_text("x")
    assert files.canonical_path(str(tmp_path), "m.md").endswith("m.md")
    for bad in ("../m.md", "/etc/passwd", None, "none.md"):
        with pytest.raises(ValueError):
            files.canonical_path(str(tmp_path), bad)
    assert files.file_digests(spark, f"{tmp_path}/segments").count() == 5
    (tmp_path / "new").mkdir()
    (tmp_path / "old").mkdir()
    files.publish(str(tmp_path / "new"), str(tmp_path / "old"))
    assert not (tmp_path / "new").exists() and not (tmp_path / "old.aside").exists()


def test_streams(spark, tmp_path):
    rows = [("p", 1, "a", "2024-01-01 00:10:00"), ("p", 1, "a", "2024-01-01 00:20:00"), ("p", 1, "b", "2024-01-01 01:00:00"), ("q", 2, None, "2024-01-01 01:30:00")]
    df = spark.createDataFrame(rows, "k string, page int, text string, t string").withColumn("t", F.to_timestamp("t"))
    df.limit(2).coalesce(1).write.parquet(f"{tmp_path}/in")
    df.subtract(df.limit(2)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    src = arrivals.stream(spark, f"{tmp_path}/in", df.schema, 1)
    q = arrivals.first_seen(src, ["k", "page"], "text", "t").writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("SELECT * FROM seen").count() == 3
    q = arrivals.keep_latest(src, ["k", "page"], ["t"], f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination(120)
    got = {(r.k, r.page): r.text for r in spark.read.parquet(f"{tmp_path}/out/v=1").collect()}
    assert got == {("p", 1): "b", ("q", 2): None}
    q = arrivals.arrivals_per_hour(src, "k", "t").writeStream.format("memory").queryName("hours").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.k, r["rows"]) for r in spark.sql("SELECT * FROM hours").collect()) == [("p", 1), ("p", 2), ("q", 1)]
