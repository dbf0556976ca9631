"""The whole cleaning of Markdown for chunks, and text from nested JSON."""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .grids import read_tables, to_sentences

# Words in file names and what they show, the first hit counts.
HINTS = {
    "oil": "机油", "engine": "发动机", "frame": "车架", "brake": "刹车", "tire": "轮胎", "wheel": "车轮", "light": "灯光", "switch": "开关", "meter": "仪表", "fuel": "燃油",
    "coolant": "冷却液", "battery": "蓄电池", "fuse": "保险丝", "lock": "锁", "seat": "座椅", "helmet": "头盔", "storage": "储物", "mirror": "后视镜", "handle": "把手", "pedal": "踏板",
    "chain": "链条", "belt": "皮带", "filter": "滤清器", "pump": "泵", "valve": "阀门", "spring": "弹簧", "shock": "减震", "clutch": "离合器", "gear": "齿轮", "shaft": "轴",
    "bolt": "螺栓", "nut": "螺母", "screw": "螺丝", "washer": "垫圈", "bearing": "轴承", "seal": "密封", "gasket": "垫片", "hose": "软管", "pipe": "管路", "tank": "油箱",
    "cap": "盖子", "cover": "盖子", "panel": "面板", "cable": "线缆", "wire": "电线", "connector": "接头", "sensor": "传感器", "relay": "继电器", "motor": "电机", "fan": "风扇",
    "radiator": "散热器", "exhaust": "排气", "intake": "进气", "carburetor": "化油器", "injector": "喷油器", "cylinder": "气缸", "piston": "活塞", "crank": "曲轴", "cam": "凸轮",
}
LABEL = "示意图"
_IMAGE = r"^!\[([^\]]*)\]\(([^)]+)\)"
_TABLE = re.compile(r"<table[^>]*>.*?</table>", re.S | re.I)


def image_labels(c: Column | str) -> Column:
    """Images to [示意图：text]: the alternative text, else what the file name hints at, else the bare label."""
    t = F.col(c) if isinstance(c, str) else c

    def label(part: Column) -> Column:
        alt, name = T.strip(F.regexp_extract(part, _IMAGE, 1)), F.lower(F.element_at(F.split(F.regexp_extract(part, _IMAGE, 2), "/"), -1))
        hint = F.lit(None).cast("string")
        for word, shown in reversed(HINTS.items()):
            hint = F.when(F.contains(name, F.lit(word)), F.lit(shown)).otherwise(hint)
        what = F.when(alt != "", alt).otherwise(hint)
        return F.concat(F.lit(f"[{LABEL}"), F.coalesce(F.concat(F.lit("："), what), F.lit("")), F.lit("]"))

    parts = F.split(t, r"(?=!\[)")
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(_IMAGE), F.concat(label(p), F.regexp_replace(p, _IMAGE, ""))).otherwise(p)), "")


def tables_to_text(c: Column | str) -> Column:
    """Tables within a text to their sentences; Arrow-batched, and skipped by rows without a table."""

    @F.arrow_udf("string")
    def write(texts: pa.Array) -> pa.Array:
        return pa.array([t if t is None else _TABLE.sub(lambda m: "；".join(to_sentences(r) for r in read_tables(m.group())), t) for t in texts.to_pylist()], pa.string())

    t = F.col(c) if isinstance(c, str) else c
    return F.when(t.rlike("(?i)<table"), write(t)).otherwise(t)


def clean_markdown(c: Column | str) -> Column:
    """Images, tables, headings, inline marks, tags and white space, in this order."""
    return T.clean_prose(tables_to_text(image_labels(c)))


def walk_texts(value: object) -> list[str]:
    """Texts of a nested JSON value in order: the content of {type: text} and every html field."""
    if isinstance(value, list):
        return [t for v in value for t in walk_texts(v)]
    if not isinstance(value, dict):
        return []
    own = [value["content"]] if value.get("type") == "text" and isinstance(value.get("content"), str) else []
    own += [value["html"]] if isinstance(value.get("html"), str) else []
    return own + [t for v in value.values() if isinstance(v, (dict, list)) for t in walk_texts(v)]


def json_texts(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, texts) of JSON strings; null and malformed values have none."""

    @F.arrow_udf("array<string>")
    def walk(col: pa.Array) -> pa.Array:
        def one(s: str | None) -> list[str]:
            try:
                return walk_texts(json.loads(s)) if s else []
            except ValueError:
                return []

        return pa.array([one(s) for s in col.to_pylist()], pa.list_(pa.string()))

    return df.select(*keys, walk(F.col(column)).alias("texts"))


def links(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, place, label, target, kind) of the Markdown links of lines: anchor, external or path."""
    pattern = r"(?<!!)\[([^\]\n]*)\]\(([^)\s]+)\)"
    found = rows.select(*keys, "place", F.explode(F.arrays_zip(F.regexp_extract_all("line", F.lit(pattern), F.lit(1)).alias("label"), F.regexp_extract_all("line", F.lit(pattern), F.lit(2)).alias("target"))).alias("x"))
    target = F.col("x.target")
    kind = F.when(target.startswith("#"), "anchor").when(target.rlike(r"^[a-z][a-z0-9+.-]*:"), "external").otherwise("path")
    return found.select(*keys, "place", F.col("x.label").alias("label"), target.alias("target"), kind.alias("kind"))
