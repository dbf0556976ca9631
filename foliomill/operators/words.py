"""Words with places on a page: visual lines, and table texts that the extraction left out.

Words are arrays of (x0, y0, x1, y1, text), one array a page, so each page is one value and
nothing is shuffled. Defined cases: null or empty arrays give no lines and nothing missing.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import FULL_WIDTH, HALF_WIDTH, TABLE_ASCII, TABLE_SIGNS
from .grids import fill_spans, read_tables

#: Words below this share of the page's height are its foot; the header band above the first data row, as a share of the height.
FOOT, HEADER_BAND = 0.85, 0.15
_FORM = str.maketrans(FULL_WIDTH + TABLE_SIGNS, HALF_WIDTH + TABLE_ASCII)


def _form(text: str) -> str:
    return "".join(text.translate(_FORM).split())


def visual_lines(words: Column, height: Column) -> Column:
    """Lines of a page as arrays of words: sorted by y0 and x0, a new line where y0 lies below all y1 before it; blanks, numbers and the foot are left out."""
    kept = F.filter(words, lambda w: (F.trim(w["text"]) != "") & ~F.trim(w["text"]).rlike(r"^\d+$") & (w["y0"] <= height * FOOT))
    order = F.array_sort(F.transform(kept, lambda w: F.struct(w["y0"], w["x0"], w["x1"], w["y1"], w["text"])))
    empty = F.struct(F.array().cast("array<array<struct<y0:double,x0:double,x1:double,y1:double,text:string>>>").alias("lines"), F.lit(float("-inf")).alias("low"))

    def step(acc: Column, w: Column) -> Column:
        fresh = (F.size(acc["lines"]) == 0) | (w["y0"] > acc["low"])
        grown = F.concat(F.slice(acc["lines"], F.lit(1), F.greatest(F.size(acc["lines"]) - 1, F.lit(0))), F.array(F.concat(F.coalesce(F.try_element_at(acc["lines"], F.lit(-1)), F.array().cast("array<struct<y0:double,x0:double,x1:double,y1:double,text:string>>")), F.array(w))))
        return F.struct(F.when(fresh, F.concat(acc["lines"], F.array(F.array(w)))).otherwise(grown).alias("lines"), F.greatest(acc["low"], w["y1"]).alias("low"))

    return F.aggregate(order, empty, step, lambda acc: acc["lines"])


def omitted(md: str | None, words: list[dict] | None, width: float, height: float) -> list[str]:
    """Words of table rows, left of the table's other columns, that no cell of its first column holds; and words above an empty header row."""
    grids = [fill_spans(t) for t in read_tables(md) if len(t) >= 3]
    cells = {_form(c) for g in grids for r in g for c in r if c.strip()}
    first = {_form(r[0]) for g in grids for r in g if r and r[0].strip()}
    lines: list[list[dict]] = []
    low = float("-inf")
    for w in sorted((w for w in words or () if w["text"].strip() and not w["text"].strip().isdigit() and w["y0"] <= height * FOOT), key=lambda w: (w["y0"], w["x0"])):
        if not lines or w["y0"] > low:
            lines.append([])
        lines[-1].append(w)
        low = max(low, w["y1"])
    if not cells or not lines:
        return []
    known = [w["x0"] for ln in lines for w in ln if _form(w["text"]) in cells]
    split = max(width * 0.3, min(known) * 0.9 if known else width * 0.4)
    missing: set[str] = set()
    in_table = [ln for ln in lines if any(_form(w["text"]) in cells for w in ln)]
    for ln in in_table:
        left = [w for w in ln if _form(w["text"]) not in cells and w["x0"] < split]
        found: set[int] = set()
        for i in range(len(left)):
            whole = ""
            for j in range(i, len(left)):
                if i in found or j > i and left[j]["x0"] - left[j - 1]["x1"] > 2 * (left[j - 1]["x1"] - left[j - 1]["x0"]):
                    break
                whole += " " + left[j]["text"]
                if _form(whole) in first:
                    found.update(range(i, j + 1))
                    break
        missing.update(w["text"] for i, w in enumerate(left) if i not in found)
    if in_table and any(g and not any(c.strip() for c in g[0]) for g in grids):
        top = min(w["y0"] for w in in_table[0])
        x0, x1 = min(w["x0"] for ln in in_table for w in ln), max(w["x1"] for ln in in_table for w in ln)
        body = _form(md or "")
        for ln in lines:
            if top - height * HEADER_BAND <= min(w["y0"] for w in ln) < top:
                missing.update(w["text"] for w in ln if _form(w["text"]) not in body and w["x1"] >= x0 and w["x0"] <= x1)
    return sorted(missing)


def table_omissions(df: DataFrame, keys: list[str], md: str, words: str, width: str, height: str) -> DataFrame:
    """(keys, missing): the omitted words of each page."""

    @F.arrow_udf("array<string>")
    def find(m: pa.Array, w: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([omitted(*row) for row in zip(m.to_pylist(), w.to_pylist(), x.to_pylist(), y.to_pylist())], pa.list_(pa.string()))

    return df.select(*keys, find(md, words, width, height).alias("missing"))
