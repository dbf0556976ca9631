"""HTML tables as grids: one reader serves cells, span filling, structure metrics, text and layout.

The reader is lenient: a cell or row left open ends with the next one, a missing table end ends
with the text. Each table is one value of one row, so all of this is narrow: no shuffle, and the
Arrow batches hold as many tables as Spark puts into them.

Defined cases: a null text has no tables; '' and a text without <table> neither; a table
without cells has status 'empty', one with rows of different widths is 'malformed'.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TABLE = re.compile(r"<table\b[^>]*>(.*?)(?:</table\s*>|(?=<table\b)|\Z)", re.I | re.S)
_PART = re.compile(r"<(/?)(tr|td|th|thead|tbody|tfoot)\b([^>]*)>", re.I)
_SPAN = re.compile(r"""\b(colspan|rowspan)\s*=\s*["']?\s*(\d+)""", re.I)
_FENCE = re.compile(r"^(```|~~~)", re.M)
#: A span above this is read as this: no real table has more, and the number comes from outside.
MOST_SPAN = 1000

Cell = tuple[str, int, int, bool]


def text_of(fragment: str) -> str:
    return html.unescape(re.sub(r"<[^>]*>", "", fragment)).strip()


def read_rows(body: str) -> list[list[Cell]]:
    """Rows of (text, colspan, rowspan, is_th) of what stands between the table tags; empty rows are left out."""
    rows: list[list[Cell]] = []
    row: list[Cell] = []
    cell: tuple[int, int, bool] | None = None
    begin = 0

    def close(at: int) -> None:
        nonlocal cell
        if cell:
            row.append((text_of(body[begin:at]), *cell))
            cell = None

    for m in _PART.finditer(body):
        end, name = m.group(1) == "/", m.group(2).lower()
        close(m.start())
        if name in ("td", "th"):
            if not end:
                spans = {k.lower(): min(MOST_SPAN, max(1, int(v[:6]))) for k, v in _SPAN.findall(m.group(3))}
                cell, begin = (spans.get("colspan", 1), spans.get("rowspan", 1), name == "th"), m.end()
        elif row:
            rows.append(row)
            row = []
    close(len(body))
    return rows + [row] if row else rows


def read_tables(text: str | None) -> list[list[list[Cell]]]:
    return [read_rows(m.group(1)) for m in _TABLE.finditer(text)] if text else []


def fill_spans(rows: list[list[Cell]]) -> list[list[str]]:
    """Each slot of the grid: a spanning cell's text in every slot that it covers, rows padded to the widest."""
    grid: list[list[str]] = []
    pending: dict[int, tuple[str, int]] = {}
    for row in rows:
        out: list[str] = []
        cells = iter(row)
        cell = next(cells, None)
        at = 0
        while cell or any(k >= at for k in pending):
            if at in pending:
                text, left = pending.pop(at)
                out.append(text)
                if left > 1:
                    pending[at] = (text, left - 1)
                at += 1
                continue
            if cell is None:
                out.append("")
                at += 1
                continue
            text, wide, deep, _ = cell
            for k in range(wide):
                if at + k in pending and k:
                    break
                out.append(text)
                if deep > 1:
                    pending[at + k] = (text, deep - 1)
            at = len(out)
            cell = next(cells, None)
        grid.append(out)
    width = max(map(len, grid), default=0)
    return [r + [""] * (width - len(r)) for r in grid]


def logical_widths(rows: list[list[Cell]]) -> list[int]:
    """Width of each row with what the rows above reach down into it."""
    widths, reach = [], []
    for row in rows:
        carried = [(w, d - 1) for w, d in reach if d > 1]
        widths.append(sum(w for _, w, _, _ in row) + sum(w for w, _ in carried))
        reach = carried_down(row, carried)
    return widths


def carried_down(row: list[Cell], carried: list[tuple[int, int]]) -> list[tuple[int, int]]:
    return carried + [(w, d) for _, w, d, _ in row if d > 1]


def metrics(rows: list[list[Cell]]) -> dict:
    cells = [c for r in rows for c in r]
    widths = logical_widths(rows)
    empty = sum(not c[0] for c in cells)
    return {
        "rows": len(rows), "cells": len(cells), "empty_cells": empty, "empty_ratio": round(empty / len(cells), 3) if cells else None, "span_cells": sum(w > 1 or d > 1 for _, w, d, _ in cells),
        "header_cells": sum(h for *_, h in cells), "max_width": max(widths, default=0), "regular": len(set(widths)) <= 1, "status": "empty" if not cells else "ok" if len(set(widths)) == 1 else "malformed",
    }


def to_sentences(rows: list[list[Cell]]) -> str:
    """'key：value' pieces of a table joined by '；'; a title over one cell is a warning block."""
    filled = [[c[0] for c in r if c[0]] for r in rows]
    filled = [r for r in filled if r]
    if len(filled) == 2 and len(filled[0]) == len(filled[1]) == 1:
        return f"{filled[0][0]} — {filled[1][0]}"
    if filled and all(len(r) >= 2 for r in filled):
        return "；".join(f"{r[0]}：{' / '.join(r[1:])}" for r in filled)
    return "；".join(" / ".join(r) for r in filled)


def drop_twin_columns(grid: list[list[str]], wide: int = 20) -> list[list[str]]:
    """Grids of more than ``wide`` columns without the columns that repeat their left neighbour."""
    if not grid or len(grid[0]) <= wide:
        return grid
    columns = list(zip(*grid))
    keep = [k for k, c in enumerate(columns) if not k or c != columns[k - 1]]
    return [[r[k] for k in keep] for r in grid]


def pretty(text: str) -> str:
    """Tables of a Markdown text on lines of their own, indented by nesting; fenced code and unbalanced tables stay. Idempotent."""
    parts = re.split(r"(^(?:```|~~~).*?(?:^(?:```|~~~)[ \t]*$|\Z))", text, flags=re.M | re.S)

    def layout(m: re.Match) -> str:
        whole = m.group()
        tags = [(t.group(1), t.group(2).lower()) for t in re.finditer(r"<(/?)(table|thead|tbody|tfoot|tr|td|th)\b[^>]*>", whole, re.I)]
        stack: list[str] = []
        for end, name in tags:
            if not end:
                stack.append(name)
            elif not stack or stack.pop() != name:
                return whole
        if stack:
            return whole
        out, depth = [], 0
        for piece in re.split(r"(</?(?:table|thead|tbody|tfoot|tr)\b[^>]*>|<t[dh]\b[^>]*>.*?</t[dh]\s*>)", whole, flags=re.I | re.S):
            p = piece.strip()
            if not p:
                continue
            if p.startswith("</"):
                depth -= 1
            out.append("  " * depth + p)
            if re.match(r"<(?:table|thead|tbody|tfoot|tr)\b", p, re.I):
                depth += 1
        return "\n".join(out)

    return "".join(p if k % 2 else re.sub(r"<table\b[^>]*>.*?</table\s*>", layout, p, flags=re.I | re.S) for k, p in enumerate(parts))


def _mapped(df: DataFrame, key: str, text: Column | str, fn, fields: list[tuple[str, pa.DataType]], schema: str) -> DataFrame:
    kind = dict(df.select(F.col(key).alias(key)).dtypes)[key]
    arrow = pa.schema([("key", pa.string()), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in arrow.names}
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for row in fn(t):
                    out["key"].append(k)
                    for (n, _), v in zip(fields, row):
                        out[n].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    text = F.col(text) if isinstance(text, str) else text
    done = df.select(F.col(key).cast("string").alias("key"), text.alias("text")).where(F.col("text").isNotNull()).mapInArrow(run, f"key string, {schema}")
    return done.select(F.col("key").cast(kind).alias(key), *[n for n, _ in fields])


def cells(df: DataFrame, key: str, text: Column | str, fill: bool = False) -> DataFrame:
    """(key, table_no, row_no, col_no, text, colspan, rowspan, is_th), numbered from 0; with ``fill`` every slot of the grid."""

    def rows_of(t: str):
        for n, rows in enumerate(read_tables(t)):
            if fill:
                for i, r in enumerate(fill_spans(rows)):
                    for j, x in enumerate(r):
                        yield n, i, j, x, 1, 1, False
            else:
                for i, r in enumerate(rows):
                    for j, (x, w, d, h) in enumerate(r):
                        yield n, i, j, x, w, d, h

    fields = [("table_no", pa.int32()), ("row_no", pa.int32()), ("col_no", pa.int32()), ("text", pa.string()), ("colspan", pa.int32()), ("rowspan", pa.int32()), ("is_th", pa.bool_())]
    return _mapped(df, key, text, rows_of, fields, "table_no int, row_no int, col_no int, text string, colspan int, rowspan int, is_th boolean")


def structure(df: DataFrame, key: str, text: Column | str) -> DataFrame:
    """(key, table_no, rows, cells, empty_cells, empty_ratio, span_cells, header_cells, max_width, regular, status)."""
    names = ["rows", "cells", "empty_cells", "empty_ratio", "span_cells", "header_cells", "max_width", "regular", "status"]

    def rows_of(t: str):
        for n, rows in enumerate(read_tables(t)):
            m = metrics(rows)
            yield (n, *(m[x] for x in names))

    i, fields = pa.int32(), [("table_no", pa.int32())]
    fields += [("rows", i), ("cells", i), ("empty_cells", i), ("empty_ratio", pa.float64()), ("span_cells", i), ("header_cells", i), ("max_width", i), ("regular", pa.bool_()), ("status", pa.string())]
    return _mapped(df, key, text, rows_of, fields, "table_no int, rows int, cells int, empty_cells int, empty_ratio double, span_cells int, header_cells int, max_width int, regular boolean, status string")


def sentences(df: DataFrame, key: str, text: Column | str) -> DataFrame:
    """(key, table_no, sentence)."""
    return _mapped(df, key, text, lambda t: ((n, to_sentences(r)) for n, r in enumerate(read_tables(t))), [("table_no", pa.int32()), ("sentence", pa.string())], "table_no int, sentence string")


def formatted(df: DataFrame, key: str, text: Column | str) -> DataFrame:
    """(key, formatted)."""
    return _mapped(df, key, text, lambda t: [(pretty(t),)], [("formatted", pa.string())], "formatted string")


def narrowed(df: DataFrame, key: str, text: Column | str, wide: int = 20) -> DataFrame:
    """(key, table_no, row_no, cells) of the filled grids without twin columns."""

    def rows_of(t: str):
        for n, rows in enumerate(read_tables(t)):
            for i, r in enumerate(drop_twin_columns(fill_spans(rows), wide)):
                yield n, i, r

    return _mapped(df, key, text, rows_of, [("table_no", pa.int32()), ("row_no", pa.int32()), ("cells", pa.list_(pa.string()))], "table_no int, row_no int, cells array<string>")


def parent_labels(df: DataFrame, key: str, text: Column | str) -> DataFrame:
    """(key, table_no, row_no, parent): the text of the row-spanning cell above each row that it reaches down into; the row it begins in has none."""

    def rows_of(t: str):
        for n, rows in enumerate(read_tables(t)):
            label, left = "", 0
            for i, r in enumerate(rows):
                if left > 0:
                    yield n, i, label
                    left -= 1
                elif span := next((c for c in r if c[2] > 1), None):
                    label, left = span[0], span[2] - 1

    return _mapped(df, key, text, rows_of, [("table_no", pa.int32()), ("row_no", pa.int32()), ("parent", pa.string())], "table_no int, row_no int, parent string")


def key_values(df: DataFrame, key: str, text: Column | str, header_rows: int = 1, key_words: list[str] | None = None) -> DataFrame:
    """(key, table_no, row_index, name, value, category): each data row's key cell and its other cells joined by '；'.

    The key column is the first whose header holds one of ``key_words``, else the first. A row
    of six or more equal cells is a category that holds for the rows after it.
    """
    words = key_words or []

    def rows_of(t: str):
        for n, rows in enumerate(read_tables(t)):
            grid = fill_spans(rows)
            head = grid[0] if grid else []
            at = next((j for j, h in enumerate(head) if any(w in h for w in words)), 0)
            category = ""
            for i, r in enumerate(grid[header_rows:]):
                if len(r) >= 6 and all(r) and len(set(r)) == 1:
                    category = r[0]
                    continue
                name = r[at] if at < len(r) else ""
                value = "；".join(dict.fromkeys(x for j, x in enumerate(r) if j != at and x))
                if name and value:
                    yield n, i, name, value, category

    return _mapped(df, key, text, rows_of, [("table_no", pa.int32()), ("row_index", pa.int32()), ("name", pa.string()), ("value", pa.string()), ("category", pa.string())], "table_no int, row_index int, name string, value string, category string")


def structure_differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Cells that two readings (from cells()) don't share: (key, table_no, row_no, col_no, left_text, right_text, kind)."""
    at = [key, "table_no", "row_no", "col_no"]
    both = a.select(*at, F.struct("text", "colspan", "rowspan").alias("l")).join(b.select(*at, F.struct("text", "colspan", "rowspan").alias("r")), at, "full_outer")
    kind = F.when(F.col("l").isNull(), "added").when(F.col("r").isNull(), "removed").when(F.col("l.text") != F.col("r.text"), "text").when((F.col("l.colspan") != F.col("r.colspan")) | (F.col("l.rowspan") != F.col("r.rowspan")), "span")
    return both.withColumn("kind", kind).where(F.col("kind").isNotNull()).select(*at, F.col("l.text").alias("left_text"), F.col("r.text").alias("right_text"), "kind")
