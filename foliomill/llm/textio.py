"""Arrow plumbing shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one Arrow record batch turned into Python strings at a time.
SLICE = 4096


def map_slices(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Map every batch of ``df``, as lists by column, to lists by column of ``schema``.

    A narrow operation: no shuffle, and no more than SLICE rows are held as Python objects.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                out = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def fold_slices(df: DataFrame, start: Callable[[], object], step: Callable[[object, dict[str, list]], None], finish: Callable[[object], Iterator[pa.RecordBatch]], schema: str, every: int = 200_000) -> DataFrame:
    """Pre-aggregate each partition in Python; the state is given out whenever it holds ``every`` entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                step(state, {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                if len(state) > every:
                    yield from finish(state)
                    state = start()
        yield from finish(state)

    return df.mapInArrow(run, schema)


def keyed(df: DataFrame, src: str, key: str, text: Column) -> DataFrame:
    """(src, row_key, text): the common form of the texts of several tables."""
    return df.select(F.lit(src).alias("src"), F.col(key).cast("string").alias("row_key"), text.alias("text"))


def once(df: DataFrame, *keys: str) -> DataFrame:
    """One row for each key. Repeated rows are equal in what the operators read, so any of them will do."""
    return df.dropDuplicates(list(keys))
