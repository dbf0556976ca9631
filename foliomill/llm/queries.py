"""The queries of the training-data problems, over the tables of a data directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import table
from . import bpe, lookalikes, markup, packing, repetition, scans, splitting, truncation


def _q(fn: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(*(table(spark, sf_dir, t) for t in tables))


def p1_shares(chunks: DataFrame) -> DataFrame:
    return repetition.repetition(chunks, "id", "content", "package_id").select("id", "lang", "units", "repeated", F.round("share", 6).alias("share"))


def p1_thresholds(chunks: DataFrame) -> DataFrame:
    return repetition.thresholds(repetition.repetition(chunks, "id", "content", "package_id"))


def p1_unusual(chunks: DataFrame) -> DataFrame:
    return repetition.unusual(repetition.repetition(chunks, "id", "content", "package_id"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": _q(repetition.p1_found, "chunks"),
        "p1_shares": _q(p1_shares, "chunks"),
        "p1_thresholds": _q(p1_thresholds, "chunks"),
        "p1_unusual": _q(p1_unusual, "chunks"),
        "p2_found": _q(markup.p2_found, "chunks", "content_list"),
        "p2_text": _q(markup.p2_text, "chunks", "content_list"),
        "p3_found": _q(splitting.p3_found, "chunks"),
        "p3_pieces": _q(splitting.p3_pieces, "chunks"),
        "p4_found": _q(scans.p4_found, "chunks", "vlm_eval", "packages"),
        "p4_text": _q(scans.p4_text, "chunks", "vlm_eval", "packages"),
        "p5_found": _q(lookalikes.p5_found, "chunks", "toc_tree"),
        "p5_text": _q(lookalikes.p5_text, "chunks", "toc_tree"),
        "p6_ids": _q(bpe.p6_ids, "documents"),
        "p7_containers": _q(packing.p7_containers, "documents"),
        "p7_fill": _q(packing.p7_fill, "documents"),
        "p8_found": _q(truncation.p8_found, "documents"),
        "p8_sources": _q(truncation.p8_sources, "documents"),
    }
