"""Session, table access and lineage cuts shared by every operator."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", name: str = "foliomill", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own session."""
    os.environ.setdefault("TZ", "UTC")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory; a table is a Parquet file or a folder of them."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint.

    The folder is the one that ``spark.checkpoint.dir`` names and all executors share, so the
    result survives the loss of executors. Only where nothing is set (a local session) a
    temporary folder of this machine is taken.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", "") and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="foliomill-"))
    return df.checkpoint(eager=True)


def require(ok: bool, message: str) -> None:
    """Driver-side gate of the operators that refuse a whole input."""
    if not ok:
        raise ValueError(message)
