"""Session helpers shared by queries, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filled(frame):
    """A frame of results if it has rows: Arrow can't type the text columns of an empty one."""
    if len(frame):
        yield frame


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the cluster names; a local one only where none is set (tests)."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "opinlake-checkpoint"))


def local_session(cores: str = "8", memory: str = "12g", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
