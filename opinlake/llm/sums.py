"""Sums of fixed-size arrays over whole tables, and tables kept in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir

PIECE = 1 << 12


def kept(df: DataFrame, name: str) -> DataFrame:
    """The table written once to the shared folder and read again."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def summed(df: DataFrame, count: Callable[[pd.DataFrame, np.ndarray], None], size: int) -> np.ndarray:
    """The array of ``size`` numbers to which ``count`` adds what each batch holds. A task sums its own batches; the tasks' arrays are cut into
    pieces that are summed in the order of the tasks, so that the driver gets one array, however many tasks there are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for b in batches:
            count(b, total)
        task = TaskContext.get().partitionId()
        for a in range(0, size, PIECE):
            part = total[a:a + PIECE]
            if part.any():
                yield pd.DataFrame({"at": [a], "task": [task], "data": [part.tobytes()]})

    def add(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("task")
        total = np.frombuffer(b["data"].iloc[0]).copy()
        for x in b["data"].iloc[1:]:
            total += np.frombuffer(x)
        return pd.DataFrame({"at": b["at"].iloc[:1].to_numpy(), "data": [total.tobytes()]})

    out = np.zeros(size)
    for r in df.mapInPandas(run, "at long, task long, data binary").groupBy("at").applyInPandas(add, "at long, data binary").collect():
        part = np.frombuffer(r["data"])
        out[r["at"]:r["at"] + len(part)] = part
    return out
