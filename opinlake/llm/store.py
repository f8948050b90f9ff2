"""Fitted models kept between queries.

Where the session sets ``spark.opinlake.models`` to a shared folder, a model is written there under its name and the fingerprint of what it was fitted on,
and read instead of being fitted again; without it every query fits its own. A changed table, parameter or package version has another fingerprint.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "spark.opinlake.models"


def fingerprint(tables: list[DataFrame], parameters: tuple = ()) -> str:
    """Number and summed hashes of the rows of each table, whatever their order, and the parameters."""
    seen = []
    for t in tables:
        r = t.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*t.columns).cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(7), *t.columns)).alias("x")).first()
        seen.append((sorted(t.columns), r["n"], str(r["s"]), r["x"]))
    return hashlib.sha256(repr((seen, parameters)).encode()).hexdigest()[:24]


def load(spark: SparkSession, path: str):
    """The model of a folder, or None."""
    try:
        return pickle.loads(spark.read.parquet(path).first()["model"])  # written by ``save``: the folder must be the application's own
    except AnalysisException:
        return None


def save(spark: SparkSession, path: str, model) -> None:
    spark.createDataFrame([(bytearray(pickle.dumps(model)),)], "model binary").write.mode("overwrite").parquet(path)


def fitted(spark: SparkSession, name: str, tables: list[DataFrame], parameters: tuple, fit: Callable):
    """``fit()``, or what was kept of it for the same tables and parameters."""
    folder = spark.conf.get(FOLDER, None)
    if not folder:
        return fit()
    path = f"{folder}/{name}-{fingerprint(tables, parameters)}"
    model = load(spark, path)
    if model is None:
        model = fit()
        save(spark, path, model)
    return model
