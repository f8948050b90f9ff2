"""Bounded training samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the least key hashes. Rows far above the threshold that ``n`` implies are dropped inside the scan, so that what
    all tasks together send on stays in proportion to ``n``, however large the table is."""
    total = df.select(key).count()
    h = F.xxhash64(key)
    if total > 3 * n:
        df = df.filter(h < F.lit(int(-(2**63) + 2**64 * (2.0 * n / total))))
    return df.orderBy(h, key).limit(n)
