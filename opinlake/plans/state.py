"""Configuration and state of round-based collection: a typed configuration from YAML, counts and cooldowns as tables, and the actions
run, status, plan and reset as functions over them."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import planner


@dataclass(frozen=True)
class Config:
    """What a run needs; unknown keys are ignored, missing ones take these values."""

    keywords: tuple[str, ...] = ()
    langs: tuple[str, ...] = ("ko", "en")
    per_source_cap: int = 10_000
    fetch_pause: float = 0.05
    host_pauses: dict[str, float] = field(default_factory=dict)
    month_target: int = 1_000
    months: int = 120


def load_config(path: str, keyword_file: str | None = None) -> Config:
    """A configuration file; keywords may come from a file of lines where it names none."""
    try:
        import yaml
    except ImportError as e:  # the parser is optional
        raise RuntimeError("reading YAML needs the yaml package") from e
    raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    known = {k: raw[k] for k in Config.__dataclass_fields__ if k in raw and raw[k] is not None}
    if not known.get("keywords") and keyword_file:
        known["keywords"] = [x.strip() for x in Path(keyword_file).read_text(encoding="utf-8").splitlines() if x.strip() and not x.startswith("#")]
    for k in ("keywords", "langs"):
        if k in known:
            known[k] = tuple(known[k])
    return Config(**known)


def save(counts: DataFrame, path: str) -> None:
    """The month counts as a small table, replaced as a whole."""
    counts.write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def add_round(counts: DataFrame, stored: DataFrame, time: str) -> DataFrame:
    """Counts after a round: old and new ones summed per month and source."""
    both = counts.unionByName(planner.month_counts(stored, time))
    return both.groupBy("month", "source").agg(F.sum("n").alias("n"))


def plan(counts: DataFrame, config: Config, cursor: int) -> DataFrame:
    """The months of the next round in their order."""
    return planner.rank_rotate(planner.deficits(counts, config.month_target, config.months), cursor).orderBy("turn")


def status(counts: DataFrame) -> DataFrame:
    return counts.groupBy("source").agg(F.sum("n").alias("n"), F.min("month").alias("first_month"), F.max("month").alias("last_month"))


def reset(spark: SparkSession, path: str) -> None:
    save(spark.createDataFrame([], "month string, source string, n long"), path)
