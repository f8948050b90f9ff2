"""The stages in order, as one lazy plan each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import content, dedup, rows, scored


def articles(raw: DataFrame, least: int = 20, most: int = 200_000) -> DataFrame:
    """Raw posts -> clean, fitting, exactly deduplicated articles, the earliest of each text."""
    clean = raw.withColumn("clean_text", T.squeeze(T.cut_tail(F.col("raw_text")))).filter(content.length_between(F.col("clean_text"), least, most))
    return dedup.exact_first(clean, F.concat_ws(" ", "title", "clean_text"), "row_id")


def merged(*frames: DataFrame) -> DataFrame:
    """Canonical rows of all sources, merged."""
    return rows.merge(rows.canonical(rows.union_all(*frames)))


def scored_rows(merged_rows: DataFrame, scorer=None) -> DataFrame:
    """Merged rows with scores: of an injected scorer, or of the offline lexicon."""
    t = scored.scoring_text(merged_rows)
    s = scored.remote_score(t, scorer) if scorer else scored.lexicon_score(t)
    return s.withColumn("label", scored.dominant("negative", "neutral", "positive")).withColumn("score", scored.score("negative", "neutral", "positive"))


REGISTRY = {"articles": articles, "merged": merged, "scored": scored_rows}
