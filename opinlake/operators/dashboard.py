"""Dashboard aggregates over scored rows (see ``scored.from_events``): shares, distributions, trends, buckets, top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scored import LABELS

ARTICLE_SOURCE = "signup"  # stands in for the article source


def comments(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("source") != ARTICLE_SOURCE)


def articles(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("source") == ARTICLE_SOURCE)


def select_range(rows: DataFrame, days: int = 90) -> DataFrame:
    """The rows of the last ``days`` before the newest day; the bounds are one row, so the join is a broadcast of it."""
    top = rows.agg(F.max("day").alias("hi"), F.min("day").alias("lo"))
    b = top.select(F.greatest(F.col("lo"), F.date_sub("hi", days)).alias("from_day"), F.col("hi").alias("to_day"))
    return rows.join(F.broadcast(b), (F.col("day") >= F.col("from_day")) & (F.col("day") <= F.col("to_day")))


def kpis(rows: DataFrame) -> DataFrame:
    """Totals and label shares over all rows."""
    share = lambda label: F.round(F.avg((F.col("label") == label).cast("double")), 6)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), share("negative").alias("negative_share"), share("positive").alias("positive_share"), F.count_if(F.col("source") == ARTICLE_SOURCE).alias("n_articles"))


def label_distribution(rows: DataFrame) -> DataFrame:
    """Rows per label, also of labels that don't occur."""
    dim = rows.sparkSession.createDataFrame([(x,) for x in LABELS], "l string")
    n = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return dim.join(n, F.col("l") == F.col("label"), "left").select(F.col("l").alias("label"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def source_counts(rows: DataFrame) -> DataFrame:
    return comments(rows).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def source_label_share(rows: DataFrame) -> DataFrame:
    n = comments(rows).groupBy("source", "label").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("source")), 6))


def likert_segments(rows: DataFrame) -> DataFrame:
    """Diverging bars: three segments per source around the middle of neutral, scaled by the largest source."""
    per = comments(rows).groupBy("source").agg(*[F.count_if(F.col("label") == x).alias(x) for x in LABELS])
    total = F.col("negative") + F.col("neutral") + F.col("positive")
    per = per.withColumn("total", total)
    scaled = per.withColumn("scale", F.col("total") / F.max("total").over(Window.partitionBy()))  # a row per source
    share = lambda c: F.col(c) / F.when(F.col("total") == 0, 1).otherwise(F.col("total")) * F.col("scale")
    s = scaled.select("source", share("negative").alias("a"), share("neutral").alias("b"), share("positive").alias("c"))
    return s.select("source", F.expr("stack(3, 'negative', -a - b / 2, -b / 2, 'neutral', -b / 2, b / 2, 'positive', b / 2, b / 2 + c) as (label, x0, x1)")).select("source", "label", F.round("x0", 6).alias("x0"), F.round("x1", 6).alias("x1"))


def daily_score(rows: DataFrame) -> DataFrame:
    """Mean score and rows per day, with the mean over the last seven days present; days are pre-aggregated, so the window is small."""
    d = comments(rows).groupBy("day").agg(F.avg("score").alias("s"), F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("day").rowsBetween(-6, 0)
    return d.select("day", F.round("s", 6).alias("score"), "n", F.round(F.avg("s").over(w), 6).alias("ma7"))


def hourly_score(rows: DataFrame) -> DataFrame:
    d = comments(rows).groupBy("hr").agg(F.avg("score").alias("s"), F.count(F.lit(1)).alias("n"))
    return d.select("hr", F.round("s", 6).alias("score"), "n", F.round(F.avg("s").over(Window.orderBy("hr").rowsBetween(-2, 0)), 6).alias("ma3"))


def volume(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def span(rows: DataFrame) -> DataFrame:
    return rows.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("n"))


def bucket_stats(rows: DataFrame, by: str) -> DataFrame:
    """Statistics of every bucket: mean score, rows, label shares and the span of days."""
    share = lambda label: F.round(F.avg((F.col("label") == label).cast("double")), 6)
    return rows.groupBy(by).agg(F.round(F.avg("score"), 6).alias("score"), F.count(F.lit(1)).alias("n"), *[share(x).alias(f"{x}_share") for x in LABELS], F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def top_dates(rows: DataFrame, k: int = 3) -> DataFrame:
    """The k busiest days of each hour, earlier days first among equals; counts are pre-aggregated per (hour, day)."""
    n = rows.groupBy("hr", "day").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("hr").orderBy(F.desc("n"), "day")
    return n.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


def top_sources(rows: DataFrame, k: int = 5) -> DataFrame:
    n = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return n.orderBy(F.desc("n"), "source").limit(k)


def samples(rows: DataFrame, k: int = 6) -> DataFrame:
    """The newest rows of each label, by day and then key."""
    w = Window.partitionBy("label").orderBy(F.desc("day"), "pos_id")
    return rows.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k).select("label", "rank", "pos_id", "day", "source")


ALIASES = {"negative": ("negative", "neg", "sentiment_negative", "neg_score"), "neutral": ("neutral", "neu", "sentiment_neutral", "neu_score"), "positive": ("positive", "pos", "sentiment_positive", "pos_score")}


def keep_columns(rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The kept columns that exist, and the three weights under their common names: of each, the first alias that the table has."""
    names = set(rows.columns)
    weights = [F.col(next(a for a in alias if a in names)).cast("double").alias(k) for k, alias in ALIASES.items() if any(a in names for a in alias)]
    return rows.select(*[c for c in keep if c in names and c not in ALIASES], *weights)


def within(rows: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """Times outside the half-open window become null; every row stays."""
    t = F.col(time)
    return rows.withColumn(time, F.when((t >= F.lit(start).cast("timestamp_ntz")) & (t < F.lit(end).cast("timestamp_ntz")), t))


def local_days(rows: DataFrame, time: str, zone: str, first: str, last: str) -> DataFrame:
    """Rows whose local day is in the range, or whose time is unknown."""
    day = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(time)))
    return rows.filter(F.col(time).isNull() | day.between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))


def percent(share, digits: int = 1):
    """A share as text."""
    return F.format_string(f"%.{digits}f%%", share * 100)


def relevant(rows: DataFrame, flag: str = "is_related") -> DataFrame:
    """Rows marked as relevant; no mark means not relevant."""
    return rows.filter(F.coalesce(F.col(flag).cast("boolean"), F.lit(False)))


def explained(rows: DataFrame, text: str = "explanation") -> DataFrame:
    """Rows with an explanation that isn't blank, trimmed."""
    return rows.withColumn(text, F.trim(text)).filter(F.length(text) > 0)


def in_bucket(rows: DataFrame, day: str | None = None, hour: int | None = None) -> DataFrame:
    """The rows behind a bucket of a chart; rows without a time belong to none."""
    out = rows if day is None else rows.filter(F.col("day") == day)
    return out if hour is None else out.filter(F.col("hr") == hour)


def label_counts_all(rows: DataFrame, by: str, label: str, labels: tuple[str, ...]) -> DataFrame:
    """(by, label, n) with a row for each of ``labels``, 0 where none was seen: one pivoted count, then a row per label."""
    n = rows.groupBy(by).agg(*[F.count_if(F.col(label) == x).alias(x) for x in labels])
    return n.select(by, F.explode(F.array(*[F.struct(F.lit(x).alias("label"), F.col(x).alias("n")) for x in labels])).alias("s")).select(by, "s.label", "s.n")
