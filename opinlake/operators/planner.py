"""Collection planning: coverage per month and source, deficits, ranked rotation, cooldowns, search windows, priorities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rounds and thresholds of the planner, order of the sources, pauses per host.
COOLDOWN_ROUNDS, DUP_LIMIT, AGE_DISCOUNT = 3, 0.8, 0.03
PRIORITY = ("dcinside", "bobaedream", "mlbpark", "theqoo", "ppomppu", "gdelt", "youtube")
SOURCE_OFFSETS = {"gdelt": 0, "youtube": 1, "forums": 2}


def month_counts(rows: DataFrame, time: str = "kst") -> DataFrame:
    return rows.groupBy(F.date_format(time, "yyyy-MM").alias("month"), "source").agg(F.count(F.lit(1)).alias("n"))


def deficits(counts: DataFrame, target: int, months: int = 12) -> DataFrame:
    """What is missing to the target in each of the last months of each source; unseen months count as 0."""
    s = counts.agg(F.max("month").alias("hi")).select(F.explode(F.expr(f"sequence(add_months(to_date(hi || '-01'), -{months - 1}), to_date(hi || '-01'), interval 1 month)")).alias("m")).select(F.date_format("m", "yyyy-MM").alias("d_month"))
    grid = s.crossJoin(counts.select(F.col("source").alias("d_source")).distinct())  # months x sources, as the plan wants it
    j = grid.join(counts, (F.col("month") == F.col("d_month")) & (F.col("source") == F.col("d_source")), "left")
    return j.select(F.col("d_month").alias("month"), F.col("d_source").alias("source"), F.greatest(F.lit(0), F.lit(target) - F.coalesce("n", F.lit(0))).cast("long").alias("deficit"))


def rank_rotate(missing: DataFrame, cursor: int) -> DataFrame:
    """Months by total deficit, older ones discounted, turned by the cursor; the newest month has age 0. A row per month."""
    total = missing.groupBy("month").agg(F.sum("deficit").alias("total"))
    age = F.row_number().over(Window.orderBy(F.desc("month"))) - 1
    scored = total.withColumn("rank_score", F.round(F.col("total") * (1 - AGE_DISCOUNT * age), 6))
    rank = F.row_number().over(Window.orderBy(F.desc("rank_score"), "month")) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy())
    return scored.withColumn("turn", F.pmod(rank - cursor, n).cast("long")).select("month", "total", "rank_score", "turn")


def cooldowns(rounds: DataFrame) -> DataFrame:
    """(bucket, n_stored, n_fetched, n_duplicates) -> with dup_ratio, the duplicates' share of what was fetched or skipped, and the rounds to rest: little
    stored or mostly duplicates."""
    seen = F.greatest(F.lit(1), F.col("n_fetched") + F.greatest(F.lit(0), F.col("n_duplicates")))
    ratio = F.col("n_duplicates") / seen
    return rounds.withColumn("dup_ratio", F.round(ratio, 6)).withColumn("rest", F.when((F.col("n_stored") < 1) | (ratio >= DUP_LIMIT), F.lit(COOLDOWN_ROUNDS)).otherwise(F.lit(0)).cast("long"))


def tick(resting: DataFrame) -> DataFrame:
    """The rests after another round: each one shorter, the last round's gone."""
    return resting.withColumn("rest", F.col("rest") - 1).filter("rest > 0")


def merge_rests(resting: DataFrame, new: DataFrame) -> DataFrame:
    """(bucket, rest): the longer of what is left and what the round has added."""
    return resting.select("bucket", "rest").unionByName(new.select("bucket", "rest")).groupBy("bucket").agg(F.max("rest").alias("rest")).filter("rest > 0")


def windows(spark: SparkSession, start: str, end: str, days: int, overlap: int) -> DataFrame:
    """Overlapping windows over a period; the last one is the tail of the overlap's length."""
    return spark.sql(f"SELECT s AS w_start, least(date_add(s, {days}), date'{end}') AS w_end FROM (SELECT explode(sequence(date'{start}', date_sub(date'{end}', 1), interval {days - overlap} day)) AS s)")


def keyword_windows(keywords: DataFrame, frames: DataFrame) -> DataFrame:
    """Every keyword in every window: the request plan, small by nature."""
    return keywords.crossJoin(frames)


def priority(column: str = "source", order: tuple[str, ...] = PRIORITY):
    """The rank of a source in the order; others come last."""
    at = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(column))
    return F.when(at == 0, F.lit(len(order) + 1)).otherwise(at).cast("long")


def host_pause(urls: DataFrame, pauses: DataFrame, default: float) -> DataFrame:
    """(host) -> pause: the exact host, else the first configured suffix. The suffixes of a host are exploded, so that the lookup is an
    equi-join instead of a comparison of every host with every suffix."""
    labels = F.split("host", r"\.")
    suffix = urls.select("host", F.posexplode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("depth", "suffix"))
    hit = suffix.join(pauses.select(F.col("host").alias("p_host"), "pause", "ord"), F.col("suffix") == F.col("p_host"))
    best = hit.groupBy("host").agg(F.min(F.struct(F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.lit(1)).alias("kind"), F.col("ord").alias("o"), F.col("pause").alias("pause"))).alias("b"))
    b = best.select(F.col("host").alias("b_host"), F.col("b.pause").alias("found"))
    return urls.join(b, F.col("host") == F.col("b_host"), "left").select("host", F.coalesce("found", F.lit(default)).alias("pause"))


def cap_per_source(rows: DataFrame, cap: int, order: str) -> DataFrame:
    """The first rows of each source: the cap is what this operator is for."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("source").orderBy(order)).cast("long")).filter(F.col("rank") <= cap)


def chunks(ids: DataFrame, key: str, size: int) -> DataFrame:
    """(key, chunk) for calls that take ``size`` ids at once: chunk k has the ids k x size to (k + 1) x size - 1 in the order of the key (distinct
    values). Ids are ranged by buckets of their hash-free order: each range is numbered by itself and shifted by the sizes of the ranges before it, so no
    task sorts everything."""
    spread = ids.repartitionByRange(key).withColumn("_part", F.spark_partition_id())
    inside = spread.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(key)))
    sizes = spread.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))  # a row per partition
    before = sizes.select(F.col("_part").alias("_p"), (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    return inside.join(F.broadcast(before), F.col("_part") == F.col("_p")).withColumn("chunk", F.floor((F.col("_n") + F.col("_before") - 1) / F.lit(size)).cast("long")).drop("_part", "_p", "_n", "_before")


def month_bounds(counts: DataFrame, now: str) -> DataFrame:
    """(month, w_start, w_end): each month's window, not reaching beyond ``now``."""
    first = F.to_date(F.concat("month", F.lit("-01")))
    return counts.select("month").distinct().select("month", first.alias("w_start"), F.least(F.add_months(first, 1), F.to_date(F.lit(now))).alias("w_end"))


def quotas(keywords: DataFrame, total: int, per_call: int = 101) -> DataFrame:
    """Units of a daily quota that each keyword may use, and the calls they pay for."""
    n = keywords.count()
    share = total // max(n, 1)
    return keywords.withColumn("units", F.lit(share).cast("long")).withColumn("calls", F.lit(share // per_call).cast("long"))
