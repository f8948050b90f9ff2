"""Round-based ingestion as streams: files in, unseen rows out, month counts kept; a run until all input is read equals the batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import url as U


def read(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).load(path)


def unique_urls(stream: DataFrame, url: str = "url", delay: str | None = None, time: str | None = None) -> DataFrame:
    """Each normalised URL once. Without a watermark the state holds all keys and the result equals the batch; with one (an addition for endless
    streams) copies later than the delay come again."""
    x = stream.withColumn("norm_url", U.normalize(F.col(url)))
    if delay and time:
        return x.withWatermark(time, delay).dropDuplicatesWithinWatermark(["norm_url"])
    return x.dropDuplicates(["norm_url"])


def month_counts(stream: DataFrame, time: str, source: str = "source") -> DataFrame:
    return stream.groupBy(F.date_format(time, "yyyy-MM").alias("month"), F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))


def drain(frame: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything that is there to a table and stop."""
    frame.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def drain_counts(frame: DataFrame, table: str, checkpoint: str) -> None:
    frame.writeStream.format("memory").queryName(table).option("checkpointLocation", checkpoint).outputMode("complete").trigger(availableNow=True).start().awaitTermination()


def observed(stream: DataFrame, handle, checkpoint: str) -> None:
    """Hand every micro-batch to a callback, as an observer of stored rows."""
    stream.writeStream.foreachBatch(lambda batch, k: handle(batch, k)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
