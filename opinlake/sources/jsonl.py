"""JSON-line sources and sinks: lenient, strict, multi-encoding, globs, folders; files per source; seen indexes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import filled

ENCODINGS = ("utf-8", "utf-8-sig", "cp949", "euc-kr", "latin-1")


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, line) of all matching files, each file once; blank lines are left out. Order inside a file is that of its splits."""
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")).filter(F.trim("line") != "")


def lenient(spark: SparkSession, paths: str | list[str], schema: StructType | str) -> DataFrame:
    """Rows of well-formed objects; malformed lines and other JSON values are skipped."""
    x = lines(spark, paths).filter(F.json_object_keys("line").isNotNull())
    return x.select(F.from_json("line", schema, {"mode": "PERMISSIVE"}).alias("r"), "line").filter("r IS NOT NULL").select("r.*", F.col("line").alias("raw_line"))


def strict(spark: SparkSession, paths: str | list[str], schema: StructType | str) -> DataFrame:
    """The same, but the first malformed line fails the job and names its file."""
    x = lines(spark, paths)
    ok = F.when(F.json_object_keys("line").isNotNull(), F.col("line")).otherwise(F.raise_error(F.concat(F.lit("malformed line in "), F.col("file"), F.lit(": "), F.substring("line", 1, 80))))
    return x.select(F.from_json(ok, schema).alias("r")).select("r.*")


def any_encoding(spark: SparkSession, paths: str | list[str], encodings: tuple[str, ...] = ENCODINGS) -> DataFrame:
    """(file, line) of files in one of several encodings: each file is decoded whole by the first that fits, so no line comes twice."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                for e in encodings:
                    try:
                        text = bytes(content).decode(e)
                        break
                    except UnicodeDecodeError:
                        continue
                rows = [x for x in (y.rstrip("\r") for y in text.lstrip("\ufeff").split("\n")) if x.strip()]  # other line separators may stand inside a string
                yield from filled(pd.DataFrame({"file": [path] * len(rows), "line": rows}))

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, "file string, line string")


def dotted(rows: DataFrame) -> DataFrame:
    """Nested structs become columns named by their path, joined with dots; arrays and maps stay as they are."""
    from pyspark.sql.types import StructType as Struct

    def walk(fields, path: tuple[str, ...]):
        for f in fields:
            at = (*path, f.name)
            if isinstance(f.dataType, Struct):
                yield from walk(f.dataType.fields, at)
            else:
                yield F.col(".".join(f"`{x}`" for x in at)).alias(".".join(at))

    return rows.select(*walk(rows.schema.fields, ()))


def in_order(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, at, line) of all matching files; ``file`` and ``at`` (a line's place in it) order the rows by path, as a reader of one file after another
    sees them. Files are read whole, one a row."""
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\n")).alias("at", "line"))
    return whole.withColumn("line", F.regexp_replace("line", "\r$", "")).filter(F.trim("line") != "").withColumn("at", F.col("at") + 1)


def strict_in_order(spark: SparkSession, paths: str | list[str], schema: StructType | str) -> DataFrame:
    """As ``strict``, and the error names the line's number too."""
    x = in_order(spark, paths)
    ok = F.when(F.json_object_keys("line").isNotNull(), F.col("line")).otherwise(F.raise_error(F.concat(F.lit("malformed line "), F.col("at").cast("string"), F.lit(" of "), F.col("file"))))
    return x.select("file", "at", F.from_json(ok, schema).alias("r")).select("file", "at", "r.*")


def folder(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All .jsonl and .json files below a folder; a .json file holds one object or an array of them."""
    opts = {"recursiveFileLookup": "true"}
    a = spark.read.options(**opts, pathGlobFilter="*.jsonl").schema(schema).json(path)
    b = spark.read.options(**opts, pathGlobFilter="*.json", multiLine="true").schema(schema).json(path)
    return a.unionByName(b)


def stop_words(spark: SparkSession, path: str) -> DataFrame:
    """(word) of a stop-word file: comments left out, blanks part words, lower case."""
    return spark.read.text(path).select(F.explode(F.split(F.lower(F.regexp_replace("value", "#.*$", "")), r"\s+")).alias("word")).filter("word <> ''").distinct()


def append_per_source(rows: DataFrame, path: str) -> None:
    """One folder per source, forums under forum_{source}; rows need ``source`` and ``discovered_type``; nulls are written."""
    bucket = F.when(F.col("discovered_type") == "forum", F.concat(F.lit("forum_"), "source")).otherwise(F.col("source"))
    rows.withColumn("bucket", bucket).write.mode("append").partitionBy("bucket").option("ignoreNullFields", "false").json(path)


def overwrite(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def update_index(rows: DataFrame, path: str, keys: tuple[str, ...] = ("id", "norm_url")) -> None:
    """The seen index is a table that only grows, by what it doesn't hold yet; membership is an anti join on it. Without a table it is begun."""
    new = rows.select(*keys).distinct()
    try:
        old = rows.sparkSession.read.parquet(path).select(*[F.col(k).alias(f"_{k}") for k in keys])
    except AnalysisException:
        old = None
    if old is not None:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        new = new.join(old, same, "left_anti")
    new.write.mode("append").parquet(path)
