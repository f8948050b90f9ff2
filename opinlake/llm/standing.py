"""Lines repeated across one source's documents (problem 2).

Method: a graph per source whose nodes are lines (letters only, case ignored) weighted by the documents
that hold them, and whose edges are lines that follow one another; nodes and edges of high support are
kept, connected components are the boilerplate blocks, and every occurrence of a block's lines is deleted.

Scale: each document counts a line once before any shuffle, the count is combined on the map side by
(source, 64-bit key), so a hot source isn't one task. At most 50 x (distinct lines per document) lines of a
source can reach a share of 2 percent, so the kept nodes are few; the joins are left to the adaptive planner,
which broadcasts them only below its size threshold and shuffles beyond it.

Defined results: null or empty texts have no lines; null sources form one source; lines without letters are
never standing; extra columns pass through ``remove_standing`` untouched; empty tables give empty results.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_DOCS = 3
MIN_SHARE = 0.02


def line_keys(documents: DataFrame) -> DataFrame:
    """(doc_id, source, lines: array<line_no, key>) of the lines with a letter."""
    return documents.select(
        "doc_id", "source",
        F.expr(r"""filter(transform(split(text, '\n', -1), (x, i) -> struct(cast(i as bigint) as line_no,
            xxhash64(lower(upper(regexp_replace(x, '[^\\p{L}]+', '')))) as key, x rlike '\\p{L}' as lettered)), s -> s.lettered)""").alias("lines"),
    )


def standing_lines(lines: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """The nodes: (source, key, n_docs) of lines that enough of a source's documents hold."""
    totals = lines.groupBy("source").agg(F.count(F.lit(1)).alias("total"))
    counts = (
        lines.select("source", F.explode(F.expr("array_distinct(transform(lines, s -> s.key))")).alias("key"))
        .groupBy("source", "key").agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
    )
    t = totals.withColumnRenamed("source", "t_source")
    return counts.join(t, F.col("source").eqNullSafe(F.col("t_source"))).filter(F.col("n_docs") + 1e-6 >= F.col("total") * F.lit(min_share)).select("source", "key", "n_docs", "total")


def occurrences(lines: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, source, line_no, seq, key) of every occurrence of a kept line."""
    flat = lines.select("doc_id", F.col("source").alias("l_source"), F.posexplode("lines").alias("seq", "s")).select("doc_id", "l_source", "seq", F.col("s.line_no").alias("line_no"), F.col("s.key").alias("l_key"))
    return flat.join(nodes, (F.col("l_key") == F.col("key")) & F.col("l_source").eqNullSafe(F.col("source"))).select("doc_id", "source", "line_no", "seq", "key")


def _components(pdf: pd.DataFrame) -> pd.DataFrame:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(pdf["key"], pdf["next_key"]):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    source = pdf["source"].iloc[0]
    return pd.DataFrame({"source": [source] * len(parent), "key": list(parent), "block": [root(k) for k in parent]})


def edges(occ: DataFrame, nodes: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """(source, key, next_key) of kept lines that follow one another in enough of a source's documents."""
    w = Window.partitionBy("doc_id").orderBy("seq")
    follows = occ.select("doc_id", "source", "key", "seq", F.lead("key").over(w).alias("next_key"), F.lead("seq").over(w).alias("next_seq")).filter(F.col("next_seq") == F.col("seq") + 1)
    # a document counts an edge once: combined per document first, so that a source's hot edge is no single task
    support = follows.select("doc_id", "source", "key", "next_key").distinct().groupBy("source", "key", "next_key").agg(F.count(F.lit(1)).alias("support"))
    totals = nodes.select(F.col("source").alias("t_source"), "total").distinct()
    return support.join(totals, F.col("source").eqNullSafe(F.col("t_source"))).filter((F.col("support") >= min_docs) & (F.col("support") + 1e-6 >= F.col("total") * F.lit(min_share))).select("source", "key", "next_key")


def blocks(nodes: DataFrame, kept: DataFrame) -> DataFrame:
    """(source, key, n_docs, block): connected components over edges of high support; a source's kept graph is small (see above)."""
    graph = nodes.select("source", "key", F.col("key").alias("next_key")).unionByName(kept)
    # a node is an edge to itself: with a null, pandas would turn the 64-bit keys into floats
    comp = graph.groupBy("source").applyInPandas(_components, "source string, key long, block long")
    n = nodes.select(F.col("source").alias("n_source"), F.col("key").alias("n_key"), "n_docs")
    return comp.join(n, (F.col("key") == F.col("n_key")) & F.col("source").eqNullSafe(F.col("n_source"))).select("source", "key", "n_docs", "block")


def find_standing(documents: DataFrame) -> DataFrame:
    """(doc_id, line_no, block) of every line that belongs to a boilerplate block of its source."""
    lines = line_keys(documents)
    nodes = standing_lines(lines)
    occ = occurrences(lines, nodes)
    b = blocks(nodes, edges(occ, nodes)).select(F.col("source").alias("b_source"), F.col("key").alias("b_key"), "block")
    return occ.join(b, (F.col("key") == F.col("b_key")) & F.col("source").eqNullSafe(F.col("b_source"))).select("doc_id", "line_no", "block")


def remove_standing(documents: DataFrame) -> DataFrame:
    """The documents, each once, with ``clean_text`` and ``n_removed``; texts without standing lines stay as they are."""
    gone = find_standing(documents).groupBy("doc_id").agg(F.collect_set("line_no").alias("gone"))  # a document's own lines only
    g = gone.withColumnRenamed("doc_id", "g_doc_id")
    return (
        documents.join(g, F.col("doc_id") == F.col("g_doc_id"), "left")
        .withColumn("clean_text", F.expr(r"CASE WHEN gone IS NULL THEN text ELSE array_join(filter(split(text, '\n', -1), (x, i) -> NOT array_contains(gone, cast(i as bigint))), '\n') END"))
        .withColumn("n_removed", F.coalesce(F.size("gone"), F.lit(0)).cast("long"))
        .drop("g_doc_id", "gone")
    )


def report(documents: DataFrame) -> DataFrame:
    """(source, n_lines, n_edges, n_blocks): per source the kept lines, the kept edges between different lines, and the blocks that they form."""
    lines = line_keys(documents)
    nodes = standing_lines(lines)
    kept = edges(occurrences(lines, nodes), nodes)
    b = blocks(nodes, kept).groupBy("source").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("block").alias("n_blocks"))
    e = kept.filter("key <> next_key").groupBy(F.col("source").alias("e_source")).agg(F.count(F.lit(1)).alias("n_edges"))
    return b.join(e, F.col("source").eqNullSafe(F.col("e_source")), "left").select("source", "n_lines", F.coalesce("n_edges", F.lit(0)).cast("long").alias("n_edges"), "n_blocks")
