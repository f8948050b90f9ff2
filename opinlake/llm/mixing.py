"""Mixing sources to target weights (problem 9).

Method: entropy balancing. The rate of a document (its expected number of copies) is the least tilted one, in entropy against one
copy each, that gives every source its share of the tokens: min(max_repeats, exp(lambda of its source x its relative length)).
Distributed Newton iterations solve the convex dual; each needs one aggregate per source. Rates are rounded into copies
systematically, along the lengths of hashed parts of a source, reproducibly.

Scale: the tokens of each document are counted once and kept as a narrow table in the shared checkpoint folder; an iteration reads
that table and combines sums on the map side, so a hot source is no single task; the driver holds one number per source, of which
there are as many as ``mix_targets`` has rows, which is checked.

Defined results: sources without a target or with a share of 0 are left out; targets of sources without tokens can't be met and their share
is spread over the others in proportion; null and empty texts have no tokens and are never chosen; the total is that of the corpus's
sources with a target, or less where a cap binds; repeated rows are separate documents by their own keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import filled
from .sums import kept

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_SOURCES = 100_000
ITERATIONS = 25
TOLERANCE = 1e-6
PART_ROWS = 50_000


def count_tokens(documents: DataFrame, tokenizer: str = TOKENIZER, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, source, n_tokens) with a public byte-level tokenizer's vocabulary file and the pattern that parts texts before it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import base64

        import tiktoken

        with open(tokenizer, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        enc = tiktoken.Encoding("mix", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b["text"]]
            yield from filled(pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "n_tokens": np.array(n, dtype=np.int64)}))

    return documents.select("doc_id", "source", "text").mapInPandas(run, "doc_id long, source string, n_tokens long")


def solve(tokens: DataFrame, targets: list[dict]) -> dict[str, dict]:
    """For each source lambda, mean length, cap and aim; the dual is solved by Newton steps kept inside a bracket."""
    base = {r["source"]: r for r in tokens.filter("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("total"), F.avg("n_tokens").alias("mean")).filter("source IS NOT NULL").join(
        tokens.sparkSession.createDataFrame([(t["source"],) for t in targets], "t_source string"), F.col("source") == F.col("t_source")).select("source", "total", "mean").collect()}
    want = {t["source"]: t for t in targets if t["source"] in base and (t["target_share"] or 0) > 0 and (t["max_repeats"] or 0) > 0}
    if not want:
        return {}
    weight = sum(t["target_share"] for t in want.values())
    total = sum(base[s]["total"] for s in want)
    total = min(total, min(t["max_repeats"] * base[s]["total"] * weight / t["target_share"] for s, t in want.items()))
    state = {s: {"lam": 0.0, "lo": -60.0, "hi": 60.0, "mean": base[s]["mean"], "cap": int(t["max_repeats"]), "aim": total * t["target_share"] / weight, "share": t["target_share"], "done": False} for s, t in want.items()}
    spark = tokens.sparkSession
    for _ in range(ITERATIONS):
        params = spark.createDataFrame([(s, float(x["lam"]), float(x["mean"]), float(x["cap"])) for s, x in state.items() if not x["done"]], "p_source string, lam double, mean double, cap double")
        z = F.col("n_tokens") / F.col("mean")
        rate = F.least(F.exp(F.col("lam") * z), F.col("cap"))
        sums = tokens.filter("n_tokens > 0").join(F.broadcast(params), F.col("source") == F.col("p_source")).groupBy("source").agg(
            F.sum(F.col("n_tokens") * rate).alias("f"), F.sum(F.when(rate < F.col("cap"), F.col("n_tokens") * z * rate).otherwise(0.0)).alias("g"))
        for r in sums.collect():  # one row per source
            x = state[r["source"]]
            gap = r["f"] - x["aim"]
            if abs(gap) <= TOLERANCE * x["aim"]:
                x["done"] = True
                continue
            if gap > 0:
                x["hi"] = x["lam"]
            else:
                x["lo"] = x["lam"]
            step = x["lam"] - gap / r["g"] if r["g"] > 0 else None
            x["lam"] = step if step is not None and x["lo"] < step < x["hi"] else (x["lo"] + x["hi"]) / 2
            x["done"] = x["hi"] - x["lo"] < 1e-9
        if all(x["done"] for x in state.values()):
            break
    return state


def mix(documents: DataFrame, mix_targets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, n_tokens, n_uses, target_share, reached_share): the chosen documents."""
    spark = documents.sparkSession
    n = mix_targets.count()
    if n > MAX_SOURCES:
        raise ValueError(f"mix_targets has {n} rows; the solver keeps a number per source and is meant for {MAX_SOURCES} at most")
    targets = [r.asDict() for r in mix_targets.select("source", "target_share", "max_repeats").collect()]
    tokens = kept(count_tokens(documents, tokenizer), "tokens")
    state = solve(tokens, targets)
    params = spark.createDataFrame([(s, float(x["lam"]), float(x["mean"]), float(x["cap"]), float(x["share"])) for s, x in state.items()], "p_source string, lam double, mean double, cap double, target_share double")
    rate = F.least(F.exp(F.col("lam") * F.col("n_tokens") / F.col("mean")), F.col("cap"))
    # systematic rounding: along the documents of a part in order of length, running rates cross whole numbers; each part is off by one copy at most
    parts = max(1, -(-tokens.count() // PART_ROWS))
    part = F.pmod(F.xxhash64(F.lit(17), F.col("doc_id")), F.lit(parts))
    toss = (F.pmod(F.xxhash64(F.lit(29), F.col("source"), F.col("part")), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    w = Window.partitionBy("source", "part").orderBy("n_tokens", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    rated = tokens.filter("n_tokens > 0").join(F.broadcast(params), F.col("source") == F.col("p_source")).select("doc_id", "source", "n_tokens", "target_share", "cap", rate.alias("rate"), part.alias("part"))
    run = rated.withColumn("c", F.sum("rate").over(w) + toss)
    chosen = run.select("doc_id", "source", "n_tokens", F.least(F.floor(F.col("c") + 1e-9) - F.floor(F.col("c") - F.col("rate") + 1e-9), F.col("cap")).cast("long").alias("n_uses"), "target_share").filter("n_uses > 0")
    sums = chosen.groupBy(F.col("source").alias("s_source")).agg(F.sum(F.col("n_tokens") * F.col("n_uses")).alias("used"))
    whole = chosen.agg(F.sum(F.col("n_tokens") * F.col("n_uses")).alias("all_used"))
    shares = sums.crossJoin(whole).select("s_source", (F.col("used") / F.col("all_used")).alias("reached_share"))  # a row per source beside one row
    return chosen.join(F.broadcast(shares), F.col("source") == F.col("s_source")).select("doc_id", "source", "n_tokens", "n_uses", "target_share", "reached_share")


def shares(documents: DataFrame, mix_targets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(source, n_docs, n_uses, n_tokens, target_share, reached_share) per source."""
    return mix(documents, mix_targets, tokenizer).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_uses").alias("n_uses"), F.sum(F.col("n_tokens") * F.col("n_uses")).alias("n_tokens"), F.first("target_share").alias("target_share"), F.first("reached_share").alias("reached_share"))
