"""Scored rows: probabilities, labels, scores, and the normal forms of a scorer's answers."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from ..functions.text import strip

LABELS = ("negative", "neutral", "positive")
LABEL_KO = {"negative": "부정", "neutral": "중립", "positive": "긍정"}
UNRELATED = "무관"
# Fixed value: coarse language that shifts a client answer of one forum towards negative.
COARSE = r"(?i)(ㅅㅂ|ㅈ|시발|씨발|지랄|fuck|shit|사기|근들갑|싱글벙글|ㅋㅋ{2,})"


def from_events(events: DataFrame) -> DataFrame:
    """The events table as scored comments: one row each, Seoul wall clock, three weights and their label."""
    k = F.get_json_object("props", "$.k").cast("long")
    kst = F.convert_timezone(F.lit("UTC"), F.lit("Asia/Seoul"), F.col("ts"))
    rows = events.select(
        F.col("event_id").alias("pos_id"), F.col("event_type").alias("source"), "user_id", kst.alias("kst"), F.to_date(kst).alias("day"), F.hour(kst).alias("hr"),
        F.greatest(F.lit(0), 50 - k).cast("long").alias("neg"), F.lit(25).cast("long").alias("neu"), F.greatest(F.lit(0), k - 50).cast("long").alias("pos"),
    )
    return rows.withColumn("label", dominant("neg", "neu", "pos")).withColumn("score", score("neg", "neu", "pos"))


def dominant(neg: str, neu: str, pos: str) -> Column:
    """The label of the largest weight; ties go to negative, then neutral; no weights at all: unknown."""
    n, u, p = (F.coalesce(F.col(c).cast("double"), F.lit(float("-inf"))) for c in (neg, neu, pos))
    return F.when(F.coalesce(neg, neu, pos).isNull(), F.lit("unknown")).when((n >= u) & (n >= p), F.lit(LABELS[0])).when(u >= p, F.lit(LABELS[1])).otherwise(F.lit(LABELS[2]))


def score(neg: str, neu: str, pos: str) -> Column:
    """Positive less negative share, within -1 and 1; no mass scores 0."""
    total = F.col(neg) + F.col(neu) + F.col(pos)
    return F.when(total > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col(pos) - F.col(neg)) / total))).otherwise(F.lit(0.0))


def percents(df: DataFrame, neg: str, neu: str, pos: str) -> DataFrame:
    """Adds p_neg, p_neu, p_pos: integer percents that sum to 100; what rounding leaves goes to the largest."""
    c = {k: F.greatest(F.lit(0.0), F.coalesce(F.col(v).cast("double"), F.lit(0.0))) for k, v in (("n", neg), ("u", neu), ("p", pos))}
    total = c["n"] + c["u"] + c["p"]
    pct = lambda x: F.bround(x / total * 100, 0).cast("long")
    d = df.withColumn("_t", total).withColumn("_n", F.when(total > 0, pct(c["n"])).otherwise(0)).withColumn("_u", F.when(total > 0, pct(c["u"])).otherwise(100)).withColumn("_p", F.when(total > 0, pct(c["p"])).otherwise(0))
    left = F.lit(100) - F.col("_n") - F.col("_u") - F.col("_p")
    n_top = (F.col("_n") >= F.col("_u")) & (F.col("_n") >= F.col("_p"))
    u_top = ~n_top & (F.col("_u") >= F.col("_p"))
    return (
        d.withColumn("p_neg", F.col("_n") + F.when(n_top, left).otherwise(0)).withColumn("p_neu", F.col("_u") + F.when(u_top, left).otherwise(0))
        .withColumn("p_pos", F.col("_p") + F.when(~n_top & ~u_top, left).otherwise(0)).drop("_t", "_n", "_u", "_p")
    )


def decide_label(neg: str, neu: str, pos: str) -> Column:
    """The Korean label of the largest percent; ties go to negative, then positive."""
    top = F.greatest(neg, neu, pos)
    return F.when(F.col(neg) == top, F.lit("부정")).when(F.col(pos) == top, F.lit("긍정")).otherwise(F.lit("중립"))


def client_normal(df: DataFrame) -> DataFrame:
    """The client's normal form of (text, source, is_related, negative, neutral, positive, label): clipped, shifted by coarse language on one
    forum, scaled to 1, rounded twice to two decimals; unrelated rows get zeros. Rounding is half even on the binary value, as the
    answers' consumers expect, so the two rounding steps run in an Arrow UDF."""
    clip = lambda c: F.greatest(F.lit(0.0), F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    shifted = F.when(F.coalesce(F.col("text"), F.lit("")).rlike(COARSE) & F.contains(F.coalesce(F.col("source"), F.lit("")), F.lit("dcinside")), F.least(F.lit(1.0), clip("negative") + 0.15)).otherwise(clip("negative"))

    @F.pandas_udf("negative double, neutral double, positive double")
    def twice(n: pd.Series, u: pd.Series, p: pd.Series) -> pd.DataFrame:
        out = []
        for a, b, c in zip(n, u, p):
            s = a + b + c
            v = (0.0, 1.0, 0.0) if s <= 0 else tuple(round(x / s, 2) for x in (a, b, c))
            s = sum(v)
            out.append(tuple(round(x / s, 2) for x in v) if s > 0 else v)
        return pd.DataFrame(out, columns=["negative", "neutral", "positive"])

    related = F.coalesce(F.col("is_related"), F.lit(False))
    x = df.withColumn("_r", related).withColumn("_w", twice(shifted, clip("neutral"), clip("positive")))
    value = lambda k: F.when(F.col("_r"), F.col(f"_w.{k}")).otherwise(F.lit(0.0))
    n, u, p = (F.col(f"_w.{k}") for k in LABELS)
    own = F.trim(F.coalesce(F.col("label"), F.lit("")))
    label = F.when(~F.col("_r"), F.lit(UNRELATED)).when(own.isin("부정", "중립", "긍정", UNRELATED), own).when((n >= u) & (n >= p), F.lit("부정")).when((p >= n) & (p >= u), F.lit("긍정")).otherwise(F.lit("중립"))
    return x.select(*[c for c in df.columns if c not in (*LABELS, "label", "is_related")], F.col("_r").alias("is_related"), *[value(k).alias(k) for k in LABELS], label.alias("label"))


def loose_bool(c: Column) -> Column:
    """Truth as scorers write it."""
    return F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes", "y", "t")


def answer_json(raw: Column) -> Column:
    """The outermost JSON object inside a chatty answer."""
    return F.regexp_extract(raw, r"(?s)(\{.*\})", 1)


def explanation(label_ko: Column, text: Column) -> Column:
    """An explanation with its label in front, or a standing sentence where there is none."""
    base = F.trim(F.coalesce(text, F.lit("")))
    return F.when(base == "", F.concat(F.lit("["), label_ko, F.lit("] 국민연금 제도에 대한 전반적인 감성에 근거해 분포를 부여했습니다."))).when(base.rlike(r"^(\[|부정|중립|긍정)"), base).otherwise(F.concat(F.lit("["), label_ko, F.lit("] "), base))


def scoring_text(df: DataFrame, least: int = 5) -> DataFrame:
    """Adds ``scoring_text``: title, body and comment as the scorer wants them by kind; texts under ``least`` characters are empty."""
    names = df.columns
    # stripped once, in an array below the branches, which only refer to it
    df = df.withColumn("_p", F.transform(F.array("title", "text", "comment_text"), lambda x: strip(F.coalesce(x, F.lit("")))))
    t, b, c = (F.col("_p")[k] for k in range(3))
    gap = F.lit("\n\n")
    kind = F.coalesce(F.nullif(F.col("doc_type"), F.lit("")), F.lit("post"))
    post = F.when((t != "") & (b != ""), F.concat(t, gap, b)).when(t != "", t).otherwise(b)
    # a comment with a body but no title, or no body at all, keeps only one of the two
    comment = F.when((t != "") & (b != "") & (c != ""), F.concat(t, gap, b, gap, c)).otherwise(F.concat(t, gap, F.when(b != "", b).otherwise(c)))
    other = F.when(t != "", F.concat(t, gap, b)).otherwise(b)
    text = F.when(kind == "post", post).when(kind == "comment", comment).otherwise(other)
    text = F.when(text == "", t).otherwise(text)
    return df.withColumn("scoring_text", F.when(F.length(text) < least, F.lit("")).otherwise(text)).select(*[F.col(f"`{n}`") for n in names if n != "scoring_text"], "scoring_text")


# A small offline lexicon; a remote scorer is injected instead in production.
LEXICON = {"negative": ("걱정", "의문", "부담", "한숨", "terrible", "doubt", "worry", "burden"), "positive": ("신뢰", "늘어난다", "찬성", "trust", "agree", "well said", "잘 보고")}


def lexicon_score(df: DataFrame, text: str = "scoring_text") -> DataFrame:
    """A deterministic stand-in for the remote scorer, as expressions: counts of lexicon hits become weights."""
    hits = lambda words: sum((F.contains(F.lower(F.col(text)), F.lit(w)).cast("int") for w in words), F.lit(0))
    related = F.length(text) > 0
    return df.withColumn("is_related", related).withColumn("negative", F.when(related, hits(LEXICON["negative"]).cast("double")).otherwise(0.0)).withColumn("neutral", F.when(related, F.lit(1.0)).otherwise(0.0)).withColumn("positive", F.when(related, hits(LEXICON["positive"]).cast("double")).otherwise(0.0))


def remote_score(df: DataFrame, scorer, text: str = "scoring_text", tries: int = 3, pause: float = 2.0) -> DataFrame:
    """Rows through an injected scorer (text -> dict), batch by batch; blanks never reach it and failures count as unrelated."""
    schema = StructType([*df.schema.fields, StructField("is_related", BooleanType()), *(StructField(k, DoubleType()) for k in LABELS)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t in b[text]:
                got = None
                if t and t.strip():
                    for k in range(tries):
                        try:
                            got = scorer(t)
                            break
                        except Exception:  # noqa: BLE001 - any failure of the service is retried
                            if k + 1 < tries:
                                time.sleep(pause)
                out.append((bool(got.get("is_related")), float(got.get("negative") or 0), float(got.get("neutral") or 0), float(got.get("positive") or 0)) if got else (False, 0.0, 0.0, 0.0))
            yield b.assign(**dict(zip(("is_related", "negative", "neutral", "positive"), map(list, zip(*out))))) if out else b.assign(is_related=[], negative=[], neutral=[], positive=[])

    return df.mapInPandas(run, schema)


def prompt(text: Column, source: Column, lang: Column) -> Column:
    """The scorer's prompt of a row: what is asked, where the text comes from, the text."""
    head = F.concat(F.lit("source: "), F.coalesce(source, F.lit("unknown")), F.lit("\nlang: "), F.coalesce(lang, F.lit("unknown")))
    ask = F.lit("Answer as JSON with is_related, negative, neutral, positive, label, explanation.")
    return F.concat(ask, F.lit("\n"), head, F.lit("\n\n"), F.coalesce(text, F.lit("")))
