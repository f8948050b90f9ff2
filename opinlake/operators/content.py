"""Content of documents and posts: quality gate, filters, word statistics, bodies of single sites, assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Lines of one board's interface, at which a body ends or which are skipped before it.
UI_LINES = ("목록보기", "목록으로", "이전글", "다음글", "첨부파일", "댓글쓰기", "댓글 쓰기", "글쓰기", "NO", "YES")
UI_STARTS = ("추천하기", "다른의견", "신고", "댓글주소복사", "레벨", "알림", "짤방", "사진", "익명요구", "이미지추가", "코멘트", "갤러리")
# The marks around one board's bodies.
BODY_START = "갤러리 본문 영역"
BODY_ENDS = ("하단 갤러리 리스트 영역", "갤러리 리스트 영역", "왼쪽 컨텐츠 영역")
UI_MARKS = ("|", "△", "▽", "▶", "▲", "▼")


def length_between(text: Column, least: int, most: int) -> Column:
    n = F.length(T.strip(F.coalesce(text, F.lit(""))))
    return (n > 0) & (n >= least) & (n <= most)


def keyword_quality(rows: DataFrame, title: str, text: str, keywords: tuple[str, ...], lang: str, langs: tuple[str, ...], least: int = 1, fallback: str | None = None) -> DataFrame:
    """Adds length, hits (keywords found in title and text), coverage, score, reasons and passed. An empty text gives way to ``fallback`` (a column such as a
    post's comments, one a line); no language counts as ``und``."""
    body = F.coalesce(F.col(text), F.lit(""))
    if fallback:
        body = F.when(body == "", F.coalesce(F.col(fallback), F.lit(""))).otherwise(body)
    blended = F.lower(F.concat(F.when(F.col(title).isNotNull(), F.concat(F.col(title), F.lit("\n"))).otherwise(F.lit("")), body))
    n = F.size(F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(blended, F.lower(k))))
    language = F.coalesce(F.col(lang), F.lit("und"))
    right = F.lower(language).isin(*langs)
    reasons = F.array_compact(F.array(F.when(~right, F.concat(F.lit("lang="), language)), F.when(n < least, F.lit("keyword_hits"))))
    score = F.when(right, 0.3).otherwise(0.0) + F.when(n >= least, 0.2).otherwise(0.0)
    return rows.withColumn("length", F.length(body).cast("long")).withColumn("hits", n.cast("long")).withColumn("coverage", F.round(n / len(keywords), 3)).withColumn("score", F.round(score, 3)).withColumn("reasons", F.array_join(reasons, ",")).withColumn("passed", n >= least)


def between_markers(text: Column, start: str = BODY_START, ends: tuple[str, ...] = BODY_ENDS) -> Column:
    """What follows the last ``start``, if there is one, up to the first of each of ``ends`` in turn."""
    t = F.coalesce(text, F.lit(""))
    t = F.element_at(F.split(t, F.lit("\\Q" + start + "\\E")), -1) if start else t
    for e in ends:
        t = F.substring_index(t, e, 1)
    return T.strip(t)


def distinct_comments(comments: DataFrame, post: str, text: str, order: str) -> DataFrame:
    """The first comment of each text of a page; blank ones are left out. Combined on the map side, so a hot page is no single task."""
    t = F.trim(F.coalesce(F.col(text), F.lit("")))
    first = comments.withColumn("_t", t).filter("_t <> ''").groupBy(F.col(post).alias("_post"), "_t").agg(F.min(order).alias("_first"))
    return first.select(F.col("_post").alias(post), F.col("_first").alias(order), F.col("_t").alias(text))


def words(rows: DataFrame, text: Column, label: str, pos: str, lang: str = "en", stop: tuple[str, ...] = ()) -> DataFrame:
    """(pos, at, word, label): tokens fit for a word cloud."""
    t = T.korean_english_only(T.web_noise(text))
    w = rows.select(F.col(pos).alias("pos"), F.col(label).alias("label"), F.posexplode(F.split(F.lower(t) if lang == "en" else t, " ")).alias("at", "word")).filter("word <> ''")
    if lang == "en":
        return w.filter(F.col("word").rlike("^[a-z]{2,}$") & ~T.is_gibberish(F.col("word")) & (~F.col("word").isin(*stop) if stop else F.lit(True)))
    return w.withColumn("word", F.regexp_extract("word", "([가-힣]{2,})", 1)).filter("word <> ''")


def word_stats(tokens: DataFrame, least: int = 2) -> DataFrame:
    """(word, n, negative, neutral, positive, word_score) of words that occur often enough: one combined aggregate."""
    g = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("label") == x).alias(x) for x in ("negative", "neutral", "positive")]).filter(F.col("n") >= least)
    return g.withColumn("word_score", F.round((F.col("positive") - F.col("negative")) / F.col("n"), 6))


def word_links(stats: DataFrame, k: int) -> DataFrame:
    """(word, label, n) links of the k most frequent words, without empty ones."""
    top = stats.orderBy(F.desc("n"), "word").limit(k)
    return top.select("word", F.expr("stack(3, 'negative', negative, 'neutral', neutral, 'positive', positive) as (label, n)")).filter("n > 0")


def comment_phrases(comments: DataFrame) -> DataFrame:
    """(post_id, phrases): the lines of a post's comments without trailing bars; a post's own comments meet in one row."""
    line = F.explode(F.split(T.unix_lines(F.trim("text")), "\n"))
    x = comments.select("post_id", line.alias("l")).select("post_id", F.trim(F.regexp_replace(F.trim("l"), r"\|+$", "")).alias("l")).filter("l <> ''").distinct()
    return x.groupBy("post_id").agg(F.array_sort(F.collect_list("l")).alias("phrases"))


def board_body(rows: DataFrame, text: str, title: str, phrases: str | None = None) -> DataFrame:
    """Adds ``body``: what stands between the view count and the interface of a board's page. Lines are classed once; the body begins at
    the first line that is neither blank nor interface and ends before the next line that is interface or opens a comment. All of it is
    array algebra inside the JVM; null texts have an empty body."""
    head = F.trim(F.coalesce(F.col(title), F.lit("")))
    every = F.transform(F.split(T.unix_lines(F.coalesce(F.col(text), F.lit(""))), "\n"), lambda x: T.strip(x))
    after_title = F.when(head != "", F.array_position(every, head)).otherwise(F.lit(0)).cast("int")
    tail = F.slice(F.col("_every"), F.col("_at") + 1, F.greatest(F.size("_every") - F.col("_at"), F.lit(0)))
    views = F.array_position(F.transform(F.col("_tail"), lambda x: F.contains(x, F.lit("조회"))), F.lit(True)).cast("int")
    said = F.coalesce(F.col(phrases), F.array().cast("array<string>")) if phrases else F.array().cast("array<string>")
    bare = F.transform(F.slice(F.col("_tail"), F.col("_views") + 1, F.greatest(F.size("_tail") - F.col("_views"), F.lit(0))), lambda x: T.strip(F.regexp_replace(x, r"\|+$", "")))
    starts = r"^(" + "|".join(UI_STARTS) + ")"
    classed = F.transform(
        F.filter(bare, lambda x: ~x.isin(*UI_MARKS)),
        lambda x: F.struct(x.alias("x"), (x.isin(*UI_LINES) | x.rlike(starts) | x.rlike(r"^\d+$")).alias("ui"), F.array_contains(said, x).alias("said")),
    )
    first = F.array_position(F.transform(F.col("_c"), lambda t: (t["x"] != "") & ~t["ui"]), F.lit(True)).cast("int")
    own = F.when(F.col("_first") > 0, F.slice(F.col("_c"), F.greatest(F.col("_first"), F.lit(1)), F.size("_c")))
    stop = F.array_position(F.transform(F.col("_own"), lambda t, i: (i > 0) & (t["ui"] | t["said"])), F.lit(True)).cast("int")
    kept = F.when(F.col("_stop") > 0, F.slice(F.col("_own"), F.lit(1), F.greatest(F.col("_stop") - 1, F.lit(0)))).otherwise(F.col("_own"))
    x = rows.withColumn("_every", every).withColumn("_at", after_title).withColumn("_tail", tail).withColumn("_views", views).withColumn("_c", classed).withColumn("_first", first).withColumn("_own", own).withColumn("_stop", stop)
    joined = T.strip(F.regexp_replace(F.array_join(F.transform(kept, lambda t: t["x"]), "\n"), r"\n{3,}", "\n\n"))
    return x.withColumn("body", F.coalesce(joined, F.lit(""))).drop("_every", "_at", "_tail", "_views", "_c", "_first", "_own", "_stop")


def assemble(rows: DataFrame, *, titles: tuple[str, ...], times: tuple[str, ...], text: str, source: str, tolerant: tuple[str, ...]) -> DataFrame:
    """Title and time from the first source that has them, and the reason for which a page is rejected: no text (tolerated for some
    sources) or no title."""
    blank = lambda c: F.nullif(T.strip(F.col(c).cast("string")), F.lit(""))
    t, p = F.coalesce(*[blank(c) for c in titles]), F.coalesce(*[blank(c) for c in times])
    reason = F.when(blank(text).isNull() & ~F.col(source).isin(*tolerant), F.lit("empty")).when(t.isNull(), F.lit("untitled"))
    return rows.withColumn("final_title", t).withColumn("final_time", p).withColumn("rejected", reason)


def augment(posts: DataFrame, comments: DataFrame, most: int = 200) -> DataFrame:
    """(id, full_text): the body with its first comments below, as search and scoring read it. The number of comments is part of the form."""
    c = comments.filter(F.trim(F.coalesce("text", F.lit(""))) != "")
    w = Window.partitionBy("post_id").orderBy("comment_index")
    c = c.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= most)
    g = c.groupBy(F.col("post_id").alias("c_post")).agg(F.array_sort(F.collect_list(F.struct("comment_index", F.trim("text").alias("t")))).alias("cs"))
    j = posts.join(g, F.col("id") == F.col("c_post"), "left")
    return j.select("id", F.concat_ws("\n\n", F.nullif(T.strip(F.coalesce("text", F.lit(""))), F.lit("")), F.nullif(F.array_join(F.coalesce(F.col("cs.t"), F.array().cast("array<string>")), "\n"), F.lit(""))).alias("full_text"))


def author_counts(posts: DataFrame) -> DataFrame:
    return posts.select(F.explode("authors").alias("author")).groupBy("author").agg(F.count(F.lit(1)).alias("n"))


def left_details(items: DataFrame, details: DataFrame, key: str, detail_key: str, fill: dict[str, tuple[str, str]]) -> DataFrame:
    """Search items with their details where there are any; each filled column takes the detail's value first. The planner broadcasts the
    details only when they are small."""
    j = items.join(details, F.col(key) == F.col(detail_key), "left")
    return j.select(*[F.col(c) for c in items.columns if c not in fill], *[F.coalesce(F.col(a), F.col(b)).alias(c) for c, (a, b) in fill.items()])
