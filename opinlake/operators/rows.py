"""Posts and comments as rows: flattening, canonical form, merge, time order, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.text import EVENT_KEYWORDS, first_paragraph, strip
from ..functions.times import comment_clock, lenient_ntz

CANONICAL = ("id", "source", "lang", "title", "text", "published_at", "comment_index", "comment_text", "comment_publishedAt")
REQUIRED = ("id", "source", "lang", "title", "text", "published_at")


def trimmed(c: str) -> Column:
    return F.nullif(strip(F.col(c).cast("string")), F.lit(""))


def canonical(rows: DataFrame) -> DataFrame:
    """Trimmed strings, blanks as null, defaults for source and language, a lenient comment_index; further columns pass through."""
    base = {c: trimmed(c) for c in CANONICAL if c in rows.columns}
    base["source"] = F.coalesce(trimmed("source"), F.lit("unknown"))
    base["lang"] = F.coalesce(trimmed("lang"), F.lit("ko"))
    base["comment_index"] = F.expr("try_cast(trim(cast(comment_index as string)) as int)")
    return rows.select(*[base[c].alias(c) for c in CANONICAL if c in base], *[c for c in rows.columns if c not in CANONICAL])


def missing_keys(lines: Column) -> Column:
    """The required keys that a JSON line doesn't have; keys with null count as present."""
    return F.array_except(F.array(*[F.lit(k) for k in REQUIRED]), F.coalesce(F.json_object_keys(lines), F.array().cast("array<string>")))


def union_all(*frames: DataFrame) -> DataFrame:
    """Several sources one after another, missing columns as null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def merge(rows: DataFrame, pos: str = "row_id") -> DataFrame:
    """One row per (source, id, comment_index, comment_text): the longest text, then the longest time string, then the earliest; at the
    position of the first. Combined on the map side as one aggregate of a struct, so a hot key is no single task's sort."""
    key = ("source", "id", "comment_index", "comment_text")
    rest = [c for c in rows.columns if c not in key]
    n = lambda c: F.length(F.coalesce(F.col(c), F.lit("")))
    best = F.max_by(F.struct(*rest), F.struct(n("text"), n("published_at"), -F.col(pos)))
    g = rows.groupBy(*key).agg(best.alias("b"), F.min(pos).alias("first_pos"))
    return g.select(*key, *[F.col(f"b.{c}").alias(c) for c in rest], "first_pos")


def time_key() -> Column:
    return F.coalesce(lenient_ntz(F.col("comment_publishedAt")), lenient_ntz(F.col("published_at")))


def time_sorted(rows: DataFrame, pos: str = "row_id") -> DataFrame:
    """All rows in time order, missing times first, ties by position: a range-partitioned sort."""
    return rows.withColumn("sort_time", time_key()).orderBy(F.col("sort_time").asc_nulls_first(), pos)


def time_ranked(rows: DataFrame, pos: str = "row_id") -> DataFrame:
    """Adds sort_time and sort_rank, the row's place (from 1) in that order: each range is numbered by itself and shifted by the sizes of those before it."""
    spread = rows.withColumn("sort_time", time_key()).repartitionByRange(F.col("sort_time").asc_nulls_first(), F.col(pos)).withColumn("_part", F.spark_partition_id())
    inside = spread.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(F.col("sort_time").asc_nulls_first(), pos)))
    sizes = spread.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))  # a row per partition
    before = sizes.select(F.col("_part").alias("_p"), (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    return inside.join(F.broadcast(before), F.col("_part") == F.col("_p")).withColumn("sort_rank", (F.col("_n") + F.col("_before")).cast("long")).drop("_part", "_p", "_n", "_before")


def limit_valid(rows: DataFrame, valid, n: int, pos: str = "row_id") -> DataFrame:
    """The first ``n`` valid rows in the order of ``pos``: rows that can't be read don't count."""
    return rows.filter(valid).orderBy(pos).limit(n)


def success_ratio(rows: DataFrame, valid) -> DataFrame:
    """(n_rows, n_valid, ratio) of a conversion."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(valid).alias("n_valid")).withColumn("ratio", F.when(F.col("n_rows") > 0, F.round(F.col("n_valid") / F.col("n_rows"), 6)).otherwise(F.lit(0.0)))


def counted(rows: DataFrame, name: str, **counters):
    """(rows, observation): counters that fill while the rows are written, without a pass of their own."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(k) for k, c in counters.items()]), seen


def summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce(F.nullif("source", F.lit("")), F.lit("unknown")).alias("source"), F.coalesce(F.nullif("doc_type", F.lit("")), F.lit("unknown")).alias("doc_type")).agg(F.count(F.lit(1)).alias("n"))


def flatten(posts: DataFrame, comments: DataFrame, keep_blank: bool = True) -> DataFrame:
    """Post rows and comment rows; a comment row repeats its post's title and body and is named {post}_{index}. ``keep_blank``: whether blank
    comments stay (forums differ). posts: id, source, title, lang, published_at, text; comments: post_id, comment_index, text, published_at."""
    p = posts.select("id", "source", F.lit("post").alias("doc_type"), F.lit(None).cast("string").alias("parent_id"), "title", "lang", "published_at", "text", F.lit(None).cast("int").alias("comment_index"), F.lit(None).cast("string").alias("comment_text"), F.lit(None).cast("string").alias("comment_publishedAt"))
    c = comments if keep_blank else comments.filter(F.trim(F.coalesce("text", F.lit(""))) != "")
    c = c.select(F.col("post_id").alias("c_post"), F.col("comment_index").alias("c_index"), F.col("text").alias("c_text"), F.col("published_at").alias("c_time"))
    joined = posts.join(c, F.col("id") == F.col("c_post")).select(
        F.concat("id", F.lit("_"), F.col("c_index").cast("string")).alias("id"), "source", F.lit("comment").alias("doc_type"), F.col("id").alias("parent_id"), "title", "lang", "published_at", "text",
        F.col("c_index").cast("int").alias("comment_index"), F.nullif(F.trim("c_text"), F.lit("")).alias("comment_text"), F.col("c_time").alias("comment_publishedAt"))
    return p.unionByName(joined)


def flatten_board(posts: DataFrame, comments: DataFrame, board: str) -> DataFrame:
    """Post and comment rows as one board's export wants them.

    ``paragraph``: the body is the first paragraph, the title what stands before its first pipe, the language Korean; blank comments left out; without a body
    a comment row has no text at all (``has_text`` false) and a later merge drops it. ``events``: posts whose title announces an event are left
    out, blank comments stay with a null text, a time of day alone takes the post's date. ``own_lang``: a comment's own language goes before its post's;
    blank comments left out."""
    has_lang = "lang" in comments.columns
    if board == "paragraph":
        posts = posts.withColumn("title", F.trim(F.substring_index(F.coalesce("title", F.lit("")), "|", 1))).withColumn("text", F.nullif(first_paragraph(F.col("text")), F.lit(""))).withColumn("lang", F.lit("ko"))
    elif board == "events":
        low = F.lower(F.coalesce("title", F.lit("")))
        posts = posts.filter(~F.exists(F.array(*[F.lit(k.lower()) for k in EVENT_KEYWORDS]), lambda k: F.contains(low, k)))
    rows = flatten(posts, comments, keep_blank=board == "events")
    if board == "own_lang" and has_lang:
        own = comments.filter("lang IS NOT NULL AND lang <> ''").select(F.concat("post_id", F.lit("_"), F.col("comment_index").cast("string")).alias("o_id"), F.col("lang").alias("o_lang"))
        rows = rows.join(own, F.col("id") == F.col("o_id"), "left").withColumn("lang", F.coalesce("o_lang", "lang")).drop("o_id", "o_lang")
    if board == "events":
        rows = rows.withColumn("comment_publishedAt", comment_clock(F.col("published_at"), F.col("comment_publishedAt")))
    return rows.withColumn("has_text", (F.col("doc_type") == "post") | F.col("text").isNotNull()) if board == "paragraph" else rows


def flatten_arrays(posts: DataFrame, comments: str = "comments", drop_blank: bool = False, raw_positions: bool = True) -> DataFrame:
    """The same from an array of JSON elements in the post itself; scalars among them are skipped. ``raw_positions``: comment_index is the
    position in the array, else the count after the elements that aren't objects are left out."""
    objects = F.filter(F.transform(comments, lambda x, i: F.struct(i.alias("i"), x.alias("e"))), lambda s: F.json_object_keys(s["e"]).isNotNull())
    at = F.transform(objects, lambda s, i: F.struct((s["i"] if raw_positions else i).alias("i"), s["e"].alias("e")))
    x = posts.withColumn("_c", F.explode(at)).select(
        F.col("id").alias("parent_id"), F.concat("id", F.lit("_"), F.col("_c.i").cast("string")).alias("id"), F.col("_c.i").alias("comment_index"),
        F.trim(F.coalesce(F.get_json_object("_c.e", "$.text"), F.lit(""))).alias("comment_text"), F.get_json_object("_c.e", "$.publishedAt").alias("comment_publishedAt"), F.get_json_object("_c.e", "$.author").alias("author"))
    return x.filter("comment_text <> ''") if drop_blank else x


def flatten_videos(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """One row per non-blank comment, its text the title, description and comment; a row of its own only for videos without any comment."""
    head = F.concat_ws("\n", F.nullif(F.trim("title"), F.lit("")), F.nullif(F.trim("text"), F.lit("")))
    c = comments.select(F.col("post_id").alias("c_post"), F.col("comment_index").alias("c_index"), F.trim(F.coalesce("text", F.lit(""))).alias("c_text"))
    j = posts.join(c, F.col("id") == F.col("c_post"), "left")
    return j.filter(F.col("c_post").isNull() | (F.col("c_text") != "")).select(
        F.when(F.col("c_post").isNull(), F.col("id")).otherwise(F.concat("id", F.lit("_"), F.col("c_index").cast("string"))).alias("id"), "source", F.concat_ws("\n", F.nullif(head, F.lit("")), "c_text").alias("text"),
        F.col("c_index").cast("int").alias("comment_index"), F.col("c_text").alias("comment_text"))


def without_comments(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """(id, body): the post's text with each comment's text taken out, one after another in their order, as a fold inside the JVM. A post's
    comments meet in one row, as they do in the page itself."""
    c = comments.filter(F.trim(F.coalesce("text", F.lit(""))) != "").groupBy(F.col("post_id").alias("c_post")).agg(F.array_sort(F.collect_list(F.struct("comment_index", F.trim("text").alias("t")))).alias("cs"))
    j = posts.join(c, F.col("id") == F.col("c_post"), "left")
    body = F.aggregate(F.coalesce(F.col("cs.t"), F.array().cast("array<string>")), F.trim(F.col("text")), lambda acc, t: F.replace(acc, t, F.lit("")))
    return j.select("id", strip(F.regexp_replace(body, r"\n{3,}", "\n\n")).alias("body"))


def event_time(rows: DataFrame) -> DataFrame:
    """Adds event_time: articles by publication, videos by comment alone, others by comment and else publication, as a Seoul wall clock."""
    pub, com = lenient_ntz(F.col("published_at")), lenient_ntz(F.col("comment_publishedAt"))
    t = F.when(F.col("source").contains("news") | F.col("source").contains("wire"), pub).when(F.col("source").contains("video"), com).otherwise(F.coalesce(com, pub))
    return rows.withColumn("event_time", F.convert_timezone(F.lit("UTC"), F.lit("Asia/Seoul"), t))


def cloud_text(rows: DataFrame) -> DataFrame:
    """Adds cloud_text: a comment's own words, or all texts of a row one after another."""
    part = lambda c: F.nullif(strip(F.coalesce(c, F.lit(""))), F.lit(""))
    return rows.withColumn("cloud_text", F.when(F.col("doc_type") == "comment", F.coalesce(part("comment_text"), F.lit(""))).otherwise(F.concat_ws(" ", part("comment_text"), part("text"), part("title"))))


def sample_rows(rows: DataFrame, snippet: int = 220) -> DataFrame:
    """(row_id, sample): title and snippet parts in one line for a prompt."""
    one = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    t, b = one("title"), F.substring(one("text"), 1, snippet)
    return rows.select("row_id", F.concat_ws(" / ", F.when(t != "", F.concat(F.lit("제목: "), t)), F.when(b != "", F.concat(F.lit("본문: "), b))).alias("sample"))


def latest_per(rows: DataFrame, key: str, order: str) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).filter("_r = 1").drop("_r")
