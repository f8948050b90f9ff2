"""The core's registered queries and their SQL. Every query runs over its whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .functions import times as C
from .functions import url as U
from .operators import content, dashboard, dedup, planner, rows, scored, timestamps
from .session import ensure_checkpoint_dir, table
from .sources import jsonl

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text, so that results look alike in every engine."""
    return df.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) if t == "date" else F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if t.startswith("timestamp") else F.col(f"`{c}`") for c, t in df.dtypes])


def query(sql: str | None = None):
    """Register a query under its name, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = lambda s, d: _plain(f(s, d))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _ev(s: SparkSession, d: str) -> DataFrame:
    return scored.from_events(table(s, d, "events"))


def _rows(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(f"{d}/unified_rows.parquet")


def _docs(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(f"{d}/documents.parquet")


def _posts(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(f"{d}/raw_posts.parquet")


def _comments(s: SparkSession, d: str) -> DataFrame:
    return s.read.parquet(f"{d}/raw_comments.parquet").select("post_id", "comment_index", "text", F.col("published_at_raw").alias("published_at"), "author", "comment_key")


def _post_rows(s: SparkSession, d: str) -> DataFrame:
    """raw_posts, the first of each id."""
    p = _posts(s, d).select("row_id", "id", "source", "title", "lang", "published_at", F.col("raw_text").alias("text"))
    return dedup.first_by(p, "id", "row_id")


EV = """WITH k AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, ts + INTERVAL 9 HOUR AS kst FROM events),
w AS (SELECT event_id AS pos_id, event_type AS source, user_id, kst, strftime(kst, '%Y-%m-%d') AS day, CAST(hour(kst) AS INT) AS hr, greatest(0, 50 - k) AS neg, CAST(25 AS BIGINT) AS neu, greatest(0, k - 50) AS pos FROM k),
e AS (SELECT *, CASE WHEN neg >= neu AND neg >= pos THEN 'negative' WHEN neu >= pos THEN 'neutral' ELSE 'positive' END AS label, CAST(pos - neg AS DOUBLE) / (neg + neu + pos) AS score FROM w)
"""
SHARE = "round(avg(CASE WHEN label = '{0}' THEN 1.0 ELSE 0.0 END), 6)"


# --- dashboard
@query(EV + ", g AS (SELECT day, avg(score) AS s, count(*) AS n FROM e WHERE source <> 'signup' GROUP BY day) SELECT day, round(s, 6) AS score, n, round(avg(s) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS ma7 FROM g")
def daily_score_ma7(s, d):
    return dashboard.daily_score(_ev(s, d))


@query(EV + ", g AS (SELECT hr, avg(score) AS s, count(*) AS n FROM e WHERE source <> 'signup' GROUP BY hr) SELECT hr, round(s, 6) AS score, n, round(avg(s) OVER (ORDER BY hr ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS ma3 FROM g")
def hourly_score_ma3(s, d):
    return dashboard.hourly_score(_ev(s, d))


@query(EV + "SELECT day, count(*) AS n FROM e WHERE source <> 'signup' GROUP BY day")
def daily_volume(s, d):
    return dashboard.volume(dashboard.comments(_ev(s, d)), "day")


@query(EV + "SELECT hr, count(*) AS n FROM e WHERE source <> 'signup' GROUP BY hr")
def hourly_volume(s, d):
    return dashboard.volume(dashboard.comments(_ev(s, d)), "hr")


@query(EV + "SELECT day, count(*) AS n FROM e WHERE source = 'signup' GROUP BY day")
def article_daily(s, d):
    return dashboard.volume(dashboard.articles(_ev(s, d)), "day")


@query(EV + "SELECT min(day) AS first_day, max(day) AS last_day, count(*) AS n FROM e WHERE source = 'signup'")
def article_span(s, d):
    return dashboard.span(dashboard.articles(_ev(s, d)))


@query(EV + f"SELECT count(*) AS n_rows, {SHARE.format('negative')} AS negative_share, {SHARE.format('positive')} AS positive_share, CAST(sum(CASE WHEN source = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS n_articles FROM e")
def kpi_summary(s, d):
    return dashboard.kpis(_ev(s, d))


_DIST = ", l AS (SELECT unnest(['negative', 'neutral', 'positive']) AS label) SELECT l.label, CAST(count(e.label) AS BIGINT) AS n FROM l LEFT JOIN e ON l.label = e.label AND e.source {} 'signup' GROUP BY l.label"


@query(EV + _DIST.format("<>"))
def label_distribution(s, d):
    return dashboard.label_distribution(dashboard.comments(_ev(s, d)))


@query(EV + _DIST.format("="))
def article_label_distribution(s, d):
    return dashboard.label_distribution(dashboard.articles(_ev(s, d)))


@query(EV + "SELECT source, count(*) AS n FROM e WHERE source <> 'signup' GROUP BY source")
def source_counts(s, d):
    return dashboard.source_counts(_ev(s, d))


@query(EV + ", g AS (SELECT source, label, count(*) AS n FROM e WHERE source <> 'signup' GROUP BY source, label) SELECT source, label, n, round(n / sum(n) OVER (PARTITION BY source), 6) AS share FROM g")
def source_label_share(s, d):
    return dashboard.source_label_share(_ev(s, d))


@query(EV + """, g AS (SELECT source, sum(CASE WHEN label = 'negative' THEN 1.0 ELSE 0 END)::DOUBLE AS a, sum(CASE WHEN label = 'neutral' THEN 1.0 ELSE 0 END)::DOUBLE AS b, sum(CASE WHEN label = 'positive' THEN 1.0 ELSE 0 END)::DOUBLE AS c FROM e WHERE source <> 'signup' GROUP BY source),
t AS (SELECT *, a + b + c AS t, (a + b + c) / max(a + b + c) OVER () AS sc FROM g), q AS (SELECT source, a / t * sc AS a, b / t * sc AS b, c / t * sc AS c FROM t)
SELECT source, 'negative' AS label, round(-a - b / 2, 6) AS x0, round(-b / 2, 6) AS x1 FROM q UNION ALL SELECT source, 'neutral', round(-b / 2, 6), round(b / 2, 6) FROM q UNION ALL SELECT source, 'positive', round(b / 2, 6), round(b / 2 + c, 6) FROM q""")
def likert_segments(s, d):
    return dashboard.likert_segments(_ev(s, d))


_BUCKET = "SELECT {0}, round(avg(score), 6) AS score, count(*) AS n, " + ", ".join(f"{SHARE.replace('{0}', x)} AS {x}_share" for x in scored.LABELS) + ", min(day) AS first_day, max(day) AS last_day FROM e GROUP BY {0}"


@query(EV + _BUCKET.format("day"))
def bucket_stats_day(s, d):
    return dashboard.bucket_stats(_ev(s, d), "day")


@query(EV + _BUCKET.format("hr"))
def bucket_stats_hour(s, d):
    return dashboard.bucket_stats(_ev(s, d), "hr")


@query(EV + ", g AS (SELECT hr, day, count(*) AS n FROM e GROUP BY hr, day), r AS (SELECT *, row_number() OVER (PARTITION BY hr ORDER BY n DESC, day) AS rank FROM g) SELECT * FROM r WHERE rank <= 3")
def top_dates(s, d):
    return dashboard.top_dates(_ev(s, d))


@query(EV + "SELECT source, count(*) AS n FROM e GROUP BY source ORDER BY n DESC, source LIMIT 5")
def top_sources(s, d):
    return dashboard.top_sources(_ev(s, d))


@query(EV + ", r AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY day DESC, pos_id) AS rank, pos_id, day, source FROM e) SELECT * FROM r WHERE rank <= 6")
def policy_samples(s, d):
    return dashboard.samples(_ev(s, d))


@query(EV + ", b AS (SELECT max(day) AS hi, greatest(min(day), strftime(CAST(max(day) AS DATE) - INTERVAL 90 DAY, '%Y-%m-%d')) AS lo FROM e) SELECT source, count(*) AS n, min(day) AS first_day, max(day) AS last_day FROM e, b WHERE day BETWEEN lo AND hi GROUP BY source")
def date_range_default(s, d):
    return dashboard.select_range(_ev(s, d)).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query(EV + "SELECT DISTINCT hr, (CASE WHEN hr < 12 THEN '오전 ' ELSE '오후 ' END) || CAST(CASE WHEN hr % 12 = 0 THEN 12 ELSE hr % 12 END AS VARCHAR) || '시' AS hour_label FROM e")
def hour_labels(s, d):
    return _ev(s, d).select("hr").distinct().withColumn("hour_label", T.hour_label(F.col("hr")))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def selection_dates(s, d):
    e = table(s, d, "events")
    ms = (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long")
    pick = F.when(F.col("event_id") % 3 == 0, ms.cast("string")).when(F.col("event_id") % 3 == 1, F.floor(ms / 1000).cast("string")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return e.select("event_id", C.selection_date(pick).alias("day"))


@query(EV + "SELECT DISTINCT day, strftime(CAST(day AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') AS from_day, strftime(CAST(day AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS to_day FROM e")
def search_window_days(s, d):
    return _ev(s, d).select("day").distinct().select("day", F.date_sub("day", 1).alias("from_day"), F.date_add("day", 1).alias("to_day"))


@query("SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts FROM events")
def half_open_window(s, d):
    return dashboard.within(table(s, d, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts")), "ts", "2024-01-10", "2024-01-20")


@query("SELECT event_id FROM events WHERE ts IS NULL OR CAST(ts + INTERVAL 9 HOUR AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-15'")
def local_day_filter(s, d):
    return dashboard.local_days(table(s, d, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts")), "ts", "Asia/Seoul", "2024-01-05", "2024-01-15").select("event_id")


@query(EV + "SELECT pos_id, source, CAST(neg AS DOUBLE) AS negative, CAST(neu AS DOUBLE) AS neutral, CAST(pos AS DOUBLE) AS positive FROM e")
def keep_columns(s, d):
    return dashboard.keep_columns(_ev(s, d), ("pos_id", "source", "missing"))


@query(EV + ", m AS (SELECT DISTINCT strftime(kst, '%Y-%m') AS month FROM e) SELECT month, month || '-01' AS w_start, strftime(least(CAST(month || '-01' AS DATE) + INTERVAL 1 MONTH, DATE '2024-01-20'), '%Y-%m-%d') AS w_end FROM m")
def month_window_bounds(s, d):
    return planner.month_bounds(planner.month_counts(_ev(s, d)), "2024-01-20")


@query("WITH k AS (SELECT DISTINCT event_type AS keyword FROM events), n AS (SELECT count(*) AS n FROM k) SELECT keyword, CAST(10000 // n AS BIGINT) AS units, CAST((10000 // n) // 101 AS BIGINT) AS calls FROM k, n")
def keyword_quotas(s, d):
    return planner.quotas(table(s, d, "events").select(F.col("event_type").alias("keyword")).distinct(), 10_000)


# --- scores
_PCT = """, s AS (SELECT *, round_even(neg / CAST(neg + neu + pos AS DOUBLE) * 100, 0)::BIGINT AS n0, round_even(neu / CAST(neg + neu + pos AS DOUBLE) * 100, 0)::BIGINT AS u0, round_even(pos / CAST(neg + neu + pos AS DOUBLE) * 100, 0)::BIGINT AS p0 FROM e),
p AS (SELECT pos_id, n0 + CASE WHEN n0 >= u0 AND n0 >= p0 THEN 100 - n0 - u0 - p0 ELSE 0 END AS p_neg, u0 + CASE WHEN NOT (n0 >= u0 AND n0 >= p0) AND u0 >= p0 THEN 100 - n0 - u0 - p0 ELSE 0 END AS p_neu, p0 + CASE WHEN NOT (n0 >= u0 AND n0 >= p0) AND NOT u0 >= p0 THEN 100 - n0 - u0 - p0 ELSE 0 END AS p_pos FROM s)
"""


@query(EV + _PCT + "SELECT * FROM p")
def prob_renormalize_pct(s, d):
    return scored.percents(_ev(s, d), "neg", "neu", "pos").select("pos_id", "p_neg", "p_neu", "p_pos")


@query(EV + _PCT + "SELECT pos_id, CASE WHEN p_neg = greatest(p_neg, p_neu, p_pos) THEN '부정' WHEN p_pos = greatest(p_neg, p_neu, p_pos) THEN '긍정' ELSE '중립' END AS label_ko FROM p")
def decide_label(s, d):
    return scored.percents(_ev(s, d), "neg", "neu", "pos").select("pos_id", scored.decide_label("p_neg", "p_neu", "p_pos").alias("label_ko"))


@query()
def prob_normalize_client(s, d):
    x = _ev(s, d).select("pos_id", F.lit("").alias("text"), "source", (F.col("neg") >= 0).alias("is_related"), F.col("neg").cast("double").alias("negative"), F.col("neu").cast("double").alias("neutral"), F.col("pos").cast("double").alias("positive"), F.lit("").alias("label"))
    return scored.client_normal(x).select("pos_id", "negative", "neutral", "positive", "label")


_TXT = r"""WITH x AS (SELECT row_id, regexp_replace(coalesce(title, ''), '^[\s\x{00A0}\x{3000}]+|[\s\x{00A0}\x{3000}]+$', '', 'g') AS t, regexp_replace(coalesce(text, ''), '^[\s\x{00A0}\x{3000}]+|[\s\x{00A0}\x{3000}]+$', '', 'g') AS b, regexp_replace(coalesce(comment_text, ''), '^[\s\x{00A0}\x{3000}]+|[\s\x{00A0}\x{3000}]+$', '', 'g') AS c, coalesce(nullif(doc_type, ''), 'post') AS kind FROM unified_rows),
y AS (SELECT row_id, t, CASE WHEN kind = 'post' THEN CASE WHEN t <> '' AND b <> '' THEN t || chr(10) || chr(10) || b WHEN t <> '' THEN t ELSE b END
 WHEN kind = 'comment' THEN CASE WHEN t <> '' AND b <> '' AND c <> '' THEN t || chr(10) || chr(10) || b || chr(10) || chr(10) || c ELSE t || chr(10) || chr(10) || CASE WHEN b <> '' THEN b ELSE c END END
 ELSE CASE WHEN t <> '' THEN t || chr(10) || chr(10) || b ELSE b END END AS x FROM x), z AS (SELECT row_id, CASE WHEN x = '' THEN t ELSE x END AS x FROM y)
SELECT row_id, CASE WHEN length(x) < 5 THEN '' ELSE x END AS scoring_text FROM z"""


@query(_TXT)
def scoring_text(s, d):
    return scored.scoring_text(_rows(s, d)).select("row_id", "scoring_text")


@query()
def lexicon_scores(s, d):
    x = scored.lexicon_score(scored.scoring_text(_rows(s, d)))
    return x.select("row_id", "is_related", scored.dominant("negative", "neutral", "positive").alias("label"), F.round(scored.score("negative", "neutral", "positive"), 6).alias("score"))


@query("SELECT row_id, 'Answer as JSON with is_related, negative, neutral, positive, label, explanation.' || chr(10) || 'source: ' || coalesce(source, 'unknown') || chr(10) || 'lang: ' || coalesce(lang, 'unknown') || chr(10) || chr(10) || coalesce(comment_text, '') AS prompt FROM unified_rows")
def prompt_rows(s, d):
    return _rows(s, d).select("row_id", scored.prompt(F.col("comment_text"), F.col("source"), F.col("lang")).alias("prompt"))


# --- planning
@query(EV + "SELECT strftime(kst, '%Y-%m') AS month, source, count(*) AS n FROM e GROUP BY ALL")
def month_source_counts(s, d):
    return planner.month_counts(_ev(s, d))


_MISS = EV + """, c AS (SELECT strftime(kst, '%Y-%m') AS month, source, count(*) AS n FROM e GROUP BY ALL), hi AS (SELECT CAST(max(month) || '-01' AS DATE) AS m FROM c),
g AS (SELECT strftime(unnest(generate_series(m - INTERVAL 11 MONTH, m, INTERVAL 1 MONTH)), '%Y-%m') AS month FROM hi), q AS (SELECT DISTINCT source FROM c),
f AS (SELECT g.month, q.source, CAST(greatest(0, 200 - coalesce(c.n, 0)) AS BIGINT) AS deficit FROM g CROSS JOIN q LEFT JOIN c ON c.month = g.month AND c.source = q.source)
"""


@query(_MISS + "SELECT * FROM f")
def month_deficits(s, d):
    return planner.deficits(planner.month_counts(_ev(s, d)), 200)


@query(_MISS + ", t AS (SELECT month, CAST(sum(deficit) AS BIGINT) AS total FROM f GROUP BY month), a AS (SELECT *, round(total * (1 - 0.03::DOUBLE * (row_number() OVER (ORDER BY month DESC) - 1)), 6) AS rank_score FROM t) SELECT month, total, rank_score, CAST((row_number() OVER (ORDER BY rank_score DESC, month) - 1 - 2 + count(*) OVER ()) % count(*) OVER () AS BIGINT) AS turn FROM a")
def month_rank_rotate(s, d):
    return planner.rank_rotate(planner.deficits(planner.month_counts(_ev(s, d)), 200), 2)


@query(EV + ", r AS (SELECT source AS bucket, sum(CASE WHEN label = 'negative' THEN 1 ELSE 0 END)::BIGINT AS n_stored, sum(CASE WHEN label <> 'negative' THEN 1 ELSE 0 END)::BIGINT AS n_duplicates, count_if(user_id % 4 = 0)::BIGINT AS n_fetched FROM e GROUP BY source, day) SELECT bucket, n_stored, n_duplicates, n_fetched, round(n_duplicates / CAST(greatest(1, n_fetched + n_duplicates) AS DOUBLE), 6) AS dup_ratio, CAST(CASE WHEN n_stored < 1 OR n_duplicates / CAST(greatest(1, n_fetched + n_duplicates) AS DOUBLE) >= 0.8 THEN 3 ELSE 0 END AS BIGINT) AS rest FROM r")
def cooldown_rule(s, d):
    r = _ev(s, d).groupBy("source", "day").agg(F.count_if(F.col("label") == "negative").alias("n_stored"), F.count_if(F.col("label") != "negative").alias("n_duplicates"), F.count_if(F.col("user_id") % 4 == 0).alias("n_fetched"))
    return planner.cooldowns(r.select(F.col("source").alias("bucket"), "n_stored", "n_duplicates", "n_fetched"))


@query("WITH s AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-29', INTERVAL 6 DAY)) AS DATE) AS w_start), w AS (SELECT w_start, least(CAST(w_start + INTERVAL 7 DAY AS DATE), DATE '2024-03-01') AS w_end FROM s) SELECT DISTINCT event_type AS keyword, strftime(w_start, '%Y-%m-%d') AS w_start, strftime(w_end, '%Y-%m-%d') AS w_end FROM events CROSS JOIN w")
def keyword_window_cross(s, d):
    k = table(s, d, "events").select(F.col("event_type").alias("keyword")).distinct()
    return planner.keyword_windows(k, planner.windows(s, "2024-01-01", "2024-03-01", 7, 1))


@query("SELECT event_id, CAST(CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS BIGINT) AS priority FROM events")
def priority_order(s, d):
    return table(s, d, "events").select("event_id", planner.priority("event_type", ("purchase", "click")).alias("priority"))


@query("WITH r AS (SELECT row_id, source, row_number() OVER (PARTITION BY source ORDER BY row_id) AS rank FROM raw_posts) SELECT * FROM r WHERE rank <= 20")
def per_source_cap(s, d):
    return planner.cap_per_source(_posts(s, d).select("row_id", "source"), 20, "row_id")


@query("SELECT row_id, CAST(floor((row_number() OVER (ORDER BY row_id) - 1) / 50) AS BIGINT) AS chunk FROM raw_posts")
def id_chunks(s, d):
    return planner.chunks(_posts(s, d).select("row_id"), "row_id", 50)


# --- rows
_STRIP = r"nullif(regexp_replace({0}, '^[\s\x{{00A0}}\x{{3000}}]+|[\s\x{{00A0}}\x{{3000}}]+$', '', 'g'), '')"
_CANON = "SELECT row_id, " + ", ".join(f"{_STRIP.format(c)} AS {c}" for c in ("id", "title", "text", "published_at", "comment_text", '"comment_publishedAt"')).replace('AS "comment_publishedAt"', 'AS "comment_publishedAt"') + f", coalesce({_STRIP.format('source')}, 'unknown') AS source, coalesce({_STRIP.format('lang')}, 'ko') AS lang, coalesce(comment_index, -1) AS comment_index FROM unified_rows"


@query(_CANON)
def merge_canonical(s, d):
    return rows.canonical(_rows(s, d)).select("row_id", *rows.CANONICAL).withColumn("comment_index", F.coalesce("comment_index", F.lit(-1)))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY source, id, comment_index, comment_text ORDER BY length(coalesce(text, '')) DESC, length(coalesce(published_at, '')) DESC, row_id) AS rn, min(row_id) OVER (PARTITION BY source, id, comment_index, comment_text) AS first_pos FROM unified_rows)
SELECT row_id, source, id, first_pos FROM r WHERE rn = 1""")
def merge_dedup(s, d):
    return rows.merge(_rows(s, d)).select("row_id", "source", "id", "first_pos")


_NTZ = r"""CASE WHEN regexp_matches({0}, '^\d{{4}}-\d{{2}}-\d{{2}}([T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d{{1,6}})?)?)?(Z|[+-]\d{{2}}:?\d{{2}})?$') THEN TRY_CAST(replace(regexp_replace({0}, '(Z|[+-]\d{{2}}:?\d{{2}})$', ''), 'T', ' ') AS TIMESTAMP) WHEN regexp_matches({0}, '^\d{{8}}T\d{{6}}Z?$') THEN try_strptime(replace({0}, 'Z', ''), '%Y%m%dT%H%M%S') END"""


_TIME = f"""WITH x AS (SELECT row_id, source, {_NTZ.format('"comment_publishedAt"')} AS c, {_NTZ.format('published_at')} AS p FROM unified_rows)"""


@query(_TIME + " SELECT row_id, strftime(coalesce(c, p), '%Y-%m-%d %H:%M:%S') AS sort_time, row_number() OVER (ORDER BY coalesce(c, p) NULLS FIRST, row_id) AS sort_rank FROM x")
def merge_time_sort_pos(s, d):
    x = rows.time_ranked(_rows(s, d).select("row_id", "published_at", "comment_publishedAt"))
    return x.select("row_id", "sort_time", "sort_rank")


@query("SELECT coalesce(nullif(source, ''), 'unknown') AS source, coalesce(nullif(doc_type, ''), 'unknown') AS doc_type, count(*) AS n FROM unified_rows GROUP BY ALL")
def source_doctype_summary(s, d):
    return rows.summary(_rows(s, d))


@query(_TIME + " SELECT row_id, strftime(CASE WHEN contains(source, 'news') OR contains(source, 'wire') THEN p WHEN contains(source, 'video') THEN c ELSE coalesce(c, p) END + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS event_time FROM x")
def event_time_by_source(s, d):
    return rows.event_time(_rows(s, d)).select("row_id", "event_time")


@query(r"SELECT row_id, CASE WHEN doc_type = 'comment' THEN regexp_replace(coalesce(comment_text, ''), '^[\s\x{00A0}\x{3000}]+|[\s\x{00A0}\x{3000}]+$', '', 'g') ELSE concat_ws(' ', nullif(regexp_replace(coalesce(comment_text, ''), '^[\s\x{00A0}\x{3000}]+|[\s\x{00A0}\x{3000}]+$', '', 'g'), ''), nullif(regexp_replace(coalesce(text, ''), '^[\s\x{00A0}\x{3000}]+|[\s\x{00A0}\x{3000}]+$', '', 'g'), ''), nullif(regexp_replace(coalesce(title, ''), '^[\s\x{00A0}\x{3000}]+|[\s\x{00A0}\x{3000}]+$', '', 'g'), '')) END AS cloud_text FROM unified_rows")
def wordcloud_text(s, d):
    return rows.cloud_text(_rows(s, d)).select("row_id", "cloud_text")


@query(r"WITH x AS (SELECT row_id, trim(regexp_replace(coalesce(title, ''), '\s+', ' ', 'g')) AS t, substr(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')), 1, 220) AS b FROM unified_rows) SELECT row_id, concat_ws(' / ', CASE WHEN t <> '' THEN '제목: ' || t END, CASE WHEN b <> '' THEN '본문: ' || b END) AS sample FROM x")
def sample_snippets(s, d):
    return rows.sample_rows(_rows(s, d))


@query("SELECT row_id, CAST((CASE WHEN title IS NULL THEN 1 ELSE 0 END) + (CASE WHEN text IS NULL THEN 1 ELSE 0 END) + (CASE WHEN published_at IS NULL THEN 1 ELSE 0 END) + (CASE WHEN lang IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing FROM unified_rows")
def required_keys(s, d):
    line = F.to_json(F.struct("id", "source", "lang", "title", "text", "published_at"), {"ignoreNullFields": "true"})
    return _rows(s, d).select("row_id", F.size(rows.missing_keys(line)).cast("long").alias("n_missing"))


_POST1 = "WITH p AS (SELECT id, min(row_id) AS row_id FROM raw_posts GROUP BY id), q AS (SELECT r.* FROM raw_posts r JOIN p ON r.row_id = p.row_id)"


@query(_POST1 + " SELECT id, 'post' AS doc_type, CAST(NULL AS VARCHAR) AS parent_id, -1 AS comment_index, CAST(NULL AS VARCHAR) AS comment_text FROM q UNION ALL SELECT q.id || '_' || CAST(c.comment_index AS VARCHAR), 'comment', q.id, c.comment_index, nullif(trim(c.text), '') FROM q JOIN raw_comments c ON c.post_id = q.id")
def flatten_post_comments(s, d):
    return rows.flatten(_post_rows(s, d), _comments(s, d)).select("id", "doc_type", "parent_id", F.coalesce("comment_index", F.lit(-1)).alias("comment_index"), "comment_text")


@query(_POST1 + " SELECT q.id || '_' || CAST(c.comment_index AS VARCHAR) AS id, c.comment_index, trim(c.text) AS comment_text FROM q JOIN raw_comments c ON c.post_id = q.id WHERE trim(coalesce(c.text, '')) <> ''")
def flatten_skip_blank(s, d):
    return rows.flatten(_post_rows(s, d), _comments(s, d), keep_blank=False).filter("doc_type = 'comment'").select("id", "comment_index", "comment_text")


@query(_POST1 + " SELECT CASE WHEN c.post_id IS NULL THEN q.id ELSE q.id || '_' || CAST(c.comment_index AS VARCHAR) END AS id, coalesce(c.comment_index, -1) AS comment_index, CASE WHEN c.post_id IS NULL THEN NULL ELSE trim(coalesce(c.text, '')) END AS comment_text FROM q LEFT JOIN raw_comments c ON c.post_id = q.id WHERE c.post_id IS NULL OR trim(coalesce(c.text, '')) <> ''")
def flatten_video(s, d):
    return rows.flatten_videos(_post_rows(s, d), _comments(s, d)).select("id", F.coalesce("comment_index", F.lit(-1)).alias("comment_index"), "comment_text")


@query()
def body_minus_comments(s, d):
    return rows.without_comments(_post_rows(s, d), _comments(s, d))


@query()
def comment_phrase_sets(s, d):
    return content.comment_phrases(_comments(s, d))


@query()
def line_state_clean(s, d):
    p = _posts(s, d).select("row_id", "raw_text", "title")
    return content.board_body(p, "raw_text", "title").select("row_id", "body")


@query(_POST1 + ", c AS (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY comment_index) AS k FROM raw_comments WHERE trim(coalesce(text, '')) <> ''), g AS (SELECT post_id, string_agg(trim(text), chr(10) ORDER BY comment_index, trim(text)) AS cs FROM c WHERE k <= 200 GROUP BY post_id) SELECT q.id, concat_ws(chr(10) || chr(10), nullif(regexp_replace(coalesce(raw_text, ''), '^[\\s\\x{00A0}\\x{3000}]+|[\\s\\x{00A0}\\x{3000}]+$', '', 'g'), ''), cs) AS full_text FROM q LEFT JOIN g ON g.post_id = q.id".replace("\\\\", "\\"))
def augment_with_comments(s, d):
    return content.augment(_post_rows(s, d), _comments(s, d))


@query("SELECT author, count(*) AS n FROM (SELECT unnest(authors) AS author FROM raw_posts) GROUP BY author")
def author_counts(s, d):
    return content.author_counts(_posts(s, d))


@query("SELECT row_id, CASE WHEN json_valid(extra) THEN coalesce(json_extract_string(extra, '$.forum.site'), json_extract_string(extra, '$.article.site'), json_extract_string(extra, '$.video.site')) END AS site FROM raw_posts")
def extra_json_fields(s, d):
    j = lambda p: F.get_json_object("extra", p)
    whole = F.json_object_keys("extra").isNotNull()
    return _posts(s, d).select("row_id", F.when(whole, F.coalesce(j("$.forum.site"), j("$.article.site"), j("$.video.site"))).alias("site"))


@query("SELECT p.row_id, coalesce(s.kind, p.source) AS kind, coalesce(p.lang, s.main_lang) AS lang FROM raw_posts p LEFT JOIN source_info s ON p.source = s.source")
def search_left_details(s, d):
    i = table(s, d, "source_info").select(F.col("source").alias("s_source"), "kind", "main_lang")
    j = _posts(s, d).select("row_id", "source", "lang").join(i, F.col("source") == F.col("s_source"), "left")
    return j.select("row_id", F.coalesce("kind", "source").alias("kind"), F.coalesce("lang", "main_lang").alias("lang"))


@query()
def assembly_cascade(s, d):
    p = _posts(s, d).withColumn("head", F.substring_index(F.col("raw_text"), "\n", 1))
    return content.assemble(p, titles=("title", "head"), times=("published_at", "crawl_fetched_at"), text="raw_text", source="source", tolerant=("lumen_video",)).select("row_id", "final_title", "final_time", "rejected")


# --- URLs
_NORM = r"""regexp_replace(regexp_extract(url, '^([^?#]*)', 1), '^https?://', '')"""
_KV = "list_transform(list_filter(string_split(query, '&'), lambda x: x <> ''), lambda x: {'k': url_decode(replace(split_part(x, '=', 1), '+', ' ')), 'v': CASE WHEN contains(x, '=') THEN url_decode(replace(substr(x, instr(x, '=') + 1), '+', ' ')) ELSE '' END})"
_IDS = "'id', 'no', 'idx', 'idxno', 'arcid', 'aid', 'oid', 'ud', 'newsid', 'articleid', 'article_id', 'seq', 'sn', 'docid'"
# from the rule itself: scheme and host in lower case, http and / where there is none, ;params and fragment gone, blank values kept, decoded pairs sorted;
# no host of the tables has a rule of its own
_URL = r"""WITH b AS (SELECT row_id, url, regexp_replace(trim(url), '#.*$', '') AS bare FROM raw_posts),
u AS (SELECT row_id, url, lower(regexp_extract(bare, '^([A-Za-z]+)://', 1)) AS scheme, lower(regexp_extract(bare, '^[A-Za-z]+://([^/?]*)', 1)) AS host, regexp_replace(regexp_extract(bare, '^[A-Za-z]+://[^/?]*([^?]*)', 1), ';[^/]*$', '') AS path,
 CASE WHEN contains(bare, '?') THEN substr(bare, instr(bare, '?') + 1) ELSE '' END AS query FROM b),
v AS (SELECT *, list_filter(""" + _KV + r""", lambda y: NOT list_contains(['utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'fbclid', 'gclid', 'igshid', 'mibextid', 'ref', 'ref_src', 'spm'], lower(y.k))) AS kv FROM u),
x AS (SELECT *, CASE WHEN len(list_filter(kv, lambda y: list_contains([""" + _IDS + r"""], lower(y.k)))) > 0 THEN list_filter(kv, lambda y: list_contains([""" + _IDS + r""", 'code', 'b', 'board', 'cid', 'category', 'mid'], lower(y.k))) ELSE kv END AS kept FROM v),
n AS (SELECT row_id, url, scheme || '://' || regexp_replace(host, ':(80|443)$', '') || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(list_transform(list_sort(kept), lambda y: y.k || '=' || y.v), '&') ELSE '' END AS norm_url FROM x)
"""


@query(_URL + "SELECT row_id, norm_url FROM n")
def url_normalize(s, d):
    return _posts(s, d).select("row_id", U.normalize(F.col("url")).alias("norm_url"))


@query(_URL + "SELECT row_id, sha1(norm_url) AS page_id FROM n")
def url_doc_id(s, d):
    return _posts(s, d).select("row_id", dedup.url_id(F.col("url")).alias("page_id"))


@query(_URL + "SELECT norm_url, min(row_id) AS row_id FROM n GROUP BY norm_url")
def url_first_wins(s, d):
    return dedup.url_first_wins(_posts(s, d).select("row_id", "url")).select("norm_url", "row_id")


@query(_URL + ", k AS (SELECT row_id, host, regexp_replace(path, '/+$', '') AS path, list_filter(" + _KV + ", lambda y: NOT starts_with(lower(y.k), 'utm_') AND NOT list_contains(['fbclid', 'gclid', 'mc_cid', 'mc_eid'], lower(y.k))) AS kv FROM u) SELECT row_id, '//' || host || path || CASE WHEN len(kv) > 0 THEN '?' || array_to_string(list_transform(kv, lambda y: replace(url_encode(y.k), '%20', '+') || '=' || replace(url_encode(y.v), '%20', '+')), '&') ELSE '' END AS article_key FROM k")
def url_article_key(s, d):
    return _posts(s, d).select("row_id", U.article_key(F.col("url")).alias("article_key"))


@query(_URL + "SELECT row_id, norm_url LIKE '%/' OR length(norm_url) - length(replace(norm_url, '/', '')) <= 2 AS homepage FROM n")
def homepage_filter(s, d):
    return _posts(s, d).select("row_id", U.is_homepage(U.normalize(F.col("url"))).alias("homepage"))


@query("WITH h AS (SELECT DISTINCT lower(regexp_extract(url, '^[a-z]+://([^/?]*)', 1)) AS host FROM raw_posts) SELECT host, CAST(CASE WHEN host = 'plaza-sur.example' THEN 0.5 WHEN host LIKE '%.example' THEN 2.5 ELSE 0.05 END AS DOUBLE) AS pause FROM h")
def host_pause_lookup(s, d):
    h = _posts(s, d).select(U.host_of(F.col("url")).alias("host")).distinct()
    p = s.createDataFrame([("plaza-sur.example", 0.5, 1), ("example", 2.5, 2)], "host string, pause double, ord int")
    return planner.host_pause(h, p, 0.05)


@query(r"SELECT row_id, regexp_replace(url, '\?.*$', '') || '?' || array_to_string(list_append(list_filter(string_split(CASE WHEN contains(url, '?') THEN regexp_replace(url, '^[^?]*\?', '') ELSE '' END, '&'), lambda x: x <> '' AND split_part(x, '=', 1) <> 'page'), 'page=2'), '&') AS next_url FROM raw_posts")
def page_urls(s, d):
    return _posts(s, d).select("row_id", U.set_param(F.col("url"), "page", F.lit(2)).alias("next_url"))


@query("SELECT p.row_id FROM raw_posts p WHERE NOT EXISTS (SELECT 1 FROM unified_rows u WHERE u.id = p.id AND u.doc_type = 'post')")
def seen_anti_join(s, d):
    seen = _rows(s, d).filter("doc_type = 'post'").select(F.col("id").alias("seen_id"))
    p = _posts(s, d).select("row_id", "id")
    return p.join(seen, F.col("id") == F.col("seen_id"), "left_anti").select("row_id")


@query()
def mentions_datetime(s, d):
    timed, dates = C.mentions(F.coalesce(F.col("raw_text"), F.lit("")))
    return _posts(s, d).select("row_id", F.coalesce(F.array_max(timed), F.array_max(dates)).alias("inferred"), F.size(timed).cast("long").alias("n_timed"))


@query(r"SELECT comment_key, CASE WHEN regexp_matches(published_at_raw, '^\d{4}\.\d{2}\.\d{2} \d{2}:\d{2}:\d{2}$') THEN strftime(try_strptime(published_at_raw, '%Y.%m.%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') WHEN regexp_matches(published_at_raw, '^\d{2}\.\d{2} \d{2}:\d{2}:\d{2}$') AND NOT starts_with(published_at_raw, '02.29') THEN strftime(try_strptime(CAST(year(fetched_at) AS VARCHAR) || '.' || published_at_raw, '%Y.%m.%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') END AS at FROM raw_comments")
def forum_comment_time(s, d):
    c = s.read.parquet(f"{d}/raw_comments.parquet")
    return c.select("comment_key", C.forum_time(F.col("published_at_raw"), F.year("fetched_at")).alias("at"))


# --- documents
_BLANK = r"regexp_replace({0}, '^[\s\x{{00A0}}\x{{3000}}]+|[\s\x{{00A0}}\x{{3000}}]+$', '', 'g')"
_UNIX = "replace(replace({0}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


@query(f"SELECT doc_id FROM documents WHERE length({_BLANK.format('text')}) BETWEEN 200 AND 1000")
def length_filter(s, d):
    return _docs(s, d).filter(content.length_between(F.col("text"), 200, 1000)).select("doc_id")


@query("SELECT doc_id, lower(lang) AS lang FROM documents WHERE lower(lang) IN ('ko', 'en')")
def lang_filter(s, d):
    return _docs(s, d).select("doc_id", F.lower("lang").alias("lang")).filter(F.col("lang").isin("ko", "en"))


_KW = ("국민연금", "연금", "보험료율", "기금", "노후", "pension", "fund", "contribution")


@query("""WITH x AS (SELECT doc_id, coalesce(text, '') AS body, lower(CASE WHEN title IS NULL THEN '' ELSE title || chr(10) END || coalesce(text, '')) AS b, coalesce(lang, 'und') AS l FROM documents),
h AS (SELECT doc_id, length(body) AS length, l, lower(l) IN ('ko', 'en') AS ok, len(list_filter(['""" + "', '".join(_KW) + """'], lambda k: contains(b, k))) AS n FROM x)
SELECT doc_id, CAST(length AS BIGINT) AS length, CAST(n AS BIGINT) AS hits, round(n / 8.0::DOUBLE, 3) AS coverage, round(CASE WHEN ok THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN n >= 2 THEN 0.2::DOUBLE ELSE 0 END, 3) AS score, concat_ws(',', CASE WHEN NOT ok THEN 'lang=' || l END, CASE WHEN n < 2 THEN 'keyword_hits' END) AS reasons, n >= 2 AS passed FROM h""")
def keyword_quality(s, d):
    return content.keyword_quality(_docs(s, d), "title", "text", _KW, "lang", ("ko", "en"), 2).select("doc_id", "length", "hits", "coverage", "score", "reasons", "passed")


@query("SELECT doc_id FROM documents WHERE NOT (" + " OR ".join(f"contains(lower(coalesce(title, '')), '{k}')" for k in T.EVENT_KEYWORDS) + ")")
def keyword_block(s, d):
    low = F.lower(F.coalesce("title", F.lit("")))
    return _docs(s, d).filter(~F.exists(F.array(*[F.lit(k) for k in T.EVENT_KEYWORDS]), lambda k: F.contains(low, k))).select("doc_id")


_POS = "nullif(instr(lower(text), {0}), 0)"


@query("WITH x AS (SELECT doc_id, text, least(" + ", ".join(_POS.format(f"'{m}'") for m in T.ARTICLE_TAILS) + ") AS p FROM documents) SELECT doc_id, CASE WHEN p > 1 THEN substr(text, 1, p - 1) ELSE text END AS clean FROM x")
def clean_tail_cut(s, d):
    return _docs(s, d).select("doc_id", T.cut_tail(F.col("text")).alias("clean"))


@query("SELECT doc_id, " + _BLANK.format(f"regexp_replace(regexp_replace({_UNIX.format('text')}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '[ \\t]{{2,}}', ' ', 'g')").replace("{{3,}}", "{3,}").replace("{{2,}}", "{2,}") + " AS clean FROM documents")
def squeeze_ws(s, d):
    return _docs(s, d).select("doc_id", T.squeeze(F.col("text")).alias("clean"))


@query("SELECT doc_id, " + _BLANK.format(f"split_part({_UNIX.format('text')}, chr(10) || chr(10), 1)") + " AS first_part FROM documents")
def first_paragraph(s, d):
    return _docs(s, d).select("doc_id", T.first_paragraph(F.col("text")).alias("first_part"))


@query(r"SELECT doc_id, trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) AS folded FROM documents")
def fold_text(s, d):
    return _docs(s, d).select("doc_id", T.fold(F.col("text")).alias("folded"))


@query(r"SELECT doc_id, trim(regexp_replace(lower(split_part(split_part(split_part(split_part(title, ' - ', 1), '｜', 1), ' | ', 1), '|', 1)), '\s+', ' ', 'g')) AS title_key FROM documents")
def title_key(s, d):
    return _docs(s, d).select("doc_id", T.title_key(F.col("title")).alias("title_key"))


@query(r"SELECT doc_id, trim(regexp_replace(title, '(\|[^|]{0,30})+$', '')) AS head FROM documents")
def title_tail_strip(s, d):
    return _docs(s, d).select("doc_id", T.title_tail(F.col("title")).alias("head"))


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(text, '#([\p{L}\p{N}_]+)', '\1', 'g'), '[ \t]{2,}', ' ', 'g')) AS plain FROM documents")
def hashtags_strip(s, d):
    return _docs(s, d).select("doc_id", T.hashtags_to_words(F.col("text")).alias("plain"))


_NOISE = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(array_to_string(list_filter(list_filter(list_transform(string_split(" + _UNIX.format("text") + r", chr(10)), lambda x: trim(x)), lambda x: x <> ''), lambda x: NOT regexp_matches(x, '" + T.BOILERPLATE_PATTERN + r"') AND NOT (regexp_matches(x, '" + T.SOCIAL_PATTERN + r"') AND (regexp_matches(x, '" + T.URL_PATTERN + r"') OR contains(x, '@') OR contains(lower(x), 'threads.com')))), ' '), '" + T.URL_PATTERN + "', ' ', 'g'), '" + T.EMAIL_PATTERN + r"', ' ', 'g'), '(?i)dc\s+official\s+app', ' ', 'g'), '\s+', ' ', 'g'))"


@query(f"SELECT doc_id, {_NOISE} AS clean FROM documents")
def web_noise_strip(s, d):
    return _docs(s, d).select("doc_id", T.web_noise(F.col("text")).alias("clean"))


@query(r"SELECT min(doc_id) AS doc_id, trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) AS folded FROM documents GROUP BY 2")
def exact_dedup_first(s, d):
    return dedup.exact_first(_docs(s, d).select("doc_id", "text"), F.col("text"), "doc_id").select("doc_id", "folded")


_FINE = r"""WITH k AS (SELECT doc_id, text, coalesce(lang, '') AS g_lang, trim(regexp_replace(title, '(\|[^|]{0,30})+$', '')) AS g_title, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+')) AS t FROM documents),
c AS (SELECT *, first_value(doc_id) OVER w AS canonical, first_value(t) OVER w AS ct FROM k WINDOW w AS (PARTITION BY g_lang, g_title ORDER BY length(coalesce(text, '')) DESC, doc_id))
SELECT doc_id, canonical, doc_id = canonical OR (CASE WHEN len(t) = 0 OR len(ct) = 0 THEN 0 ELSE len(list_intersect(t, ct)) / CAST(len(t) + len(ct) - len(list_intersect(t, ct)) AS DOUBLE) END) < 0.9 AS kept FROM c"""


@query(_FINE)
def fine_dedup_jaccard(s, d):
    return dedup.fine(_docs(s, d), F.col("title"), "text", "lang", "doc_id").select("doc_id", "canonical", "kept")


@query()
def near_dup_kept(s, d):
    return dedup.near_kept(_docs(s, d), F.concat_ws(" ", "title", "text"), "doc_id")


@query()
def fuzzy_title_dedup(s, d):
    return dedup.fuzzy_titles(_docs(s, d), "title", "lang", "url", "text", "fetched_at", "doc_id")


_LABELLED = "CASE WHEN lower(lang) LIKE 'en%' THEN 'negative' WHEN lang IS NULL THEN 'positive' ELSE 'neutral' END"
_TOK = f"""WITH n AS (SELECT doc_id, {_LABELLED} AS label, string_split(lower(trim(regexp_replace(regexp_replace({_NOISE}, '[^가-힣A-Za-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))), ' ') AS ws FROM documents),
w AS (SELECT label, unnest(ws) AS word FROM n), v AS (SELECT *, length(word) AS l, length(word) - length(translate(word, 'aeiou', '')) AS v FROM w WHERE regexp_matches(word, '^[a-z]{{2,}}$')),
t AS (SELECT label, word FROM v WHERE NOT (l >= 22 OR (l >= 7 AND v <= 1) OR (l >= 10 AND v / CAST(l AS DOUBLE) < 0.22) OR (l >= 9 AND regexp_matches(word, '[^aeiou]{{5,}}')) OR (l >= 8 AND len(list_filter(string_split('abcdefghijklmnopqrstuvwxyz', ''), lambda c: l - length(replace(word, c, '')) >= 5)) > 0))),
g AS (SELECT word, count(*) AS n, CAST(sum(CASE WHEN label = 'negative' THEN 1 ELSE 0 END) AS BIGINT) AS negative, CAST(sum(CASE WHEN label = 'neutral' THEN 1 ELSE 0 END) AS BIGINT) AS neutral, CAST(sum(CASE WHEN label = 'positive' THEN 1 ELSE 0 END) AS BIGINT) AS positive FROM t GROUP BY word HAVING count(*) >= 2)
"""


def _tokens(s: SparkSession, d: str) -> DataFrame:
    label = F.when(F.lower("lang").like("en%"), F.lit("negative")).when(F.col("lang").isNull(), F.lit("positive")).otherwise(F.lit("neutral"))
    return content.words(_docs(s, d).withColumn("label", label), F.col("text"), "label", "doc_id")


@query(_TOK + "SELECT word, n, negative, neutral, positive FROM g")
def word_freq_en(s, d):
    return content.word_stats(_tokens(s, d)).select("word", "n", "negative", "neutral", "positive")


@query(_TOK + "SELECT word, round((positive - negative) / CAST(n AS DOUBLE), 6) AS word_score FROM g")
def word_sentiment_score(s, d):
    return content.word_stats(_tokens(s, d)).select("word", "word_score")


@query(_TOK + ", k AS (SELECT * FROM g ORDER BY n DESC, word LIMIT 80) SELECT word, label, n FROM (SELECT word, 'negative' AS label, negative AS n FROM k UNION ALL SELECT word, 'neutral', neutral FROM k UNION ALL SELECT word, 'positive', positive FROM k) WHERE n > 0")
def word_label_links(s, d):
    return content.word_links(content.word_stats(_tokens(s, d)), 80)


# --- timestamps (problem 4)
@query()
def p4_found(s, d):
    values = timestamps.stack_values(s.read.parquet(f"{d}/unified_rows.parquet"), s.read.parquet(f"{d}/raw_comments.parquet"))
    return timestamps.normalise(values, table(s, d, "source_info"))


@query()
def p4_fields(s, d):
    values = timestamps.stack_values(s.read.parquet(f"{d}/unified_rows.parquet"), s.read.parquet(f"{d}/raw_comments.parquet"))
    return timestamps.normalise(values, table(s, d, "source_info")).groupBy("tbl", "field").agg(F.count(F.lit(1)).alias("n_settled"), F.count_if(F.col("instant_utc") == "").alias("n_unclear"), F.lit(timestamps.zone_database_version()).alias("zone_tables"))


# --- board exports, stamps of listings, page pieces
_TRIM = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_BOARD = """WITH p AS (SELECT row_id, id, source, title, lang, published_at, raw_text AS text FROM raw_posts QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_id) = 1),
c AS (SELECT post_id, comment_index, nullif(trim(text, ' '), '') AS comment_text, published_at_raw AS comment_time, author FROM raw_comments)"""


@query(_BOARD + ", q AS (SELECT id, trim(split_part(coalesce(title, ''), '|', 1), ' ') AS title, nullif(" + _BLANK.format(f"split_part({_UNIX.format('text')}, chr(10) || chr(10), 1)") + ", '') AS text FROM p) SELECT id, 'post' AS doc_type, title, text, true AS has_text FROM q UNION ALL SELECT q.id || '_' || comment_index, 'comment', title, text, text IS NOT NULL FROM q JOIN c ON q.id = c.post_id WHERE comment_text IS NOT NULL")
def flatten_first_paragraph(s, d):
    return rows.flatten_board(_post_rows(s, d), _comments(s, d), "paragraph").select("id", "doc_type", "title", "text", "has_text")


_CLOCK = "CASE WHEN trim(t, ' ') = '' THEN NULL WHEN day IS NOT NULL AND contains(trim(t, ' '), ':') AND NOT contains(trim(t, ' '), ' ') THEN day || ' ' || trim(t, ' ') ELSE trim(t, ' ') END"


@query(_BOARD + ", q AS (SELECT *, strftime(" + _NTZ.format("trim(published_at, ' ')") + ", '%Y-%m-%d') AS day FROM p WHERE NOT (" + " OR ".join(f"contains(lower(coalesce(title, '')), '{k}')" for k in T.EVENT_KEYWORDS) + ")), x AS (SELECT q.id || '_' || comment_index AS id, comment_text, comment_time AS t, day FROM q JOIN c ON q.id = c.post_id) SELECT id, NULL AS comment_text, NULL AS comment_time FROM q UNION ALL SELECT id, comment_text, " + _CLOCK + " FROM x")
def flatten_event_boards(s, d):
    return rows.flatten_board(_post_rows(s, d), _comments(s, d), "events").select("id", "comment_text", F.col("comment_publishedAt").alias("comment_time"))


@query(_BOARD + " SELECT id, lang FROM p UNION ALL SELECT p.id || '_' || comment_index, CASE WHEN regexp_matches(comment_text, '[가-힣]') THEN 'ko' ELSE lang END FROM p JOIN c ON p.id = c.post_id WHERE comment_text IS NOT NULL")
def flatten_comment_lang(s, d):
    c = _comments(s, d).withColumn("lang", F.when(F.col("text").rlike("[가-힣]"), F.lit("ko")))
    return rows.flatten_board(_post_rows(s, d), c, "own_lang").select("id", "lang")


@query("WITH x AS (SELECT comment_key, published_at_raw AS t, strftime(fetched_at, '%Y-%m-%d') AS day FROM raw_comments) SELECT comment_key, " + _CLOCK + " AS at FROM x")
def comment_clock_time(s, d):
    c = s.read.parquet(f"{d}/raw_comments.parquet")
    return c.select("comment_key", C.comment_clock(F.date_format("fetched_at", "yyyy-MM-dd"), F.col("published_at_raw")).alias("at"))


_MAKE = "strftime(try_strptime({y} || '-' || {0} || '-' || {1} || ' ' || {2} || ':' || {3} || ':' || {4}, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')"
_PART = "coalesce(nullif(regexp_extract(t, '{0}', {1}), ''), '0')"


def _made(form: str, year: str, first: int) -> str:
    return _MAKE.format(*[_PART.format(form, first + k) for k in range(5)], y=year)


_DAY = r"(\d{1,2})[./-](\d{1,2})(?:\s+(\d{1,2}):(\d{2})(?::(\d{2}))?)?"
_L4, _L2 = r"(\d{4})[./-]" + _DAY, r"(\d{2})[./-]" + _DAY
_LC = r"(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})Z?"
_Y2 = "CAST(CASE WHEN CAST(regexp_extract(t, '{0}', 1) AS INT) < {1} THEN 2000 ELSE 1900 END + CAST(regexp_extract(t, '{0}', 1) AS INT) AS VARCHAR)"
_ISO = r"CASE WHEN regexp_matches(t, '^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?$') THEN strftime(TRY_CAST(regexp_replace(t, '(Z|[+-]\d{2}:?\d{2})$', '') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') END"


@query("WITH x AS (SELECT comment_key, trim(regexp_replace(regexp_replace(published_at_raw, '\\([^)]*\\)', ' ', 'g'), '\\s+', ' ', 'g'), ' ') AS t FROM raw_comments) SELECT comment_key, coalesce(" + _ISO + ", CASE WHEN regexp_matches(t, '" + _L4 + "') THEN " + _made(_L4, f"regexp_extract(t, '{_L4}', 1)", 2)
       + " END, CASE WHEN regexp_matches(t, '" + _L2 + "') THEN " + _made(_L2, _Y2.format(_L2, 70).replace("{{", "{").replace("}}", "}"), 2) + " END, CASE WHEN regexp_matches(t, '" + _LC + "') THEN " + _made(_LC, f"regexp_extract(t, '{_LC}', 1)", 2) + " END) AS at FROM x")
def loose_time(s, d):
    return s.read.parquet(f"{d}/raw_comments.parquet").select("comment_key", C.loose(F.col("published_at_raw")).alias("at"))


_LIST = r"^(\d{4}|\d{2})[-./](\d{1,2})[-./](\d{1,2})(?:\s+(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?)?$"
_SAME = r"(regexp_matches(t, '^\d+-\d+-\d+($|\s)') OR regexp_matches(t, '^\d+\.\d+\.\d+($|\s)') OR regexp_matches(t, '^\d+/\d+/\d+($|\s)'))"


@query("WITH x AS (SELECT row_id, trim(published_at, ' ') AS t, regexp_replace(published_at, '\\D', '', 'g') AS g FROM raw_posts) SELECT row_id, coalesce(CASE WHEN regexp_matches(t, '" + _LIST + "') AND " + _SAME + " THEN " + _made(_LIST, f"CASE WHEN length(regexp_extract(t, '{_LIST}', 1)) = 4 THEN regexp_extract(t, '{_LIST}', 1) ELSE " + "CAST(CASE WHEN CAST(regexp_extract(t, '" + _LIST + "', 1) AS INT) < 69 THEN 2000 ELSE 1900 END + CAST(regexp_extract(t, '" + _LIST + "', 1) AS INT) AS VARCHAR) END", 2)
       + " END, CASE WHEN length(g) = 14 THEN strftime(try_strptime(g, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') WHEN length(g) = 12 THEN strftime(try_strptime(g, '%Y%m%d%H%M'), '%Y-%m-%d %H:%M:%S') WHEN length(g) = 8 THEN strftime(try_strptime(g, '%Y%m%d'), '%Y-%m-%d %H:%M:%S') END) AS at FROM x")
def listing_time(s, d):
    return _posts(s, d).select("row_id", C.listing(F.col("published_at")).alias("at"))


@query("SELECT row_id, " + _BLANK.format("split_part(split_part(split_part(string_split(raw_text, '갤러리 본문 영역')[-1], '하단 갤러리 리스트 영역', 1), '갤러리 리스트 영역', 1), '왼쪽 컨텐츠 영역', 1)") + " AS body FROM raw_posts")
def body_between_markers(s, d):
    return _posts(s, d).select("row_id", content.between_markers(F.col("raw_text")).alias("body"))


@query("SELECT post_id, min(comment_index) AS comment_index, trim(text, ' ') AS text FROM raw_comments WHERE trim(text, ' ') <> '' GROUP BY post_id, trim(text, ' ')")
def comments_distinct(s, d):
    return content.distinct_comments(s.read.parquet(f"{d}/raw_comments.parquet"), "post_id", "text", "comment_index")


@query(EV + ", r AS (SELECT *, CASE user_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_related FROM e) SELECT pos_id FROM r WHERE is_related")
def relevant_rows(s, d):
    m = F.col("user_id") % 3
    return dashboard.relevant(_ev(s, d).withColumn("is_related", F.when(m == 0, F.lit(True)).when(m == 1, F.lit(False)))).select("pos_id")


@query("SELECT row_id, trim(title, ' ') AS explanation FROM raw_posts WHERE trim(title, ' ') <> ''")
def explained_rows(s, d):
    return dashboard.explained(_posts(s, d).select("row_id", F.col("title").alias("explanation")))


@query(EV + "SELECT pos_id FROM e WHERE hr = 9 AND source = 'view' OR day = (SELECT max(day) FROM e)")
def bucket_rows(s, d):
    e = _ev(s, d)
    last = e.agg(F.max("day").alias("last"))  # one row
    on_day = e.join(F.broadcast(last), F.col("day") == F.col("last")).select("pos_id")
    return dashboard.in_bucket(e.filter("source = 'view'"), hour=9).select("pos_id").union(on_day).distinct()


@query(EV + ", d AS (SELECT DISTINCT day FROM e), l AS (SELECT unnest(['negative', 'neutral', 'positive', 'unscored']) AS label) SELECT d.day, l.label, count(e.pos_id) AS n FROM d CROSS JOIN l LEFT JOIN e ON e.day = d.day AND e.label = l.label GROUP BY d.day, l.label")
def label_counts_with_zeros(s, d):
    return dashboard.label_counts_all(_ev(s, d), "day", "label", ("negative", "neutral", "positive", "unscored"))


@query("SELECT row_id FROM raw_posts WHERE json_valid(extra) ORDER BY row_id LIMIT 100")
def limit_after_parse(s, d):
    return rows.limit_valid(_posts(s, d).select("row_id", "extra"), F.json_object_keys("extra").isNotNull(), 100).select("row_id")


@query("SELECT count(*) AS n_rows, count_if(coalesce(json_valid(extra), false)) AS n_valid, round(count_if(coalesce(json_valid(extra), false)) / count(*), 6) AS ratio FROM raw_posts")
def parse_success_ratio(s, d):
    return rows.success_ratio(_posts(s, d), F.coalesce(F.json_object_keys("extra").isNotNull(), F.lit(False)))


_EXTRA = "article struct<site:string,comments:bigint>, forum struct<site:string,comments:bigint>, video struct<site:string,comments:bigint>"
_SIX = [f"{k}.{f}" for k in ("article", "forum", "video") for f in ("site", "comments")]


@query("SELECT row_id, " + ", ".join(f"CAST(json_extract_string(extra, '$.{x}') AS {'VARCHAR' if x.endswith('site') else 'BIGINT'}) AS \"{x}\"" for x in _SIX) + " FROM raw_posts WHERE json_valid(extra)")
def json_dotted(s, d):
    x = _posts(s, d).filter(F.json_object_keys("extra").isNotNull()).select("row_id", F.from_json("extra", _EXTRA).alias("e")).select("row_id", "e.*")
    return jsonl.dotted(x)


# --- JSON lines, written to and read from the shared folder
def _as_lines(s: SparkSession, d: str, name: str) -> str:
    """The posts as JSON lines, with a malformed line and a blank one per partition."""
    ensure_checkpoint_dir(s)
    path = f"{s.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
    good = _posts(s, d).select(F.to_json(F.struct("row_id", "id", "title", "raw_text")).alias("value"))
    bad = good.limit(3).select(F.lit('{"row_id": 1, "id": ').alias("value")).union(good.limit(2).select(F.lit("  ").alias("value"))).union(good.limit(2).select(F.lit("[1, 2]").alias("value")))
    good.union(bad).write.text(path)
    return path


@query("SELECT row_id, id, title, length(raw_text) AS n_chars FROM raw_posts")
def jsonl_lenient(s, d):
    x = jsonl.lenient(s, _as_lines(s, d, "lines"), "row_id long, id string, title string, raw_text string")
    return x.select("row_id", "id", "title", F.length("raw_text").cast("long").alias("n_chars"))


@query("SELECT count(*) + 5 AS n_lines, count(*) AS n_objects FROM raw_posts")
def jsonl_in_order(s, d):
    x = jsonl.in_order(s, _as_lines(s, d, "ordered"))
    return x.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.json_object_keys("line").isNotNull()).alias("n_objects"))


@query("SELECT count(*) + 5 AS n_lines, count(*) AS n_objects FROM raw_posts")
def jsonl_any_encoding(s, d):
    x = jsonl.any_encoding(s, _as_lines(s, d, "encoded"))
    return x.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.json_object_keys("line").isNotNull()).alias("n_objects"))


@query("SELECT CASE WHEN i.kind = 'forum' THEN 'forum_' || p.source ELSE p.source END AS bucket, count(*) AS n FROM raw_posts p JOIN source_info i ON p.source = i.source GROUP BY 1")
def jsonl_per_source(s, d):
    ensure_checkpoint_dir(s)
    path = f"{s.sparkContext._jsc.sc().getCheckpointDir().get()}/store-{uuid.uuid4().hex}"
    i = table(s, d, "source_info").select(F.col("source").alias("i_source"), F.col("kind").alias("discovered_type"))
    jsonl.append_per_source(_posts(s, d).select("row_id", "source", "title").join(i, F.col("source") == F.col("i_source")).drop("i_source"), path)
    return s.read.schema("row_id long, bucket string").json(path).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT id FROM raw_posts")
def seen_index(s, d):
    ensure_checkpoint_dir(s)
    path = f"{s.sparkContext._jsc.sc().getCheckpointDir().get()}/seen-{uuid.uuid4().hex}"
    p = _posts(s, d)
    jsonl.update_index(p.filter("row_id % 2 = 0"), path, ("id",))
    jsonl.update_index(p, path, ("id",))  # what is there already isn't added again
    return s.read.parquet(path).select("id")
