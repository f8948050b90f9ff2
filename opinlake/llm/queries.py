"""The pN_ queries of the problems tagged llm, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import copies, langid, leaks, mainbody, mixing, pii, prose, standing, toxic


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def _unified(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/unified_rows.parquet")


def _posts(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/raw_posts.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_scores(spark, d).filter("offensive").select("row_id")


def p1_scores(spark: SparkSession, d: str) -> DataFrame:
    model, letters = toxic.trained(spark, _unified(spark, d), table(spark, d, "review_labels"))
    return toxic.scores_of_letters(letters, model)


def p1_rates(spark: SparkSession, d: str) -> DataFrame:
    return toxic.rates(p1_scores(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    docs, rows = _documents(spark, d), _unified(spark, d)
    model, bodies = prose.trained(spark, _posts(spark, d), rows, docs)
    langs = spark.sparkContext.broadcast(model.value.langs)
    return prose.languages_of_documents(bodies, model).unionByName(langid.find_in_rows(rows, langs))


def p3_segments(spark: SparkSession, d: str) -> DataFrame:
    docs, rows = _documents(spark, d), _unified(spark, d)
    models = prose.readers(_posts(spark, d), rows, docs)
    of_rows = langid.segments_of_rows(rows, spark.sparkContext.broadcast(models[1])).withColumnRenamed("row_id", "row_key").withColumn("tbl", F.lit("unified_rows"))
    return prose.segments_of_documents(docs, spark.sparkContext.broadcast(models)).unionByName(of_rows)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rows = _unified(spark, d)
    return pii.find(rows, pii.trained(spark, rows))


def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    rows = _unified(spark, d)
    return pii.redact(rows, pii.trained(spark, rows))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_documents(spark, d), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(_documents(spark, d), table(spark, d, "mix_targets"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    posts, docs = _posts(spark, d), _documents(spark, d)
    model = mainbody.trained(spark, posts, _unified(spark, d), docs)
    return mainbody.find_furniture(mainbody.stack_pages(posts, docs), model).select("tbl", "row_key", "line_no")


def p6_main_text(spark: SparkSession, d: str) -> DataFrame:
    posts, docs = _posts(spark, d), _documents(spark, d)
    return mainbody.main_text(mainbody.stack_pages(posts, docs), mainbody.trained(spark, posts, _unified(spark, d), docs))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    model, bodies = prose.trained(spark, _posts(spark, d), _unified(spark, d), _documents(spark, d))
    return prose.not_prose(bodies, model)


def p10_statistics(spark: SparkSession, d: str) -> DataFrame:
    model, bodies = prose.trained(spark, _posts(spark, d), _unified(spark, d), _documents(spark, d))
    return prose.document_statistics(bodies, model)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return standing.find_standing(_documents(spark, d)).select("doc_id", "line_no")


def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    return standing.remove_standing(_documents(spark, d)).select("doc_id", "clean_text", "n_removed")


def p2_blocks(spark: SparkSession, d: str) -> DataFrame:
    return standing.report(_documents(spark, d))


def p7_members(spark: SparkSession, d: str) -> DataFrame:
    return copies.members(_unified(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return copies.pairs(_unified(spark, d))


def p7_collapse(spark: SparkSession, d: str) -> DataFrame:
    return copies.collapse(_unified(spark, d))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(_documents(spark, d), table(spark, d, "eval_items"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leak_report(_documents(spark, d), table(spark, d, "eval_items"))


QUERIES = {f.__name__: f for f in (
    p1_found, p1_scores, p1_rates, p2_found, p2_clean, p2_blocks, p3_found, p3_segments, p5_found, p5_redacted, p6_found, p6_main_text, p7_found, p7_collapse, p7_members, p8_found, p8_report, p9_mix, p9_shares, p10_found, p10_statistics,
)}

_LINES = r"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
k AS (SELECT *, replace(lower(regexp_replace(line, '[^\p{L}]+', '', 'g')), 'ß', 'ss') AS key FROM l WHERE regexp_matches(line, '\p{L}')),
t AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
s AS (SELECT k.source, key FROM k JOIN t ON k.source = t.source GROUP BY k.source, key, total HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT doc_id) >= total * 0.02)
"""
_CODES = r"""
WITH c AS (SELECT row_id, array_to_string(list_sort(regexp_extract_all(replace(lower(id), 'ß', 'ss'), '[\p{L}\p{N}]+')), ' ') AS c_id,
  coalesce(regexp_replace(replace(lower(comment_text), 'ß', 'ss'), '[^\p{L}\p{N}]+', '', 'g'), '') AS c_text FROM unified_rows)
"""
_RUNS = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
d AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 11], ' ') AS run FROM dw, unnest(range(1, greatest(len(w) - 10, 1))) AS u(p)),
i AS (SELECT DISTINCT item_id, array_to_string(w[p:p + 11], ' ') AS run FROM iw, unnest(range(1, greatest(len(w) - 10, 1))) AS u(p))
"""
ORACLES = {
    "p2_found": _LINES + "SELECT doc_id, CAST(line_no AS BIGINT) AS line_no FROM k JOIN s ON k.source = s.source AND k.key = s.key",
    "p2_clean": _LINES
    + """, j AS (SELECT l.doc_id, l.line, l.line_no, s.key IS NOT NULL AS gone FROM l LEFT JOIN k ON l.doc_id = k.doc_id AND l.line_no = k.line_no LEFT JOIN s ON k.source = s.source AND k.key = s.key)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '') AS clean_text, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_removed FROM j GROUP BY doc_id""",
    "p7_found": _CODES + "SELECT a.row_id AS row_id_a, b.row_id AS row_id_b FROM c a JOIN c b ON a.c_id = b.c_id AND a.c_text = b.c_text AND a.row_id < b.row_id WHERE a.c_id <> ''",
    "p7_members": _CODES + "SELECT row_id, min(row_id) OVER (PARTITION BY c_id, c_text) AS first_id, count(*) OVER (PARTITION BY c_id, c_text) AS n_copies FROM c WHERE c_id <> '' QUALIFY count(*) OVER (PARTITION BY c_id, c_text) > 1",
    "p8_found": _RUNS + "SELECT DISTINCT doc_id, item_id FROM d JOIN i ON d.run = i.run",
    "p8_report": _RUNS + "SELECT item_id, count(DISTINCT doc_id) AS n_docs FROM d JOIN i ON d.run = i.run GROUP BY item_id",
    "p2_blocks": _LINES.replace("WITH l", "WITH RECURSIVE l") + r""", o AS (SELECT k.doc_id, k.source, k.key, row_number() OVER (PARTITION BY k.doc_id ORDER BY k.line_no) AS n, s.key IS NOT NULL AS kept FROM k LEFT JOIN s ON k.source = s.source AND k.key = s.key),
f AS (SELECT *, lead(key) OVER (PARTITION BY doc_id ORDER BY n) AS next_key, lead(kept) OVER (PARTITION BY doc_id ORDER BY n) AS next_kept FROM o),
e AS (SELECT f.source, key, next_key FROM f JOIN t ON f.source = t.source WHERE kept AND next_kept AND key <> next_key GROUP BY f.source, key, next_key, total HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT doc_id) >= total * 0.02),
u AS (SELECT source, key, next_key FROM e UNION SELECT source, next_key, key FROM e),
r AS (SELECT source, key, key AS root FROM s UNION SELECT u.source, u.next_key, r.root FROM r JOIN u ON r.source = u.source AND r.key = u.key),
c AS (SELECT source, key, min(root) AS root FROM r GROUP BY source, key)
SELECT source, count(*) AS n_lines, (SELECT count(*) FROM e WHERE e.source = c.source) AS n_edges, count(DISTINCT root) AS n_blocks FROM c GROUP BY source""",
    "p7_collapse": _CODES + "SELECT min(row_id) AS row_id, count(*) AS n_copies FROM c WHERE c_id <> '' GROUP BY c_id, c_text UNION ALL SELECT row_id, CAST(1 AS BIGINT) FROM c WHERE coalesce(c_id, '') = ''",
}
