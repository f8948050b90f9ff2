import pytest

from opinlake.functions import url as U
from opinlake.sources import jsonl, remote
from opinlake.streaming import ingest


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1", "x": null}\n\n{bad\n[1]\n{"id": "2"}\n', encoding="utf-8")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.json").write_text('[{"id": "3"}, {"id": "4"}]', encoding="utf-8")
    assert sorted(r["id"] for r in jsonl.lenient(spark, str(tmp_path / "a.jsonl"), "id string").collect()) == ["1", "2"]
    with pytest.raises(Exception, match="malformed"):
        jsonl.strict(spark, str(tmp_path / "a.jsonl"), "id string").collect()
    assert {"3", "4"} <= {r["id"] for r in jsonl.folder(spark, str(tmp_path), "id string").collect()}
    (tmp_path / "k.txt").write_bytes("가나\n다".encode("cp949"))
    assert [r["line"] for r in jsonl.any_encoding(spark, str(tmp_path / "k.txt")).collect()] == ["가나", "다"]
    (tmp_path / "stop.txt").write_text("The and # not this\nOF\n")
    assert sorted(r["word"] for r in jsonl.stop_words(spark, str(tmp_path / "stop.txt")).collect()) == ["and", "of", "the"]
    df = spark.createDataFrame([("1", "s", "forum", None), ("2", "s", None, "y")], "id string, source string, discovered_type string, x string")
    jsonl.append_per_source(df, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("bucket=*")) == ["bucket=forum_s", "bucket=s"]
    jsonl.update_index(df.selectExpr("id", "id as norm_url"), str(tmp_path / "ix"))
    jsonl.update_index(df.selectExpr("id", "id as norm_url"), str(tmp_path / "ix"))  # nothing new
    assert spark.read.parquet(str(tmp_path / "ix")).count() == 2
    (tmp_path / "u.jsonl").write_text('{"id": "a\u2028b"}\n{"id": "c\u0085d"}\r\n', encoding="utf-8")
    assert len(jsonl.any_encoding(spark, str(tmp_path / "u.jsonl")).collect()) == 2
    got = jsonl.in_order(spark, [str(tmp_path / "u.jsonl"), str(tmp_path / "a.jsonl")]).orderBy("file", "at").collect()
    assert [(r["file"][-7:], r["at"]) for r in got] == [("a.jsonl", 1), ("a.jsonl", 3), ("a.jsonl", 4), ("a.jsonl", 5), ("u.jsonl", 1), ("u.jsonl", 2)]
    with pytest.raises(Exception, match="malformed line 3 of"):
        jsonl.strict_in_order(spark, str(tmp_path / "a.jsonl"), "id string").collect()
    nested = spark.sql("SELECT 1 AS id, named_struct('b', named_struct('c', 2, 'd', array(1)), 'e', 'x') AS a")
    assert jsonl.dotted(nested).columns == ["id", "a.b.c", "a.b.d", "a.e"]


def test_fetch(spark):
    df = spark.createDataFrame([("http://a/1", "a"), ("http://a/2", "a"), ("http://b/x", "b")], "url string, host string")
    got = {r["url"]: r["status"] for r in remote.fetch(df, lambda u: (200, u) if "b" not in u else 1 / 0, hosts=2).collect()}
    assert got == {"http://a/1": 200, "http://a/2": 200, "http://b/x": 0}
    assert remote.search(df, lambda r: [{"k": r["host"], "n": 1}], "k string, n long").count() == 3


def test_stream_equals_batch(spark, sf, tmp_path):
    p = spark.read.parquet(f"{sf}/raw_posts.parquet")
    p.repartition(3).write.parquet(str(tmp_path / "in"))
    s = ingest.unique_urls(ingest.read(spark, str(tmp_path / "in"), p.schema).select("url", "source", "crawl_fetched_at"))
    ingest.drain(s, str(tmp_path / "out"), str(tmp_path / "ck"))
    want = {r["n"] for r in p.select(U.normalize(p["url"]).alias("n")).collect()}
    got = [r["norm_url"] for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    c = ingest.month_counts(ingest.read(spark, str(tmp_path / "in"), p.schema), "crawl_fetched_at")
    ingest.drain_counts(c, "months", str(tmp_path / "ck2"))
    assert spark.table("months").selectExpr("sum(n)").first()[0] == p.count()
