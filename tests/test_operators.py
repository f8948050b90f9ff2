import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from opinlake.operators import content, dashboard, dedup, planner, rows, scored
from opinlake.plans import pipeline


def test_merge_is_argmax(spark):
    r = random.Random(1)
    data = [(i, r.choice("ab"), r.choice("xy"), r.choice([None, 1]), r.choice([None, "c", ""]), "t" * r.randint(0, 3), r.choice([None, "1", "22"])) for i in range(300)]
    df = spark.createDataFrame(data, "row_id long, source string, id string, comment_index int, comment_text string, text string, published_at string")
    best: dict = {}
    for x in data:
        k = x[1:5]
        cur = best.get(k)
        new = (len(x[5]), len(x[6] or ""), -x[0])
        if cur is None or new > cur[0]:
            best[k] = (new, x[0])
    assert sorted(v[1] for v in best.values()) == sorted(x["row_id"] for x in rows.merge(df).collect())
    assert rows.merge(df.limit(0)).count() == 0


def test_canonical_and_keys(spark):
    df = spark.createDataFrame([(" a ", "", None, "7", "extra")], "id string, source string, lang string, comment_index string, other string")
    x = rows.canonical(df).first()
    assert (x["id"], x["source"], x["lang"], x["comment_index"], x["other"]) == ("a", "unknown", "ko", 7, "extra")
    line = json.dumps({"id": 1, "source": None, "lang": "", "title": "", "published_at": None})
    assert spark.createDataFrame([(line,), ("[1]",)], "l string").select(rows.missing_keys(F.col("l")).alias("m")).toPandas()["m"].map(len).tolist() == [1, 6]


def test_flatten(spark):
    p = spark.createDataFrame([("p1", "s", "t", "ko", None, "body 댓글 end"), ("p2", "s", "t", "ko", None, None)], "id string, source string, title string, lang string, published_at string, text string")
    c = spark.createDataFrame([("p1", 0, "댓글", None), ("p1", 1, " ", None), ("p1", 2, "end", None)], "post_id string, comment_index int, text string, published_at string")
    assert rows.flatten(p, c).count() == 5 and rows.flatten(p, c, keep_blank=False).count() == 4
    assert {(x["id"], x["body"]) for x in rows.without_comments(p, c).collect()} == {("p1", "body"), ("p2", None)}
    assert rows.flatten_videos(p, c).count() == 3
    a = spark.createDataFrame([("p", ['{"text": "a"}', "3", '{"text": " "}', '{"text": "b"}'])], "id string, comments array<string>")
    assert [(x["id"], x["comment_text"]) for x in rows.flatten_arrays(a, drop_blank=True).collect()] == [("p_0", "a"), ("p_3", "b")]
    assert [x["id"] for x in rows.flatten_arrays(a, raw_positions=False).collect()] == ["p_0", "p_1", "p_2"]
    full = {x["id"]: x["full_text"] for x in content.augment(p, c).collect()}
    assert full == {"p1": "body 댓글 end\n\n댓글\nend", "p2": ""}


def test_board_body(spark):
    t = "제목\n조회 12\n첫줄 |\n\n\n둘째\n목록보기\n뒤"
    df = spark.createDataFrame([(t, "제목", ["둘째"]), (None, None, None), ("목록보기\n본문", None, [])], "raw string, title string, ph array<string>")
    assert [x["body"] for x in content.board_body(df, "raw", "title").collect()] == ["첫줄\n\n둘째", "", "본문"]
    assert content.board_body(df, "raw", "title", "ph").first()["body"] == "첫줄"


def test_fine_and_exact(spark):
    df = spark.createDataFrame([(1, "t|x", "a b c d e f g h i j", "ko"), (2, "t", "a b c d e f g h i j k", "ko"), (3, "t", "", "ko"), (4, "t", "z", None), (5, None, None, None)], "p long, title string, text string, lang string")
    got = {x["p"]: (x["canonical"], x["kept"]) for x in dedup.fine(df, F.col("title"), "text", "lang", "p").collect()}
    assert got[1] == (2, False) and got[2] == (2, True) and got[3] == (2, True) and got[4] == (4, True)
    assert dedup.exact_first(df, F.col("text"), "p").count() == 5


def test_near_kept_against_sequence(spark):
    r = random.Random(3)
    base = ["".join(r.choice("abcdefgh ") for _ in range(150)) for _ in range(6)]
    data = []
    for i in range(40):
        t = list(r.choice(base))
        for _ in range(r.choice([0, 2, 6, 20])):
            t[r.randrange(20, len(t))] = r.choice("xyz")
        data.append((i, "".join(t)))
    data += [(40, data[0][1].upper()), (41, ""), (42, None)]
    df = spark.createDataFrame(data, "p long, text string")
    fold = {p: x for p, x in ((y["p"], y["folded"]) for y in dedup.exact_first(df, F.col("text"), "p").collect())}
    kept: list[int] = []
    for p in sorted(fold):
        s = fold[p]
        if s is None or not s:
            kept.append(p)
            continue
        toks = set(list(dict.fromkeys(s.split()))[:8])
        ok = True
        for q in kept:
            o = fold[q]
            if o and toks & set(list(dict.fromkeys(o.split()))[:8]) and abs(len(s) - len(o)) <= max(200, int(0.5 * max(len(s), len(o)))) and SequenceMatcher(None, s, o).ratio() >= 0.9:
                ok = False
                break
        if ok:
            kept.append(p)
    assert sorted(x["p"] for x in dedup.near_kept(df, F.col("text"), "p").collect()) == kept


def test_near_pairs_bounds(spark, monkeypatch):
    """Texts of few and of many different characters, in chunks: the pairs are those of comparing all, and few are compared."""
    import difflib

    r = random.Random(8)
    words = ["".join(r.choice("abcdefghijklmnoprstuwyvkxzq"[: r.choice([8, 14, 27])]) for _ in range(r.randrange(2, 8))) for _ in range(150)]
    base = [" ".join(r.choice(words) for _ in range(r.choice([4, 60, 70, 160]))) for _ in range(18)]
    data = []
    for i in range(60):
        t = r.choice(base)
        for _ in range(r.choice([0, 1, 3, 9])):
            k = r.randrange(len(t))
            t = t[:k] + r.choice(["q", "", " the ", "zz"]) + t[k:]
        data.append((i, "hot " + t))
    want = {(a, b) for a, x in data for b, y in data if a < b and abs(len(x) - len(y)) <= max(200, max(len(x), len(y)) // 2) and SequenceMatcher(None, y, x).ratio() >= 0.9}
    monkeypatch.setattr(dedup, "CHUNK_LETTERS", 6000)
    df = spark.createDataFrame([*data, (98, ""), (99, None)], "p long, folded string")
    assert {(x["a"], x["b"]) for x in dedup.edges(df, "folded", "p").collect()} == want and len(want) > 20
    calls, real = [], difflib.SequenceMatcher
    monkeypatch.setattr(difflib, "SequenceMatcher", lambda *a: calls.append(a) or real(*a))
    near = dedup._Near([p for p, _ in data], [x for _, x in data], 0.9)
    assert {e for p, x in data for e in near.of(p, x)} == want and len(calls) < 2 * len(want) + 20


def test_fuzzy_titles(spark):
    long = "x" * 300
    df = spark.createDataFrame([(1, "t", "ko", None, long, "1"), (2, "t", "ko", None, long, "2"), (3, "t", "ko", None, "other", "1"), (4, None, None, "http://a/b", "q", None), (5, None, None, None, None, None)], "p long, title string, lang string, url string, text string, time string")
    assert sorted(x["p"] for x in dedup.fuzzy_titles(df, "title", "lang", "url", "text", "time", "p").collect()) == [1, 3, 4, 5]


def test_fuzzy_titles_against_plain_scan(spark, monkeypatch):
    """Groups of near texts, interleaved: the same representatives as by comparing every pair, with few comparisons."""
    import difflib

    r = random.Random(5)
    base = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(r.choice([0, 3, 400, 900, 905]))) for _ in range(12)]
    data = []
    for i in range(150):
        x = list(r.choice(base))
        for _ in range(r.choice([0, 1, 2, 8]) if x else 0):
            x[r.randrange(len(x))] = r.choice("xyz")
        data.append((i, f"t{i % 3}", "ko", None, "".join(x) + "q" * r.choice([0, 0, 1, 4]), str(r.randrange(9))))
    want = []
    for g in range(3):
        reps: list[list] = []
        once: dict[str, list] = {}
        for p, _, _, _, x, t in data[g::3]:
            once.setdefault(x, [p, x, t])[2] = max(once[x][2], t) if x in once else t
        for row in once.values():
            for q in reps:
                if SequenceMatcher(None, q[1], row[1]).ratio() >= 0.995:
                    if (len(row[1]), row[2]) > (len(q[1]), q[2]):
                        q[:] = row
                    break
            else:
                reps.append(list(row))
        want += [q[0] for q in reps]
    df = spark.createDataFrame(data, "p long, title string, lang string, url string, text string, time string")
    assert sorted(x["p"] for x in dedup.fuzzy_titles(df, "title", "lang", "url", "text", "time", "p").collect()) == sorted(want) and len(want) < 140
    calls = []
    monkeypatch.setattr(difflib, "SequenceMatcher", lambda *a: calls.append(a))
    g = dedup._Representatives(0.995)
    for i in range(300):  # texts of one length that can't be near: none of them is compared
        g.add(i, chr(0x4E00 + i) * 500, "")
    assert len(g.pos) == 300 and not calls


def test_scores(spark):
    df = spark.createDataFrame([("t", "dcinside", True, 1 / 3, 1 / 3, 1 / 3, ""), ("시발", "dcinside", True, 0.2, 0.5, 0.3, ""), ("t", "x", True, 0.0, 0.0, 0.0, None), ("t", "x", None, 1.0, 0.0, 0.0, "부정"), ("t", "x", True, -1.0, 0.5, 0.5, "긍정")], "text string, source string, is_related boolean, negative double, neutral double, positive double, label string")
    got = [(x["negative"], x["neutral"], x["positive"], x["label"]) for x in scored.client_normal(df).collect()]
    assert got[0] == (0.33, 0.33, 0.33, "부정") and got[1][0] == 0.3 and got[2] == (0.0, 1.0, 0.0, "중립") and got[3] == (0.0, 0.0, 0.0, "무관") and got[4] == (0.0, 0.5, 0.5, "긍정")
    p = scored.percents(spark.createDataFrame([(1.0, 1.0, 1.0), (0.0, None, 0.0)], "a double, b double, c double"), "a", "b", "c").collect()
    assert [tuple(x[k] for k in ("p_neg", "p_neu", "p_pos")) for x in p] == [(34, 33, 33), (0, 100, 0)]
    raw = spark.createDataFrame([('ok ```{"a": {"b": 1}}``` bye',)], "x string").select(scored.answer_json(F.col("x")).alias("y")).first()["y"]
    assert json.loads(raw) == {"a": {"b": 1}}


def test_remote_scorer_retries(spark):
    df = spark.createDataFrame([("good",), (" ",), ("bad",)], "scoring_text string")

    def scorer(t):
        if t == "bad":
            raise RuntimeError
        return {"is_related": True, "negative": 0.1, "neutral": 0.2, "positive": 0.7}

    assert [x["is_related"] for x in scored.remote_score(df, scorer, pause=0.0).collect()] == [True, False, False]


def test_planner(spark):
    h = spark.createDataFrame([("a.b.example",), ("b.example",), ("z.test",)], "host string")
    p = spark.createDataFrame([("b.example", 2.0, 1), ("a.b.example", 9.0, 2)], "host string, pause double, ord int")
    assert {x["host"]: x["pause"] for x in planner.host_pause(h, p, 0.1).collect()} == {"a.b.example": 9.0, "b.example": 2.0, "z.test": 0.1}
    r = spark.createDataFrame([("a", 0, 0, 0), ("b", 1, 9, 2), ("c", 5, 1, 5), ("d", 1, 4, 6)], "bucket string, n_stored long, n_duplicates long, n_fetched long")
    rest = planner.cooldowns(r)
    assert [(x["dup_ratio"], x["rest"]) for x in rest.orderBy("bucket").collect()] == [(0.0, 3), (0.818182, 3), (0.166667, 0), (0.4, 0)]
    left = planner.tick(spark.createDataFrame([("a", 1), ("b", 3), ("e", 2)], "bucket string, rest long"))
    assert {x["bucket"]: x["rest"] for x in planner.merge_rests(left, rest).collect()} == {"a": 3, "b": 3, "e": 1}
    ids = spark.range(60).selectExpr("id * 50 AS k").repartition(7)
    got = planner.chunks(ids, "k", 50).collect()
    assert {x["k"] // 50: x["chunk"] for x in got} == {k: k // 50 for k in range(60)} and planner.chunks(ids.limit(0), "k", 50).count() == 0


def test_quality(spark):
    q = spark.createDataFrame([("t", "", "국민연금 최고", "KO"), (None, "nothing", None, "fr"), ("국민연금", None, None, None)], "title string, text string, comments string, lang string")
    got = content.keyword_quality(q, "title", "text", ("국민연금", "x1", "x2"), "lang", ("ko",), fallback="comments").collect()
    assert [(x["hits"], x["coverage"], x["score"], x["reasons"], x["length"]) for x in got] == [(1, 0.333, 0.5, "", 7), (0, 0.0, 0.0, "lang=fr,keyword_hits", 7), (1, 0.333, 0.2, "lang=und", 0)]


def test_boards(spark):
    p = spark.createDataFrame([("a", "s", "Head | x", "en", "2025-01-02 03:04:05", "첫줄\n\n둘째"), ("b", "s", None, None, None, None), ("c", "s", "쿠폰 나눔", "ko", "no time", "t")], "id string, source string, title string, lang string, published_at string, text string")
    c = spark.createDataFrame([("a", 0, " one ", "10:20", "ko"), ("a", 1, " ", "11:00:01", None), ("b", 0, "two", "12:00", ""), ("c", 0, "x", None, None)], "post_id string, comment_index int, text string, published_at string, lang string")
    got = {x["id"]: x for x in rows.flatten_board(p, c, "paragraph").collect()}
    assert set(got) == {"a", "b", "c", "a_0", "b_0", "c_0"} and got["a_0"]["title"] == "Head" and got["a_0"]["text"] == "첫줄" and got["a_0"]["has_text"] and not got["b_0"]["has_text"] and got["b"]["has_text"]
    got = {x["id"]: x for x in rows.flatten_board(p, c, "events").collect()}
    assert set(got) == {"a", "b", "a_0", "a_1", "b_0"} and got["a_0"]["comment_publishedAt"] == "2025-01-02 10:20" and got["a_1"]["comment_text"] is None and got["b_0"]["comment_publishedAt"] == "12:00"
    got = {x["id"]: x["lang"] for x in rows.flatten_board(p, c, "own_lang").collect()}
    assert got == {"a": "en", "b": None, "c": "ko", "a_0": "ko", "b_0": None, "c_0": "ko"}
    assert rows.flatten_board(p.limit(0), c, "events").count() == 0


def test_counters(spark):
    df = spark.range(10)
    out, seen = rows.counted(df, "pages", n_even=F.col("id") % 2 == 0)
    assert out.count() == 10 and seen.get == {"n_rows": 10, "n_even": 5}
    assert rows.success_ratio(df.limit(0), F.col("id") > 3).first()["ratio"] == 0.0
    t = spark.createDataFrame([(1, None, None), (2, "2025-01-01 00:00:00", None), (3, None, "2024-01-01")], "row_id long, published_at string, comment_publishedAt string").repartition(3)
    assert {x["row_id"]: x["sort_rank"] for x in rows.time_ranked(t).collect()} == {1: 1, 3: 2, 2: 3}
    c = spark.createDataFrame([("p", 2, "same"), ("p", 0, " same "), ("p", 1, " "), ("q", 5, "same")], "post string, at int, text string")
    assert sorted(tuple(x) for x in content.distinct_comments(c, "post", "text", "at").collect()) == [("p", 0, "same"), ("q", 5, "same")]
    assert content.between_markers(F.lit("x")) is not None


def test_dashboard_empty(spark):
    e = scored.from_events(spark.createDataFrame([], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"))
    assert dashboard.daily_score(e).count() == 0 and dashboard.label_distribution(e).count() == 3 and dashboard.likert_segments(e).count() == 0


def test_pipeline(spark, sf):
    p = spark.read.parquet(f"{sf}/raw_posts.parquet")
    assert 0 < pipeline.articles(p).count() <= p.count()
    u = spark.read.parquet(f"{sf}/unified_rows.parquet")
    assert pipeline.scored_rows(pipeline.merged(u)).filter("label = 'unknown'").count() == 0


def test_state_and_config(spark, tmp_path):
    from opinlake.plans import state

    path = str(tmp_path / "counts")
    state.reset(spark, path)
    assert state.load(spark, path).count() == 0
    rows_ = spark.sql("SELECT timestamp_ntz'2024-01-05' AS t, 'a' AS source UNION ALL SELECT timestamp_ntz'2024-02-05', 'a'")
    c = state.add_round(state.load(spark, path), rows_, "t")
    assert {(x["month"], x["n"]) for x in c.collect()} == {("2024-01", 1), ("2024-02", 1)}
    assert state.status(c).first()["n"] == 2 and state.plan(c, state.Config(month_target=5, months=2), 0).count() == 2
    yaml = pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text(yaml.safe_dump({"langs": ["ko"], "unknown": 1}))
    (tmp_path / "k.txt").write_text("연금\n# no\n")
    cfg = state.load_config(str(tmp_path / "c.yaml"), str(tmp_path / "k.txt"))
    assert cfg.langs == ("ko",) and cfg.keywords == ("연금",)
