"""Operators that must see whole tables, not samples of them."""

import numpy as np

from opinlake.llm import langid, mainbody, prose, queries, standing, store, toxic


def test_prose_counts_every_document(spark):
    """Fitted over the table as over the list of all documents, wherever the partitions end; a rare topic counts with all its documents."""
    plain = mainbody.Labeller(mainbody.fit([], []).net, cut=2.0)
    langs = langid.fit([])
    r = np.random.default_rng(4)
    say = lambda k: f"The {r.choice(['office', 'board', 'clerk', 'nurse'])} {r.choice(['printed', 'rejected', 'explained'])} the {r.choice(['letter', 'table', 'form'])} number {k} again today."
    docs = [(k, "\n".join(say(k) for _ in range(3)), None, "en") for k in range(4400)]
    docs += [(9000 + k, f"Xylophonists quibbled {w} about the glockenspiels.", None, "en") for k, w in enumerate(["once", "twice", "later", "today"])]
    df = spark.createDataFrame(docs, "doc_id long, text string, title string, lang string").repartition(5)
    bodies = prose.read(df, spark.sparkContext.broadcast((plain, langs)))
    assert bodies.count() == len(docs)
    got, want = prose.fit_all(bodies), prose.fit([{"text": t, "title": None} for _, t, _, _ in docs], plain, langs)
    assert (got.grams == want.grams).all() and (got.joins == want.joins).all() and (got.common == want.common).all()
    assert np.allclose(got.means, want.means, atol=1e-3)
    rare = prose._line_counts(["glockenspiels"], None, None)[1]
    assert (got.grams[rare] > 0).all()
    b = spark.sparkContext.broadcast(prose.Trained(plain, langs, got))
    a, c = prose.document_statistics(bodies, b), prose.document_statistics(df, b)
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0


def test_abuse_counts_every_comment(spark):
    """All comments are background, whatever their number and partitions; a frequent language is weighted, not thinned."""
    r = np.random.default_rng(6)
    words = ["report", "meeting", "letter", "number", "table", "window", "garden", "summer"]
    texts = [f"The {r.choice(words)} about the {r.choice(words)} and the {r.choice(words)} came {k} days late." for k in range(26000)] + ["Quizzical wombats juggled jonquils."] * 3 + ["", "👍"]
    df = spark.createDataFrame([(k, "s", t) for k, t in enumerate(texts)] + [(99999, "s", None)], "row_id long, source string, comment_text string").repartition(5)
    ratings = spark.createDataFrame([(k, False) for k in range(5)], "row_id long, offensive boolean")
    labelled = toxic.training_sample(df, ratings)
    assert len(labelled) == 5
    (sent, letters), want = toxic.trained(spark, df, ratings), toxic.fit(labelled, texts)
    got = sent.value
    a, b = toxic.scores(df, sent), toxic.scores_of_letters(letters, sent)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and b.count() == len(texts) + 1
    assert np.allclose(got.odds, want.odds, atol=1e-4) and abs(got.lam - want.lam) < 1e-3 and abs(got.k - want.k) < 1e-3 * want.k + 1e-9
    rare = np.concatenate([x[ok] for x, ok in list(toxic.grams(toxic.pack(["wombatsjuggledjonquils"])[0]))[3:]])
    assert (got.odds[rare] < 0).mean() > 0.9  # three comments of 26,000 are evidence for clean


def test_segments_of_both_tables(spark, sf):
    """Every document with a word has its segments with a confidence, as every judged row has."""
    got = queries.p3_segments(spark, sf).cache()
    assert got.columns == ["tbl", "row_key", "segment", "lang_code", "confidence", "n_words"]
    keys = {t: {r["row_key"] for r in got.filter(got.tbl == t).select("row_key").distinct().collect()} for t in ("documents", "unified_rows")}
    docs = {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) > 100").select("doc_id").collect()}
    assert keys["unified_rows"] and docs and len(docs & keys["documents"]) >= 0.95 * len(docs)
    assert got.filter("confidence IS NULL OR confidence <= 0 OR confidence > 1").count() == 0
    assert got.count() == got.select("tbl", "row_key", "segment").distinct().count()


def test_cut_has_one_rule():
    """The cut moves from the prior to the rated rows without a step, whatever their number and raters."""
    clean = [f"The report number {k} about the garden came late." for k in range(200)]

    def cut(n, raters=1):
        rated = [(k, f"You utter moron, fuck off with number {k}", 1.0, raters) for k in range(n)] + [(1000 + k, t, 0.0, raters) for k, t in enumerate(clean)]
        return toxic.fit(rated, clean).cut

    few, below, above = cut(6), cut(59), cut(61)
    assert few != toxic.CUT and toxic.fit([], clean).cut == toxic.CUT
    assert abs(above - below) < 0.2 * abs(above - toxic.CUT)
    score, y = np.concatenate([np.full(400, 0.1), np.full(40, 5.0)]), np.repeat([0.0, 1.0], [400, 40])
    far = [abs(toxic.choose_cut(np.tile(score, k), np.tile(y, k), np.full(440 * k, w)) - toxic.CUT) for k, w in ((1, 0.5), (1, 1.0), (4, 1.0), (16, 1.0))]
    assert far == sorted(far) and far[0] > 0


def test_standing_blocks_are_components(spark):
    """Lines that always follow one another share a block; a line that stands elsewhere has its own."""
    rows = [(k, f"Rights reserved\nShare this page\nAll about us\nown text {chr(97 + k % 26)}{chr(97 + k // 26)}\n" + ("Lonely line" if k % 2 else "other" + chr(97 + k % 26) * 3), "a") for k in range(60)]
    got = {(r["line_no"], r["block"]) for r in standing.find_standing(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect() if r["doc_id"] == 1}
    block = dict(got)
    assert len(got) == 4 and block[0] == block[1] == block[2] != block[4]
    rows = [(k, f"Rights reserved\nShare this page\nAll about us\nown {chr(97 + k % 26)}{chr(97 + k // 26)}", "a") for k in range(40)]
    report = standing.report(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert [(r["n_lines"], r["n_edges"], r["n_blocks"]) for r in report] == [(3, 2, 1)]


def test_models_are_kept(spark, tmp_path):
    """Fitted once for the same table, in whatever order its rows come; again for another table or parameter; always without a folder."""
    made = []

    def fit():
        made.append(1)
        return {"weights": np.arange(len(made))}

    df = spark.createDataFrame([(k, f"text {k}") for k in range(50)], "k long, t string")
    store.fitted(spark, "m", [df], (1,), fit)
    spark.conf.set(store.FOLDER, str(tmp_path / "models"))
    try:
        first = store.fitted(spark, "m", [df], (1,), fit)
        again = store.fitted(spark, "m", [df.repartition(3).orderBy("t")], (1,), fit)
        assert len(made) == 2 and (first["weights"] == again["weights"]).all()
        store.fitted(spark, "m", [df.filter("k > 0")], (1,), fit)
        store.fitted(spark, "m", [df], (2,), fit)
        assert len(made) == 4
    finally:
        spark.conf.unset(store.FOLDER)
