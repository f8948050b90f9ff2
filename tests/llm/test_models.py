"""Trained operators: held-out accuracy on made texts, and the awkward cases."""

import numpy as np
import pytest

from opinlake.llm import langid, mainbody, mixing, pii, prose, toxic, toxic_seeds

U = "row_id long, id string, source string, lang string, title string, text string, comment_index int, comment_text string, extra string"


@pytest.fixture(scope="module")
def lang_model():
    return langid.fit([])


def test_languages(lang_model):
    texts = {
        "ko": "어제 회의에서 새로운 방안을 논의했습니다", "en": "They talked about the new plan at the meeting yesterday", "es": "Ayer hablaron del nuevo plan en la reunión con los vecinos", "de": "Gestern haben sie in der Sitzung über den neuen Plan gesprochen",
        "pt": "Ontem falaram sobre o novo plano na reunião e não gostaram", "ja": "昨日の会議で新しい案について話しました", "zh": "昨天他们在会议上讨论了新的计划",
    }
    found = langid.detect(lang_model, list(texts.values()))
    assert [f.langs for f in found] == [[k] for k in texts]
    mixed = langid.detect(lang_model, [texts["ko"] + ". " + texts["en"], texts["en"] + " " + texts["de"]])
    assert mixed[0].langs == ["en", "ko"] and mixed[1].langs == ["de", "en"]
    assert langid.detect(lang_model, [None, "", "ㅋㅋㅋ", "👍", "123 !!", "haha"]) == [None] * 6
    assert langid.detect(lang_model, [texts["en"] * 3000])[0].langs == ["en"]


def test_labels():
    assert [langid.label_of(x) for x in ("ko", "KO", "en_GB", "und", None, "", "??", "xx")] == ["ko", "ko", "en", None, None, None, None, None]


def test_language_frame(spark, lang_model):
    b = spark.sparkContext.broadcast(lang_model)
    rows = [(1, "a", "s", "ko", None, "글 본문입니다 여러분", None, None, "x"), (2, "b", "s", "en", None, "post", 0, "저는 그렇게 생각하지 않습니다", None), (3, "c", "s", None, None, None, 1, None, None), (4, "d", "s", "??", None, None, 2, "ㅋㅋ", None)]
    df = spark.createDataFrame(rows, U)
    assert [tuple(r) for r in langid.find_in_rows(df, b).collect()] == [("unified_rows", 2, "ko")]
    assert langid.find_in_rows(df.limit(0), b).count() == 0 and langid.segments_of_rows(df, b).count() == 2


CALM = ["The report on fees was published this week and I read it.", "회의 자료를 읽고 의견을 정리했습니다.", "El informe salió ayer y lo leí.", "Der Bericht kam gestern und ich habe ihn gelesen."]


def test_toxic_lexicon_alone(spark):
    """Without ratings the lexicon teaches; none of these sentences is in it."""
    m = toxic.fit([], CALM * 40)
    bad = m.score(["what an utter moron he is, honestly", "이런 개자식아 조용히 해라", "stop it, m.o.r.o.n, stop", "ese tipo es un gilipollas", "the b1tch and the b@stard"])
    good = m.score(["The fees were published on Monday", "회의 자료를 다시 읽었습니다", None, "", "👍"])
    assert bad.min() > good.max() and good[2] == good[3] == 0
    assert m.passages("what a fucking moron, said nobody") and m.passages("") == []
    df = spark.createDataFrame([(1, "a", "s", None, None, None, 0, "fuck off, you stupid moron", None), (2, "b", None, None, None, None, 0, None, None)], U)
    b = spark.sparkContext.broadcast(m)
    got = {r["row_id"]: r for r in toxic.scores(df, b).collect()}
    assert got[1]["offensive"] and got[1]["n_passages"] >= 1 and got[2]["score"] == 0
    assert toxic.rates(toxic.scores(df, b)).count() == 1 and toxic.scores(df.limit(0), b).count() == 0


def test_toxic_learns_turns_from_ratings():
    """A turn of phrase without a word of the lexicon is learnt from rated rows and found in wordings that none of them has."""
    who = ["plumbers", "bakers", "drivers", "gardeners", "painters", "teachers", "sailors", "cooks"]
    rated = [(k, f"The lot of {who[k % 4]} ought to be flushed away for ever. {CALM[k % 4]}", 1.0, 2) for k in range(24)]
    rated += [(100 + k, f"{who[k % 8].capitalize()} came to the meeting. {CALM[k % 4]}", 0.0, 2) for k in range(60)]
    back = [t for _, t, _, _ in rated] + CALM * 200 + [f"We met {w} at the counter and read the report." for w in who] * 20
    m = toxic.fit(rated, back)
    s = m.score([f"the lot of {w} ought to be flushed away" for w in who[4:]] + [f"We met {w} again at the counter" for w in who[4:]])
    assert s[:4].min() > s[4:].max() and (s[:4] >= m.cut).all() and (s[4:] < m.cut).all()


def test_toxic_unseen_says_nothing():
    """An n-gram that neither side has is no evidence, however much larger one side is."""
    assert toxic.log_odds(np.array([0.0, 5.0, 0.0]), np.array([0.0, 0.0, 1000.0]))[0] == 0


def test_toxic_short_oath_in_long_text():
    """A short sentence of abuse stands out in a long text, as it does alone."""
    m = toxic.fit([], CALM * 40)
    m.lam, m.k, m.each, m.cut = 0.4, 0.003, (0.8, 0.003), 2.6
    alone, within = m.score(["Fuck you.", " ".join(CALM) + " Fuck you. " + " ".join(CALM)])
    assert alone >= m.cut and within >= m.cut and m.score([" ".join(CALM * 2)])[0] < m.cut


def test_passages_add_up():
    """Two significant passages are less likely by chance than one of them."""
    m = toxic.fit([], CALM * 40)
    part = [(0, 5, 14.0), (9, 14, 13.0)]
    assert m.together(part, 60) > m.together(part[:1], 60) > 0 and m.together([], 60) == 0


def test_max_segment_scan():
    """The vectorised scan against a plain one."""
    m = toxic.ToxicModel(np.random.default_rng(0).normal(0, 1, 1 << toxic.BITS).astype(np.float32))
    texts = ["abcdefgh", "가나다라마바사", "x", "hello world again and again" * 5]
    s, of = m.positions([toxic.squash(t) for t in texts])
    best, _ = m.best([toxic.squash(t) for t in texts])
    for i in range(len(texts)):
        run = top = 0.0
        for v in s[(of == i) & (s > -1e5)]:
            run = max(0.0, run + v)
            top = max(top, run)
        assert abs(top - best[i]) < 1e-5
        assert not m.passages(texts[i]) or abs(max(m.p_values(np.array([top]), np.array([1.0]))) - max(m.p_values(np.array([best[i]]), np.array([1.0])))) < 1e-6


QUIET = ["오늘 회의가 길었습니다", "비가 와서 늦게 도착했어요", "the meeting was long and loud", "we walked home in the rain", "la reunión fue muy larga", "das Treffen war lang und laut", "昨日は雨でした", "今天开会时间很长"]


def _words(texts):
    total = np.zeros((2 << pii.WORD_BITS) + 1)
    pii.word_counts(texts, total)
    return pii.Words(total)


@pytest.fixture(scope="module")
def pii_model():
    return pii.fit(QUIET * 40, _words(QUIET * 40), rounds=1)


def test_pii_unseen_wordings(pii_model):
    """Sentences written for this test: training puts values at random places and knows none of them."""
    cases = [
        ("Leave word at jo.kranz@postbox.net before noon", {"email"}), ("schick es bitte an lena99 [at] kiste [dot] de", {"email"}), ("제 주소창에 hana.k@uchi.org 적어 주시면 됩니다", {"email"}), ("메일은 jh7@ab.kr 이에요", {"email"}), ("anna.k ät postfach punkt de", {"email"}),
        ("After six try 415-555-0137, I never sleep", {"phone"}), ("밤에는 010-4821-7730 이 더 빨라요", {"phone"}), ("marca el +34 612 45 78 90 y pregunta", {"phone"}), ("공일공 사팔이일 칠칠삼공 여기로요", {"phone"}),
        ("their form printed 666-21-4839 on the cover", {"id_number"}), ("옆 사람이 900231-1234567 이라고 크게 읽더라고요", {"id_number"}), ("ponía 12345678-Z en la portada", {"id_number"}),
        ("we used to rent 48 Bramley Lane, Flat 7, Nortwick", {"address"}), ("작년까지 송미시 다온구 해찬로 27번길 15 에 있었죠", {"address"}), ("damals in der Kerzenmacherstraße 12, 01234 Bornau", {"address"}), ("nos mudamos a calle del Molino Viejo 9, 3º A, Villarosa", {"address"}),
        ("옆자리 남궁하람 씨한테 들었어요", {"name"}), ("박도윤 교수님 강의가 좋았죠", {"name"}), ("they asked Brunhild Ostrander to sign it", {"name"}), ("la tía Casilda Montesclaros lo vio", {"name"}),
    ]
    miss = [(t, want) for t, want in cases if not want <= {s.type for s in pii_model.find(t)}]
    assert len(miss) <= 2, miss
    plain = ["the sum was 1,204,300 in all", "release 4.12.7 came on 2024-05-17", "접수 2023-11-9042 건", "seen by 4500 people at 10:30", "표 3-2-11 을 보세요", "retired at 62.5 or later", "@nobody and user4711 wrote", "Bus 12 fährt um 8"]
    assert sum(bool(pii_model.find(t)) for t in plain) <= 1


def test_pii_gates_lose_nothing(pii_model):
    """The cheap tests before the grammars change no result, on texts thrown together from pieces."""
    r = np.random.default_rng(12)
    pieces = ["k1@b2.io", "jh7@ab.kr", "a at b dot c", "an.na (at) x [dot] de", "x 골뱅이 y.kr", "ät", "punkt", "punto com", "010", "O1O-1234-5678", "12", "3456", "7890123", "로 15", "느티길3", "강남구", "동 7", "calle", "C/ Sol", "plaza Mayor 3", "Weg 9", "Hofstr. 4a", "Am", "oh seven six five one two three", "one", "two-three", "zero", "nine", "eight", "seven", "six", "St", "4 Elm St", "Anna", "Kovel", "ANNA", "kovel", "李明", "田中太郎さん", "東京都", "1丁目2番", "김하늘", "씨", "남궁민수", "님", "X1234567L", "12.345.678-Z", "１２３", ",", ".", "(", "[at]", "\n"]
    for _ in range(400):
        t = str(r.choice([" ", " ", ""])).join(r.choice(pieces, int(r.integers(1, 14))))
        a, b = pii.candidates(t, pii_model.words), pii.candidates(t, pii_model.words, gated=False)
        key = lambda x: sorted((s.start, s.end, s.type, sorted(s.feats)) for s in x)
        assert key(a) == key(b), t


def test_pii_redaction(spark, pii_model):
    assert pii_model.redact("문의: a.b@mail.example 또는 010-1234-5678") == "문의: [EMAIL] 또는 [PHONE]"
    for t in (None, "", "x" * 50_000):
        assert pii_model.redact(t) == t
    b = spark.sparkContext.broadcast(pii_model)
    df = spark.createDataFrame([(1, "a", "s", None, None, "문의: a@b.example", 0, "연락 010-1234-5678", None), (2, "b", "s", None, None, None, 0, None, None)], U)
    assert {tuple(r) for r in pii.find(df, b).collect()} == {(1, "text", "email"), (1, "comment_text", "phone")}
    assert pii.redact(df, b).count() == 2 and pii.find(df.limit(0), b).count() == 0


def test_pii_counts_words_of_all_rows(spark):
    df = spark.createDataFrame([(k, "a", "s", None, None, "body word", None if k % 3 == 0 else 0, "said Word twice word", None) for k in range(3000)], U).repartition(4)
    total, want = pii.count_words(df), np.zeros((2 << pii.WORD_BITS) + 1)
    pii.word_counts(["body word\nsaid Word twice word" if k % 3 == 0 else "said Word twice word" for k in range(3000)], want)
    assert (total == want).all() and total[-1] == 3000


@pytest.fixture(scope="module")
def labeller():
    r = np.random.default_rng(0)
    subj, verb, obj = ["The office", "A clerk", "My aunt", "The board", "A nurse"], ["explained", "rejected", "printed", "reviewed"], ["the new rate", "the old form", "that letter", "a long table"]
    say = lambda: f"{r.choice(subj)} {r.choice(verb)} {r.choice(obj)} and {r.choice(subj).lower()} {r.choice(verb)} {r.choice(obj)} again."
    menu = lambda: " | ".join(r.choice(["Home", "News", "Forum", "Polls", "Guides", "Photos"], 5))
    posts = []
    for i in range(160):
        body = [say() for _ in range(int(r.integers(2, 7)))]
        page = [menu()] * (r.random() < 0.8) + body + [f"Share this story {r.integers(1, 99)}"] * (r.random() < 0.7) + [f"Rights stay with Site © 20{r.integers(10, 30)}"]
        posts.append({"raw_text": "\n".join(page), "title": "A headline", "body": "\n".join(body)})
    return mainbody.fit(posts[:120], []), posts[120:]


def test_main_body(spark, labeller):
    model, held = labeller
    ok = n = 0
    for p, (_, lines, prob) in zip(held, model.furniture([p["raw_text"] for p in held], [None] * len(held))):
        body = set(p["body"].split("\n"))
        ok += sum((q >= 0.5) == (x not in body) for x, q in zip(lines, prob))
        n += len(lines)
    assert ok / n > 0.95
    b = spark.sparkContext.broadcast(model)
    df = spark.createDataFrame([("t", 1, held[0]["raw_text"], None), ("t", 2, None, None), ("t", 3, "", "x"), ("t", 4, "\n \n", None), ("t", 5, "one line\n" * 3000, None)], "tbl string, row_key long, text string, title string")
    got = {r["row_key"]: r for r in mainbody.main_text(df, b).collect()}
    assert len(got) == 5 and got[2]["main_text"] == "" and got[4]["n_removed"] == 0
    assert {r["row_key"] for r in mainbody.find_furniture(df, b).collect()} <= {1, 5} and mainbody.find_furniture(df.limit(0), b).count() == 0
    assert mainbody.fit([], []).furniture(["a\nb"], [None])[0][1] == ["a", "b"]


def test_prose(spark, labeller, lang_model):
    model, held = labeller
    plain = mainbody.Labeller(model.net, cut=2.0)  # every line is kept
    r = np.random.default_rng(1)
    docs = [{"text": p["body"], "title": None} for p in held for _ in range(6)]
    m = prose.fit(docs, plain, lang_model)
    table = "\n".join("\t".join(str(x) for x in r.integers(1, 99999, 5)) for _ in range(12))
    junk = "\n".join("".join(r.choice(list("qwxz0189#"), 40)) for _ in range(6))
    j = prose.Judged(m, plain, lang_model, [held[0]["body"], table, junk, None, "", held[1]["body"].replace(".", "")], [None] * 6)
    assert (j.junk_share > 0.5).tolist() == [False, True, True, False, False, False]
    b = spark.sparkContext.broadcast(prose.Trained(plain, lang_model, m))
    df = spark.createDataFrame([(1, table, None, "ko"), (2, None, None, None), (3, held[0]["body"], "t", "en")], "doc_id long, text string, title string, lang string")
    assert [r_["doc_id"] for r_ in prose.not_prose(df, b).collect()] == [1]
    st = {x["doc_id"]: x for x in prose.document_statistics(df, b).collect()}
    assert st[2]["distance"] is None and st[2]["is_prose"] and abs(sum(st[3]["contributions"]) - st[3]["distance"]) < 1e-6
    assert prose.document_statistics(df.limit(0), b).count() == 0
    assert {x["row_key"] for x in prose.languages_of_documents(df, b).collect()} <= {3}


def test_mixing(spark):
    r = np.random.default_rng(3)
    docs = [(i, "a" if i % 10 < 7 else "b", "word " * int(r.integers(1, 60)), "x") for i in range(600)] + [(9000, "a", None, None), (9001, "b", "", None), (9002, None, "text", None), (9003, "zz", "text", None)]
    d = spark.createDataFrame(docs, "doc_id long, source string, text string, n_uses string")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 4), ("none", 0.0, 2), ("empty", 0.2, 3)], "source string, target_share double, max_repeats int")
    rows = mixing.mix(d, t).collect()
    assert {x["source"] for x in rows} == {"a", "b"}
    used = {s: sum(x["n_tokens"] * x["n_uses"] for x in rows if x["source"] == s) for s in "ab"}
    assert abs(used["a"] / sum(used.values()) - 0.5) < 0.03 and max(x["n_uses"] for x in rows if x["source"] == "a") == 1 and max(x["n_uses"] for x in rows) <= 4
    assert abs(rows[0]["reached_share"] - used[rows[0]["source"]] / sum(used.values())) < 1e-9
    assert mixing.mix(d.limit(0), t).count() == 0
