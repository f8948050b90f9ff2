"""Work that is done once or not at all, with the same results as when it is done for everything."""

import re
import unicodedata
import zlib
from types import SimpleNamespace

import numpy as np
import pytest

from opinlake.llm import langid, mainbody, pii, prose


@pytest.fixture(scope="module")
def langs():
    return langid.fit([])


def test_equal_words_are_scored_once(langs, monkeypatch):
    seen = []
    plain = langid.ngram_ids
    texts = ["The report came late and the report was long. " * 40, "보고서가 늦게 나왔고 보고서가 길었습니다 " * 40, "The report 보고서가 came late 늦게 나왔고 and was long"]
    want = [langs.word_scores([w]) for w in langid.tokens(texts[2])]
    monkeypatch.setattr(langid, "ngram_ids", lambda words: seen.extend(words) or plain(words))
    assert [f.langs for f in langid.detect(langs, texts)][:2] == [["en"], ["ko"]]
    assert len(seen) == len(set(seen)) == len({w for t in texts for w in langid.tokens(t)})
    assert (langs.word_scores(langid.tokens(texts[2])) == np.concatenate(want)).all()


def test_paths_of_many_texts():
    """All texts in step, against one text at a time; ties included."""
    r = np.random.default_rng(2)
    texts = [np.round(r.normal(0, 6, (int(n), 7))) for n in r.integers(1, 60, 40)]

    def plain(rows, switch):
        best, back = rows[0], []
        for row in rows[1:]:
            top = max(best)
            j, jump = best.index(top), top - switch
            back.append([i if b >= jump else j for i, b in enumerate(best)])
            best = [(b if b >= jump else jump) + v for b, v in zip(best, row)]
        path = [best.index(max(best))]
        for came in reversed(back):
            path.append(came[path[-1]])
        return path[::-1]

    assert langid.best_paths(texts, 14.0) == [plain(t.tolist(), 14.0) for t in texts] and langid.best_paths([]) == []
    assert any(len(set(p)) > 1 for p in langid.best_paths(texts, 14.0))


def test_tokens_by_the_plain_pattern():
    """Words with a digit or sign are read once, and texts without one not at all, with the words of the plain pattern."""
    r = np.random.default_rng(0)
    drop = re.compile(r"(?<![!-~])[!-~]*[0-9@#][!-~]*|https?://\S+|www\.\S+")
    pieces = [*"aZé가ㅋ一ア09@#_'’./:!~ \n\t１ﬁßİ𝒜²٣힤", "http://", "https://", "www.", "abcdefghij", "漢字漢字漢字漢字漢字", "가나다라마바사아자차", "don't", "  "]
    for _ in range(4000):
        t = "".join(pieces[i] for i in r.integers(0, len(pieces), int(r.integers(1, 14))))
        assert langid.tokens(t) == langid._TOKEN.findall(langid._JAMO.sub(" ", drop.sub(" ", unicodedata.normalize("NFKC", t))).lower()), t


def test_title_lines():
    """The cheap tests before the letters are compared turn no title away."""
    r = np.random.default_rng(5)
    pieces = ["A", "b", "ß", "ΐ", "ﬃ", "İ", "가", " ", "-", "7", "²", "_", "?"]
    hits = 0
    for _ in range(20000):
        line, title = ("".join(r.choice(pieces, int(r.integers(1, 4)))) for _ in range(2))
        key = mainbody.letters(title)
        want = bool(key) and len(line) < 2 * len(title) + 20 and mainbody.letters(line) == key
        assert mainbody.is_title(line, title, key) == want, (line, title)
        hits += want
    assert hits > 100 and mainbody.is_title("STRASSE!", "straße", mainbody.letters("straße"))


def test_prose_is_asked_of_reported_documents_only(spark, langs):
    """A document whose label is right needs no statistics; one whose label is wrong is still left out if it isn't prose."""

    class Unasked(prose.ProseModel):
        def distance(self, x, lang):
            if (lang == langid.LANGS.index("en")).any():
                raise AssertionError("asked of a document whose label is right")
            return super().distance(x, lang)

    keep = mainbody.Labeller(mainbody.fit([], []).net, cut=2.0)
    n = 1 << prose.GRAM_BITS
    text = {"en": "They talked about the new plan at the meeting yesterday.", "de": "Gestern haben sie in der Sitzung über den neuen Plan gesprochen."}
    junk = "Gestern | haben | sie | in | der | Sitzung | über\n" * 30
    model = Unasked(np.zeros(n, np.float32), np.zeros(1 << 16, np.float32), np.zeros((prose.N_ALL, len(prose.STATS))), np.stack([np.eye(len(prose.STATS))] * prose.N_ALL), cut=0.1)
    model.joins = np.zeros(n, np.float32)
    model.means[:] = prose.Judged(model, keep, langs, [text["de"]], [None]).stats[0]
    docs = [(k, text["en"], None, "en") for k in range(5)] + [(10, text["de"], None, "en"), (11, text["de"], None, "de"), (12, None, None, "en"), (13, junk, None, "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, title string, lang string")
    bodies = prose.read(df, spark.sparkContext.broadcast((keep, langs)))
    sent = SimpleNamespace(value=prose.Trained(keep, langs, model))
    for t in (bodies, df):
        assert [tuple(r) for r in prose.languages_of_documents(t, sent).collect()] == [("documents", 10, "de")]


def test_pii_looks_up_each_word_once(monkeypatch):
    """Whether a word is rare is asked once for all its places, of texts with and without a pair of rare words."""
    asked = []
    plain = pii._rare
    monkeypatch.setattr(pii, "_rare", lambda w, words: asked.append(w) or plain(w, words))
    total = np.zeros((2 << pii.WORD_BITS) + 1)
    pii.word_counts(["the meeting was long and loud"] * 50, total)
    words = pii.Words(total)
    texts = ["the meeting was long", "the long meeting was brunhild ostrander", "was the meeting loud and long"] * 20
    names = [[t[s.start:s.end] for s in pii.candidates(t, words) if s.type == "name"] for t in texts]
    assert names == [[], ["brunhild ostrander"], []] * 20
    assert len(asked) == len(set(asked)) == len({w for t in texts for w in t.split()})


def test_pii_numbers_of_identity_behind_a_gate():
    """The cheap test lets every number through that the grammar takes, and keeps dates and amounts out."""
    r = np.random.default_rng(3)
    pieces = ["12", "345", "678", "9", "12345678", "A", "Z", "XY", ".", "-", " ", "x", "나"]
    hits = 0
    for _ in range(20000):
        t = "".join(r.choice(pieces, int(r.integers(2, 10))))
        found = pii._ID.search(t) is not None
        assert not found or pii._ID_DIGITS.search(t), t
        hits += found
    assert hits > 100 and not any(map(pii._ID_DIGITS.search, ("on 2024-05-17 at 10:30", "1,204,300 won", "표 3-2-11")))


def test_pii_word_counts_by_the_plain_rule():
    """Counted by whole sets of words as by one word after another."""
    pieces = ["Word", "word", "WORD", "İki", "ß", "한글", "漢字", "漢字体系", "字体", "カナ", "かな", " ", "-", "é", "É"]
    r = np.random.default_rng(8)
    texts = ["".join(r.choice(pieces, int(r.integers(1, 9)))) for _ in range(3000)]
    got, want = np.zeros((2 << pii.WORD_BITS) + 1), np.zeros((2 << pii.WORD_BITS) + 1)
    pii.word_counts(texts, got)
    at = lambda w: zlib.crc32(w.encode()) >> (32 - pii.WORD_BITS)
    for t in texts:
        words = set(pii._WORDS.findall(t))
        pairs = {w[i:i + 2] for w in words if len(w) > 2 and "一" <= w[0] <= "鿿" for i in range(len(w) - 1)}
        for w in {w.lower() for w in words} | pairs:
            want[at(w)] += 1
        for w in words:
            want[(1 << pii.WORD_BITS) + at(w)] += w.islower()
    want[-1] = len(texts)
    assert (got == want).all()
