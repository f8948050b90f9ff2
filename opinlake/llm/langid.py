"""Missing or wrong document language labels (problem 3).

Method: multinomial naive Bayes over hashed character n-grams; the log-probability matrix is broadcast and batches are scored sparsely
in numpy. Scores are kept per word, so that a text is cut into language segments by a Viterbi pass wherever one language doesn't
explain all its words.

Training (on the driver): the labels of a bounded sample of rows (``TRAIN_ROWS`` of each table), which are mostly right, together with a
few plain sentences per language; the model then relabels the sample sentence by sentence and is fitted again, which removes wrong
labels and mixed texts.

Scale: one narrow pass, no shuffle. Texts are whole, never prefixes. Equal texts of a batch are scored once.

Defined results: null texts and texts without a word (laughter, emoji, digits, signs) have no language; a text too short to tell keeps
its label if that names a language; repeated rows give repeated results by their own keys; empty tables give empty results.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import filled
from .samples import bounded

LANGS = ("ko", "en", "es", "pt", "de", "ja", "zh")
BITS = 16
TRAIN_ROWS = 6000
SWITCH = 14.0
WRONG = 3.0
CHUNK = 20_000

# Plain sentences of each language, so that every language is known where labels are few.
SEEDS = {
    "ko": "오늘은 날씨가 좋아서 친구와 함께 공원에 갔습니다. 그 사람은 어제 무엇을 했는지 말해 주지 않았어요. 정부는 새로운 제도를 내년부터 시행한다고 발표했다. 저도 그렇게 생각합니다. 감사합니다. 정말 그런가요? 궁금해요. 잘 읽었습니다. 맞는 말씀이네요.",
    "en": "The weather was good today so I went to the park with a friend. He did not tell us what they had done yesterday. The government said that the new rules would start next year. I agree with you. Thank you. Is that really so? Well said. Here we go again. Same here, that is right. What do you think about this?",
    "es": "Hoy hacía buen tiempo y fui al parque con una amiga. No nos dijo lo que habían hecho ayer. El gobierno anunció que las nuevas normas empezarán el año que viene. Estoy de acuerdo. Muchas gracias. ¿De verdad es así? Bien dicho. Otra vez lo mismo. Yo también pienso eso. Los que viven aquí no lo saben.",
    "pt": "Hoje o tempo estava bom e fui ao parque com uma amiga. Ele não nos disse o que tinham feito ontem. O governo anunciou que as novas regras começam no próximo ano. Concordo com você. Muito obrigado. É mesmo assim? Bem dito. De novo isso. Eu também acho. As pessoas que moram aqui não sabem disso, não é?",
    "de": "Heute war das Wetter gut und ich ging mit einer Freundin in den Park. Er hat uns nicht gesagt, was sie gestern gemacht haben. Die Regierung kündigte an, dass die neuen Regeln nächstes Jahr beginnen. Das sehe ich auch so. Vielen Dank. Ist das wirklich so? Gut gesagt. Schon wieder. Wer hier wohnt, weiß das nicht.",
    "ja": "今日は天気が良かったので、友達と公園に行きました。彼は昨日何をしたのか話してくれませんでした。政府は新しい制度を来年から始めると発表した。私もそう思います。ありがとうございます。本当ですか。なるほど。また始まった。その通りです。",
    "zh": "今天天气很好,我和朋友一起去了公园。他没有告诉我们昨天做了什么。政府宣布新的规定从明年开始实行。我也这么认为。谢谢。真的是这样吗?说得好。又来了。这里的人都不知道这件事。你们觉得怎么样?",
}

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_ASCII_TOKEN = re.compile(r"[a-z]+(?:'[a-z]+)*")
_SPELT = re.compile(r"\S+ ?(?:[\[(]at[\])]|골뱅이|at) ?[\w-]+(?: ?(?:[\[(]dot[\])]|dot|\.) ?[\w-]+)+")
_DROP = re.compile(r"(?<![!-~])[!\"$-/:-?A-~]*+[0-9@#][!-~]*+|https?://\S+|www\.\S+")  # possessive: a word is read once
_DROPPED = re.compile(r"[0-9@#]|https?://|www\.")
_UNSPACED = re.compile("[⺀-ꯟ\ud7a4-\U0010ffff]")
_SCRIPTS = np.array([0x80, 0x250, 0x1100, 0x2E80, 0x3040, 0x3100, 0x4E00, 0xA000, 0xAC00, 0xD7B0], dtype=np.uint64)
_JAMO = re.compile(r"[ᄀ-ᇿ㄰-㆏]+")
_LAUGH = re.compile(r"(?:(?:[ha]{2,}|[je]{2,}|[ja]{3,}|[he]{3,}|lo+l+|k{2,}|w{2,}|x+d+|rs(?:rs)*|笑+|草+|www+)\s*)+", re.I)


def label_of(value: str | None) -> str | None:
    """The language a label names: letter case and region don't matter."""
    if not isinstance(value, str):
        return None
    head = re.split(r"[-_]", value.strip().lower())[0]
    return head if head in LANGS else None


def tokens(text: str) -> list[str]:
    """Words in normal form; addresses, handles and jamo-only laughter are left out."""
    t = unicodedata.normalize("NFKC", text) if not text.isascii() else text
    if "at]" in t or "at)" in t or "골뱅이" in t or " dot " in t:
        t = _SPELT.sub(" ", t)
    if _DROPPED.search(t):
        t = _DROP.sub(" ", t)
    return _ASCII_TOKEN.findall(t.lower()) if t.isascii() else _TOKEN.findall(_JAMO.sub(" ", t).lower())


def has_word(text: str | None, words: list[str]) -> bool:
    return bool(words) and (_LAUGH.fullmatch(words[0]) is None or not all(map(_LAUGH.fullmatch, words)))


def _weights(words: list[str]) -> list[str]:
    """Words of scripts without blanks, cut so that a segment can end inside them."""
    out = []
    for w in words:
        if len(w) > 8 and ord(w[0]) > 0x2E7F and not ("가" <= w[0] <= "힣"):
            out += [w[i:i + 6] for i in range(0, len(w), 6)]
        else:
            out.append(w)
    return out


def ngram_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the 1-, 2- and 3-grams of all words, the word of each), with blanks around each word."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    n = len(codes)
    space = codes == 32
    word = np.cumsum(space) - 1
    parts, owner = [], []
    one = np.flatnonzero(~space)
    c = codes * np.uint64(0x9E3779B1)
    two = c[:-1] * np.uint64(31) + c[1:]
    three = two[:-1] * np.uint64(31) + c[2:] if n > 2 else np.zeros(0, np.uint64)
    for h, at, salt in ((c[one], word[one], 1), (two, word[:-1], 2), (three, word[:-2], 3)):
        inner = space[1:-1][: len(h)] if salt == 3 else None
        if inner is not None:
            keep = ~inner
            h, at = h[keep], at[keep]
        x = (h + np.uint64(salt)) * np.uint64(0xD6E8FEB86659FD93)
        parts.append((x >> np.uint64(64 - BITS)).astype(np.int64))
        owner.append(at)
    first = codes[np.flatnonzero(space)[:-1] + 1][: len(words)]  # the script of each word counts as an n-gram of its own
    script = np.searchsorted(_SCRIPTS, first, side="right")
    parts.append(script.astype(np.int64) * 977 % (1 << BITS))
    owner.append(np.arange(len(first)))
    ids, own = np.concatenate(parts), np.concatenate(owner)
    ok = own < len(words)
    return ids[ok], own[ok]


class LangModel:
    """The log-probability matrix (n-gram buckets x languages)."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log-probabilities of each word under each language, relative to their mean. Equal words are scored once."""
        index = {w: i for i, w in enumerate(dict.fromkeys(words))}
        different = list(index)
        out = np.empty((len(different), len(LANGS)), dtype=np.float32)
        for a in range(0, len(different), CHUNK):
            part = different[a:a + CHUNK]
            ids, own = ngram_ids(part)
            m = self.matrix[ids]
            for k in range(len(LANGS)):
                out[a:a + CHUNK, k] = np.bincount(own, weights=m[:, k], minlength=len(part))
        return out[np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))]


def fit_matrix(texts: list[list[str]], labels: list[int], mix: float = 0.08) -> LangModel:
    """Relative n-gram frequencies, interpolated with those of all languages together, so that what no language has shown says nothing."""
    counts = np.zeros((len(LANGS), 1 << BITS), dtype=np.float64)
    for k in range(len(LANGS)):
        words = [w for t, y in zip(texts, labels) if y == k for w in t]
        for a in range(0, len(words), CHUNK):
            counts[k] += np.bincount(ngram_ids(words[a:a + CHUNK])[0], minlength=1 << BITS)
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    common = 0.9 * shares.mean(axis=0) + 0.1 / (1 << BITS)
    logp = np.log((1 - mix) * shares + mix * common)
    logp -= logp.mean(axis=0)
    return LangModel(np.ascontiguousarray(np.clip(logp, -4, 4).T.astype(np.float32)))


def _sentences(text: str) -> list[str]:
    return [s for s in re.split(r"(?<=[.!?。！？…])\s+|(?<=[。！？])|\n", text) if s and s.strip()]


def training_sample(documents: DataFrame, unified_rows: DataFrame, n: int = TRAIN_ROWS) -> list[tuple[str, str]]:
    """(text, label) of the rows with the least hashes whose label names a language."""
    part = lambda df, key, text: bounded(df.select(F.col(key).alias("k"), F.col(text).alias("t"), "lang").filter("t IS NOT NULL AND lang IS NOT NULL AND length(t) >= 8"), "k", n).select("t", "lang")
    rows = part(documents, "doc_id", "text").unionByName(part(unified_rows, "row_id", "comment_text")).collect()
    return [(r["t"], y) for r in rows if (y := label_of(r["lang"]))]


def _piece_scores(model: LangModel, pieces: list[list[str]]) -> np.ndarray:
    starts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])[:-1]])
    return np.add.reduceat(model.word_scores([w for p in pieces for w in p]), starts, axis=0)


def fit(sample: list[tuple[str, str]]) -> LangModel:
    """Three rounds: seeds only, then the sentences whose label the last model doesn't contradict. No label moves; it is kept or left out."""
    base = [(tokens(s), LANGS.index(k)) for k, v in SEEDS.items() for s in _sentences(v)] * 3
    model = fit_matrix([t for t, _ in base], [y for _, y in base])
    pieces, labels = [], []
    for t, y in sample:
        for s in _sentences(t):
            w = tokens(s)
            if w:
                pieces.append(w)
                labels.append(LANGS.index(y))
    if not pieces:
        return model
    given = np.array(labels)
    for slack in (6.0, 0.0, 0.0):
        score = _piece_scores(model, pieces)
        kept = score[np.arange(len(pieces)), given] >= score.max(axis=1) - slack
        model = fit_matrix([t for t, _ in base] + [p for p, k in zip(pieces, kept) if k], [y for _, y in base] + given[kept].tolist())
    return model


def trained(spark: SparkSession, documents: DataFrame, unified_rows: DataFrame) -> Broadcast:
    """The model (about 2 MB), fitted and sent to the executors."""
    return spark.sparkContext.broadcast(fit(training_sample(documents, unified_rows)))


def _weight(words: list[str]) -> int:
    """Letters, those of scripts without blanks counting for more."""
    return sum(len(w) * (4 if ord(w[0]) > 0x2E7F and not ("가" <= w[0] <= "힣") else 2 if ord(w[0]) > 0x2E7F else 1) for w in words)


def best_paths(texts: list[np.ndarray], switch: float = SWITCH) -> list[list[int]]:
    """The language of each word of each text by the Viterbi pass: all texts take their n-th word in one step, the longest first in line."""
    if not texts:
        return []
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    size = np.array([len(texts[i]) for i in order])
    S = np.concatenate([texts[i] for i in order])
    at = np.cumsum(size) - size
    left = np.searchsorted(-size, -np.arange(size[0]), side="left")  # the texts that have an n-th word
    same = np.arange(S.shape[1], dtype=np.uint8)
    best, back = S[at], []
    for s, m in enumerate(left[1:].tolist(), 1):
        b = best[:m]
        j = b.argmax(axis=1)
        jump = (b[np.arange(m), j] - switch)[:, None]
        stay = b >= jump
        back.append(np.where(stay, same, j.astype(np.uint8)[:, None]))
        best[:m] = np.where(stay, b, jump) + S[at[:m] + s]
    path = np.zeros(len(S), dtype=np.uint8)
    now = best.argmax(axis=1)
    for s in range(len(back), 0, -1):
        m = left[s]
        path[at[:m] + s] = now[:m]
        now[:m] = back[s - 1][np.arange(m), now[:m]]
    path[at] = now
    out: list[list[int]] = [[]] * len(texts)
    for i, a, n in zip(order, at, size):
        out[i] = path[a:a + n].tolist()
    return out


def segment(words: list[str], scores: np.ndarray, path: list[int], least: int = 14) -> list[tuple[int, int, int, float]]:
    """(first word, end, language, confidence) of the segments of one text, from its best path."""
    n = len(words)
    out: list[list] = []
    for i, y in enumerate(path):
        if out and out[-1][2] == y:
            out[-1][1] = i + 1
        else:
            out.append([i, i + 1, y])
    if len(out) > 1:
        keep = [s for s in out if _weight(words[s[0]:s[1]]) >= least and s[1] - s[0] >= (1 if _weight(words[s[0]:s[1]]) >= 28 else 2)]
        if not keep:
            total = scores.sum(axis=0)
            keep = [[0, n, int(total.argmax())]]
        merged: list[list] = []
        for s in keep:
            if merged and merged[-1][2] == s[2]:
                merged[-1][1] = s[1]
            else:
                merged.append(list(s))
        merged[0][0], merged[-1][1] = 0, n
        for a, b in zip(merged, merged[1:]):
            a[1] = b[0]
        out = merged
    res = []
    for a, b, y in out:
        s = scores[a:b].sum(axis=0)
        p = np.exp(s - s.max())
        res.append((a, b, y, float(p[y] / p.sum())))
    return res


class Found:
    """The languages of one text."""

    __slots__ = ("langs", "margin", "segments", "words")

    def __init__(self, langs, margin, segments, words):
        self.langs, self.margin, self.segments, self.words = langs, margin, segments, words


def detect(model: LangModel, texts: list[str | None]) -> list[Found | None]:
    """The languages of each text; None where there is no word. Equal texts are read once."""
    cache: dict[str, int] = {}
    lists: list[list[str]] = []
    where = []
    for t in texts:
        if not t:
            where.append(-1)
            continue
        at = cache.get(t)
        if at is None:
            w = tokens(t)
            at = cache[t] = len(lists) if has_word(t, w) else -1
            if at >= 0:
                lists.append(_weights(w) if not t.isascii() and _UNSPACED.search("".join(w)) else w)
        where.append(at)
    if not lists:
        return [None] * len(texts)
    ends = np.cumsum([len(x) for x in lists])
    starts = np.concatenate([[0], ends[:-1]])
    flat = [w for x in lists for w in x]
    S = model.word_scores(flat).astype(np.float64)
    total = np.add.reduceat(S, starts, axis=0)
    free = np.add.reduceat(S.max(axis=1), starts)
    order = np.sort(total, axis=1)
    best, margin = total.argmax(axis=1), order[:, -1] - order[:, -2]
    gain = free - order[:, -1]
    p = np.exp(total - total.max(axis=1, keepdims=True))
    sure = (p[np.arange(len(p)), best] / p.sum(axis=1)).tolist()
    mixed = np.flatnonzero(gain > SWITCH).tolist()
    scores = [S[starts[i]:ends[i]] for i in mixed]
    cut = {i: segment(lists[i], s, path) for i, s, path in zip(mixed, scores, best_paths(scores))}
    done: list[Found] = []
    for i, (w, y, c, d) in enumerate(zip(lists, best.tolist(), sure, margin.tolist())):
        segs = cut.get(i)
        langs = [LANGS[y]] if segs is None else sorted({LANGS[y] for _, _, y, _ in segs})
        done.append(Found(langs, d, segs or [(0, len(w), y, c)], w))
    return [done[k] if k >= 0 else None for k in where]


def judge(found: Found | None, label: str | None) -> list[str]:
    """The languages of a record whose label is missing or wrong or whose text is mixed; else nothing."""
    if found is None:
        return []
    y = label_of(label)
    if len(found.langs) > 1:
        return found.langs
    if y is None:
        return found.langs
    return found.langs if found.langs[0] != y and found.margin >= WRONG else []


def find_in_rows(rows: DataFrame, model: Broadcast) -> DataFrame:
    """unified_rows -> (tbl, row_key, lang_code): comments are judged by comment_text, posts by text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys, codes = [], []
            for a in range(0, len(b), 4096):
                part = b.iloc[a:a + 4096]
                for k, label, f in zip(part["row_id"], part["lang"], detect(model.value, part["t"].tolist())):
                    for c in judge(f, label):
                        keys.append(k)
                        codes.append(c)
            yield from filled(pd.DataFrame({"tbl": ["unified_rows"] * len(keys), "row_key": np.array(keys, dtype=np.int64), "lang_code": codes}))

    judged = rows.select("row_id", "lang", F.when(F.col("comment_index").isNull(), F.col("text")).otherwise(F.col("comment_text")).alias("t")).filter("t IS NOT NULL")
    return judged.mapInPandas(run, "tbl string, row_key long, lang_code string")


def segments_of_rows(rows: DataFrame, model: Broadcast) -> DataFrame:
    """unified_rows -> (row_id, segment, lang_code, confidence, n_words): every language segment of every judged text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for a in range(0, len(b), 4096):
                part = b.iloc[a:a + 4096]
                for k, f in zip(part["row_id"], detect(model.value, part["t"].tolist())):
                    for i, (s, e, y, c) in enumerate(f.segments if f else ()):
                        out.append((k, i, LANGS[y], c, e - s))
            yield from filled(pd.DataFrame(out, columns=["row_id", "segment", "lang_code", "confidence", "n_words"]).astype({"row_id": "int64", "segment": "int64", "n_words": "int64", "confidence": "float64"}))

    judged = rows.select("row_id", F.when(F.col("comment_index").isNull(), F.col("text")).otherwise(F.col("comment_text")).alias("t")).filter("t IS NOT NULL")
    return judged.mapInPandas(run, "row_id long, segment long, lang_code string, confidence double, n_words long")
