"""Abusive, hateful or sexual content (problem 1).

Method: maximum-scoring segments over token log-odds. Tokens are the character n-grams of a text brought to its letters (case, widths,
look-alike digits, signs between letters and drawn-out letters undone). Each has a log-odds of abusive against clean text under an
informative Dirichlet prior; a linear scan finds the passages of maximal total score, and their scores become p-values by the
extreme-value law of maximal segments, calibrated on clean text. A row's score is -log10 of the p-value of its passages together.

A row's passages that chance would hold in fewer than ``ALPHA`` of clean rows are added up by the law of sums of the best scores.

Training: a small lexicon, a bounded sample of hand-rated rows (``TRAIN_RATED``; rows whose raters differ are left out, single ratings count
half) and all comments as background, from which sentences that the round before scores high are taken out again; those that it scores very high
count as abusive, so that turns nobody has rated are learnt too. Languages weigh by the square root of their number of sentences, and from ``FULL``
sentences on, counts are taken in proportion to that many, so that evidence means the same at every size. The cut is the one
that the rated rows support best, drawn towards ``CUT`` by as much as there are few of them.

Scale: the comments' letters are kept once in the shared folder, each round's scores beside them; a round sums n-gram counts and score histograms of
fixed size over all of them, and the final scores are read from the same letters. Scoring is one narrow pass, no shuffle; the table of log-odds (4 MB) is broadcast. Only the rated rows' texts are joined, by a broadcast
of at most ``TRAIN_RATED`` keys.

Defined results: null, blank and wordless texts score 0; repeated rows score alike; without ratings the seeds alone teach; rates
of a source are over its rows with a comment.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import filled
from . import langid, sums, toxic_seeds
from .samples import bounded

TRAIN_RATED = 20000
FULL = 200_000.0
BITS = 20
ORDERS = (2, 3, 4, 5, 6)
WEIGHTS = (0.06, 0.16, 0.24, 0.27, 0.27)
PRIOR = 0.04
DRIFT = 1.2
FLOOR = -1.5  # the background holds unrated abuse, so its evidence for clean is bounded
CUT = 2.6
CUT_ROWS = 200  # raters err, so that some dozen rows say little
ROUNDS = 3
SUSPECT = 3e-3
CERTAIN = 1e-4
LEARNT = 0.3  # what unrated sentences weigh as abuse at most, together, beside the lexicon and the rated rows
ALPHA = 0.05
UNSUPPORTED, DOUBT = 0.1, 0.2  # a rated row that nothing else supports by this p-value weighs so much
SYLLABLE = 1.0
TOP_ODDS = 7.0
RATED = 1.0  # what a rated row weighs beside a word of the lexicon
TRUSTED = 1.0  # what the rated clean rows weigh together, beside the background
STEPS, TOP = 512, 1 << 16  # histograms: steps of a score to 1, and steps
_SENTENCE = re.compile(r"[.!?。！？…~]+(?:\s|$)|[。！？]|\n| / ")

_LEET = str.maketrans("013457@$!€", "oieastasie")
_MIXED = re.compile(r"(?<![^\s(\"'])(?=[a-z0-9@$!€]*[a-z$@])(?=[a-z0-9@$!€]*[0-9@$!€])[a-zà-ÿß0-9@$!€]+", re.I)
_LAUGH = re.compile("[ㅋㅎㅉㅠㅜㅡᄏ후ᅲ]+")
_ADDRESS = re.compile(r"\S*[\w.]@[\w-]+\.\S*|https?://\S+|\S+ ?[\[(]at[\])] ?[\w-]+(?:(?:\.| ?[\[(]dot[\])] ?)[\w-]+)*|\S+ at [\w-]+(?: dot [\w-]+)+|\S+ 골뱅이 \S+", re.I)
_LETTERS = re.compile(r"[^\W\d_]+|\x01+")
BREAK = "\x01"
_KO, _JA = re.compile("[가-힣ㄱ-ㅎ]"), re.compile("[ぁ-ヶ]")
_STEP = np.uint32(0x9E3779B1)
_POWERS = [np.uint32(pow(0x85EBCA6B, k, 1 << 32) | 1) for k in range(max(ORDERS))]
NOTHING = 1 << BITS
CHUNK = 60_000  # letters at a time, so that the arrays stay in the cache


def squash(text: str) -> str:
    """The letters of a text, disguises undone, its sentences parted by ``BREAK``."""
    t = _SENTENCE.sub("\x01", text)
    if "@" in t or "://" in t or "골뱅이" in t or " dot " in t or "at]" in t or "at)" in t:
        t = _ADDRESS.sub(" ", t)
    t = t.lower()
    if not t.isascii():
        t = _LAUGH.sub("", t)
        t = unicodedata.normalize("NFKC", t).lower()
    if any(c in t for c in "013457@$!€"):
        t = _MIXED.sub(lambda m: m[0].translate(_LEET), t)
    return "".join(x if x[0] != BREAK else BREAK for x in _LETTERS.findall(t)).strip(BREAK)


def pack(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points with a 0 after each text, text of each position); runs of one Latin letter become one."""
    codes = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != codes[:-1]) | (codes[1:] > 0x24F) | (codes[1:] == 0)
    codes = codes[keep]
    end = codes == 0
    return codes, np.cumsum(end) - end


def grams(codes: np.ndarray, out_of: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the hashed n-gram that ends at each position, and whether it lies within one sentence; with ``out_of``, n-grams that don't get the
    id ``NOTHING`` instead and the letters since the sentence began come second."""
    n = len(codes)
    at = np.arange(n, dtype=np.int32)
    run = at - np.maximum.accumulate(np.where(codes <= 1, at, np.int32(-1)))
    h = codes * _STEP
    past = 1
    for order in ORDERS:
        while past < order:
            if past < n:
                h[past:] += codes[:-past] * _POWERS[past]
            past += 1
        x = h + np.uint32(order)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(12)
        x *= np.uint32(0x297A2D39)
        x >>= np.uint32(32 - BITS)
        if out_of is None:
            yield x, run >= order
        else:
            x[run < order] = NOTHING
            yield x, run


def _any_of(words: set[str]) -> re.Pattern:
    """One of the words, those with the same first letter together, as that is faster."""
    rest: dict[str, set[str]] = {}
    for w in words:
        rest.setdefault(w[0], set()).add(re.escape(w[1:]))
    return re.compile("|".join(f"{re.escape(k)}(?:{'|'.join(sorted(v, key=len))})" for k, v in sorted(rest.items())))


#: The lexicon's words in a sentence's letters; short Latin ones stand in harmless words too often.
_LISTED = _any_of({x for t in toxic_seeds.words() if len(x := squash(t)) > 3 or not x.isascii()})


class ToxicModel:
    """Log-odds of hashed n-grams, the extreme-value parameters and the cut."""

    def __init__(self, odds: np.ndarray):
        self.odds, self.lam, self.k, self.cut = np.append(odds, np.float32(0)), 1.0, 0.1, CUT  # last: no n-gram
        self.each = (1.0, 0.1)  # lambda and K of single sentences

    def odds_of(self, ids: np.ndarray, of: np.ndarray) -> np.ndarray:
        return self.odds.take(ids)

    def positions(self, squashed: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The score of each position and the text that it belongs to; the position after a text scores so low that it ends every passage."""
        codes, of = pack(squashed)
        total, known = np.zeros(len(codes), np.float32), np.full(len(codes), 1e-9, np.float32)
        for w, (ids, _) in zip(WEIGHTS, grams(codes, 0)):
            part = self.odds_of(ids, of)
            known += np.float32(w) * (part != 0)
            part *= np.float32(w)
            total += part
        total /= known  # the orders that fit before this position and have been seen
        s = total.astype(np.float64) - DRIFT
        s[codes >= 0x1100] *= SYLLABLE
        s[codes == 0] = -1e6
        return s, of

    def best(self, squashed: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(score of the maximal passage, number of letters) of each text, by one linear scan over all of them."""
        top, letters = np.zeros(len(squashed)), np.zeros(len(squashed))
        for a, b in _chunks(squashed, CHUNK):
            top[a:b], letters[a:b] = self._best(squashed[a:b])
        return top, letters

    def _best(self, squashed: list[str]) -> tuple[np.ndarray, np.ndarray]:
        n = len(squashed)
        s, of = self.positions(squashed)
        real = s > -1e5
        c = np.cumsum(np.where(real, s, 0.0))
        before = c - np.where(real, s, 0.0)
        low = np.minimum.accumulate(before - of * 1e5) + of * 1e5  # the offset makes the running minimum begin anew in each text
        gain = np.where(real, c - low, 0.0)
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        top = np.zeros(n)
        top[of[first]] = np.maximum(np.maximum.reduceat(gain, first), 0.0)
        return top, np.bincount(of[real], minlength=n).astype(np.float64)

    def rule(self) -> ToxicModel:
        """The extreme-value parameters alone."""
        out = ToxicModel(np.zeros(0, np.float32))
        out.lam, out.k = self.lam, self.k
        return out

    def p_values(self, score: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The chance that clean text of that length holds a passage of that score."""
        return -np.expm1(-self.k * np.maximum(letters, 1) * np.exp(-self.lam * score))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """-log10 p of each text; equal texts are read once."""
        unique: dict[str, int] = {}
        which = [unique.setdefault(squash(t), len(unique)) if t else -1 for t in texts]
        out = np.zeros(len(texts))
        if unique:
            at = np.array(which)
            out[at >= 0] = self.judge(list(unique))[0][at[at >= 0]]
        return out

    def judge(self, squashed: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(-log10 p, number of passages beyond the cut) of squashed texts."""
        s, n = self.best(squashed)
        p = self.p_values(s, n)
        value, count = np.where(s > 0, -np.log10(np.maximum(p, 1e-12)), 0.0), np.zeros(len(squashed), dtype=np.int64)
        value = np.maximum(value, self.by_sentence(squashed, s, n))
        for i in np.flatnonzero((p <= ALPHA) & (s > 0)):
            found = self._segments(squashed[i])
            value[i] = max(value[i], self.together(found, n[i]))
            if value[i] >= self.cut:
                each = self.p_values(np.array([x for _, _, x in found]), np.full(len(found), n[i]))
                count[i] = max(1, int((-np.log10(np.maximum(each, 1e-12)) >= self.cut).sum()))
        return value, np.where(value >= self.cut, np.maximum(count, 1), 0)

    def by_sentence(self, squashed: list[str], s: np.ndarray, n: np.ndarray) -> np.ndarray:
        """-log10 p of the least likely sentence of each text, for the number of its sentences: a short oath in a long text stands out only there.
        ``s`` and ``n`` are the texts' scores and letters, those of texts of one sentence also."""
        many = np.array([BREAK in x for x in squashed], bool)
        parts = [x.split(BREAK) for x in squashed if BREAK in x]
        of = np.append(np.flatnonzero(~many), np.repeat(np.flatnonzero(many), [len(x) for x in parts]))
        more, letters = self.best([y for x in parts for y in x])
        return self.worst(np.append(s[~many], more), np.append(n[~many], letters), of, len(squashed))

    def worst(self, s: np.ndarray, n: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
        """The same of the sentences' scores and letters."""
        lam, k = self.each
        value, out = np.where(s > 0, -np.log10(np.maximum(-np.expm1(-k * np.maximum(n, 1) * np.exp(-lam * s)), 1e-12)), 0.0), np.zeros(size)
        np.maximum.at(out, of, value)
        return np.maximum(out - np.log10(np.maximum(np.bincount(of[n > 0], minlength=size), 1)), 0.0)

    def together(self, segments: list[tuple[int, int, float]], letters: float) -> float:
        """-log10 of the p-value of the significant passages of a text: of the sums of its r best, normalised, the least likely, each r weighing half
        of the one before."""
        t = sorted((self.lam * s - np.log(self.k * max(letters, 1.0)) for _, _, s in segments), reverse=True)
        best, total, fact = 0.0, 0.0, 0.0
        for r, x in enumerate(t, 1):
            if r > 1 and -np.expm1(-np.exp(-x)) > ALPHA:
                break
            total += x
            fact += np.log(r) + (np.log(r - 1) if r > 1 else 0.0)  # r! (r - 1)!
            p = -np.expm1(-np.exp(-total)) if r == 1 else np.exp(min(0.0, -total + (r - 1) * np.log(max(total, 1e-9)) - fact + (r - 1) * np.log(2)))
            best = max(best, -np.log10(max(p, 1e-12)))
        return best

    def passages(self, text: str) -> list[tuple[int, int, float]]:
        """All maximal passages (start, end, -log10 p) of one text's letters, by the linear stack algorithm."""
        squashed = squash(text)
        if not squashed:
            return []
        found = self._segments(squashed)
        p = self.p_values(np.array([s for _, _, s in found]), np.full(len(found), float(len(pack([squashed])[0]) - 1)))
        return [(a, b, float(-np.log10(max(q, 1e-12)))) for (a, b, _), q in zip(found, p)]

    def _segments(self, squashed: str) -> list[tuple[int, int, float]]:
        s, _ = self.positions([squashed])
        stack: list[list] = []  # [start, end, sum before, sum after]
        total = 0.0
        for i, x in enumerate(s[:-1].tolist()):
            before, total = total, total + x
            if x <= 0:
                continue
            new = [i, i + 1, before, total]
            while True:
                j = len(stack) - 1
                while j >= 0 and stack[j][2] >= new[2]:
                    j -= 1
                if j < 0 or stack[j][3] >= new[3]:
                    stack.append(new)
                    break
                new = [stack[j][0], i + 1, stack[j][2], total]
                del stack[j:]
        return [(b[0], b[1], b[3] - b[2]) for b in stack]


def _chunks(texts: list[str], letters: int) -> Iterator[tuple[int, int]]:
    """Ranges of about so many letters."""
    start = room = 0
    for i, t in enumerate(texts):
        room += len(t) + 1
        if room >= letters:
            yield start, i + 1
            start, room = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _counts(texts: list[str], weights: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << BITS)
    if not texts:
        return out
    for a, b in _chunks(texts, 20 * CHUNK):
        codes, of = pack(texts[a:b])
        w = weights[a:b][of]
        for ids, ok in grams(codes):
            out += np.bincount(ids[ok], weights=w[ok], minlength=1 << BITS)
    return out


def log_odds(bad: np.ndarray, clean: np.ndarray, nb: float | None = None, nc: float | None = None, prior: float = PRIOR) -> np.ndarray:
    """Log-odds under Dirichlet priors in proportion to each side's size (``nb``, ``nc``), so that an unseen token says nothing; uncertain ones are
    shrunk."""
    nb, nc = max(bad.sum() if nb is None else nb, 1.0), max(clean.sum() if nc is None else nc, 1.0)
    q = 0.5 * (bad / nb + clean / nc)
    ab, ac = nb * (prior * q + 1e-15), nc * (prior * q + 1e-15)
    d = np.log((bad + ab) / (nb * (1 + prior))) - np.log((clean + ac) / (nc * (1 + prior)))
    spread = np.sqrt(1 / (bad + ab + 0.3) + 1 / (clean + ac + 0.3))
    return np.clip(d * np.minimum(1.0, np.abs(d) / (1.2 * spread)), FLOOR, TOP_ODDS).astype(np.float32)


class _Apart(ToxicModel):
    """The model of some sentences without what each of them has taught it itself."""

    def __init__(self, model: ToxicModel, bad: np.ndarray, good: np.ndarray, own: np.ndarray):
        self.bad, self.good, self.own, self.lam, self.k = np.append(bad, 0.0), np.append(good, 0.0), own, model.lam, model.k
        self.nb, self.nc = bad.sum(), good.sum()

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(score of the maximal passage, number of letters) of each sentence."""
        if not texts:
            return np.zeros(0), np.zeros(0)
        self.texts = texts
        return self._best(texts)

    def odds_of(self, ids: np.ndarray, of: np.ndarray) -> np.ndarray:
        own = np.append(self.own, 0.0)[of]
        d = log_odds(np.maximum(self.bad[ids] - own, 0.0), self.good[ids], self.nb, self.nc)
        d[ids == NOTHING] = 0.0
        return d


def training_sample(unified_rows: DataFrame, review_labels: DataFrame, n_rated: int = TRAIN_RATED):
    """Rated rows with text, share of raters that found them offensive and number of raters."""
    rated = review_labels.filter("offensive IS NOT NULL").groupBy(F.col("row_id").alias("r_id")).agg(F.avg(F.col("offensive").cast("double")).alias("share"), F.count(F.lit(1)).alias("n"))
    rated = F.broadcast(bounded(rated, "r_id", n_rated))
    rows = unified_rows.filter("comment_text IS NOT NULL").select("row_id", "comment_text")
    labelled = rows.join(rated, F.col("row_id") == F.col("r_id")).select("row_id", "comment_text", "share", "n").collect()
    return sorted((r["row_id"], r["comment_text"], r["share"], r["n"]) for r in labelled)


def sentences(text: str) -> list[str]:
    """The squashed sentences of a text."""
    return [x for x in squash(text).split(BREAK) if x]


def _langs(model: langid.LangModel, texts: list[str]) -> np.ndarray:
    """The language of each text; Hangul and kana tell it at once."""
    out = np.zeros(len(texts), np.int64)
    rest = []
    for i, t in enumerate(texts):
        if _KO.search(t):
            out[i] = langid.LANGS.index("ko")
        elif _JA.search(t):
            out[i] = langid.LANGS.index("ja")
        else:
            rest.append(i)
    if rest:
        out[rest] = model.word_scores([texts[i] or "-" for i in rest]).argmax(axis=1)
    return out


class _Balance:
    """Weights that give seeds and corpus the same shares of languages, so that a language isn't taken for abuse. ``corpus`` has the (weighted)
    number of sentences of each language."""

    def __init__(self, model: langid.LangModel, seeds: list[str], corpus: np.ndarray):
        self.model = model
        a = np.bincount(_langs(model, seeds), minlength=len(langid.LANGS)) + 1.0
        b = corpus + 1.0
        a, b = a / a.sum(), b / b.sum()
        aim = np.sqrt(a * b)
        aim /= aim.sum()
        self.seed, self.corpus = aim / a, np.minimum(aim / b, 8.0)

    def of(self, texts: list[str], seed: bool = False) -> np.ndarray:
        return (self.seed if seed else self.corpus)[_langs(self.model, texts)]


class Part:
    """The different squashed comments and sentences of some texts, how often each occurs, the sentences' languages and, once read by a model, their
    scores."""

    def __init__(self, wholes: list[str], n_wholes: np.ndarray, parts: list[str], n_parts: np.ndarray, of: np.ndarray):
        self.wholes, self.n_wholes, self.parts, self.n_parts, self.of = wholes, n_wholes, parts, n_parts, of
        self.s = self.n = np.zeros(0)

    @classmethod
    def read(cls, squashed: Iterable[str], langs: langid.LangModel) -> Part:
        wholes = Counter(x for x in squashed if x)
        parts: Counter[str] = Counter()
        for w, n in wholes.items():
            for x in w.split(BREAK):
                if x:
                    parts[x] += n
        return cls(list(wholes), np.array(list(wholes.values()), np.int64), list(parts), np.array(list(parts.values()), np.int64), _langs(langs, list(parts)).astype(np.int64))

    def rooms(self, total: np.ndarray) -> None:
        """Adds the number of sentences of each language."""
        total += np.bincount(self.of, weights=self.n_parts, minlength=len(total))

    def clean(self, model: ToxicModel | None, weights: np.ndarray, total: np.ndarray) -> None:
        """Adds the n-grams of the sentences that the model, which has read them, doesn't score high and, behind them, of those that it scores very high."""
        w, n = self.n_parts * weights[self.of], 1 << BITS
        if model is None or not self.parts:
            total[:n] += _counts(self.parts, w * np.array([not _LISTED.search(x) for x in self.parts], bool))
            return
        p = model.p_values(self.s, self.n)
        total[:n] += _counts(self.parts, w * (p > SUSPECT))
        sure = np.flatnonzero(p <= CERTAIN)
        total[n:] += _counts([self.parts[i] for i in sure], w[sure])

    def scored(self, model: ToxicModel) -> None:
        """Reads the sentences."""
        self.s, self.n = model.best(self.parts) if self.parts else (np.zeros(0), np.zeros(0))

    def histogram(self, total: np.ndarray) -> None:
        """Adds the histograms of the sentences' scores and letters."""
        if len(self.n_parts):
            _histogram(self.s, self.n, self.n_parts, total)

    def of_wholes(self, model: ToxicModel, total: np.ndarray) -> None:
        """Adds the histograms of the comments' scores and letters."""
        if self.wholes:
            _histogram(*model.best(self.wholes), self.n_wholes, total)


def _histogram(s: np.ndarray, n: np.ndarray, times: np.ndarray, total: np.ndarray) -> None:
    ok = n > 0
    for k, v in enumerate((np.ceil(s[ok] * STEPS), n[ok])):
        total[k * TOP:(k + 1) * TOP] += np.bincount(np.minimum(v, TOP - 1).astype(np.int64), weights=times[ok], minlength=TOP)


class _List:
    """All comments as one part, in memory."""

    def __init__(self, background: list[str], langs: langid.LangModel):
        self.part = Part.read((squash(t) for t in background if t), langs)

    def sum(self, f: Callable, size: int, columns: tuple[str, ...] = ()) -> np.ndarray:
        total = np.zeros(size)
        f(self.part, total)
        return total

    def read_by(self, model: ToxicModel) -> None:
        self.part.scored(model)

    def send(self, value):
        return _Here(value)


_TEXTS, _ARRAYS = ("wholes", "parts"), {"n_wholes": np.int64, "n_parts": np.int64, "langs": np.uint8, "s": np.float32, "n": np.float32}
LETTERS = "keys binary, sources string, which binary, wholes string, n_wholes binary, parts string, n_parts binary, langs binary, s binary, n binary"


def _parts_of(b: pd.DataFrame) -> Iterator[Part]:
    """The parts that the rows of a kept table hold, as far as their columns were read."""
    for i in range(len(b)):
        text = {c: (b[c].iloc[i].split("\n") if b[c].iloc[i] else []) if c in b else [] for c in _TEXTS}
        array = {c: np.frombuffer(b[c].iloc[i], t) if c in b else np.zeros(0, t) for c, t in _ARRAYS.items()}
        part = Part(text["wholes"], array["n_wholes"], text["parts"], array["n_parts"], array["langs"].astype(np.int64))
        part.s, part.n = array["s"].astype(np.float64), array["n"].astype(np.float64)
        yield part


class _Table:
    """All comments, their letters kept in the shared folder; a model's scores of the sentences are kept beside them."""

    def __init__(self, rows: DataFrame, langs: langid.LangModel):
        sent = rows.sparkSession.sparkContext.broadcast(langs)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                squashed = [squash(t) if t else "" for t in b["comment_text"]]
                p = Part.read(squashed, sent.value)
                at = {w: i for i, w in enumerate(p.wholes)}
                which = np.array([-2 if t is None else at.get(x, -1) for t, x in zip(b["comment_text"], squashed)], np.int32)
                sources = "\n".join("" if x is None else "=" + x.replace("\n", " ") for x in b["source"])
                yield pd.DataFrame({
                    "keys": [b["row_id"].to_numpy(np.int64).tobytes()], "sources": [sources], "which": [which.tobytes()], "wholes": ["\n".join(p.wholes)], "n_wholes": [p.n_wholes.tobytes()],
                    "parts": ["\n".join(p.parts)], "n_parts": [p.n_parts.tobytes()], "langs": [p.of.astype(np.uint8).tobytes()], "s": [b""], "n": [b""],
                })

        self.kept = sums.kept(rows.select("row_id", "source", "comment_text").mapInPandas(run, LETTERS), "letters")
        self.scored = self.kept

    def sum(self, f: Callable, size: int, columns: tuple[str, ...] = ("parts", "n_parts", "langs", "s", "n")) -> np.ndarray:
        def add(b: pd.DataFrame, total: np.ndarray) -> None:
            for p in _parts_of(b):
                f(p, total)

        return sums.summed((self.kept if "wholes" in columns else self.scored).select(*columns), add, size)

    def read_by(self, model: ToxicModel) -> None:
        sent = self.send(model)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                s, n = [], []
                for p in _parts_of(b):
                    p.scored(sent.value)
                    s.append(p.s.astype(np.float32).tobytes())
                    n.append(p.n.astype(np.float32).tobytes())
                yield b.assign(s=s, n=n)

        self.scored = sums.kept(self.kept.select("parts", "n_parts", "langs").mapInPandas(run, "parts string, n_parts binary, langs binary, s binary, n binary"), "scored")

    def send(self, value):
        return self.kept.sparkSession.sparkContext.broadcast(value)


def fit(labelled: list[tuple], background: list[str]) -> ToxicModel:
    """Fit on lists."""
    langs = langid.fit([])
    return _fit(labelled, langs, _List(background, langs))


def fit_all(labelled: list[tuple], unified_rows: DataFrame) -> tuple[ToxicModel, DataFrame]:
    """Fit on the rated rows and all comments; also all comments' letters, as kept."""
    langs = langid.fit([])
    table = _Table(unified_rows, langs)
    return _fit(labelled, langs, table), table.kept


class _Here:
    """What a broadcast is where nothing is sent."""

    def __init__(self, value):
        self.value = value


def _fit(labelled: list[tuple], langs: langid.LangModel, data: _List | _Table) -> ToxicModel:
    """Rounds of counting over the sentences of all comments. Of a row rated abusive only its worst sentence counts as
    abusive, as the others may be clean; sentences of the background that score high stop counting as clean. Then calibration and the choice of
    the cut."""
    seeds, clean = [squash(t) for t in toxic_seeds.phrases()], [squash(t) for t in toxic_seeds.clean()]
    pos = [(x, RATED if n > 1 else 0.5 * RATED) for _, t, share, n in labelled if share == 1.0 and (x := sentences(t))]
    neg = [(y, RATED if n > 1 else 0.5 * RATED) for _, t, share, n in labelled if share == 0.0 for y in sentences(t)]
    flat = [y for x, _ in pos for y in x]
    room = data.sum(lambda p, total: p.rooms(total), len(langid.LANGS), ("n_parts", "langs"))
    back = bool(room.any())
    even = np.sqrt(np.maximum(room, 1).max() / np.maximum(room, 1)) * min(1.0, FULL / max(np.sqrt(room).sum() * np.sqrt(room.max()), 1.0))
    balance = _Balance(langs, seeds, room * even if back else np.bincount(_langs(langs, [y for y, _ in neg]), minlength=len(langid.LANGS)))
    seed_counts = _counts(seeds, balance.of(seeds, True))
    back_weight, flat_weight = balance.corpus * even, balance.of(flat, True)
    neg_weight = np.array([w for _, w in neg]) * balance.of([t for t, _ in neg])
    if neg and back:  # rated clean rows stand for all clean ones, also for those that look like abuse and don't count as background
        neg_weight *= max(1.0, TRUSTED * (room * back_weight).sum() / neg_weight.sum())
    neg_counts = _counts([t for t, _ in neg], np.array([w for _, w in neg]) * balance.of([t for t, _ in neg]))
    clean_counts = 20.0 * _counts(clean, balance.of(clean, True)) + _counts([t for t, _ in neg], neg_weight)
    owner = np.repeat(np.arange(len(pos)), [len(x) for x, _ in pos]) if pos else np.zeros(0, np.int64)
    weight = np.array([w for _, w in pos])[owner] if pos else np.zeros(0)
    size = np.array([len(x) for x, _ in pos], dtype=float)
    share = 1.0 / size[owner] if pos else np.ones(0)
    model = None
    for _ in range(ROUNDS):
        rule = model.rule() if model else None
        kept = data.sum(lambda p, total, m=rule: p.clean(m, back_weight, total), 2 << BITS).reshape(2, -1) if back else np.zeros((2, 1))
        bad = seed_counts + _counts(flat, weight * share * flat_weight)
        learnt = kept[1] * (bad + 1e-9) / (bad + neg_counts + 1e-9)  # what rated rows show to be clean isn't learnt from unrated ones
        bad = bad + learnt * min(1.0, LEARNT * bad.sum() / max(learnt.sum(), 1.0))  # unrated sentences never outweigh the rest
        own = _counts(flat, share * back_weight[_langs(langs, flat)]) if back and flat else 0.0  # rated abuse stands in the background too
        good = clean_counts + np.maximum(kept[0] - own, 0.0) + _counts(flat, weight * (1 - share) * flat_weight)
        model = ToxicModel(log_odds(bad, good))
        if back:
            data.read_by(model)
            _calibrate(model, data.sum(lambda p, total: p.histogram(total), 2 * TOP, ("n_parts", "s", "n")))
            model.each = (model.lam, model.k)
        if flat:
            apart = _Apart(model, bad, good, weight * share * flat_weight)
            s, n = apart.scores(flat)
            top = np.full(len(pos), -1e9)
            np.maximum.at(top, owner, s)
            soft = np.exp(np.maximum(model.lam * (s - top[owner]), -30.0))
            share = soft / np.bincount(owner, weights=soft, minlength=len(pos))[owner]
            share *= np.where(model.p_values(top, np.bincount(owner, weights=n, minlength=len(pos))) <= UNSUPPORTED, 1.0, DOUBT)[owner]  # raters err
    sent = data.send(model)
    _calibrate(model, data.sum(lambda p, total: p.of_wholes(sent.value, total), 2 * TOP, ("wholes", "n_wholes")))
    truth = [(t, y, 1.0 if n > 1 else 0.5) for _, t, y, n in labelled if y in (0.0, 1.0)]
    if truth:
        value, y = model.score([t for t, _, _ in truth]), np.array([y for _, y, _ in truth])
        if flat:  # what abusive rows would score had they not been rated
            s, n = apart.scores(flat)
            top = np.zeros(len(pos))
            np.maximum.at(top, owner, s)
            unseen = np.maximum(-np.log10(np.maximum(model.p_values(top, np.bincount(owner, weights=n, minlength=len(pos))), 1e-12)), model.worst(s, n, owner, len(pos)))
            has = np.array([bool(sentences(t)) for t, _, _ in truth])
            value[(y == 1.0) & has] = np.minimum(value[(y == 1.0) & has], unseen)
        model.cut = choose_cut(value, y, np.array([w for _, _, w in truth]))
    return model


def choose_cut(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut that the rated rows support best, drawn towards ``CUT``, which weighs as much as ``CUT_ROWS`` rows rated offensive; one rule for any number."""
    n = float(weight[y > 0].sum())
    if not n:
        return CUT
    cuts = np.unique(np.quantile(score, np.linspace(0.6, 0.997, 120)))
    hit = [weight[(score >= c) & (y > 0)].sum() for c in cuts]
    out = [weight[score >= c].sum() for c in cuts]
    f = np.array([2.0 * h / max(1.0, o + n) for h, o in zip(hit, out)])
    best = float(cuts[f >= f.max() - 0.004].mean())
    return (CUT_ROWS * CUT + n * best) / (CUT_ROWS + n)


def _at(h: np.ndarray, q: float) -> int:
    """The step of a quantile."""
    c = np.cumsum(h)
    return int(np.searchsorted(c, q * c[-1]))


def _calibrate(model: ToxicModel, histograms: np.ndarray) -> None:
    """The extreme-value parameters. Lambda from the excesses over the 80th percentile, censored at the 93rd, as what lies beyond may be abuse nobody
    has rated; K from the share that exceeds the 80th."""
    h, letters = histograms[:TOP], histograms[TOP:]
    n = h.sum()
    if n < 50:
        return
    lo, hi = _at(h, 0.8), _at(h, 0.93)
    over = h[lo + 1:]
    if hi <= lo or not over.any():
        return
    excess = np.minimum(np.arange(1, len(over) + 1), hi - lo)
    model.lam = float(np.clip(over[:hi - lo - 1].sum() / ((over * excess).sum() / STEPS), 0.02, 5.0))
    model.k = float(-np.log1p(-over.sum() / n) / max(_at(letters, 0.5), 1.0) * np.exp(model.lam * lo / STEPS))


def trained(spark: SparkSession, unified_rows: DataFrame, review_labels: DataFrame) -> tuple[Broadcast, DataFrame]:
    """The model, fitted on the rated rows and all comments, sent to the executors, and the comments' letters."""
    model, letters = fit_all(training_sample(unified_rows, review_labels), unified_rows)
    return spark.sparkContext.broadcast(model), letters


SCORES = "row_id long, source string, score double, offensive boolean, n_passages long, has_comment boolean"


def scores(unified_rows: DataFrame, model: Broadcast) -> DataFrame:
    """(row_id, source, score, offensive, n_passages, has_comment): every row with its score."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for a in range(0, len(b), 8192):
                part = b.iloc[a:a + 8192]
                unique: dict[str, int] = {}
                which = np.array([-2 if t is None else unique.setdefault(x, len(unique)) if (x := squash(t)) else -1 for t in part["comment_text"]], np.int64)
                yield from filled(_scored(model.value, part["row_id"].to_numpy(), part["source"].tolist(), which, list(unique)))

    return unified_rows.select("row_id", "source", "comment_text").mapInPandas(run, SCORES)


def scores_of_letters(letters: DataFrame, model: Broadcast) -> DataFrame:
    """The same from the letters that ``trained`` has kept."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for keys, sources, which, wholes in zip(b["keys"], b["sources"], b["which"], b["wholes"]):
                yield from filled(_scored(model.value, np.frombuffer(keys, np.int64), [x[1:] if x else None for x in sources.split("\n")], np.frombuffer(which, np.int32), wholes.split("\n") if wholes else []))

    return letters.select("keys", "sources", "which", "wholes").mapInPandas(run, SCORES)


def _scored(model: ToxicModel, keys: np.ndarray, sources: list, which: np.ndarray, wholes: list[str]) -> pd.DataFrame:
    value, count = model.judge(wholes) if wholes else (np.zeros(0), np.zeros(0, np.int64))
    value, count = np.append(value, 0.0), np.append(count, 0)  # last: no letters
    at = np.where(which < 0, len(wholes), which)
    score = value[at]
    bad = score >= model.cut
    return pd.DataFrame({"row_id": keys, "source": sources, "score": score, "offensive": bad, "n_passages": np.where(bad, count[at], 0), "has_comment": which > -2})


def rates(scored: DataFrame) -> DataFrame:
    """(source, n_rows, n_offensive, rate, mean_score) per source, of the rows of ``scores``."""
    return (
        scored.filter("has_comment").groupBy("source")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("offensive").cast("long")).alias("n_offensive"), F.avg("score").alias("mean_score"))
        .withColumn("rate", F.col("n_offensive") / F.col("n_rows"))
    )
