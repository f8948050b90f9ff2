"""Per-document text quality statistics (problem 10).

Method: robust Mahalanobis distance. The main body of a document is cut into passages of neighbouring lines; the statistics of each
passage are compared with the prose mean and covariance of its language, which are fitted robustly (concentration steps on the
closest part of the prose passages), and each statistic's contribution to the squared distance is reported. A document isn't prose when
passages beyond the cut hold more than half of its characters.

Scale: n-grams, junctions, units and the moments of every step are counted over all documents, as arrays of fixed size that the tasks
sum; only the labeller and the language model are fitted on samples. Main bodies are read once and kept in the shared folder. Familiarity goes
by frequency: from ``FULL_GRAMS`` n-grams on, counts are taken in proportion to that many, so that it means the same at every size.

Defined results: null and empty texts, and texts of page furniture alone, have no statistics (nulls) and count as prose; repeated rows
give repeated results by their own keys; a language with too few passages takes the mean and covariance of all.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from ..session import filled
from . import langid, mainbody, store, sums
from .mainbody import _CJK, _DIGIT, _ENDS, _HANGUL, _LETTER, _SPACE, _UPPER, _classes, _codes, _isin

FULL_GRAMS = 1_500_000
FULL_JOINS = 450_000
PASSAGE = 220
CHUNK = 250
GRAM_BITS = 19
CUT = 120.0
STATS = (
    "words_per_line", "mean_word_length", "symbol_ratio", "digit_ratio", "lines_ending_in_punctuation", "sentence_ends", "common_unit_share",
    "uppercase_ratio", "familiar_ngrams", "longest_word", "repeated_characters", "separators",
    "familiar_junctions", "distinct_words", "marked_lines",
)
CHI2_MEDIAN = len(STATS) * (1 - 2 / (9 * len(STATS))) ** 3  # makes the median distance that of normal data
_STOPS = re.compile(r"[.!?。！？…]+(?=\s|$)|[。！？]")
_PAIRED = re.compile(r"(?<=\S) {2}(?=\S)")
_MARKED = re.compile(r"[•▪\-*·■●#>\[(]|\d+[.)]\s|https?:")
_SIDE = (np.uint64(1), np.uint64(0x10001), np.uint64(0x1000003D))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _line_counts(lines: list[str], grams: np.ndarray | None, common: np.ndarray | None, joins: np.ndarray | None = None):
    """Counts per line from which all statistics are made; also the n-gram ids and unit ids, for fitting."""
    n = len(lines)
    text = "\n".join(_PAIRED.sub(" ", x) if "  " in x else x for x in lines)
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    code, lower = _codes(text), _codes(low).astype(np.uint64)
    cls = _classes()[np.minimum(code, 0x10000)]
    nl = code == 10
    at = np.cumsum(nl)
    per = lambda mask, w=None: np.bincount(at[mask], weights=None if w is None else w[mask], minlength=n)[:n].astype(np.float64)
    letter, digit, space = (cls & _LETTER) > 0, (cls & _DIGIT) > 0, ((cls & _SPACE) > 0) & ~nl
    wordc = letter | digit
    start = wordc & ~np.append(False, wordc[:-1])
    end = wordc & ~np.append(wordc[1:], False)
    w_start, w_end = np.flatnonzero(start), np.flatnonzero(end)
    longest = np.zeros(n)
    if len(w_start):
        np.maximum.at(longest, at[w_start], (w_end - w_start + 1).astype(float))
    stops = np.append(np.flatnonzero(nl), len(code))
    begins = np.append(0, stops[:-1] + 1)
    last = code[np.clip(stops - 1, 0, max(len(code) - 1, 0))] if len(code) else np.zeros(n, np.uint32)
    prev = code[np.clip(stops - 2, 0, max(len(code) - 1, 0))] if len(code) else last
    ends = (_isin(last, _ENDS) | (_isin(last, "\"'”’」)]") & _isin(prev, _ENDS))).astype(np.float64)
    is_end = _isin(code, _ENDS) & ~np.append(False, _isin(code[:-1], _ENDS)) & ~(np.append(False, digit[:-1]) & np.append(digit[1:], False))
    same = np.zeros(len(code), bool)
    if len(code) > 2:
        same[2:] = (code[2:] == code[1:-1]) & (code[1:-1] == code[:-2]) & ~nl[2:] & ~space[2:] & (code[2:] != 46)
    sep = _isin(code, "|;,\t/•#=_★") | (space & np.append(space[1:], False))
    marked = np.fromiter((_MARKED.match(x) is not None for x in lines), dtype=np.float64, count=n)
    # n-grams of four letters or blanks, within a line
    smooth = np.where(letter, lower, np.uint64(32))
    g_at, g_id = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(code) > 3:
        h = ((smooth[:-3] * _STEP + smooth[1:-2]) * _STEP + smooth[2:-1]) * _STEP + smooth[3:]
        ok = letter[3:] & ~(nl[:-3] | nl[1:-2] | nl[2:-1])
        g_id = ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)[ok]
        g_at = at[3:][ok]
    w_hash = np.zeros(0, np.uint64)
    if len(w_start):
        rolled = lower * np.uint64(0xC2B2AE3D27D4EB4F)
        rolled = rolled ^ (rolled >> np.uint64(29))
        total = np.append(np.uint64(0), np.cumsum(rolled))
        w_hash = total[w_end + 1] - total[w_start]
    # junctions: the end of a word with the start of the next word of its line
    j_at, j_id = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(w_start) > 1:
        sign = np.where(digit, np.uint64(48), lower)
        side = lambda base, step, bound: sum(np.where((base + step * k) * step <= bound * step, sign[np.clip(base + step * k, 0, len(sign) - 1)], np.uint64(0)) * _SIDE[k] for k in range(3))
        h = side(w_end[:-1], -1, w_start[:-1]) * np.uint64(1_000_003) + side(w_start[1:], 1, w_end[1:])
        near = (at[w_start[1:]] == at[w_start[:-1]])
        j_id = ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)[near]
        j_at = at[w_start[1:]][near]
    # units that carry grammar: Latin words, last syllables of Hangul words, single CJK characters
    hangul_end = np.flatnonzero(end & ((cls & _HANGUL) > 0))
    cjk = np.flatnonzero((cls & _CJK) > 0)
    latin = np.flatnonzero(start & letter & ((cls & (_HANGUL | _CJK)) == 0))
    if len(latin):
        le = w_end[np.searchsorted(w_end, latin)]
        long = le - latin + 1
        word = np.zeros(len(latin), np.uint64)
        for k in range(int(min(8, long.max()))):
            word = np.where(k < long, word * _STEP + lower[np.minimum(latin + k, len(lower) - 1)], word)
        word = np.where(long <= 8, word, np.uint64(1))
    else:
        word = np.zeros(0, np.uint64)
    units = np.concatenate([lower[hangul_end] + np.uint64(1 << 40), lower[cjk] + np.uint64(1 << 41), word])
    u_id = ((units * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 16)).astype(np.int64)
    u_at = np.concatenate([at[hangul_end], at[cjk], at[latin]])
    c = {
        "size": (stops - begins).astype(np.float64), "lines": np.ones(n), "letters": per(letter), "digits": per(digit), "spaces": per(space), "upper": per((cls & _UPPER) > 0),
        "words": np.bincount(at[w_start], minlength=n)[:n].astype(np.float64), "word_chars": per(wordc), "ends": ends, "sentences": per(is_end), "same": per(same), "sep": per(sep),
        "grams": np.bincount(g_at, minlength=n)[:n].astype(np.float64), "units": np.bincount(u_at, minlength=n)[:n].astype(np.float64), "longest": longest, "marked": marked, "joins": np.bincount(j_at, minlength=n)[:n].astype(np.float64), "word_at": at[w_start], "word_hash": w_hash,
    }
    if grams is not None:
        c["familiar"] = np.bincount(g_at, weights=grams[g_id], minlength=n)[:n]
        c["joined"] = np.bincount(j_at, weights=joins[j_id], minlength=n)[:n]
        c["common"] = np.bincount(u_at, weights=common[u_id], minlength=n)[:n]
    return c, g_id, u_id, j_id


def statistics(c: dict[str, np.ndarray], of: np.ndarray, n: int) -> np.ndarray:
    """Statistics of passages from the counts of their lines."""
    s = {k: np.bincount(of, weights=v, minlength=n) for k, v in c.items() if k not in ("longest", "word_at", "word_hash")}
    pair = of[c["word_at"]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ c["word_hash"]
    _, first = np.unique(pair, return_index=True)
    distinct = np.bincount(of[c["word_at"][first]], minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, of, c["longest"])
    size, words = np.maximum(s["size"], 1), np.maximum(s["words"], 1)
    symbols = np.maximum(s["size"] - s["letters"] - s["digits"] - s["spaces"], 0)
    return np.stack([
        np.log1p(s["words"] / np.maximum(s["lines"], 1)), np.log(np.clip(s["word_chars"] / words, 1, 10)), symbols / size, s["digits"] / size, s["ends"] / np.maximum(s["lines"], 1),
        np.minimum(100 * s["sentences"] / size, 4), s["common"] / np.maximum(s["units"], 1), s["upper"] / size, s["familiar"] / np.maximum(s["grams"], 1), np.log1p(np.minimum(longest, 16)), np.minimum(s["same"] / size, 0.3), np.minimum(s["sep"] / size, 0.3),
        np.where(s["joins"] > 0, s["joined"] / np.maximum(s["joins"], 1), s["familiar"] / np.maximum(s["grams"], 1)), np.minimum(distinct / words, 1) * np.minimum(1, np.sqrt(words / 20)), s["marked"] / np.maximum(s["lines"], 1),
    ], axis=1)


def passages(sizes: list[int], most: int = PASSAGE) -> list[int]:
    """The passage of each line: neighbouring lines up to ``most`` characters."""
    out, k, room = [], -1, 0
    for s in sizes:
        if k < 0 or room + s > most:
            k, room = k + 1, 0
        room += s
        out.append(k)
    return out


class ProseModel:
    """Familiar n-grams, common units, and mean and inverse covariance per language (the last entry: all)."""

    def __init__(self, grams, common, means, inverses, cut=CUT):
        self.grams, self.joins, self.common, self.means, self.inverses, self.cut = grams, grams, common, means, inverses, cut

    def distance(self, x: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances and the contribution of each statistic."""
        d = x - self.means[lang]
        part = d * np.einsum("nij,nj->ni", self.inverses[lang], d)
        return part.sum(axis=1), part


class Judged:
    """One batch: what is known of each document."""

    def __init__(self, model: ProseModel | None, labeller, langs: langid.LangModel, texts: list[str | None], titles: list[str | None]):
        got = labeller.furniture(texts, titles)
        cut = labeller.cut
        self.bodies: list[list[str]] = []
        for (_, lines, p), title in zip(got, titles):
            key = mainbody.letters(title) if isinstance(title, str) else ""
            own = [x for x, q in zip(lines, p) if q < cut]
            rest = [x for x in own if not mainbody.is_title(x, title, key)]
            self.bodies.append(rest or own)
        self.found = langid.detect(langs, ["\n".join(b) if b else None for b in self.bodies])
        if model is not None:
            self.measure(model)

    @classmethod
    def of(cls, model: Trained, part: pd.DataFrame, measured: bool = True) -> Judged:
        """The batch of documents, or of main bodies that ``read`` has kept."""
        if "body" not in part:
            return cls(model.prose if measured else None, model.labeller, model.langs, part["text"].tolist(), part["title"].tolist())
        self = cls.__new__(cls)
        self.bodies = _lines(part["body"])
        self.found = [langid.Found(y.split("+"), m, None, None) if y else None for y, m in zip(part["langs"], part["margin"])]
        if measured:
            self.measure(model.prose)
        return self

    def only(self, at: list[int]) -> Judged:
        """The documents at these places, not measured."""
        some = Judged.__new__(Judged)
        some.bodies, some.found = [self.bodies[i] for i in at], [self.found[i] for i in at]
        return some

    def measure(self, model: ProseModel, whole: bool = True) -> None:
        """The share of junk in the passages; with ``whole``, also the statistics of the documents as such."""
        n = len(self.bodies)
        flat = [x for b in self.bodies for x in b]
        self.stats = np.full((n, len(STATS)), np.nan)
        self.parts = np.full((n, len(STATS)), np.nan)
        self.distance = np.full(n, np.nan)
        self.junk_share = np.zeros(n)
        self.n_words = np.zeros(n)
        if not flat:
            return
        counts = _line_counts(flat, model.grams, model.common, model.joins)[0]
        doc = np.repeat(np.arange(n), [len(b) for b in self.bodies])
        at, base = [], 0
        lang_of, doc_of = [], []
        for i, b in enumerate(self.bodies):
            if b:
                p = passages([len(x) for x in b])
                at += [base + k for k in p]
                base += p[-1] + 1
                doc_of += [i] * (p[-1] + 1)
                f = self.found[i]
                ys = [langid.LANGS.index(y) for y in f.langs] if f else [len(langid.LANGS)]
                lang_of += [ys] * (p[-1] + 1)
        of, owner = np.array(at), np.array(doc_of)
        x = statistics(counts, of, base)
        lang = np.array([y[0] for y in lang_of])
        d, _ = model.distance(x, lang)
        for k in range(1, len(langid.LANGS)):  # a mixed document's passage is compared with the nearest of its languages
            more = np.array([i for i, y in enumerate(lang_of) if len(y) > k], dtype=np.int64)
            if len(more):
                other, _ = model.distance(x[more], np.array([lang_of[i][k] for i in more]))
                d[more] = np.minimum(d[more], other)
        size = np.bincount(of, weights=counts["size"], minlength=base)
        total = np.bincount(owner, weights=size, minlength=n)
        self.junk_share = np.bincount(owner, weights=size * (d > model.cut), minlength=n) / np.maximum(total, 1)
        self.passage_distance, self.passage_doc, self.passage_size = d, owner, size
        if not whole:
            return
        all_ = statistics(counts, doc, n)
        has = total > 0
        first = np.full(n, len(langid.LANGS))
        first[owner] = lang
        dist, part = model.distance(all_, first)
        self.stats[has], self.parts[has], self.distance[has] = all_[has], part[has], dist[has]
        self.n_words = np.bincount(doc, weights=counts["words"], minlength=n)


N_ALL = len(langid.LANGS) + 1
SETTLED = 0.001  # concentration ends when no group gains or loses more than this share of its passages
TOTALS = (2 << GRAM_BITS) + (N_ALL << 16)
BINS = 8192
EDGES = np.append(0.0, np.geomspace(1e-3, 1e6, BINS))
FLOOR = np.diag([0.02, 0.01, 2e-4, 2e-4, 0.02, 0.09, 0.004, 2e-4, 0.004, 0.03, 4e-5, 4e-4, 0.006, 0.006, 0.004])


def _lines(bodies: Iterable[str | None]) -> list[list[str]]:
    return [b.split("\n") if b else [] for b in bodies]


def _main_language(found: langid.Found | None) -> int:
    return max(found.segments, key=lambda s: s[1] - s[0])[2] if found else N_ALL - 1


def _count(bodies: list[list[str]], langs: Iterable[int], every: bool, total: np.ndarray) -> None:
    """Adds the n-grams, junctions and, per language, units of the sentences, or of every line."""
    of: dict[int, list[str]] = {}
    for b, y in zip(bodies, langs):
        of.setdefault(int(y), []).extend(x for x in b if every or (len(x) >= 25 and x.rstrip("\"'”’」)]")[-1:] in _ENDS))
    n = 1 << GRAM_BITS
    for y, lines in of.items():
        for a in range(0, len(lines), 4000):
            _, g, u, j = _line_counts(lines[a:a + 4000], None, None)
            total[:n] += np.bincount(g, minlength=n)
            total[n:2 * n] += np.bincount(j, minlength=n)
            at = 2 * n + (y << 16)
            total[at:at + (1 << 16)] += np.bincount(u, minlength=1 << 16)


def _sample(bodies: list[list[str]], langs: Iterable[int], model: ProseModel) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and language of the prose passages: as they are, a third also without their punctuation, a sixth also cut to one line, as
    short and unpunctuated prose is prose. Which ones, their own text says, so that it doesn't hang on the order of rows."""
    rows, langs_ = [], []
    for body, y in zip(bodies, langs):
        if body:
            p = passages([len(x) for x in body])
            own: list[list[str]] = [[] for _ in range(p[-1] + 1)]
            for x, q in zip(body, p):
                own[q].append(x)
            rows += own
            langs_ += [int(y)] * len(own)
    x, y = _passage_statistics(rows, model), np.array(langs_, dtype=np.uint8)
    prose = np.flatnonzero((x[:, 4] >= 0.5) & (x[:, 3] < 0.1) & (x[:, 14] < 0.5) & (x[:, 11] < 0.12))
    turn = np.array([zlib.crc32("\n".join(rows[i]).encode("utf-8", "surrogatepass")) % 6 for i in prose], dtype=np.int64)
    third, sixth = prose[turn % 3 == 0], prose[turn == 1]
    bare = [[_STOPS.sub(" ", z).rstrip() or z for z in rows[i]] for i in third]
    short = [rows[i][:1] for i in sixth]
    return np.concatenate([x[prose], _passage_statistics(bare, model), _passage_statistics(short, model)]), np.concatenate([y[prose], y[third], y[sixth]])


def _groups(y: np.ndarray) -> list[np.ndarray]:
    """The rows of each language and, last, all."""
    return [np.flatnonzero(y == k) for k in range(N_ALL - 1)] + [np.arange(len(y))]


def _moments(x: np.ndarray, y: np.ndarray, means: np.ndarray, inverses: np.ndarray, cut: np.ndarray, total: np.ndarray) -> None:
    """Adds number, sum and sum of products of the passages within each group's cut."""
    t, d = total.reshape(N_ALL, -1), len(STATS)
    for k, at in enumerate(_groups(y)):
        z = x[at] - means[k]
        if np.isfinite(cut[k]):
            at = at[np.einsum("ni,ij,nj->n", z, inverses[k], z) <= cut[k]]
        z = x[at]
        t[k, 0] += len(z)
        t[k, 1:1 + d] += z.sum(axis=0)
        t[k, 1 + d:] += (z.T @ z).ravel()


def _distances(x: np.ndarray, y: np.ndarray, means: np.ndarray, inverses: np.ndarray, total: np.ndarray) -> None:
    """Adds the histogram of each group's squared distances, in steps of a quarter of a percent."""
    t = total.reshape(N_ALL, -1)
    for k, at in enumerate(_groups(y)):
        z = x[at] - means[k]
        d = np.einsum("ni,ij,nj->n", z, inverses[k], z)
        t[k] += np.bincount(np.searchsorted(EDGES, d).clip(1, BINS) - 1, minlength=BINS)


def _quantile(h: np.ndarray, q: float) -> float:
    c = np.cumsum(h)
    i = int(np.searchsorted(c, q * c[-1]))
    return float(EDGES[i] + (EDGES[i + 1] - EDGES[i]) * (q * c[-1] - (c[i] - h[i])) / max(h[i], 1))


def _robust(reduce: Callable, weight: float = 60.0, keep: float = 0.95, steps: int = 12) -> tuple[np.ndarray, np.ndarray] | None:
    """Means and inverse covariances of the closest part of each language's passages and of all, by concentration steps, made consistent at the
    median; few passages lean on the pooled covariance. ``reduce(f, size)`` sums over all passages. None for too few."""
    d = len(STATS)
    means, inverses, cut, scale = np.zeros((N_ALL, d)), np.zeros((N_ALL, d, d)), np.full(N_ALL, np.inf), np.ones(N_ALL)
    covs, before, rows = np.zeros((N_ALL, d, d)), None, None
    for _ in range(steps):
        t = reduce(lambda x, y, total, a=(means, inverses, cut): _moments(x, y, *a, total), N_ALL * (1 + d + d * d)).reshape(N_ALL, -1)
        n = t[:, 0]
        rows = n if rows is None else rows
        if rows[-1] < 30:
            return None
        if before is not None and (np.abs(n - before) <= SETTLED * before).all():
            break
        before = n
        means, inverses, covs = means.copy(), inverses.copy(), covs.copy()
        for k in range(N_ALL - 1, -1, -1):
            if rows[k] < 20:
                continue
            means[k] = t[k, 1:1 + d] / n[k]
            cov = (t[k, 1 + d:].reshape(d, d) - n[k] * np.outer(means[k], means[k])) / max(n[k] - 1, 1) + FLOOR
            covs[k] = cov if k == N_ALL - 1 else (n[k] * cov + weight * covs[-1] * scale[-1]) / (n[k] + weight)
            inverses[k] = np.linalg.inv(covs[k])
        h = reduce(lambda x, y, total, a=(means, inverses): _distances(x, y, *a, total), N_ALL * BINS).reshape(N_ALL, -1)
        for k in np.flatnonzero(rows >= 20):
            cut[k], scale[k] = _quantile(h[k], keep), max(_quantile(h[k], 0.5), 1e-9) / CHI2_MEDIAN
        cut = cut.copy()
    for k in range(N_ALL):
        if rows[k] >= 20:
            inverses[k] = np.linalg.inv(covs[k] * scale[k])
    for k in np.flatnonzero(rows < 20):
        means[k], inverses[k] = means[-1], inverses[-1]
    return means, inverses


def _fit(count: Callable, sample: Callable) -> ProseModel:
    """``count(every)`` gives the sums of ``_count`` over all documents, ``sample(model)`` the ``reduce`` over their prose passages."""
    n = 1 << GRAM_BITS
    model = ProseModel(np.zeros(n, np.float32), np.zeros(1 << 16, np.float32), np.zeros((N_ALL, len(STATS))), np.zeros((N_ALL, len(STATS), len(STATS))))
    model.joins = np.zeros(n, np.float32)
    total = count(False)
    if not total.any():
        total = count(True)
    if not total.any():
        return model
    known = lambda c, full: np.minimum(1.0, np.log1p(np.maximum(c - 1, 0) * min(1.0, full / max(c.sum(), 1.0))) / np.log(11)).astype(np.float32)  # noqa: E731 - without its own occurrence
    model.grams, model.joins = known(total[:n], FULL_GRAMS), known(total[n:2 * n], FULL_JOINS)
    for c in total[2 * n:].reshape(N_ALL, -1):
        top = np.argsort(-c)[:60]
        model.common[top[c[top] > 2]] = 1.0
    got = _robust(sample(model))
    if got:
        model.means, model.inverses = got
    return model


def fit(docs: list, labeller, langs: langid.LangModel) -> ProseModel:
    """Fit on a list of documents."""
    bodies: list[list[str]] = []
    lang_of: list[int] = []
    for a in range(0, len(docs), CHUNK):
        part = docs[a:a + CHUNK]
        j = Judged(None, labeller, langs, [d["text"] for d in part], [d["title"] for d in part])
        bodies += j.bodies
        lang_of += [_main_language(f) for f in j.found]

    def count(every: bool) -> np.ndarray:
        total = np.zeros(TOTALS)
        _count(bodies, lang_of, every, total)
        return total

    def sample(model: ProseModel) -> Callable:
        x, y = _sample(bodies, lang_of, model)

        def reduce(f: Callable, size: int) -> np.ndarray:
            total = np.zeros(size)
            f(x, y, total)
            return total

        return reduce

    return _fit(count, sample)


def read(documents: DataFrame, models: Broadcast) -> DataFrame:
    """(doc_id, lang, body, langs, margin, main): every document's main body and its languages, kept in the shared folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeller, langs = models.value
        for b in batches:
            for a in range(0, len(b), 512):
                part = b.iloc[a:a + 512]
                j = Judged(None, labeller, langs, part["text"].tolist(), part["title"].tolist())
                yield from filled(pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(), "lang": part["lang"].to_numpy(), "body": ["\n".join(x) for x in j.bodies], "langs": ["+".join(f.langs) if f else "" for f in j.found],
                    "margin": [f.margin if f else 0.0 for f in j.found], "main": [_main_language(f) for f in j.found],
                }))

    return sums.kept(documents.select("doc_id", "lang", "text", "title").mapInPandas(run, "doc_id long, lang string, body string, langs string, margin double, main long"), "bodies")


def fit_all(bodies: DataFrame) -> ProseModel:
    """Fit on all the documents that ``read`` has kept."""

    def count(every: bool) -> np.ndarray:
        return sums.summed(bodies.select("body", "main"), lambda b, total: _count(_lines(b["body"]), b["main"], every, total), TOTALS)

    def sample(model: ProseModel) -> Callable:
        m = bodies.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for a in range(0, len(b), 512):
                    part = b.iloc[a:a + 512]
                    x, y = _sample(_lines(part["body"]), part["main"], m.value)
                    yield pd.DataFrame({"x": [x.astype(np.float32).tobytes()], "y": [y.tobytes()]})

        rows = sums.kept(bodies.select("body", "main").mapInPandas(run, "x binary, y binary"), "passages")

        def reduce(f: Callable, size: int) -> np.ndarray:
            def add(b: pd.DataFrame, total: np.ndarray) -> None:
                for x, y in zip(b["x"], b["y"]):
                    f(np.frombuffer(x, np.float32).reshape(-1, len(STATS)).astype(np.float64), np.frombuffer(y, np.uint8), total)

            return sums.summed(rows, add, size)

        return reduce

    return _fit(count, sample)


def _passage_statistics(rows: list[list[str]], model: ProseModel) -> np.ndarray:
    if not rows:
        return np.zeros((0, len(STATS)))
    out = []
    for a in range(0, len(rows), 1500):
        part = rows[a:a + 1500]
        counts = _line_counts([x for r in part for x in r], model.grams, model.common, model.joins)[0]
        out.append(statistics(counts, np.repeat(np.arange(len(part)), [len(r) for r in part]), len(part)))
    return np.concatenate(out)


class Trained:
    """The three models that prose judgements need."""

    def __init__(self, labeller, langs, prose):
        self.labeller, self.langs, self.prose = labeller, langs, prose


def readers(raw_posts: DataFrame, unified_rows: DataFrame, documents: DataFrame) -> tuple[mainbody.Labeller, langid.LangModel]:
    """The main-body labeller and the language model, fitted on their bounded samples."""
    tables = [documents.select("doc_id", "lang", "text"), unified_rows.select("row_id", "lang", "comment_index", "comment_text", "text")]
    langs = store.fitted(documents.sparkSession, "languages", tables, (langid.TRAIN_ROWS,), lambda: langid.fit(langid.training_sample(documents, unified_rows)))
    return mainbody.labeller(raw_posts, unified_rows, documents), langs


def trained(spark: SparkSession, raw_posts: DataFrame, unified_rows: DataFrame, documents: DataFrame) -> tuple[Broadcast, DataFrame]:
    """The readers, and the prose statistics fitted on all documents; the models, sent, and the main bodies."""
    models = readers(raw_posts, unified_rows, documents)
    bodies = read(documents, spark.sparkContext.broadcast(models))
    return spark.sparkContext.broadcast(Trained(*models, fit_all(bodies))), bodies


def _either(documents: DataFrame) -> DataFrame:
    return documents if "body" in documents.columns else documents.select("doc_id", "lang", "text", "title")


def document_statistics(documents: DataFrame, model: Broadcast) -> DataFrame:
    """(doc_id, lang_code, n_words, each statistic, distance, junk_share, is_prose, most_outlying, contributions)."""
    cols = ", ".join(f"{s} double" for s in STATS)
    schema = f"doc_id long, lang_code string, n_words long, {cols}, distance double, junk_share double, is_prose boolean, most_outlying string, contributions array<double>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for b in batches:
            for a in range(0, len(b), 512):
                part = b.iloc[a:a + 512]
                j = Judged.of(m, part)
                has = ~np.isnan(j.distance)
                out = {"doc_id": part["doc_id"].to_numpy(), "lang_code": [f.langs[0] if f and len(f.langs) == 1 else "+".join(f.langs) if f else None for f in j.found], "n_words": j.n_words.astype(np.int64)}
                for k, s in enumerate(STATS):
                    out[s] = [v if h else None for v, h in zip(j.stats[:, k].tolist(), has)]
                out["distance"] = [v if h else None for v, h in zip(j.distance.tolist(), has)]
                out["junk_share"], out["is_prose"] = j.junk_share, j.junk_share <= 0.5
                out["most_outlying"] = [STATS[int(np.argmax(p))] if h else None for p, h in zip(j.parts, has)]
                out["contributions"] = [p.tolist() if h else None for p, h in zip(j.parts, has)]
                yield from filled(pd.DataFrame(out))

    return _either(documents).mapInPandas(run, schema)


def not_prose(documents: DataFrame, model: Broadcast) -> DataFrame:
    """(doc_id) of the documents that are for more than half a list, a table or junk."""
    return document_statistics(documents, model).filter("NOT is_prose").select("doc_id")


def languages_of_documents(documents: DataFrame, model: Broadcast) -> DataFrame:
    """(tbl, row_key, lang_code) of documents whose label is missing or wrong or whose main body is mixed; those that aren't prose are left out. Whether
    it is prose is asked only of a document whose languages are reported."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for b in batches:
            keys, codes = [], []
            for a in range(0, len(b), 512):
                part = b.iloc[a:a + 512]
                j = Judged.of(m, part, measured=False)
                named = [langid.judge(f, label) for f, label in zip(j.found, part["lang"])]
                at = [i for i, c in enumerate(named) if c]
                some = j.only(at)
                some.measure(m.prose, whole=False)
                ids = part["doc_id"].tolist()
                for i, junk in zip(at, some.junk_share):
                    if junk <= 0.5:
                        keys += [ids[i]] * len(named[i])
                        codes += named[i]
            yield from filled(pd.DataFrame({"tbl": ["documents"] * len(keys), "row_key": np.array(keys, dtype=np.int64), "lang_code": codes}))

    return _either(documents).mapInPandas(run, "tbl string, row_key long, lang_code string")


def segments_of_documents(documents: DataFrame, models: Broadcast) -> DataFrame:
    """(tbl, row_key, segment, lang_code, confidence, n_words): every language segment of every main body; ``models`` has the ``readers``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeller, langs = models.value
        for b in batches:
            out = []
            for a in range(0, len(b), 512):
                part = b.iloc[a:a + 512]
                j = Judged(None, labeller, langs, part["text"].tolist(), part["title"].tolist())
                for k, f in zip(part["doc_id"], j.found):
                    for i, (s, e, y, c) in enumerate(f.segments if f else ()):
                        out.append(("documents", k, i, langid.LANGS[y], c, e - s))
            yield from filled(pd.DataFrame(out, columns=["tbl", "row_key", "segment", "lang_code", "confidence", "n_words"]))

    return documents.select("doc_id", "text", "title").mapInPandas(run, "tbl string, row_key long, segment long, lang_code string, confidence double, n_words long")
