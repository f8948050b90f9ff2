"""Page boilerplate mixed with main content (problem 6).

Method: a recurrent block labeller. Each non-blank line of a page becomes a vector of hashed words and of shape features (the
path of marks, digits and separators that stands for the missing tags), a numpy bidirectional LSTM reads the whole page and
classifies every line.

Training (on the driver, seeded): pages of a bounded sample of posts (``TRAIN_POSTS``), whose lines are labelled by alignment with the
post's body as the crawler stored it; copies of them with the body replaced by generated lists, tables and junk, which are
a record's own content too; and lines that stand in many texts of one source in a bounded sample of documents (``TRAIN_DOCS``).

Scale: prediction is one narrow pass over the pages (no shuffle); a page is one record, batches are cut by the number of cells,
so a very long page only takes longer. The sample is chosen by a hash of the key, so it is the same for any partitioning.

Defined results: null and empty texts have no lines and an empty main text; blank lines are never furniture; repeated rows give
repeated results under their own keys; without any post to learn from, the labeller is trained on the documents alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import filled
from . import store
from .samples import bounded
from .sequence import BiLSTM

TRAIN_POSTS = 1500
TRAIN_DOCS = 2500
SAMPLE_CHARS = 30_000  # longer pages don't teach the labeller: bounds what the driver gets
BUCKETS = 8192
EMB = 24
HIDDEN = 24
CUT = 0.5
CHUNK = 250

_KEY = re.compile(r"[\W\d_]+")
_NUMBERED = re.compile(r"\(?\d+[.)]|\[\d+\]|\d+ \S")
_HANDLE = re.compile(r"[a-z]+[_.]?\d+\b", re.I)
_MARKS = "|·>»/,;\t:[#©-(%=@\"&_"
_BULLETS = "•-*·▪‣◦■●○"
_ARROWS = "└↳←→»«▶▷☰≡#>─═※★☆►+"
_ENDS = ".!?。！？…"
_CLOSERS = "\"'”’」)]"
N_STATIC = 23 + len(_MARKS)
N_SHAPE = N_STATIC + 12
_LETTER, _DIGIT, _UPPER, _SPACE, _HANGUL, _CJK = 1, 2, 4, 8, 16, 32
_TABLE: list[np.ndarray] = []
_SETS: dict[str, np.ndarray] = {}
_POWERS = (np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1))


def letters(s: str) -> str:
    """Letters only, case folded."""
    return _KEY.sub("", s).casefold()


def _classes() -> np.ndarray:
    """Class bits of the code points below 0x10000; those above count as symbols."""
    if not _TABLE:
        t = np.zeros(0x10001, dtype=np.uint8)
        for i in range(0x10000):
            c = chr(i)
            if c.isalpha():
                t[i] = _LETTER | (_UPPER if c.isupper() else 0) | (_HANGUL if 0xAC00 <= i <= 0xD7A3 else 0) | (_CJK if 0x3040 <= i <= 0x30FF or 0x3400 <= i <= 0x9FFF else 0)
            elif c.isnumeric():
                t[i] = _DIGIT
            elif c.isspace():
                t[i] = _SPACE
        _TABLE.append(t)
    return _TABLE[0]


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _isin(codes: np.ndarray, chars: str) -> np.ndarray:
    """Which codes are among the characters, all below 0x10000; by a table, so that the number of characters doesn't count."""
    table = _SETS.get(chars)
    if table is None:
        table = _SETS[chars] = np.zeros(0x10001, dtype=bool)
        table[[ord(c) for c in chars]] = True
    return table[np.minimum(codes, 0x10000)]


def _places(codes: np.ndarray, chars: str) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the characters, the index of each)."""
    at = np.flatnonzero(_isin(codes, chars))
    order = np.argsort([ord(c) for c in chars])
    return at, order[np.searchsorted(np.array([ord(c) for c in chars])[order], codes[at])]


def is_title(line: str, title: str, key: str) -> bool:
    """Whether a line has the letters ``key`` of the title; all letters are compared only where the first one and their number allow it (folding makes three
    of one at most)."""
    if not key or not line or len(key) > 3 * len(line) or len(line) >= 2 * len(title) + 20 or (line[0].isalpha() and not key.startswith(line[0].casefold())):
        return False
    return letters(line) == key


def featurise(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(flat hashed-word ids, start and count per line, shape rows) of stripped, non-empty lines, all at once."""
    n = len(lines)
    text = "\n".join(lines)
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    code, lower = _codes(text), _codes(low).astype(np.uint64)
    cls = _classes()[np.minimum(code, 0x10000)]
    lower = np.where((cls & _DIGIT) > 0, np.uint64(48), lower)
    nl = code == 10
    at = np.cumsum(nl)
    ends = np.append(np.flatnonzero(nl), len(code))
    begin = np.append(0, ends[:-1] + 1)
    size = (ends - begin).astype(np.float32)
    per = lambda mask: np.bincount(at[mask], minlength=n)[:n].astype(np.float32)
    word_char = (cls & (_LETTER | _DIGIT)) > 0
    prev = np.append(False, word_char[:-1])
    w_start = np.flatnonzero(word_char & ~prev)
    total = len(w_start)
    digit = (cls & _DIGIT) > 0
    space = ((cls & _SPACE) > 0) & ~nl
    n_words = np.bincount(at[w_start], minlength=n)[:n]
    parts, owners = [], []
    longest = np.zeros(n, np.float32)
    if total:
        pos = np.flatnonzero(word_char)
        word = (np.cumsum(word_char & ~prev) - 1)[pos]
        inside = pos - w_start[word]
        first = np.flatnonzero(inside == 0)
        terms = lower[pos] * _POWERS[inside % 64]
        hashed = np.add.reduceat(terms, first)
        length = np.diff(np.append(first, len(pos)))
        w_line = at[w_start]
        np.maximum.at(longest, w_line, length.astype(np.float32))
        has_cjk = np.bitwise_or.reduceat(cls[pos], first) & _CJK
        plain = has_cjk == 0
        parts.append(hashed[plain])
        owners.append(w_line[plain])
        hangul = plain & (length > 2) & ((cls[w_start] & _HANGUL) > 0)
        k = w_start[hangul]
        parts.append(lower[k] * _POWERS[40] + lower[np.minimum(k + 1, len(lower) - 1)] * _POWERS[41])
        owners.append(w_line[hangul])
        cjk = (cls & _CJK) > 0
        pair = np.flatnonzero(cjk[:-1] & cjk[1:])
        parts.append(lower[pair] * _POWERS[50] + lower[pair + 1] * _POWERS[51])
        owners.append(at[pair])
        lead = np.append(True, w_line[1:] != w_line[:-1])
        tail = np.append(w_line[1:] != w_line[:-1], True)
        parts += [hashed[lead] * _POWERS[60], hashed[tail] * _POWERS[61]]
        owners += [w_line[lead], w_line[tail]]
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        ids = ((np.concatenate(parts) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 13)).astype(np.int64)[order]
        counts = np.bincount(owner, minlength=n)[:n].astype(np.int64)
    else:
        ids, counts = np.zeros(0, np.int64), np.zeros(n, np.int64)
    starts = (np.cumsum(counts) - counts).astype(np.int64)
    safe = lambda i: code[np.clip(i, 0, len(code) - 1)]
    last = safe(ends - 1)
    closing = _isin(last, _CLOSERS) & (size > 1)
    stop = np.where(closing, safe(ends - 2), last)
    is_end = _isin(code, _ENDS)
    follows = np.append(code[1:], 10)
    inner = is_end & (np.isin(follows, np.array([10, 32], dtype=np.uint32)) | _isin(code, "。！？"))
    clock = np.zeros(len(code), bool)
    if len(code) > 2:
        clock[1:-1] = digit[:-2] & digit[2:] & _isin(code[1:-1], ".:/-")
    head = code[np.minimum(begin, len(code) - 1)] if len(code) else np.zeros(n, np.uint32)
    second = safe(begin + 1)
    upper, digits, alpha = per((cls & _UPPER) > 0), per(digit), per((cls & _LETTER) > 0)
    blank = per(space)
    double = per(space & np.append(space[1:], False))
    sz = np.maximum(size, 1)
    numbered = np.fromiter((_NUMBERED.match(x) is not None for x in lines), dtype=np.float32, count=n)
    handle = np.fromiter((_HANDLE.match(x) is not None for x in lines), dtype=np.float32, count=n)
    f = [
        np.log1p(size) / 4, np.log1p(n_words) / 3, digits / sz, alpha / sz, blank / sz, upper / sz, np.minimum(longest, 60) / 30,
        _isin(stop, _ENDS), last == ord(":"), _isin(last, ")]"), head == ord("["), head == ord("("), numbered, _isin(head, _BULLETS) & (second == 32), _isin(head, _ARROWS), handle,
        per(clock) > 1, np.minimum(per(inner), 6) / 3, (cls[np.clip(ends - 1, 0, len(code) - 1)] & _DIGIT) > 0, (cls[np.minimum(begin, len(code) - 1)] & _DIGIT) > 0, size < 25, size > 90, np.minimum(double, 6) / 3,
    ]
    mark_at, mark = _places(code, _MARKS)
    marks = np.bincount(at[mark_at] * len(_MARKS) + mark, minlength=n * len(_MARKS))[:n * len(_MARKS)].reshape(n, -1)
    f += list((np.minimum(marks, 6).astype(np.float32) / 3).T)
    return ids, starts, counts, np.stack([np.asarray(x, dtype=np.float32) for x in f], axis=1)


class Pages:
    """Pages cut into non-blank lines, with the labeller's input for all of them."""

    def __init__(self, texts: list[str | None], titles: list[str | None]):
        self.numbers: list[list[int]] = []
        self.lines: list[list[str]] = []
        unique: dict[str, int] = {}
        which: list[int] = []
        context: list[tuple] = []
        for text, title in zip(texts, titles):
            numbers, lines, gaps = [], [], []
            for i, x in enumerate(text.split("\n") if text else ()):
                x = x.strip()
                if x:
                    gaps.append(not numbers or numbers[-1] < i - 1)
                    numbers.append(i)
                    lines.append(x)
            self.numbers.append(numbers)
            self.lines.append(lines)
            n = len(lines)
            if not n:
                continue
            t = letters(title) if isinstance(title, str) else ""
            first_seen: dict[str, int] = {}
            twice = set()
            for x in lines:
                if x in first_seen:
                    twice.add(x)
                first_seen[x] = 1
            seen_title = False
            for k, x in enumerate(lines):
                own = is_title(x, title, t)
                seen_title = seen_title or own
                context.append((own, k == 0, k == n - 1, k / n, min(k, 10) / 10, min(n - 1 - k, 10) / 10, min(n, 40) / 40, gaps[k], k == n - 1 or gaps[k + 1], x in twice, seen_title, bool(t)))
                which.append(unique.setdefault(x, len(unique)))
        self.lengths = np.array([len(x) for x in self.lines], dtype=np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        if which:
            ids, starts, counts, shape = featurise(list(unique))
            w = np.array(which)
            self.shape = np.concatenate([shape[w], np.array(context, dtype=np.float32)], axis=1)
            self.counts = counts[w]
            self.starts = np.cumsum(self.counts) - self.counts
            self.ids = ids[np.repeat(starts[w] - self.starts, self.counts) + np.arange(int(self.counts.sum()))]

    def page(self, i: int):
        """One page's input, for training."""
        a = int(self.offsets[i])
        b = a + int(self.lengths[i])
        s = self.starts[a:b]
        lo, hi = (int(s[0]), int(s[-1] + self.counts[b - 1])) if b > a else (0, 0)
        return self.ids[lo:hi], s - lo, self.counts[a:b], self.shape[a:b]


class Labeller:
    """The trained model with the cut; ``furniture`` labels whole batches of pages."""

    def __init__(self, net: BiLSTM, cut: float = CUT):
        self.net, self.cut = net, cut

    def furniture(self, texts: list[str | None], titles: list[str | None]):
        """For each page (line numbers, stripped lines, probability of furniture)."""
        pages = Pages(texts, titles)
        if not pages.lengths.sum():
            return [(a, b, np.zeros(0, np.float32)) for a, b in zip(pages.numbers, pages.lines)]
        prob = self.net.predict(pages.ids, pages.starts, pages.counts, pages.shape, pages.lengths)
        ends = np.cumsum(pages.lengths)
        return [(a, b, prob[e - n:e]) for a, b, e, n in zip(pages.numbers, pages.lines, ends, pages.lengths)]


def _field(words: list[str], r: np.random.Generator):
    """A maker of one kind of field: words of the page, numbers, codes or symbols, each by a rule drawn once."""
    k, kind = int(r.integers(1, 5)), int(r.integers(0, 9))
    alphabet = ["0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0123456789"][int(r.integers(0, 5))]
    size, point, group = int(r.integers(1, 14)), int(r.integers(0, 4)), bool(r.random() < 0.3)
    joint = ["/", ".", "-", ":", "_", "="][int(r.integers(0, 6))]
    code = lambda n: "".join(alphabet[int(i)] for i in r.integers(0, len(alphabet), n))
    word = lambda n: " ".join(words[int(i)] for i in r.integers(0, len(words), n))
    number = lambda: f"{r.integers(0, 10 ** int(r.integers(1, 6))) / 10**point:{',' if group else ''}.{point}f}"
    if kind <= 2:
        return lambda: word(int(r.integers(1, k + 1)))
    if kind <= 4:
        return number
    if kind == 5:
        return lambda: code(int(r.integers(max(1, size // 2), size + 1)))
    if kind == 6:
        return lambda: joint.join(code(int(r.integers(1, 6))) for _ in range(k))
    if kind == 7:
        return lambda: joint.join(x.strip(".,") for x in word(k).split(" ")).lower()
    return lambda: word(1)[:1] * size


def _generated(words: list[str], r: np.random.Generator) -> list[str]:
    """Lines of a list, a table or junk out of a page's own words: all lines follow one pattern, drawn at random, of fields between marks."""
    marks = ["", " ", "  ", "   ", "\t", "|", " | ", ";", ",", ", ", ": ", "=", " - ", " / ", "/", " (", ") ", " [", "] ", "#", " #", "://", "@", "%", " ★ ", "? "]
    mark = lambda: marks[int(r.integers(0, len(marks)))]
    u, n = r.random(), int(r.integers(3, 24))
    if u < 0.2:  # words without sentences
        return [" ".join(words[int(i)] for i in r.integers(0, len(words), int(r.integers(8, 60)))) for _ in range(int(r.integers(1, 6)))]
    if u < 0.3:  # broken encoding and random characters
        return [" ".join(words[int(i)] for i in r.integers(0, len(words), 4)).encode().decode("latin-1") if r.random() < 0.5 else "".join(chr(int(c)) for c in r.integers(33, 127, int(r.integers(10, 80)))) for _ in range(int(r.integers(2, 9)))]
    fields = [_field(words, r) for _ in range(1 + int(r.integers(0, 2) if u < 0.6 else r.integers(1, 7)))]
    same = mark() if r.random() < 0.6 else None
    lead, tail = ("", "") if r.random() < 0.4 else (["- ", "* ", "• ", "· ", "{}. ", "{}) ", "[", "> ", "("][int(r.integers(0, 9))], mark().rstrip() if r.random() < 0.2 else "")
    between = [mark() if same is None else same for _ in fields]
    out = []
    for i in range(n):
        line = lead.format(i + 1)
        for f, m in zip(fields, between):
            line += f() + m
        out.append(line[:len(line) - len(between[-1])] + tail)
    if u > 0.8 and len(out) > 3:  # several on a line
        k = int(r.integers(2, 9))
        out = [(mark() or " ").join(out[i:i + k]) for i in range(0, len(out), k)]
    return [x.replace("\n", " ") for x in out if x.strip()]


def _post_pages(posts: list, r: np.random.Generator):
    """Training pages of aligned posts and of their copies with generated bodies."""
    texts, titles, labels = [], [], []
    for p in posts:
        body = {k for k in (letters(x) for x in (p["body"] or "").split("\n")) if k}
        title = letters(p["title"] or "")
        stripped = [x for x in (x.strip() for x in p["raw_text"].split("\n")) if x]
        keys = [letters(x) for x in stripped]
        if not stripped or (body and len(body & set(keys)) < 0.7 * len(body)):
            continue  # edited since: no alignment to learn from
        y = [0.0 if k and (k in body or k == title) else 1.0 for k in keys]
        texts.append(p["raw_text"])
        titles.append(p["title"])
        labels.append(y)
        pool = [w for x, v in zip(stripped, y) if v == 0 for w in x.split()]
        if len(pool) < 8 or r.random() > 0.7:
            continue
        fresh, made = _generated(pool, r), []
        at, n_body = 0, sum(1 for k, v in zip(keys, y) if v == 0 and k != title)
        share = max(1, len(fresh) // max(1, n_body))
        for x, k, v in zip(stripped, keys, y):
            if v == 1 or k == title:
                made.append((x, v))
            else:
                part = fresh[at:at + share] if at + 2 * share <= len(fresh) else fresh[at:]
                at += len(part)
                made += [(z.strip(), 0.0) for z in part if z.strip()]
        texts.append("\n".join(x for x, _ in made))
        titles.append(p["title"] if r.random() < 0.8 else None)
        labels.append([v for _, v in made])
    out = []
    for a in range(0, len(texts), CHUNK):  # bounds the driver's memory
        pages = Pages(texts[a:a + CHUNK], titles[a:a + CHUNK])
        for i, y in enumerate(labels[a:a + CHUNK]):
            if len(y) == len(pages.lines[i]) and y:
                out.append((*(x.copy() for x in pages.page(i)), np.array(y, np.float32), np.ones(len(y), np.float32)))
    return out


def _doc_pages(docs: list, net: BiLSTM | None):
    """Training pages of documents: standing lines are furniture; else what the first model is sure of."""
    keys = [[letters(x) for x in (x.strip() for x in d["text"].split("\n")) if x] for d in docs]
    support: dict[tuple, int] = {}
    total: dict = {}
    for d, ks in zip(docs, keys):
        total[d["source"]] = total.get(d["source"], 0) + 1
        for k in set(ks):
            if k:
                support[d["source"], k] = support.get((d["source"], k), 0) + 1
    out = []
    for a in range(0, len(docs), CHUNK):
        part = docs[a:a + CHUNK]
        pages = Pages([d["text"] for d in part], [d["title"] for d in part])
        prob = net.predict(pages.ids, pages.starts, pages.counts, pages.shape, pages.lengths) if net is not None and pages.lengths.sum() else None
        ends = np.cumsum(pages.lengths)
        for i, (d, ks) in enumerate(zip(part, keys[a:a + CHUNK])):
            if not ks:
                continue
            need = max(3, 0.02 * total[d["source"]])
            standing = np.array([bool(k) and support[d["source"], k] >= need for k in ks])
            title = letters(d["title"] or "")
            own = np.array([bool(title) and k == title for k in ks])
            if prob is not None:
                p = prob[ends[i] - len(ks):ends[i]]
                y = np.where(standing, 1.0, (p > 0.5) * 1.0)
                w = np.where(standing, 1.0, np.where((p < 0.1) | (p > 0.9), 0.5, 0.0))
            else:
                y, w = standing * 1.0, np.ones(len(ks))
            y, w = np.where(own, 0.0, y), np.where(own, 1.0, w)
            out.append((*(x.copy() for x in pages.page(i)), y.astype(np.float32), w.astype(np.float32)))
    return out


def training_sample(raw_posts: DataFrame, unified_rows: DataFrame, documents: DataFrame, n_posts: int = TRAIN_POSTS, n_docs: int = TRAIN_DOCS):
    """The bounded sample: posts with their bodies, and documents; chosen by a hash of the key."""
    fits = lambda c: f"{c} IS NOT NULL AND {c} <> '' AND length({c}) <= {SAMPLE_CHARS}"
    posts = bounded(raw_posts.filter(fits("raw_text")).select("row_id", F.col("id").alias("post_id"), "title", "raw_text"), "row_id", n_posts).dropDuplicates(["post_id"]).collect()
    spark = raw_posts.sparkSession
    ids = F.broadcast(spark.createDataFrame([(r["post_id"],) for r in posts], "post_id string"))  # n_posts ids at most
    bodies = unified_rows.filter("comment_index IS NULL AND " + fits("text")).select(F.col("id").alias("u_id"), "text")
    body = {r["post_id"]: r["body"] for r in bodies.join(ids, F.col("post_id") == F.col("u_id")).groupBy("post_id").agg(F.min("text").alias("body")).collect()}
    joined = [{"row_id": r["row_id"], "title": r["title"], "raw_text": r["raw_text"], "body": body[r["post_id"]]} for r in posts if r["post_id"] in body]
    docs = bounded(documents.filter(fits("text")).select("doc_id", "source", "title", "text"), "doc_id", n_docs)
    return sorted(joined, key=lambda r: r["row_id"]), docs.collect()


def fit(posts: list, docs: list, seed: int = 5) -> Labeller:
    """Train the labeller on a collected sample."""
    r = np.random.default_rng(seed)
    net = BiLSTM(BUCKETS, EMB, N_SHAPE, HIDDEN)
    pages = _post_pages(posts, r)
    if len(pages) >= 20:
        net.train(pages, epochs=max(8, min(60, 12000 // len(pages))))
        both = pages + _doc_pages(docs, net)
        net.train(both, epochs=max(2, min(12, 12000 // len(both))), lr=0.002)
    else:
        both = pages + _doc_pages(docs, None)
        if both:
            net.train(both, epochs=10)
    return Labeller(net.frozen())


def labeller(raw_posts: DataFrame, unified_rows: DataFrame, documents: DataFrame) -> Labeller:
    """The labeller, fitted on its sample or read from the models' folder."""
    tables = [raw_posts.select("row_id", "id", "title", "raw_text"), unified_rows.filter("comment_index IS NULL").select("id", "text"), documents.select("doc_id", "source", "title", "text")]
    return store.fitted(raw_posts.sparkSession, "labeller", tables, (TRAIN_POSTS, TRAIN_DOCS, SAMPLE_CHARS, BUCKETS, EMB, HIDDEN), lambda: fit(*training_sample(raw_posts, unified_rows, documents)))


def trained(spark: SparkSession, raw_posts: DataFrame, unified_rows: DataFrame, documents: DataFrame) -> Broadcast:
    """The labeller, sent to the executors (about 1 MB)."""
    return spark.sparkContext.broadcast(labeller(raw_posts, unified_rows, documents))


def find_furniture(pages: DataFrame, model: Broadcast) -> DataFrame:
    """(tbl, row_key, text, title) -> (tbl, row_key, line_no, p) of the lines that are page furniture."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for a in range(0, len(b), 1024):
                part = b.iloc[a:a + 1024]
                got = model.value.furniture(part["text"].tolist(), part["title"].tolist())
                tbl, key, no, pr = [], [], [], []
                for t, k, (numbers, _, p) in zip(part["tbl"], part["row_key"], got):
                    hit = np.flatnonzero(p >= model.value.cut)
                    tbl += [t] * len(hit)
                    key += [k] * len(hit)
                    no += [numbers[i] for i in hit]
                    pr += p[hit].tolist()
                yield from filled(pd.DataFrame({"tbl": tbl, "row_key": np.array(key, dtype=np.int64), "line_no": np.array(no, dtype=np.int64), "p": np.array(pr, dtype=np.float64)}))

    return pages.select("tbl", "row_key", "text", "title").mapInPandas(run, "tbl string, row_key long, line_no long, p double")


def main_text(pages: DataFrame, model: Broadcast) -> DataFrame:
    """(tbl, row_key, text, title) -> (tbl, row_key, main_text, n_removed): the pages with only the lines of the main body."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for a in range(0, len(b), 1024):
                part = b.iloc[a:a + 1024]
                texts = part["text"].tolist()
                got = model.value.furniture(texts, part["title"].tolist())
                out, n = [], []
                for t, (numbers, _, p) in zip(texts, got):
                    gone = {numbers[i] for i in np.flatnonzero(p >= model.value.cut)}
                    out.append("\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone).strip("\n") if t else "")
                    n.append(len(gone))
                yield from filled(pd.DataFrame({"tbl": part["tbl"], "row_key": part["row_key"], "main_text": out, "n_removed": np.array(n, dtype=np.int64)}))

    return pages.select("tbl", "row_key", "text", "title").mapInPandas(run, "tbl string, row_key long, main_text string, n_removed long")


def stack_pages(raw_posts: DataFrame, documents: DataFrame) -> DataFrame:
    """Both tables' pages in one form."""
    return raw_posts.select(F.lit("raw_posts").alias("tbl"), F.col("row_id").alias("row_key"), F.col("raw_text").alias("text"), "title").unionByName(
        documents.select(F.lit("documents").alias("tbl"), F.col("doc_id").alias("row_key"), "text", "title")
    )
