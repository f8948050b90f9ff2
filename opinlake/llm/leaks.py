"""Evaluation texts leaking into training text (problem 8).

Method: a BM25 inverted index of the test items with block-max WAND. Every training passage (overlapping runs of words)
is a query; for an item the threshold is the least score that a passage with ``RUN`` consecutive words of it can have, so
nothing that could be a leak is pruned: blocks of items whose summed block maxima stay below are skipped, the
rest is scored, and what reaches the threshold is verified on the words themselves.

Scale: the index is broadcast, never more than ``max_index_words`` words at once: a larger test set is cut by a hash of its ids into
slices, each with an index of its own, and the documents are searched slice by slice. Documents are never shuffled. Bounds are kept only for the pairs
of passage and block that share a word, ``SLICE`` texts at a time.

Defined results: null or short texts and items of fewer than ``RUN`` words give no rows; repeated items or documents give
rows by their own ids; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import filled

RUN = 12
PASSAGE = 64
BLOCK = 8
MAX_INDEX_WORDS = 5_000_000
SLICE = 512
K1, B = 1.2, 0.75
_WORD = re.compile(r"[^\W_]+")
_MULT = np.uint64(1_000_003)


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits, case folded."""
    return _WORD.findall(text.casefold()) if text else []


def run_hashes(ids: np.ndarray, run: int = RUN) -> np.ndarray:
    """A 64-bit polynomial hash of each run of consecutive ids."""
    n = len(ids) - run + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    x = ids.astype(np.uint64) + np.uint64(7)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(run):
        h = h * _MULT + x[k:k + n]
    return h


class LeakIndex:
    """Postings of the items, block maxima and lossless thresholds."""

    def __init__(self, items: list[tuple[int, str]]):
        words = [(i, w) for i, w in ((i, words_of(t)) for i, t in items) if len(w) >= RUN]
        self.item_ids = np.array([i for i, _ in words], dtype=np.int64)
        self.vocab: dict[str, int] = {}
        docs = [np.array([self.vocab.setdefault(x, len(self.vocab)) for x in w], dtype=np.int64) for _, w in words]
        n, v = len(docs), len(self.vocab)
        avg = sum(map(len, docs)) / max(n, 1)
        df = np.zeros(v)
        for d in docs:
            df[np.unique(d)] += 1
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        terms, owners, impacts = [], [], []
        grams: dict[int, list[int]] = {}
        for i, d in enumerate(docs):
            t, tf = np.unique(d, return_counts=True)
            score = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(d) / avg))
            of = dict(zip(t.tolist(), score.tolist()))
            least = min(sum(of[x] for x in set(d[k:k + RUN].tolist())) for k in range(len(d) - RUN + 1))
            terms.append(t)
            owners.append(np.full(len(t), i))
            impacts.append(score / max(least, 1e-12))  # a leak scores 1 or more
            for h in np.unique(run_hashes(d)).tolist():
                grams.setdefault(h, []).append(i)
        self.docs = docs
        self.grams = grams
        cat = lambda xs, t: np.concatenate(xs).astype(t) if xs else np.zeros(0, t)
        term, owner, impact = cat(terms, np.int64), cat(owners, np.int64), cat(impacts, np.float32)
        order = np.lexsort((owner, term))
        self.owner, self.impact = owner[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(v + 1))
        self.n_blocks = n // BLOCK + 1
        key = term[order] * self.n_blocks + self.owner // BLOCK
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        self.b_block = (key[first] % self.n_blocks).astype(np.int64)
        self.b_max = np.maximum.reduceat(self.impact, first) if len(first) else np.zeros(0, np.float32)
        self.b_start = np.searchsorted(key[first] // self.n_blocks, np.arange(v + 1))


def _spread(start: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry its postings: (which entry, where the posting is)."""
    count = start[terms + 1] - start[terms]
    total = int(count.sum())
    which = np.repeat(np.arange(len(terms)), count)
    ends = np.cumsum(count)
    return which, np.arange(total) - np.repeat(ends - count, count) + np.repeat(start[terms], count)


def search(index: LeakIndex, texts: list[str | None]) -> list[tuple[int, int]]:
    """(text number, item number) of all leaks."""
    return [(a + i, j) for a in range(0, len(texts), SLICE) for i, j in _search(index, texts[a:a + SLICE])]


def _search(index: LeakIndex, texts: list[str | None]) -> list[tuple[int, int]]:
    if not len(index.item_ids):
        return []
    get = index.vocab.get
    ids, doc_of, pos_of = [], [], []
    step = PASSAGE - RUN + 1
    for i, t in enumerate(texts):
        w = words_of(t)
        if len(w) >= RUN:
            x = np.fromiter((get(a, -1) for a in w), dtype=np.int64, count=len(w))
            if (x >= 0).sum() >= RUN:
                ids.append(x)
                doc_of.append(i)
    if not ids:
        return []
    p_term, p_of, spans = [], [], []
    for k, x in enumerate(ids):
        for a in range(0, max(1, len(x) - RUN + 1), step):
            part = x[a:a + PASSAGE]
            part = np.unique(part[part >= 0])
            if len(part):
                p_term.append(part)
                p_of.append(np.full(len(part), len(spans)))
                spans.append((k, a))
    if not spans:
        return []
    term, passage = np.concatenate(p_term), np.concatenate(p_of)
    which, at = _spread(index.b_start, term)
    pair, back = np.unique(passage[which] * index.n_blocks + index.b_block[at], return_inverse=True)
    live = pair[np.bincount(back, weights=index.b_max[at], minlength=len(pair)) >= 0.999]
    if not len(live):
        return []
    need = np.isin(passage, live // index.n_blocks)
    term, passage = term[need], passage[need]
    which, at = _spread(index.start, term)
    p, o, s = passage[which], index.owner[at], index.impact[at]
    block = p * index.n_blocks + o // BLOCK
    keep = live[np.minimum(np.searchsorted(live, block), len(live) - 1)] == block
    p, o, s = p[keep], o[keep], s[keep]
    n_items = len(index.item_ids)
    key, inverse = np.unique(p * n_items + o, return_inverse=True)
    score = np.bincount(inverse, weights=s) if len(key) else np.zeros(0)
    found = set()
    by_passage: dict[int, set[int]] = {}
    for k in key[score >= 0.999].tolist():
        by_passage.setdefault(k // n_items, set()).add(k % n_items)
    for q, items in by_passage.items():
        k, a = spans[q]
        x = ids[k][a:a + PASSAGE]
        for j, h in enumerate(run_hashes(x).tolist()):
            for i in index.grams.get(h, ()):
                if i in items and (doc_of[k], i) not in found and _has_run(index.docs[i], x[j:j + RUN]):
                    found.add((doc_of[k], i))
    return sorted(found)


def _has_run(d: np.ndarray, run: np.ndarray) -> bool:
    return any(d[s] == run[0] and np.array_equal(d[s:s + len(run)], run) for s in range(len(d) - len(run) + 1))


def _in_slice(documents: DataFrame, items: DataFrame) -> DataFrame:
    index = documents.sparkSession.sparkContext.broadcast(LeakIndex([(r["item_id"], r["text"]) for r in items.select("item_id", "text").collect()]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hits = search(index.value, b["text"].tolist())
            ids = b["doc_id"].to_numpy()
            yield from filled(pd.DataFrame({"doc_id": np.array([ids[a] for a, _ in hits], dtype=np.int64), "item_id": np.array([index.value.item_ids[i] for _, i in hits], dtype=np.int64)}))

    return documents.select("doc_id", "text").mapInPandas(run, "doc_id long, item_id long")


def find_leaks(documents: DataFrame, items: DataFrame, max_index_words: int = MAX_INDEX_WORDS) -> DataFrame:
    """(doc_id, item_id): documents with at least RUN consecutive words in common with an item."""
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    slices = max(1, -(-size // (max_index_words * 6)))  # a word has some six characters
    out = [_in_slice(documents, items if slices == 1 else items.filter(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == k)) for k in range(slices)]
    found = out[0]
    for x in out[1:]:
        found = found.unionByName(x)
    return found.distinct()


def leak_report(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, n_docs): which test items leaked and into how many documents."""
    return find_leaks(documents, items).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"))
