"""Duplicates hidden by formatting differences (problem 7).

Method: dictionary encoding. The columns of a block of rows are dictionary-encoded; each distinct value of it is canonicalised once (an id to its sorted
letter-and-digit parts, a comment to its letters and digits, case ignored) and gets an integer identifier, the 128-bit hash of its
canonical form in two words, so that all blocks agree without a dictionary that has to be joined with every row. A record becomes the tuple of
its (field, value) integers in the order of the fields, and only the compact tuples are grouped.

Scale: texts are read in one narrow pass and never shuffled, only tuples of four integers are; the encoded table is kept in the shared folder where it
is used twice. The count of copies is combined on the map side, so a group that holds a third of all rows is no single task. The result of the
operator is one row per copy with its representative (``members``); pairs are made by ``pairs`` only, inside groups of two or more.

Defined results: null and blank comments are alike; an id without letters or digits names no record, so its rows stay
single; repeated rows count as copies; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sums

KEY = ("id_1", "id_2", "text_1", "text_2")
_PART = re.compile(r"[^\W_]+")
_REST = re.compile(r"[\W_]+")


def canonical_id(value: str | None) -> str:
    """The sorted runs of letters and digits."""
    return " ".join(sorted(_PART.findall(value.upper().lower()))) if value else ""


def canonical_text(value: str | None) -> str:
    """The letters and digits."""
    return _REST.sub("", value.upper().lower()) if value else ""


def _encode(column: pa.Array, canonical) -> tuple[np.ndarray, np.ndarray]:
    """(identifiers in two words, canonical form isn't empty) of each row, by the distinct values of the column."""
    coded = column.dictionary_encode()
    values = [canonical(v) for v in coded.dictionary.to_pylist()] + [""]  # last: null
    ids = np.frombuffer(b"".join(blake2b(v.encode("utf-8", "surrogatepass"), digest_size=16).digest() for v in values), dtype=np.int64).reshape(-1, 2)
    at = coded.indices.fill_null(len(values) - 1).to_numpy(zero_copy_only=False)
    return ids[at], np.array([bool(v) for v in values])[at]


def encode(rows: DataFrame) -> DataFrame:
    """(row_id, named, id_1, id_2, text_1, text_2): the record as one integer tuple."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, named = _encode(b.column("id"), canonical_id)
            texts, _ = _encode(b.column("comment_text"), canonical_text)
            yield pa.RecordBatch.from_arrays([b.column("row_id"), pa.array(named), *(pa.array(x) for x in (ids[:, 0], ids[:, 1], texts[:, 0], texts[:, 1]))], names=["row_id", "named", *KEY])

    return rows.select("row_id", "id", "comment_text").mapInArrow(run, "row_id long, named boolean, id_1 long, id_2 long, text_1 long, text_2 long")


def _groups(encoded: DataFrame) -> DataFrame:
    return encoded.filter("named").groupBy(*KEY).agg(F.min("row_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"))


def collapse(rows: DataFrame) -> DataFrame:
    """(row_id, n_copies): one record, that of the least row_id, for each group of copies."""
    e = encode(rows)
    single = F.when(F.col("named"), F.lit(None)).otherwise(F.col("row_id"))  # rows that name no record have a group of their own
    return e.groupBy(*KEY, single.alias("single")).agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("n_copies")).select("row_id", "n_copies")


def members(rows: DataFrame) -> DataFrame:
    """(row_id, first_id, n_copies) of every row that has copies: which record it repeats."""
    e = sums.kept(encode(rows).filter("named"), "encoded")
    many = _groups(e.withColumn("named", F.lit(True))).filter("n_copies > 1").select(*[F.col(k).alias(f"g_{k}") for k in KEY], "first_id", "n_copies")
    same = [F.col(k) == F.col(f"g_{k}") for k in KEY]
    return e.join(many, same[0] & same[1] & same[2] & same[3]).select("row_id", "first_id", "n_copies")


def pairs(rows: DataFrame) -> DataFrame:
    """(row_id_a, row_id_b), a < b: all pairs of rows that are the same record."""
    m = members(rows)
    a, b = m.select(F.col("row_id").alias("row_id_a"), F.col("first_id").alias("first_a")), m.select(F.col("row_id").alias("row_id_b"), F.col("first_id").alias("first_b"))
    return a.join(b, (F.col("first_a") == F.col("first_b")) & (F.col("row_id_a") < F.col("row_id_b"))).select("row_id_a", "row_id_b")
