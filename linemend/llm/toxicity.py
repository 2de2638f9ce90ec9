"""Operator 3: toxicity by FTRL-proximal logistic regression.

Features of a document are the distinct hashes of its lower-cased words, word
pairs and skip-grams (one or two words left out), hashed into ``2**BITS``
coordinates.  FTRL-proximal learns with a rate per coordinate; its L1 term keeps
most coordinates at exactly zero, so the model is a short list of coordinates
and weights, which is broadcast to score every document in one map.

Fitting uses at most ``max_rows`` labelled rows with ``max_bytes`` of features
(documented bounds), chosen by a hash of the id, so the sample is the same at every run.  Features of those
rows are made on the executors; the driver receives only their hashes.

Results: a null or empty text has no feature but the constant one; its score is
the bias'.  Labels that are null or of unknown documents teach nothing.  With no
labelled row, every score is 0.5.  A document labelled twice counts once, as
toxic if either row says so.  Extra columns are not carried.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linemend.llm.base import cut_table, drop_table, hash_share, lean, once, small_batches, table

BITS = 20
MAX_ROWS, MAX_BYTES, EPOCHS = 12_000, 256 << 20, 16
ALPHA, BETA, L1, L2, TOXIC_WEIGHT = 1.0, 1.0, 60.0, 0.0, 5.0
CUT = 0.7
HELD_OUT_OF, HELD_OUT = 3, 1
WORD_CACHE = 100_000
# Odd multipliers that spread pairs of word hashes over 64 bits (any odd numbers do).
FIRST, SECOND, STEP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
_find = re.compile(r"[^\W_]+").findall


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        h = zlib.crc32(word.encode())
        if len(word) <= 48:
            if len(self) >= WORD_CACHE:
                self.clear()
            self[word] = h
        return h


def features(text: str | None) -> np.ndarray:
    """Distinct coordinates of a text, ascending; coordinate 0 is the constant."""
    words = _find((text or "").lower())
    hashes = once(("ftrl", "words"), _Hashes)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    shift = np.uint64(64 - BITS)
    parts = [np.zeros(1, np.int32), ((h * np.uint64(FIRST)) >> shift).astype(np.int32)]
    for gap in (1, 2, 3):
        if len(h) > gap:
            pair = h[:-gap] * np.uint64(FIRST) + (h[gap:] + np.uint64(gap)) * np.uint64(SECOND)
            parts.append(((pair * np.uint64(STEP)) >> shift).astype(np.int32))
    return np.unique(np.concatenate(parts))


def packed(x: np.ndarray) -> bytes:
    """Ascending coordinates as compressed differences."""
    return zlib.compress(np.diff(x, prepend=0).astype("<u4").tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(raw), "<u4"), dtype=np.int32)


@dataclass
class Weights:
    """Non-zero coordinates (ascending) and their weights."""

    at: np.ndarray
    value: np.ndarray

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.at] = self.value
        return out


def fit(rows: Iterable[tuple[np.ndarray, int]], epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2, toxic_weight: float = TOXIC_WEIGHT) -> Weights:
    """FTRL-proximal over rows of (coordinates, 0 or 1), in the given order; a toxic row
    counts ``toxic_weight`` times."""
    rows = list(rows)
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weight(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for x, y in rows:
            zi, ni = z[x], n[x]
            w = weight(zi, ni)
            g = (1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y) * (toxic_weight if y else 1.0)
            more = ni + g * g
            z[x] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / alpha * w
            n[x] = more
    touched = np.flatnonzero(np.abs(z) > l1)
    return Weights(touched.astype(np.int32), weight(z[touched], n[touched]).astype(np.float32))


def score(text: str | None, dense: np.ndarray) -> float:
    total = float(dense[features(text)].sum(dtype=np.float64))
    return float(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))


def held_out(id_col: str) -> F.Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_OUT_OF == HELD_OUT


def train(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Weights:
    """Fits on labelled documents that are not held out, ``max_rows`` and ``max_bytes``
    of features at most."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1)).where(~held_out("id"))
    chosen = hash_share(known, F.col("id"), 4 * max_rows).groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_rows)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(f) for f in x], pa.int32()), pa.array(map(packed, x), pa.binary())], names=["id", "y", "n", "x"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # ``chosen`` has at most max_rows rows of two numbers; of a repeated id one row stays
    rows = texts.join(F.broadcast(chosen), "id").select(F.col("id").cast("string").alias("id"), "y", "text").mapInArrow(made, "id string, y int, n int, x binary")
    rows = cut_table(rows.groupBy("id", "y").agg(F.min(F.struct("n", "x")).alias("f")).select("id", "y", "f.n", "f.x"), "toxicity-rows")
    sizes = sorted(rows.select("id", "y", "n").collect(), key=lambda r: (zlib.crc32(r.id.encode()), r.id))
    ends = np.cumsum([0, *(r.n for r in sizes)])
    sizes = [r for r, end in zip(sizes, ends[1:], strict=True) if 4 * end <= max_bytes]
    start = {r.id: int(at) for r, at in zip(sizes, ends, strict=False)}
    # one array for all, filled part by part, so that the driver holds the features once
    x = np.empty(int(ends[len(sizes)]), np.int32)
    for r in rows.select("id", "n", "x").toLocalIterator():
        if r.id in start:
            x[start[r.id] : start[r.id] + r.n] = unpacked(r.x)
    drop_table(rows)
    return fit((x[start[r.id] : start[r.id] + r.n], r.y) for r in sizes)


def toxicity(docs: DataFrame, weights: Weights, cut: float = CUT, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """Per row: doc_id, score, predicted.  ``carry`` returns the row's own columns
    instead, of the rows that are not predicted toxic."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((weights.at, weights.value))
    key = ("ftrl", hash((weights.at.tobytes(), weights.value.tobytes())))

    def of(texts: pa.Array) -> list[float]:
        dense = once(key, lambda: Weights(*shared.value).dense())
        return [score(t.as_py(), dense) for t in texts]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            s = of(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array([int(x >= cut) for x in s], pa.int32())], names=["doc_id", "score", "predicted"])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            s = of(batch.column(batch.schema.get_field_index(text_col)))
            yield batch.filter(pa.array([x < cut for x in s], pa.bool_()))

    if carry:
        return docs.mapInArrow(passed, docs.schema)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(scored, "doc_id bigint, score double, predicted int")


def op3_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = train(docs, table(spark, sf_dir, "labels"))
    return toxicity(docs, weights).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
