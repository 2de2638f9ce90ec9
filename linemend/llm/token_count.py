"""Operator 7: token counts by a map-side two-tier lookup.

A subword vocabulary whose pieces hold a space only at their front never merges
across the gap before a space, so a text falls into pre-tokens (a run of spaces
with what follows) that are counted one by one; a line feed that no piece holds
splits further.  Tier one is a compact table of the most frequent pre-tokens and
their lengths, counted map-side in a bounded sample of documents and broadcast.  Tier
two is a bounded cache in each Python worker, which asks the library on a miss.
No pre-token is ever shuffled; the plan is one map over the documents.

The table only saves time: counts are those of the library for any sample.

Results: a null text counts as empty (0 bytes, 0 tokens); extra columns are not
carried; repeated rows give repeated rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linemend.llm.base import file_bytes, hash_share, lean, once, table, tokenizer_file

LIMIT = 4096
#: Documents sampled for tier one, its entries, and the most entries of both tiers in a worker.
SAMPLE_DOCS, TABLE_SIZE, CACHE = 2_000, 50_000, 400_000
#: Of one task: bytes of texts counted for tier one, and entries sent.
SAMPLE_BYTES, TASK_TABLE = 16 << 20, 4_000
LONGEST_KEPT = 64
GAP = "▁"


class Counts(dict):
    """Pre-token -> number of tokens.  ``frequent`` stays when the cache is emptied."""

    def __init__(self, model: bytes):
        import sentencepiece

        super().__init__()
        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self._model.get_piece_size()
        pieces = [self._model.id_to_piece(i) for i in range(size) if not (self._model.is_byte(i) or self._model.is_control(i) or self._model.is_unknown(i))]
        self._check(pieces)
        self._breaks = not any("\n" in p for p in pieces) and any(self._model.is_byte(i) for i in range(size))
        self.find = re.compile(r" +[^ \n]*|[^ \n]+|\n" if self._breaks else r" +[^ ]*").findall
        self._frequent: dict[str, int] = {}
        if self._breaks:
            self["\n"] = self._frequent["\n"] = 1

    def _check(self, pieces: list[str]) -> None:
        if any(GAP in p.lstrip(GAP) for p in pieces) or len(self._model.encode(" \t a", num_threads=1)) < len(self._model.encode("\t a", num_threads=1)):
            raise ValueError("the vocabulary merges across gaps or trims spaces")

    def keep(self, frequent: dict[str, int]) -> Counts:
        self._frequent |= frequent
        self.update(frequent)
        return self

    def __missing__(self, word: str) -> int:
        encode = self._model.encode
        if word[0] != " ":  # after a line feed: no gap in front
            n = len(encode("\n" + word, num_threads=1)) - 2
        elif len(word) == 1:
            n = 1
        else:
            n = len(encode(word[1:], num_threads=1))  # the library puts one gap in front
        if len(word) <= LONGEST_KEPT:
            if len(self) >= CACHE:
                self.clear()
                self.update(self._frequent)
            self[word] = n
        return n

    def of(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self.find(" " + text.replace(GAP, " "))))


def pack(entries: list[tuple[str, int]]) -> tuple[bytes, bytes, bytes]:
    """Tier one as three flat buffers: texts, their ends, their lengths in tokens."""
    import numpy as np

    raw = [w.encode() for w, _ in entries]
    return b"".join(raw), np.cumsum([len(w) for w in raw], dtype="<u4").tobytes(), np.array([n for _, n in entries], "<u2").tobytes()


def unpack(packed: tuple[bytes, bytes, bytes]) -> dict[str, int]:
    import numpy as np

    texts, ends, counts = packed[0], np.frombuffer(packed[1], "<u4").tolist(), np.frombuffer(packed[2], "<u2").tolist()
    return {texts[a:b].decode(): n for a, b, n in zip([0, *ends], ends, counts, strict=False)}


def frequent_lengths(docs: DataFrame, model: bytes, sample_docs: int = SAMPLE_DOCS, size: int = TABLE_SIZE) -> list[tuple[str, int]]:
    """The most frequent pre-tokens of a bounded sample with their lengths; at most
    ``size`` short entries.  ``docs``: id, text.

    Documents are chosen by a hash of the id where they lie; each task counts at most
    ``sample_docs`` of them, up to ``SAMPLE_BYTES``, and sends its ``TASK_TABLE`` most
    frequent pre-tokens to the driver, which adds them up: no text leaves its task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        counts, seen, docs_left, bytes_left = once(("pieces", hashlib.sha256(model).hexdigest()), lambda: Counts(model)), Counter(), sample_docs, SAMPLE_BYTES
        for text in (t.as_py() or "" for batch in batches for t in batch.column(0)):
            seen.update(w for w in counts.find(" " + text.replace(GAP, " ")) if len(w) <= LONGEST_KEPT)
            docs_left, bytes_left = docs_left - 1, bytes_left - len(text)
            if docs_left <= 0 or bytes_left <= 0:
                break
        top = seen.most_common(TASK_TABLE)
        yield pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in top], pa.string()), "n": pa.array([counts[w] for w, _ in top], pa.int64()), "times": pa.array([n for _, n in top], pa.int64())})

    some = hash_share(docs.where(F.col("text").isNotNull()), F.col("id"), sample_docs)
    times, length = Counter(), {}
    for r in some.select("text").mapInArrow(count, "word string, n long, times long").toLocalIterator():
        times[r.word] += r.times
        length[r.word] = r.n
    return [(w, length[w]) for w, n in times.most_common(size) if n > 1]


def token_counts(
    docs: DataFrame, model_file: str | None = None, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, sample_docs: int = SAMPLE_DOCS
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit.  See the module for edge cases."""
    spark = docs.sparkSession
    data = file_bytes(model_file or tokenizer_file("piece_bpe_32k.model"))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    frequent = pack(frequent_lengths(read.select(F.col("doc_id").alias("id"), "text"), data, sample_docs))
    key = ("pieces", hashlib.sha256(data).hexdigest(), hashlib.sha256(frequent[0]).hexdigest())
    shared = spark.sparkContext.broadcast((data, frequent))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        import pyarrow.compute as pc

        counts = once(key, lambda: Counts(shared.value[0]).keep(unpack(shared.value[1])))
        for batch in batches:
            texts = batch.column(1)
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            n = [counts.of(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return read.mapInArrow(counted, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
