"""Operator 4: n-gram Jaccard join by parity sketches.

A document is its set of word shingles.  A parity sketch XORs the hash of every
shingle into one of n words, the word being chosen by the hash; a shingle that
only one of two sets holds changes one word, so the number of words in which two
sketches differ (their Hamming distance over words) is at most the symmetric
difference of the sets.  Jaccard >= t bounds that difference by
``(a + b) (1 - t) / (1 + t)``.  Sizes fall into bands; with k the bound for the
largest size of a band and n > k words, two similar sets must agree in a word, and
each set joins by its words in its own band and in the higher ones where a
partner may be.  Words without shingles agree by chance, so they are not
joined on: n is large enough that nearly every set has more than k filled words, one
of which must then agree.  It is enough that one of the two sets has.  A set that has not
joins by a second sketch as well, whose words are dealt by another hash, and so on; two
sets that both have too few in one sketch both hold the next.  Only sets with too few
in all ``SKETCHES`` (hardly any) meet in a key of their own.

Steps, none of which holds more than one block of documents or a slice of keys:

1. Documents become blocks of (set ids, sketch words).  Equal sets share an id,
   and count once from here on.
2. Words occurring once can't join.  Blocks send sorted 32-bit fingerprints of
   their words to slices, which answer with a bit for each: seen elsewhere or not.
   Only words that are seen twice become rows (word, set).
3. The sets of a word are compared with its smallest set (linear in the group): first
   by bit sketches, in which each shingle flips one bit, so that a Hamming distance
   above the bound rules a pair out; then exact sets decide.  Components of the links
   are formed.
4. Where a word still holds several components, the bit sketches of its sets are
   compared with each other, in blocks inside a task.  Pairs of different components
   that sketches do not rule out form clusters; a task returns a spanning forest of
   them, never the pairs.  The sets of a cluster then meet in blocks, each pair in one
   place, where exact intersections are counted by matrix products; again only a
   spanning forest of the links leaves the task.  So no link between different
   components is missed, and rows stay linear in sets and keys.  Components again.

Comparisons are grouped by the smaller set, salted to a bounded number of partners.

Results: one row per input row.  Null or blank texts have no shingle, link with
nothing and are their own component.  A row with a null id belongs to the component of
its equal sets, but is no component's smallest id; a set that only such rows hold is
linked with no other set, and its component is null.  Extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linemend.llm.base import cut_table, drop_table, lean, once, small_batches, table
from linemend.llm.components import components

WORDS, NUMERATOR, DENOMINATOR = 4, 85, 100
RATIO = 1.5
BLOCK_DOCS, BLOCK_BYTES, SLICE_WORDS, PARTNERS, BLOCK_SETS, CLUSTER_SETS = 512, 4 << 20, 2_000_000, 128, 512, 256
#: Sketches that a set may need, and bytes of sets or bit sketches that meet in one group.
SKETCHES, GROUP_BYTES = 8, 6 << 20
WORD_CACHE, SEEN = 60_000, 100_000
FILTER_BITS = 26
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the result."""
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> _S)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 48:
            if len(self) >= WORD_CACHE:
                self.clear()
            self[word] = h
        return h


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Ascending hashes of the distinct shingles of a text."""
    found = (text or "").encode().lower().split()  # bytes: lowers A-Z, splits at 20 and 09-0D
    if not found:
        return np.empty(0, np.uint64)
    hashes = once(("parity", "words"), _Hashes)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    size = min(words, len(h))
    acc = h[: len(h) - size + 1].copy()
    for j in range(1, size):
        acc = mixed(acc) * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - size + 1 + j]
    acc = mixed(acc + np.uint64(size))
    acc.sort()
    return acc[np.concatenate(([True], acc[1:] != acc[:-1]))]


def set_id(s: np.ndarray) -> int:
    """A signed 64-bit id of a set (its content and size)."""
    a, b = np.bitwise_xor.reduce(mixed(s ^ _M1)), mixed(s ^ _M2).sum(dtype=np.uint64)
    return xxhash.xxh3_64_intdigest(b"%d:%d:%d" % (int(a), int(b), len(s))) - (1 << 63)


@dataclass(frozen=True)
class Bands:
    """Size bands for a threshold ``num / den``."""

    num: int = NUMERATOR
    den: int = DENOMINATOR
    ratio: float = RATIO

    def most_apart(self, total: int) -> int:
        """Largest symmetric difference of two linked sets of ``total`` elements together."""
        return total * (self.den - self.num) // (self.den + self.num)

    def low(self, c: int) -> int:
        size, i = 2, 0
        while i < c:
            size, i = max(size + 1, int(size * self.ratio)), i + 1
        return size

    def band(self, size: int) -> int:
        c = 0
        while self.low(c + 1) <= size:
            c += 1
        return c

    def words(self, c: int) -> tuple[int, int]:
        """(k, n) of a band: at most k words differ, n words in the sketch."""
        high = self.low(c + 1) - 1
        k = self.most_apart(2 * high)
        if k == 0:
            return 0, 0  # only equal sets link
        fill = self.low(c) * self.num // self.den / (k + 1)
        empty = float(np.exp(-fill * 0.93))
        return k, int(np.ceil((k + 1) / (1 - empty) + 3.2 * np.sqrt(empty * (k + 1)) + 0.5))

    def of(self, size: int) -> list[int]:
        """Own band and the higher ones where a linked larger set may be."""
        own, most = self.band(size), size * self.den // self.num
        out = [own]
        while self.low(out[-1] + 1) <= most:
            out.append(out[-1] + 1)
        return [c for c in out if self.words(c)[1]]


def bit_sketch(s: np.ndarray) -> np.ndarray:
    """Parity bits of a set, 2 to 4 for each shingle, packed; a power of two of them."""
    bits = 1 << max(6, int(len(s) * 2 - 1).bit_length())
    times = np.bincount((mixed(s ^ _M2) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((times & 1).astype(bool))


def least_apart(a: np.ndarray, b: np.ndarray) -> int:
    """Lower bound of the symmetric difference of two sets, from their bit sketches;
    the longer one is folded to the length of the shorter."""
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


class Sketcher:
    def __init__(self, bands: Bands):
        self._bands, self._plan = bands, {}

    def keys(self, s: np.ndarray) -> np.ndarray:
        """Join keys of a set: the filled words of its sketches, tagged with band, sketch
        and place.  Where too few are filled, those of another sketch, dealt anew, too."""
        size = len(s)
        if size not in self._plan:
            if len(self._plan) > 100_000:
                self._plan.clear()
            self._plan[size] = [(c, *self._bands.words(c)) for c in self._bands.of(size)] if size else []
        out, hashes = [], None
        for c, k, n in self._plan[size]:
            hashes = mixed(s + _M2) if hashes is None else hashes
            for seed in range(SKETCHES):
                drawn = s if seed == 0 else mixed(s ^ np.uint64(int(_M1) * (2 * seed + 1) % (1 << 64)))
                place, held = ((drawn >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32), hashes
                if seed:  # the first is ascending, as s is
                    order = np.argsort(place, kind="stable")
                    place, held = place[order], hashes[order]
                starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
                words = np.bitwise_xor.reduceat(held, starts)
                out.append(mixed(words + mixed(place[starts] + np.uint64((seed << 56) + (c << 32)))))
                if len(starts) > k:
                    break
            else:
                out.append(mixed(np.array([(c << 32) + 0xFFFFFFFF], np.uint64)))
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def _blocks(docs: DataFrame, bands: Bands, words: int) -> DataFrame:
    """One row per block: block, doc_ids, sets (null: no shingle), sizes, n_keys, keys,
    and the bit sketch of each set that has keys here."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        from pyspark import TaskContext

        task, count, sketch, seen = TaskContext.get().partitionId(), 0, Sketcher(bands), set()
        ids, sets, sizes, n_keys, keys, bits, held = [], [], [], [], [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "block": pa.array([(task << 32) + count], pa.int64()), "doc_ids": pa.array([ids], pa.list_(pa.int64())), "sets": pa.array([sets], pa.list_(pa.int64())),
                "sizes": pa.array([sizes], pa.list_(pa.int64())), "n_keys": pa.array([n_keys], pa.list_(pa.int32())), "keys": pa.array([b"".join(keys)], pa.binary()), "bits": pa.array([bits], pa.list_(pa.binary())),
            })

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = text.as_py()
                s = shingles(raw, words)
                own = set_id(s) if len(s) else None
                found, sketched = np.empty(0, np.uint64), None
                if own is not None and own not in seen:  # a set met before in this task has its keys already
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(own)
                    found, sketched = sketch.keys(s), bit_sketch(s).tobytes()
                ids.append(doc_id)
                sets.append(own)
                sizes.append(len(s))
                n_keys.append(len(found))
                keys.append(found.tobytes())
                bits.append(sketched)
                held += len(raw or "")
                if len(ids) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                    yield block()
                    count += 1
                    ids, sets, sizes, n_keys, keys, bits, held = [], [], [], [], [], [], 0
        if ids:
            yield block()
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(made, "block bigint, doc_ids array<bigint>, sets array<bigint>, sizes array<bigint>, n_keys array<int>, keys binary, bits array<binary>")


def _sliced(keys: np.ndarray, slices: int) -> np.ndarray:
    """Slice (high half) and 32-bit fingerprint (low half) of each key."""
    return ((keys >> np.uint64(32)) % np.uint64(slices)) << np.uint64(32) | keys & np.uint64(0xFFFFFFFF)


def _ranges(both: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """The slices present in ascending ``_sliced`` values, with start and end of each."""
    found, first = np.unique(both >> np.uint64(32), return_index=True)
    return found.tolist(), first.tolist(), [*first[1:].tolist(), len(both)]


def _shared_keys(blocks: DataFrame, slices: int) -> DataFrame:
    """(key, v) for keys whose fingerprint more than one set of the table has.

    A block sends a row to each slice that it has keys of: never more rows than keys,
    however many slices there are."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                both = np.unique(_sliced(np.frombuffer(raw, np.uint64), slices))
                prints = both.astype(np.uint32)
                some, low, high = _ranges(both)
                yield pa.RecordBatch.from_pydict({
                    "slice": pa.array(some, pa.int32()), "block": pa.array([block] * len(some), pa.int64()), "prints": pa.array([prints[i:j].tobytes() for i, j in zip(low, high, strict=True)], pa.binary()),
                })

    def answered(rows: pa.Table) -> pa.Table:
        lean()
        lists = [np.frombuffer(x, np.uint32) for x in rows.column("prints").to_pylist()]
        values, times = np.unique(np.concatenate(lists), return_counts=True)
        twice = values[times > 1]
        bits = []
        for x in lists:
            at = np.searchsorted(twice, x)
            hit = at < len(twice)
            hit[hit] = twice[at[hit]] == x[hit]
            bits.append(np.packbits(hit).tobytes())
        return pa.table({"block": rows.column("block"), "slice": rows.column("slice"), "bits": pa.array(bits, pa.binary())})

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            for _, sets, n_keys, raw, answers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = np.frombuffer(raw, np.uint64)
                both, back, times = np.unique(_sliced(keys, slices), return_inverse=True, return_counts=True)
                some, low, high = _ranges(both)
                where = dict(zip(some, zip(low, high, strict=True), strict=True))
                hit = times > 1
                for a in answers or ():
                    i, j = where[a["slice"]]
                    hit[i:j] |= np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=j - i).astype(bool)
                take = hit[back]
                owner = np.repeat(np.array([0 if s is None else s for s in sets], np.int64), n_keys)
                yield pa.RecordBatch.from_pydict({"key": pa.array(keys[take].view(np.int64), pa.int64()), "v": pa.array(owner[take], pa.int64())})

    with_keys = blocks.where(F.length("keys") > 0)
    prints = with_keys.select("block", "keys").mapInArrow(sent, "slice int, block bigint, prints binary")
    bits = prints.groupBy("slice").applyInArrow(answered, "block bigint, slice int, bits binary")
    per_block = bits.groupBy("block").agg(F.collect_list(F.struct("slice", "bits")).alias("answers"))
    return with_keys.select("block", "sets", "n_keys", "keys").join(per_block, "block").mapInArrow(kept, "key bigint, v bigint")


def _id_filter(ids: DataFrame, n: int) -> tuple[int, bytes]:
    """A bit for each hash of an id; size follows n up to 2**FILTER_BITS bits (8 MB),
    beyond which it only prunes less."""
    bits = int(min(FILTER_BITS, max(12, np.ceil(np.log2(max(n, 1) * 16)))))
    place = F.shiftrightunsigned(F.xxhash64("id"), 64 - bits)
    rows = ids.select(place.alias("p")).groupBy(F.shiftright("p", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 32 as int))")).alias("b")).collect()
    out = np.zeros(1 << (bits - 5), np.uint32)
    for r in rows:
        out[r.w] = r.b
    return bits, out.tobytes()


def _possible(pairs: DataFrame, sketches: DataFrame, bands: Bands) -> DataFrame:
    """Pairs (a < b) whose bit sketches do not rule them out, with the size of b."""

    def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            n = (batch.column(3).to_numpy() + batch.column(5).to_numpy()).tolist()
            near = [
                least_apart(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) <= bands.most_apart(total)
                for x, y, total in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), n, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(5)], names=["a", "b", "n_b"]).filter(pa.array(near, pa.bool_()))

    one = lambda key, mark: sketches.select(F.col("v").alias(key), F.col("bits").alias(f"bits_{mark}"), F.col("n").alias(f"n_{mark}"))
    sized = pairs.join(one("a", "a"), "a").join(one("b", "b"), "b")
    fits = (F.least("n_a", "n_b") * bands.den >= F.greatest("n_a", "n_b") * bands.num)
    return cut_table(sized.where(fits).select("a", "b", "bits_a", "n_a", "bits_b", "n_b").mapInArrow(thinned, "a bigint, b bigint, n_b bigint"), "parity-possible")


def spanning(linked: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """(smallest id of the part, id) for the other members of each connected part of
    a symmetric relation."""
    best = ids.copy()
    while True:
        new = np.minimum(best, np.where(linked, best[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == best).all():
            return [(int(a), int(b)) for a, b in zip(best, ids, strict=True) if a != b]
        best = new


def common_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Exact intersection sizes of all pairs of a block: products of 0/1 matrices over
    the shingles that occur twice, some columns at a time."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, times = np.unique(flat, return_inverse=True, return_counts=True)
    twice = times[at] > 1
    row, at = row[twice], (np.cumsum(times > 1) - 1)[at[twice]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, columns):
        a, b = np.searchsorted(at, (low, low + columns))
        held = np.zeros((len(sets), columns), np.float32)
        held[row[a:b], at[a:b] - low] = 1
        out += held @ held.T
    return out.astype(np.int64)


def _parts(sets: int, bytes_each: int) -> Column:
    """Blocks that a group of rows (``n``: shingles) is cut into: of so many sets, and of
    ``GROUP_BYTES`` together, at most."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / sets, F.sum("n") * bytes_each / GROUP_BYTES)).cast("int").alias("parts")


def _crossing(rows: DataFrame, sketches: DataFrame, bands: Bands) -> DataFrame:
    """Spanning edges (a, b) of the sets that share a key, differ in component and are not
    ruled out by sketches.  ``rows``: key, v, c.  Of keys that hold the same sets one is enough
    (a digest of them tells).  A key's sets fall into blocks of at most ``BLOCK_SETS``; two
    blocks of a key meet in one place each."""
    h = F.xxhash64("v")
    held = [F.count(F.lit(1)).alias("n_v"), F.bit_xor("v").alias("x_v"), F.sum(F.shiftrightunsigned(h, 32)).alias("high"), F.sum(h.bitwiseAND(0xFFFFFFFF)).alias("low")]
    parts = rows.join(sketches.select("v", "n"), "v").groupBy("key").agg(_parts(BLOCK_SETS, 1), *held)
    parts = parts.groupBy("n_v", "x_v", "high", "low", "parts").agg(F.min("key").alias("key")).select("key", "parts")
    placed = rows.join(parts, "key").withColumn("own", F.pmod(F.xxhash64("v"), "parts").cast("int"))
    meet = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("p"), F.greatest(o, F.col("own")).alias("q")))
    sent = placed.withColumn("pq", F.explode(meet)).select("key", "pq.p", "pq.q", "own", "v", "c").join(sketches, "v")
    dealt = sent.select("key", "p", "q", "own", "v", "c", "n", "bits").repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")

    def forest(group: list[tuple]) -> list[tuple[int, int]]:
        own, v, c, n = (np.array([r[i] for r in group]) for i in (3, 4, 5, 6))
        size = min(len(r[7]) for r in group)
        folded = np.zeros((len(group), -(-size // 8) * 8), np.uint8)
        for i, r in enumerate(group):
            x = np.frombuffer(r[7], np.uint8)
            while len(x) > size:
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            folded[i, :size] = x
        words = folded.view(np.uint64)
        near = np.zeros((len(group), len(group)), bool)
        for i in range(len(group) - 1):
            rest = slice(i + 1, None)
            apart = np.bitwise_count(words[i] ^ words[rest]).sum(1)
            near[i, rest] = (c[rest] != c[i]) & (apart * (bands.den + bands.num) <= (n[rest] + n[i]) * (bands.den - bands.num)) & (np.minimum(n[rest], n[i]) * bands.den >= np.maximum(n[rest], n[i]) * bands.num)
        if group[0][1] != group[0][2]:
            near &= own[:, None] != own[None, :]
        return spanning(near | near.T, v) if near.any() else []

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        def groups() -> Iterator[list[tuple]]:
            now: list[tuple] = []
            for batch in batches:
                for row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                    if now and row[:3] != now[0][:3]:
                        yield now
                        now = []
                    now.append(row)
            if now:
                yield now

        found: set[tuple[int, int]] = set()
        for group in groups():
            found.update(forest(group))
            if len(found) >= 50_000:
                yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})
                found.clear()
        yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return dealt.mapInArrow(compared, "a bigint, b bigint").distinct()


def _sets(docs: DataFrame, members: DataFrame, ends: DataFrame, words: int) -> DataFrame:
    """(v, s): the shingles of the sets with ids ``ends`` (distinct v)."""
    spark = docs.sparkSession
    # a document for each set, and its text: the scan is thinned by a small bit table first
    reps = cut_table(members.join(ends, "v").groupBy("v").agg(F.min("id").alias("id")), "parity-reps")
    bits, filled = _id_filter(reps.where("id is not null"), reps.count())
    shared = spark.sparkContext.broadcast(filled)
    schema = docs.schema

    def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        table_ = np.frombuffer(shared.value, np.uint32)
        for batch in batches:
            p = batch.column(2).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(batch.filter(pa.array((table_[p >> 5] >> (p & 31).astype(np.uint32)) & 1 == 1)).columns[:2], names=["id", "text"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for whole in batches:
            for k in range(0, whole.num_rows, BLOCK_DOCS):
                batch = whole.slice(k, BLOCK_DOCS)
                found = [shingles(t.as_py(), words) for t in batch.column(1)]
                right = [len(s) > 0 and set_id(s) == v for s, v in zip(found, batch.column(0).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in found], pa.binary())], names=["v", "s"]).filter(pa.array(right, pa.bool_()))

    place = F.shiftrightunsigned(F.xxhash64("id"), 64 - bits)
    texts = docs.where("id is not null").select("id", "text", place.alias("place")).mapInArrow(thinned, schema)
    # never a broadcast: two Python functions in one stage take two workers for each core, and an
    # executor keeps all its workers, with their caches, for later stages
    return texts.join(reps.hint("merge"), "id").select("v", "text").mapInArrow(sets, "v bigint, s binary")


def _linked(docs: DataFrame, members: DataFrame, pairs: DataFrame, bands: Bands, words: int) -> DataFrame:
    """Those of the distinct pairs (a < b, n_b) of set ids that reach the threshold."""
    salts = pairs.withColumnRenamed("n_b", "n").groupBy("a").agg(_parts(PARTNERS, 8))
    tasks = pairs.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("v"))
    tasks = tasks.union(salts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("v")))
    ends = pairs.select(F.col("a").alias("v")).union(pairs.select(F.col("b").alias("v"))).distinct()

    def decided(rows: pa.Table) -> pa.Table:
        lean()
        a = rows.column("a")[0].as_py()
        held = dict(zip(rows.column("v").to_pylist(), rows.column("s").to_pylist(), strict=True))
        first, out = np.frombuffer(held.pop(a, b""), np.uint64), []
        for v, raw in held.items() if len(first) else ():
            other = np.frombuffer(raw, np.uint64)
            at = np.searchsorted(first, other)
            at[at == len(first)] = 0
            common = int((first[at] == other).sum())
            if bands.den * common >= bands.num * (len(first) + len(other) - common):
                out.append(v)
        return pa.table({"a": pa.array([a] * len(out), pa.int64()), "b": pa.array(out, pa.int64())})

    vectors = _sets(docs, members, ends, words)
    sent = vectors.join(tasks, "v").select("a", "part", "v", "s")
    return cut_table(sent.groupBy("a", "part").applyInArrow(decided, "a bigint, b bigint"), "parity-links")


def _linked_clusters(docs: DataFrame, members: DataFrame, edges: DataFrame, sketches: DataFrame, bands: Bands, words: int) -> DataFrame:
    """Spanning edges (a, b) of the links inside the clusters that ``edges`` connect.

    A cluster's sets fall into blocks of ``CLUSTER_SETS``; two blocks meet in one place."""
    labels = components(edges)
    roots = labels.select(F.col("root").alias("v"), "root").distinct()
    placed = cut_table(labels.union(roots), "parity-clusters")
    parts = placed.join(sketches.select("v", "n"), "v").groupBy("root").agg(_parts(CLUSTER_SETS, 8))
    own = placed.join(parts, "root").withColumn("own", F.pmod(F.xxhash64("v"), "parts").cast("int"))
    meet = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("p"), F.greatest(o, F.col("own")).alias("q")))
    tasks = own.withColumn("pq", F.explode(meet)).select("root", "pq.p", "pq.q", "v")

    def decided(rows: pa.Table) -> pa.Table:
        lean()
        ids = rows.column("v").to_numpy()
        found = [np.frombuffer(x, np.uint64) for x in rows.column("s").to_pylist()]
        size = np.array([len(x) for x in found])
        common = common_counts(found)
        linked = bands.den * common >= bands.num * (size[:, None] + size[None, :] - common)
        out = spanning(linked, ids)
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    sent = _sets(docs, members, placed.select("v").distinct(), words).join(tasks, "v").select("root", "p", "q", "v", "s")
    return cut_table(sent.groupBy("root", "p", "q").applyInArrow(decided, "a bigint, b bigint"), "parity-cluster-links")


def jaccard_join(
    docs: DataFrame, words: int = WORDS, num: int = NUMERATOR, den: int = DENOMINATOR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, links_to (the smallest set id of
    the component, for joining members), set_id (the row's own).  See the module for
    edge cases."""
    bands = Bands(num, den)
    small_batches(docs.sparkSession)
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = cut_table(_blocks(read, bands, words), "parity-blocks")
    total = blocks.agg(F.sum(F.length("keys"))).head()[0] or 0
    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(min(parallel, 64), -(-total // (8 * SLICE_WORDS)))
    keys = cut_table(_shared_keys(blocks, slices), "parity-keys")
    members = cut_table(
        blocks.select(F.explode(F.arrays_zip("doc_ids", "sets", "sizes")).alias("x")).select(F.col("x.doc_ids").alias("id"), F.col("x.sets").alias("v"), F.col("x.sizes").alias("n")),
        "parity-members",
    )
    sketches = cut_table(
        blocks.select(F.explode(F.arrays_zip("sets", "bits", "sizes")).alias("x")).where("x.bits is not null")
        .groupBy(F.col("x.sets").alias("v")).agg(F.first("x.bits").alias("bits"), F.first("x.sizes").alias("n")),
        "parity-sketches",
    )
    drop_table(blocks)
    known = members.where("v is not null")

    leaders = keys.groupBy("key").agg(F.min("v").alias("a"), F.max("v").alias("last")).where("a < last").select("key", "a")
    stars = cut_table(keys.join(leaders, "key").where("v <> a").select("a", F.col("v").alias("b")).distinct(), "parity-stars")
    links = _linked(read, known, _possible(stars, sketches, bands), bands, words)
    first = components(links)

    # written out, since each is read more than once and would be shuffled anew each time
    labelled = cut_table(keys.join(first, "v", "left").select("key", "v", F.coalesce("root", "v").alias("c")), "parity-labelled")
    drop_table(keys)
    open_keys = labelled.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    open_rows = cut_table(labelled.join(open_keys, "key", "left_semi").select("key", "v", "c"), "parity-open")
    drop_table(labelled)
    near = cut_table(_crossing(open_rows, sketches, bands), "parity-near")
    drop_table(open_rows)
    if not near.isEmpty():
        first = components(links.union(_linked_clusters(read, known, near, sketches, bands, words)))

    labelled = members.join(first, "v", "left").select("id", "n", "v", F.coalesce("root", "v").alias("c"))
    smallest = cut_table(labelled.where("c is not null").groupBy("c").agg(F.min("id").alias("component_id")), "parity-smallest")
    return labelled.join(smallest, "c", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("c").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"), F.col("c").alias("links_to"), F.col("v").alias("set_id")
    )


def with_set_id(docs: DataFrame, words: int = WORDS, text_col: str = "text") -> DataFrame:
    """Adds ``set_id``, as ``jaccard_join`` gives it, null without shingles."""

    @F.pandas_udf("bigint")
    def own(texts: pd.Series) -> pd.Series:
        sets = (shingles(t, words) for t in texts)
        return pd.Series([set_id(s) if len(s) else None for s in sets], dtype="Int64")

    small_batches(docs.sparkSession)
    return docs.withColumn("set_id", own(F.col(text_col).cast("string")))


def op4_parity_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
