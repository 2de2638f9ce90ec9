"""Operator 8: near duplicates among embeddings by p-stable Euclidean hashing.

Vectors are normalised, so cosine >= c means distance <= sqrt(2 - 2c).  Each of T
tables hashes a vector by m quantised Gaussian projections ``floor((a.x + b) / w)``;
vectors of one label that share a table's bucket are compared exactly, in double
precision, as matrix products.  With the defaults a pair at the threshold
distance shares no bucket of any table with probability about 0.002, closer pairs
with much less.

Equal vectors of a label are one vertex with a multiplicity, named by a hash of its
content that is drawn anew should two contents share one.  Buckets with one vertex send
nothing.  A vertex carries its T bucket codes, so a pair that meets in several tables is
counted in the first only; links are added up in the bucket and leave it as one row for
each vertex (its count, and a smaller vertex of its part of the bucket), never as pairs.
Buckets above ``BLOCK`` vertices fall into blocks, compared two at a time.  Buckets come
to a task one after the other in sorted batches, so that a small one costs no more than
its few products; the earlier tables of a pair are looked up for linked pairs only.

Results: one row per input row.  Rows whose vector is null, empty, zero or holds null
or non-finite components, or whose label is null, link with nothing and are their own
component.  Vectors of different lengths do not link.  A row linked to others counts
each of them once, equal ones too; a repeated id counts as rows, not as ids.  Extra
columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linemend.llm.base import cut_table, lean, sorted_groups, table
from linemend.llm.components import components
from linemend.llm.vectors import matrix, valid

COSINE, TABLES, PROJECTIONS, WIDTH, SEED = 0.93, 32, 8, 1.5, 11
BLOCK, PAIRS = 1024, 100_000
#: What names a group of vertices that are compared with each other.
KEYS = ("label", "dim", "t", "bucket", "p", "q")


def planes(dim: int, tables: int, projections: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.normal(size=(dim, tables * projections)), rng.uniform(0, width, tables * projections)


def codes(unit: np.ndarray, label: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """(rows, tables) 32-bit bucket codes; the bucket is the code."""
    a, b = planes(unit.shape[1], tables, projections, width, seed)
    cells = np.floor((unit @ a + b) / width).astype(np.int64).reshape(len(unit), tables, projections)
    acc = np.broadcast_to((label.astype(np.int64) * 1000003 + unit.shape[1])[:, None], cells.shape[:2]).astype(np.uint64)
    for j in range(projections):
        acc = (acc ^ cells[:, :, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
    return (acc >> np.uint64(16)).astype(np.uint32)


def _smallest_mates(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row the smallest id of its connected part of a symmetric relation."""
    best = ids.copy()
    while True:
        near = np.where(linked, best[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(best, near)
        if (new == best).all():
            return best
        best = new


def _links(ids: np.ndarray, times: np.ndarray, units: list[bytes], codes_: list[bytes], t: int, part: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(v, links, smallest mate) of the vertices of a bucket that have any, in table ``t``.
    ``part``: the block of each vertex, where two blocks meet."""
    unit = np.frombuffer(b"".join(units), np.float64).reshape(len(ids), -1)
    linked = (unit @ unit.T >= cosine) & (ids[:, None] != ids[None, :])
    if part is not None:
        linked &= part[:, None] != part[None, :]
    if not linked.any():
        return ids[:0], ids[:0], ids[:0]
    mates, n = _smallest_mates(linked, ids), np.zeros(len(ids), np.int64)
    left, right = np.nonzero(np.triu(linked))
    code = np.frombuffer(b"".join(codes_), np.uint32).reshape(len(ids), -1)[:, :t]
    for k in range(0, len(left), PAIRS):
        i, j = left[k : k + PAIRS], right[k : k + PAIRS]
        fresh = ~(code[i] == code[j]).any(axis=1)  # met in no earlier table
        np.add.at(n, i[fresh], times[j[fresh]])
        np.add.at(n, j[fresh], times[i[fresh]])
    some = (n > 0) | (mates != ids)
    return ids[some], n[some], mates[some]


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH, seed: int = SEED,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.  See the module for edge cases."""
    read = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"), F.col(label_col).cast("long").alias("label"))
    good = read.where(valid(F.col("x")) & F.col("label").isNotNull() & F.col("id").isNotNull())
    # equal vectors of a label: one vertex
    contents = cut_table(good.groupBy("label", "x").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("times")), "near-vertices")
    draw, total = 0, contents.count()
    name = lambda: F.xxhash64("label", "x", F.lit(draw))
    while contents.select(name().alias("v")).distinct().count() < total:  # two contents share a name
        draw += 1
    keyed, vertices = good.select("id", name().alias("v")), contents.withColumn("v", name())

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for whole in batches:
            for k in range(0, whole.num_rows, 2048):
                batch = whole.slice(k, 2048)
                rows = matrix(batch.column(3))
                by_size: dict[int, list[int]] = {}
                for i, x in enumerate(rows):
                    by_size.setdefault(len(x), []).append(i)
                for at in by_size.values():
                    m = np.stack([rows[i] for i in at])
                    unit = m / np.abs(m).max(axis=1, keepdims=True)  # first, so that squares neither vanish nor overflow
                    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
                    label = batch.column(2).to_numpy()[at]
                    code = codes(unit, label, tables, projections, width, seed)
                    take = pa.array(at)
                    yield pa.RecordBatch.from_pydict({
                        "v": batch.column(0).take(take), "times": batch.column(1).take(take), "label": batch.column(2).take(take),
                        "unit": pa.array([u.tobytes() for u in unit], pa.binary()), "codes": pa.array([c.tobytes() for c in code], pa.binary()),
                        "buckets": pa.array(code.astype(np.int64).tolist(), pa.list_(pa.int64())),
                    })

    signed = cut_table(vertices.select("v", "times", "label", "x").mapInArrow(hashed, "v bigint, times bigint, label bigint, unit binary, codes binary, buckets array<bigint>"), "near-signed")
    entries = signed.select("v", "label", F.length("unit").alias("dim"), F.posexplode("buckets").alias("t", "bucket"))
    sizes = entries.groupBy("label", "dim", "t", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = sizes.select("label", "dim", "t", "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")
    met = entries.join(parts, ["label", "dim", "t", "bucket"]).withColumn("own", own)
    # block pairs (p, q), p <= q, that a vertex takes part in
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("p"), F.greatest(o, F.col("own")).alias("q")))
    placed = met.withColumn("pq", F.explode(pairs)).select("v", "label", "dim", "t", "bucket", F.col("pq.p").alias("p"), F.col("pq.q").alias("q"), "own")
    sent = placed.join(signed.select("v", "times", "unit", "codes"), "v")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for chunk, bounds in sorted_groups(batches, len(KEYS)):
            t, p, q, part, ids, times = (chunk.column(c).to_numpy() for c in ("t", "p", "q", "own", "v", "times"))
            codes_, units = chunk.column("codes").to_pylist(), chunk.column("unit").to_pylist()
            found = [
                _links(ids[a:b], times[a:b], units[a:b], codes_[a:b], int(t[a]), part[a:b] if p[a] != q[a] else None, cosine)
                for a, b in zip(bounds, bounds[1:], strict=False)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*found, strict=True)], names=["v", "n", "mate"])

    ordered = sent.select(*KEYS, "own", "v", "times", "unit", "codes").repartition(*KEYS).sortWithinPartitions(*KEYS)
    found = cut_table(ordered.mapInArrow(compared, "v bigint, n bigint, mate bigint"), "near-found")
    roots = components(found.where("v <> mate").select(F.col("v").alias("a"), F.col("mate").alias("b")).distinct())
    counts = found.groupBy("v").agg(F.sum("n").alias("n"))
    grouped = vertices.select("v", "id", "times").join(roots, "v", "left").withColumn("c", F.coalesce("root", "v"))
    smallest = grouped.groupBy("c").agg(F.min("id").alias("component_id"))
    of_vertex = cut_table(
        grouped.join(smallest, "c").join(counts, "v", "left").select("v", (F.col("times") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"),
        "near-vertex-results",
    )
    linked_rows = keyed.select("id", "v").join(of_vertex, "v").select("id", "n_links", "component_id")
    alone = read.where(~(valid(F.col("x")) & F.col("label").isNotNull() & F.col("id").isNotNull())).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked_rows.unionByName(alone)
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def miss_rate(cosine: float, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH) -> float:
    """Probability that a pair at exactly this cosine shares no bucket."""
    ratio = width / math.sqrt(max(2 - 2 * cosine, 1e-12))
    below = 0.5 * math.erfc(ratio / math.sqrt(2))
    one = 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))
    return (1 - one**projections) ** tables


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
