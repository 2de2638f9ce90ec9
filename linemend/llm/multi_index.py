"""Operator 2: approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised apart, by K centroids each, so a pair of
centroids names one of K * K cells.  A query takes its distances to the
centroids of either half and walks the pairs in the order of their sum with a
heap, until the cells passed hold the wanted share of all rows; the rows of these cells
are then ranked by their exact distance.

Centroids are fitted by k-means on at most ``sample`` rows (a documented bound); every
row is indexed.  The share is calibrated on the same sample: the smallest at which
``aim`` of the sample's own nearest neighbours are passed.  Vectors with structure need
few cells; for vectors without any, most neighbours lie in cells far down the
order, the share nears a third of all rows and the search nears a blockwise scan.

Only centroids and cell counts reach the driver (K * K numbers, K at most
``MOST_CENTROIDS``).  Neighbouring cells form blocks of about ``PART_ROWS`` rows; a
crowded cell and the queries that visit a block are split, so tasks stay bounded.

Results: for each query the ``k`` nearest found, ties by id; all candidates if
there are fewer.  Rows whose vector is null, empty, zero or holds null or
non-finite components, with a null id, or of another length than the indexed ones, take
no part.  All rows with a query's id count as its own.  Extra columns are not carried.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linemend.llm.base import cut_table, lean, table
from linemend.llm.vectors import bounded_sample, matrix, valid

K_NEAREST, AIM, SAMPLE, OCCUPANCY, MOST_CENTROIDS, ROUNDS, SEED = 10, 0.96, 8192, 4, 512, 10, 5
TRIALS = 256
PART_ROWS, PART_QUERIES = 4096, 1024


def kmeans(points: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Lloyd's rounds from a k-means++ start."""
    rng = np.random.default_rng(seed)
    centres = points[rng.integers(len(points))][None]
    away = ((points - centres[0]) ** 2).sum(1)
    while len(centres) < k and away.max() > 0:
        centres = np.concatenate([centres, points[rng.choice(len(points), p=away / away.sum())][None]])
        away = np.minimum(away, ((points - centres[-1]) ** 2).sum(1))
    for _ in range(rounds):
        at = distances(points, centres).argmin(1)
        for i in range(len(centres)):
            if (mine := at == i).any():
                centres[i] = points[mine].mean(0)
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, points by centres."""
    return np.maximum((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None], 0)


def cells_in_order(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) by ascending ``left[i] + right[j]``: the multi-sequence walk."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap = [(left[a[0]] + right[b[0]], 0, 0)]
    while heap:
        _, x, y = heapq.heappop(heap)
        yield int(a[x]), int(b[y])
        if y + 1 < len(b):
            heapq.heappush(heap, (left[a[x]] + right[b[y + 1]], x, y + 1))
        if y == 0 and x + 1 < len(a):
            heapq.heappush(heap, (left[a[x + 1]] + right[b[0]], x + 1, 0))


def centroids_for(rows: int) -> int:
    return int(min(MOST_CENTROIDS, max(4, round((rows / OCCUPANCY) ** 0.5))))


def calibrated_share(points: np.ndarray, left: np.ndarray, right: np.ndarray, k: int, aim: float, trials: int = TRIALS) -> float:
    """Share of rows to pass so that ``aim`` of the k nearest of sample rows, among the
    sample, are passed."""
    if len(points) < 2:
        return 1.0
    half, reached = left.shape[1], []
    to_left, to_right = distances(points[:, :half], left).argmin(1), distances(points[:, half:], right).argmin(1)
    for q in range(0, len(points), max(1, len(points) // trials)):
        x = points[q : q + 1]
        d = ((points - x) ** 2).sum(1)
        d[q] = np.inf
        order = distances(x[:, :half], left)[0][to_left] + distances(x[:, half:], right)[0][to_right]
        near = np.argsort(d, kind="stable")[: min(k, len(points) - 1)]
        reached += [(order < order[n]).mean() for n in near]
    return float(min(1.0, np.quantile(reached, aim) + 0.02))


def blocks_of(counts: dict[int, int], rows: int = PART_ROWS) -> dict[int, tuple[int, int]]:
    """Cell -> (block, parts): runs of neighbouring cells, crowded ones by themselves."""
    out, block, held = {}, 0, 0
    for cell in sorted(counts):
        n = counts[cell]
        if held and held + n > rows:
            block, held = block + 1, 0
        out[cell] = (block, max(1, -(-n // rows)))
        held += n
    return out


def nearest(
    vectors: DataFrame, is_query: Column, k: int = K_NEAREST, aim: float = AIM, sample: int = SAMPLE, share: float | None = None, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance).  ``is_query`` is a
    condition on the input's columns; ``share`` overrides the calibration."""
    spark = vectors.sparkSession
    read = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    good = read.where(valid(F.col("x")) & F.col("id").isNotNull())
    points = bounded_sample(good, "id", "x", sample)
    dim = points.shape[1]
    good = good.where(F.size("x") == dim)
    rows_held = good.count()
    many = centroids_for(rows_held)
    half = (dim + 1) // 2
    left = kmeans(points[:, :half], many) if dim else np.zeros((1, 0))
    right = kmeans(points[:, half:], many) if dim > 1 else np.zeros((1, dim - half))
    if share is None:
        share = calibrated_share(points, left, right, k, aim)
    width, wanted = len(right), share * rows_held
    shared = spark.sparkContext.broadcast((left, right))

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        a, b = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                m = np.stack(matrix(batch.column(1)))
                cell = distances(m[:, :half], a).argmin(1) * width + distances(m[:, half:], b).argmin(1)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), batch.column(0), pa.array([x.tobytes() for x in m], pa.binary()), batch.column(2)], names=["cell", "id", "x", "asks"])

    index = cut_table(good.mapInArrow(indexed, "cell int, id bigint, x binary, asks boolean"), "multi-index")
    counts = {r.cell: r.n for r in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    placed = spark.sparkContext.broadcast((counts, blocks_of(counts)))

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        (a, b), (held, where) = shared.value, placed.value
        for batch in batches:
            for q, raw, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = np.frombuffer(raw, np.float64)[None]
                got, passed = 0, {}
                for i, j in cells_in_order(distances(x[:, :half], a)[0], distances(x[:, half:], b)[0]):
                    if n := held.get(i * width + j, 0):
                        block, parts = where[i * width + j]
                        for part in range(parts):
                            passed.setdefault((block, part), []).append(i * width + j)
                        got += n
                        if got >= max(k + own, wanted):  # its own rows are no candidates
                            break
                places = list(passed)
                for at in range(0, len(places), 256):
                    some = places[at : at + 256]
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([x for x, _ in some], pa.int32()), "part": pa.array([x for _, x in some], pa.int32()), "asker": pa.array([q] * len(some), pa.int64()),
                        "qx": pa.array([raw] * len(some), pa.binary()), "cells": pa.array([np.array(passed[x], np.int32).tobytes() for x in some], pa.binary()),
                    })

    plan = spark.createDataFrame([(c, b, p) for c, (b, p) in blocks_of(counts).items()], "cell int, block int, parts int")
    own = index.join(index.where("asks").select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("own"))
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = index.where("asks").select("id", "x").dropDuplicates(["id", "x"]).join(own, "id").repartition(parallel, "id").select("id", "x", "own")
    visits = cut_table(asked.mapInArrow(walked, "block int, part int, asker bigint, qx binary, cells binary"), "multi-visits")
    q_parts = visits.groupBy("block", "part").agg(F.ceil(F.count(F.lit(1)) / PART_QUERIES).cast("int").alias("q_parts"))
    # plan: a row for each cell, MOST_CENTROIDS squared at most
    rows = (
        index.join(F.broadcast(plan), "cell").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
        .join(q_parts, ["block", "part"])
        .select("block", "part", F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("q_part"), "cell", "id", "x")
    )
    queries = visits.join(q_parts, ["block", "part"]).select("block", "part", F.pmod(F.xxhash64("asker"), "q_parts").cast("int").alias("q_part"), "asker", "qx", "cells")

    def ranked(theirs: pa.Table, asking: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if theirs.num_rows and asking.num_rows:
            cells, ids = theirs.column("cell").to_numpy(), theirs.column("id").to_numpy()
            m = np.frombuffer(b"".join(theirs.column("x").to_pylist()), np.float64).reshape(len(ids), -1)
            names, cell_at = np.unique(cells, return_inverse=True)
            for q, raw, passed in zip(asking.column("asker").to_pylist(), asking.column("qx").to_pylist(), asking.column("cells").to_pylist(), strict=True):
                take = np.flatnonzero(np.isin(names, np.frombuffer(passed, np.int32))[cell_at] & (ids != q))
                d = np.sqrt(((m[take] - np.frombuffer(raw, np.float64)) ** 2).sum(1))
                if len(d) > k:  # ties at the k-th stay for the order by id
                    near = d <= np.partition(d, k - 1)[k - 1]
                    take, d = take[near], d[near]
                best = np.lexsort((ids[take], d))[:k]
                out["query_id"] += [q] * len(best)
                out["vec_id"] += ids[take[best]].tolist()
                out["score"] += d[best].tolist()
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()), "score": pa.array(out["score"], pa.float64())})

    keys = ["block", "part", "q_part"]
    found = rows.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(ranked, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_multi_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, F.pmod(F.col("vec_id"), F.lit(100)) == 0)
