import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from linemend.llm import multi_index as M
from linemend.llm import near_vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")
ODD = [(9001, None, 1), (9002, [0.0] * 8, 1), (9003, [NAN] + [1.0] * 7, 1), (9004, [INF] + [1.0] * 7, 1), (9005, [], 1), (9006, [None] + [1.0] * 7, 1), (9100, [0.0] * 8, 1)]


def clustered(seed, n, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [(i, (centres[i % 12] + rng.normal(scale=0.12, size=dim)).astype(np.float32).tolist(), i % 3) for i in range(n)]


def near_brute(rows, cosine=0.93):
    good = [(i, np.array(x, float), l) for i, x, l in rows if x and l is not None and all(v is not None and math.isfinite(v) for v in x) and any(x)]
    links, root = {}, {k: k for k in range(len(good))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    count = [0] * len(good)
    for a in range(len(good)):
        for b in range(a):
            (_, x, l), (_, y, m) = good[a], good[b]
            if l == m and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                count[a] += 1
                count[b] += 1
                root[find(a)] = find(b)
    least = {}
    for k, (i, _, _) in enumerate(good):
        least[find(k)] = min(least.get(find(k), i), i)
    out = [(i, count[k], least[find(k)]) for k, (i, _, _) in enumerate(good)]
    taken = [i for i, _, _ in good]
    for i, *_ in rows:
        if i in taken:
            taken.remove(i)
        else:
            out.append((i, 0, i))
    return sorted(out, key=str), links


def near(spark, rows, schema=SCHEMA):
    out = V.near_vectors(spark.createDataFrame(rows, schema)).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=str)


def test_near_against_brute_force(spark):
    rows = clustered(1, 150)
    rows += [(500 + i, rows[i % 5][1], rows[i % 5][2]) for i in range(25)] + [(600, [2 * x for x in rows[0][1]], 0), (601, rows[0][1], None), (602, rows[0][1][:4], 0), *ODD]
    got, want = near(spark, rows), near_brute(rows)[0]
    assert [r[0] for r in got] == [r[0] for r in want]
    # hashing may miss a pair at the threshold, and never adds one
    assert all(g[1] <= w[1] for g, w in zip(got, want)) and sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    assert sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.99 * len(want)
    assert [g for g in got if g[0] > 9000 or g[0] in (601, 602)] == [w for w in want if w[0] > 9000 or w[0] in (601, 602)]


def test_near_repeated_ids_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 7)
    rng = np.random.default_rng(2)
    base = rng.normal(size=8)
    rows = [(i, (base + rng.normal(scale=0.05, size=8)).astype(np.float32).tolist(), 1) for i in range(60)] + [(3, base.tolist(), 1), (3, (-base).tolist(), 1)]
    assert near(spark, rows) == near_brute(rows)[0]


def test_near_empty(spark):
    assert near(spark, []) == []
    assert near(spark, [(1, None, None)]) == [(1, 0, 1)]
    assert V.miss_rate(0.93) < 0.005 < V.miss_rate(0.7)


def search_brute(rows, every, k=10):
    good = [(i, np.array(x, float)) for i, x, _ in rows if x and all(v is not None and math.isfinite(v) for v in x) and any(x)]
    out = set()
    for q, x in good:
        if q % every == 0:
            d = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in good if i != q)
            out |= {(q, r + 1, i) for r, (_, i) in enumerate(d[:k])}
    return out


def search(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1.0) for r in rows], SCHEMA + ", score double")
    return M.nearest(df, F.pmod(F.col("vec_id"), F.lit(100)) == 0, **kw).collect()


def test_search_recall_and_scores(spark):
    rows = clustered(3, 3000) + ODD
    want, out = search_brute(rows, 100), search(spark, rows)
    found = {(r.query_id, r.vec_id) for r in out}
    assert len(found & {(q, i) for q, _, i in want}) >= 0.9 * len(want)
    by_id = {i: np.array(x, float) for i, x, _ in rows if x and None not in x}
    for r in out:
        assert r.score == pytest.approx(np.linalg.norm(by_id[r.query_id] - by_id[r.vec_id]), abs=1e-12) and r.vec_id != r.query_id
    for q in {r.query_id for r in out}:
        mine = sorted((r.rank, r.score, r.vec_id) for r in out if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def test_search_whole_share_is_exact_with_ties(spark):
    rows = clustered(4, 200)
    rows += [(1000 + i, rows[100][1], 1) for i in range(30)]
    assert {(r.query_id, r.rank, r.vec_id) for r in search(spark, rows, share=1.0)} == search_brute(rows, 100)


def test_search_small_and_empty(spark):
    assert search(spark, []) == []
    assert search(spark, ODD) == []
    assert [(r.query_id, r.vec_id, r.score) for r in search(spark, [(100, [1.0, 0.0], 1), (7, [1.0, 1.0], 1)])] == [(100, 7, 1.0)]
    assert search(spark, [(100, [1.0, 2.0], 1)]) == []


def test_crowded_cells_split(spark, monkeypatch):
    monkeypatch.setattr(M, "PART_ROWS", 16)
    monkeypatch.setattr(M, "PART_QUERIES", 2)
    rows = [(i * 20, [1.0, 2.0, 3.0, 4.0], 1) for i in range(100)]
    assert {(r.query_id, r.rank, r.vec_id) for r in search(spark, rows, share=1.0)} == search_brute(rows, 100)


def test_cells_in_order():
    rng = np.random.default_rng(0)
    a, b = rng.random(7), rng.random(5)
    sums = [a[i] + b[j] for i, j in M.cells_in_order(a, b)]
    assert sums == sorted(sums) and len(set(M.cells_in_order(a, b))) == 35


def test_search_recall_on_embeddings(spark):
    """The given vectors, which have hardly any structure."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    found = {(r.query_id, r.vec_id) for r in M.op2_multi_index_search(spark, "/root/testdata/sf0.01").collect()}
    want = {(q, i) for q, _, i in search_brute(rows, 100)}
    assert len(want) >= 50 and len(found & want) >= 0.9 * len(want)


def test_a_query_id_that_repeats_finds_others(spark):
    """Its own rows, nearest of all, are no candidates and do not fill the search."""
    rows = [(100, [1.0, 0.0, 0.0, float(i) / 1000], 1) for i in range(40)] + [(i, [0.0, 1.0, float(i), 1.0], 1) for i in range(1, 30)]
    out = search(spark, rows, share=0.0)
    assert len([r for r in out if r.query_id == 100]) >= 10 and all(r.vec_id != 100 for r in out)


def test_near_negative_zero_and_many_small_buckets(spark):
    rng = np.random.default_rng(9)
    rows = [(1, [0.0, 1.0, 0.0], 1), (2, [-0.0, 1.0, 0.0], 1), (3, [0.0, 2.0, -0.0], 1)]
    rows += [(100 + 2 * i + j, (x + j * 1e-3).tolist(), 2) for i, x in enumerate(rng.normal(size=(300, 3))) for j in (0, 1)]
    got, want = near(spark, rows), near_brute(rows)[0]
    assert [g for g in got if g[0] < 10] == [(1, 2, 1), (2, 2, 1), (3, 2, 1)]
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want) and all(g[1] <= w[1] for g, w in zip(got, want))
