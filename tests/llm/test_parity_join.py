import random

import numpy as np

from linemend.llm import parity_join as P
from linemend.llm.components import components


def brute(rows, num=85, den=100, k=4):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    return [(doc, len(sets[i]), min((x for x in groups[find(i)] if x is not None), default=None) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def corpus(seed, n=120):
    rng, rows, doc = random.Random(seed), [], 0
    words = [f"w{i}" for i in range(400)]
    while len(rows) < n:
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 5, 8, 12, 30, 60, 200]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                at = rng.randrange(len(copy))
                copy[at : at + rng.choice([0, 1, 1])] = [rng.choice(words)]
            rows.append((doc * 7 % 1000, " ".join(copy)))
            doc += 1
    return rows


def got(spark, rows, extra=""):
    df = spark.createDataFrame([(*r, *(["x"] if extra else [])) for r in rows], f"doc_id long, text string{extra}")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in P.jaccard_join(df).collect()), key=str)


def test_against_brute_force(spark):
    for seed in range(2):
        rows = corpus(seed)
        assert got(spark, rows) == sorted(brute(rows), key=str)


def test_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(6000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "A b"), (5, "a B"), (5, "a B"), (6, long), (7, long + " end"), (None, long), (9, "é É"), (10, "é É "), (11, "x\x0by z\x0cq"), (12, "x y z q"), (None, None)]
    assert got(spark, rows, ", n string") == sorted(brute(rows), key=str)


def test_empty(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None)]) == [(1, 0, 1)]


def test_large_groups_of_copies(spark):
    base = [f"t{i}" for i in range(80)]
    rows = [(i, " ".join(base)) for i in range(50)] + [(100 + i, " ".join([*base[:i], f"z{i}", *base[i + 1 :]])) for i in range(0, 80, 2)]
    assert got(spark, rows) == sorted(brute(rows), key=str)


def test_words_of_a_band_are_enough():
    """Pigeonhole: a pair at the bound shares a key, whatever differs."""
    rng, bands = np.random.default_rng(0), P.Bands()
    sketch = P.Sketcher(bands)
    for size in (6, 7, 13, 14, 20, 33, 75, 150, 900):
        for _ in range(30):
            a = np.unique(rng.integers(1 << 63, size=size).astype(np.uint64))
            gone = bands.most_apart(2 * size) // 2
            b = np.unique(np.concatenate([a[rng.permutation(size)[gone:]], rng.integers(1 << 63, size=gone).astype(np.uint64)]))
            inter = len(np.intersect1d(a, b))
            assert P.least_apart(P.bit_sketch(a), P.bit_sketch(b)) <= len(a) + len(b) - 2 * inter
            if 100 * inter >= 85 * (len(a) + len(b) - inter) and (len(a) != len(b) or inter < len(a)):
                assert set(sketch.keys(a)) & set(sketch.keys(b)), size


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(50, 51), (52, 51), (60, 60), (None, 3), (70, 71), (71, 70)]
    out = dict((r.v, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert out == {i: 1 for i in range(2, 31)} | {51: 50, 52: 50, 71: 70}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_with_too_few_filled_words_meet_in_further_sketches(monkeypatch):
    """With as few words as there can be, most sets fill too few in some sketch."""
    class Tight(P.Bands):
        def words(self, c):
            k, n = super().words(c)
            return k, k + 1 if n else 0

    rng, sketch, several = np.random.default_rng(1), P.Sketcher(Tight()), 0
    for size in (7, 13, 20, 33, 75):
        for _ in range(40):
            a = np.unique(rng.integers(1 << 63, size=size).astype(np.uint64))
            gone = P.Bands().most_apart(2 * size) // 2
            b = np.unique(np.concatenate([a[rng.permutation(size)[gone:]], rng.integers(1 << 63, size=gone).astype(np.uint64)]))
            inter = len(np.intersect1d(a, b))
            if 100 * inter >= 85 * (len(a) + len(b) - inter):
                assert set(sketch.keys(a)) & set(sketch.keys(b)), size
                several += len(sketch.keys(a)) > 2 * (Tight().words(Tight().band(size))[1])
    assert several


def test_groups_bounded_by_bytes(spark, monkeypatch):
    """Blocks cut by bytes give the same groups."""
    monkeypatch.setattr(P, "GROUP_BYTES", 2_000)
    rows = corpus(7, 80)
    assert got(spark, rows) == sorted(brute(rows), key=str)


def test_one_python_function_a_stage(spark):
    """Thinning texts and making sets meet over a shuffle, however few the sets are: with a
    broadcast they share a stage, and executors hold twice as many Python workers."""
    docs = spark.createDataFrame([(i, f"a b c d e{i}") for i in range(9)], "id long, text string")
    members = spark.createDataFrame([(i, P.set_id(P.shingles(f"a b c d e{i}"))) for i in range(9)], "id long, v long")
    out = P._sets(docs, members, members.select("v").limit(3), 4)
    assert {r.v for r in out.collect()} <= {r.v for r in members.collect()} and out.count() == 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    upper, lower = [at for at in range(len(plan)) if plan.startswith("MapInArrow", at)][:2]
    assert "Exchange hashpartitioning" in plan[upper:lower] and "BroadcastHashJoin" not in plan[upper:lower]


def shuffled(spark, action):
    """What ``action`` returns, and the bytes and rows that its stages wrote to shuffles."""
    sc = spark.sparkContext

    def stages() -> dict:
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        found = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return {x.stageId(): x for x in map(found.apply, range(found.size()))}

    last = max(stages(), default=-1)
    out = action()
    made = [x for k, x in stages().items() if k > last]
    return out, {"bytes": sum(x.shuffleWriteBytes() for x in made), "rows": sum(x.shuffleWriteRecords() for x in made)}


def test_keys_with_equal_sets_are_compared_once(spark):
    """Copies share many keys: their sketches go to one of them, and no other pair is lost."""
    rng = np.random.default_rng(3)
    sketch = lambda: rng.integers(0, 256, 1 << 16, dtype=np.uint8)
    sets = {}
    for v in (11, 21, 31):  # v + 1 is near v, all else is far
        sets[v] = sketch()
        sets[v + 1] = sets[v].copy()
        sets[v + 1][0] ^= 1
    n = 200_000
    sketches = spark.createDataFrame([(v, x.tobytes(), n) for v, x in sets.items()], "v long, bits binary, n long").persist()
    # (11, 11, 12) and (12, 21, 21) hold other sets, though doubled ones cancel out
    keys = [[11, 12]] * 60 + [[11, 12, 21]] + [[11, 11, 12], [12, 21, 21], [21, 22, 31, 31], [22, 31, 31], [31, 32]]
    rows = spark.createDataFrame([(k, v, v) for k, held in enumerate(keys) for v in held], "key long, v long, c long")
    edges, written = shuffled(spark, lambda: sorted((r.a, r.b) for r in P._crossing(rows, sketches, P.Bands()).collect()))
    sketches.unpersist()
    assert edges == [(11, 12), (21, 22), (31, 32)]
    assert written["bytes"] < 60 * (1 << 16)
