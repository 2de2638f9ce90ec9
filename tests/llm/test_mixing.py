import math
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linemend.llm import mixing
from linemend.llm.mixing import PIECE, exact_shares, mix, mix_in_order, phase, schedule


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=8))
def test_windows_and_deviation(share):
    """Replayed against the definition: every block inside its window, and no source a
    block or more from its target at any slot."""
    whole, period = exact_shares(share), sum(exact_shares(share))
    slots = phase(whole, [2 * x for x in whole])
    flat = sorted(s for x in slots for s in x)
    assert flat == list(range(len(flat)))
    for e, at in zip(whole, slots):
        for k, slot in enumerate(at):
            assert k * period // e <= slot < -(-(k + 1) * period // e)
        for t in range(len(flat) + 1):
            assert abs(Fraction(sum(s < t for s in at)) - Fraction(t * e, period)) < 1


def slow(blocks, weights):
    """slot -> (source, block)."""
    out = {}
    for s, at in schedule(blocks, weights).items():
        for k, slot in enumerate(at):
            assert slot not in out
            out[slot] = (s, k)
    return out


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 3000), min_size=1), st.data())
def test_every_block_once(blocks, data):
    weights = {s: data.draw(st.floats(0.1, 10)) for s in blocks if data.draw(st.booleans())}
    out = slow(blocks, weights)
    assert sorted(out) == list(range(sum(blocks.values())))
    for s, n in blocks.items():
        assert [k for _, (x, k) in sorted(out.items()) if x == s] == list(range(n))


def test_operator(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "x", 1) for i in range(900)] + [(None, None, None, 2), (5, "hot", "x", 1), (5, "hot", "x", 1), (10**12, None, "y", 3)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, slot int")
    out = mix(df, block_rows=8).orderBy("position").collect()
    assert len(out) == len(rows) and len({r.position for r in out}) == len(rows)
    assert set(out[0].asDict()) == {"doc_id", "source", "text", "block", "slot", "position"}
    by = {}
    for r in out:
        assert r.position // 8 == r.slot
        by.setdefault(r.source, []).append(r.block)
    for blocks in by.values():
        assert blocks == sorted(blocks) and set(blocks) == set(range(math.ceil(len(blocks) / 8)))
    assert [r.position for r in mix(df, block_rows=8).orderBy("position").collect()] == [r.position for r in out]
    many = spark.createDataFrame([(i % 40, "hot" if i % 4 else "s", "x", 1) for i in range(400)], df.schema)
    again = mix_in_order(many, block_rows=8).collect()
    assert sorted(r.position for r in again) == sorted(r.position for r in mix(many, block_rows=8).collect())
    ordered = mix_in_order(df, block_rows=8).collect()
    assert [r.position for r in ordered] == sorted(r.position for r in ordered)
    assert sorted(map(tuple, ordered), key=str) == sorted(map(tuple, out), key=str)
    assert mix_in_order(df.limit(0)).count() == 0
    given_ = mix(df, {"hot": 1.0, "s0": float("nan"), None: None}, block_rows=8).collect()
    assert len(given_) == len(rows) and max(r.slot for r in given_ if r.source == "hot") < min(r.slot for r in given_ if r.source != "hot")
    assert mix(df.limit(0)).count() == 0


def test_target_weights_within_one_block_over_the_whole_run():
    """The bound holds against the weights given, and does not grow with t."""
    cases = [
        ([1.0, 1.0, 1.0], [30000] * 3),
        ([0.5, 0.3, 0.1, 0.06, 0.04], [30000, 18000, 6000, 3600, 2400]),
        ([0.9999, 0.0001], [30000, 30000]),
        ([math.sqrt(n) for n in (40000, 9001, 777, 35)], [2500, 563, 49, 3]),
    ]
    for weights, blocks in cases:
        names = [f"s{i}" for i in range(len(weights))]
        out = slow(dict(zip(names, blocks)), dict(zip(names, weights)))
        assert sorted(out) == list(range(sum(blocks)))
        exact = [Fraction(repr(w)) for w in weights]
        part = {s: w / sum(exact) for s, w in zip(names, exact)}
        left, count = dict(zip(names, blocks)), dict.fromkeys(names, 0)
        for t in range(sum(blocks)):
            count[out[t][0]] += 1
            for s in names:
                assert abs(count[s] * part[s].denominator - (t + 1) * part[s].numerator) < part[s].denominator, (weights, t)
            if count[out[t][0]] == left[out[t][0]]:
                break


def test_twenty_skewed_sources_and_tiny_weights():
    for weights, blocks in (([81.0] + [1.0] * 19, [8100] + [100] * 19), ([0.9999, 0.0001], [20_000, 3])):
        names = [f"s{i:02}" for i in range(len(weights))]
        out = slow(dict(zip(names, blocks)), dict(zip(names, weights)))
        total, count = sum(map(Fraction, map(repr, weights))), dict.fromkeys(names, 0)
        part = {s: Fraction(repr(w)) / total for s, w in zip(names, weights)}
        for t in range(10_000):
            count[out[t][0]] += 1
            assert all(abs(count[s] - (t + 1) * part[s]) < 1 for s in names)
            if count[out[t][0]] == blocks[names.index(out[t][0])]:
                break
        assert t > 9_000


def test_slots_in_pieces(spark):
    df = spark.range(6000).selectExpr("id doc_id", "if(id % 7 < 5, 'a', 'b') source")
    weights = {"a": math.sqrt(5), "b": math.sqrt(2)}
    out = mix(df, weights, block_rows=1).collect()
    want = slow(dict(Counter(r.source for r in out)), weights)
    assert {r.slot: (r.source, r.block) for r in out} == want and max(r.block for r in out) > 2 * PIECE


def test_clashing_names_and_bounds(spark, monkeypatch):
    names = ["_h", "_n", "h", "n", "r", "k", "row", "id", "starts", "own", "c_r", "a.b", "piece"]
    df = spark.createDataFrame([(i, "ab"[i % 3 == 0], *["x"] * len(names)) for i in range(60)], ", ".join(["doc_id long", "source string", *[f"`{n}` string" for n in names]]))
    for f in (mix, mix_in_order):
        out = f(df, block_rows=4)
        assert out.columns == [*df.columns, "block", "slot", "position"] and {tuple(r)[2:-3] for r in out.collect()} == {("x",) * len(names)}
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 3)  # blocks grow with the table
    assert {r.position // 20 - r.slot for r in mix(df).collect()} == {0}
    monkeypatch.setattr(mixing, "MOST_SOURCES", 1)
    with pytest.raises(ValueError):
        mix(df)


def test_the_schedule_needs_no_python_worker(spark):
    """Lists of rows would go through Python workers of their own kind on the executors."""
    rows = spark.createDataFrame([(i, "ab"[i % 3 > 1]) for i in range(50)] + [(50, None)], "id long, source string")
    pieces = mixing.Mixer(rows, None, 4)._pieces
    assert "Python" not in pieces._jdf.queryExecution().toRdd().toDebugString()
    slots = sorted(x for r in pieces.collect() for x in r.slots)
    assert slots == list(range(len(slots))) and {r.p_source for r in pieces.collect()} == {"a", "b", None}
