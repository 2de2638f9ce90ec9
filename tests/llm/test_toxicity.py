import numpy as np

from linemend.llm import toxicity as T


def rows(spark, n=400):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(200)]
    out, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = [words[k] for k in rng.integers(200, size=60)]
        if bad:
            for _ in range(3):
                text.insert(int(rng.integers(len(text))), ["vile", "nasty", "foul"][int(rng.integers(3))])
        out.append((i, " ".join(text), "en", "x"))
        labels.append((i, int(bad)))
    return spark.createDataFrame(out, "doc_id long, text string, lang string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = rows(spark)
    out = T.toxicity(docs, T.train(docs, labels)).withColumn("h", T.held_out("doc_id")).collect()
    held = [r for r in out if r.h]
    assert len(out) == 400 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in held]) > 0.95


def test_carry_keeps_columns_and_clean_rows(spark):
    docs, labels = rows(spark)
    w = T.train(docs, labels)
    kept = T.toxicity(docs, w, carry=True)
    assert kept.schema == docs.schema
    bad = {r.doc_id for r in T.toxicity(docs, w).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == set(range(400)) - bad


def test_odd_rows(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "!!"), (None, "x"), (3, "!!")], schema)
    none = spark.createDataFrame([(9, None), (None, 1)], "doc_id long, toxic int")
    out = T.toxicity(docs, T.train(docs, none)).collect()
    assert len(out) == 5 and all(r.score == 0.5 and r.predicted == 0 for r in out)
    assert T.toxicity(docs.limit(0), T.train(docs.limit(0), none.limit(0))).count() == 0


def test_ftrl_by_hand():
    """One coordinate, one step: z = g, weight = -(z - sign l1) / ((beta + sqrt n) / alpha)."""
    w = T.fit([(np.array([0], np.int32), 1)], epochs=1, alpha=0.5, beta=1.0, l1=0.1, l2=0.0, toxic_weight=1.0)
    assert w.at.tolist() == [0] and np.isclose(w.value[0], 0.4 / ((1 + 0.5) / 0.5))
    assert len(T.fit([(np.array([0], np.int32), 1)], epochs=1, l1=1.0, toxic_weight=1.0).at) == 0


def test_features():
    assert T.features(None).tolist() == [0]
    a = T.features("one two three")
    assert len(a) == 1 + 3 + 2 + 1 and set(T.features("One TWO three three")) >= set(a)


def test_packed_features_come_back():
    for x in (T.features(None), T.features("one two three two one " * 50), np.array([0, (1 << 20) - 1], np.int32)):
        assert T.unpacked(T.packed(x)).tolist() == x.tolist()


def test_bounds_on_rows_and_bytes(spark):
    """A repeated id and a bound on bytes: the fit takes fewer rows, whole ones."""
    docs, labels = rows(spark, 60)
    more = docs.union(docs).union(docs.withColumn("text", docs.lang))
    assert len(T.train(more, labels, max_bytes=4 * 400).at) <= len(T.train(more, labels).at)
    assert len(T.train(docs, labels, max_bytes=0).at) == 0
