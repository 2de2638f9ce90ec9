import re
import sys
import time
import unicodedata

import numpy as np

from linemend.llm import langid as G


def docs(spark, n=300):
    rng = np.random.default_rng(0)
    parts = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "eit", "ung", "ver"], "cc": ["ção", "ñe", "ió", "os"]}
    rows = []
    for i in range(n):
        lang = sorted(parts)[i % 3]
        words = ["".join(parts[lang][k] for k in rng.integers(4, size=rng.integers(1, 4))) for _ in range(15)]
        rows.append((i, " ".join(words), lang, "s"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")


def test_held_out_accuracy(spark):
    d = docs(spark)
    out = G.predict(d, G.train(d, steps=150)).withColumn("h", G.held_out("doc_id")).join(d.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.h]
    assert held and np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_odd_rows(spark):
    d = docs(spark, 30)
    net = G.train(d, steps=5)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (None, "ka lo"), (5, "é" * 5000), (5, "é" * 5000)], "doc_id long, text string")
    out = {r.doc_id: (r.lang_pred, r.score) for r in G.predict(odd, net).collect()}
    assert out[1] == out[2] == out[3] == ("und", 0.0) and out[None][0] in "aa bb cc" and out[5][0] != "und"
    assert G.predict(odd.limit(0), net).count() == 0
    none = G.train(d.where("false"))
    assert none is None and {r.lang_pred for r in G.predict(odd, none).collect()} == {"und"}


def test_gradients_against_differences():
    net = G.BiGRU(["a", "b"], seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    pieces, labels = [b"abc", b"d", b"hello"], np.array([0, 1, 1])
    codes, mask = net.batch(pieces)
    _, g = net.gradients(codes, mask, labels)
    rng = np.random.default_rng(2)
    for k in net.p:
        at = tuple(int(rng.integers(s)) for s in net.p[k].shape) if k != "table" else (ord("l"), 3)
        old, eps = net.p[k][at], 1e-2
        net.p[k][at] = old + eps
        up = net.gradients(codes, mask, labels)[0]
        net.p[k][at] = old - eps
        down = net.gradients(codes, mask, labels)[0]
        net.p[k][at] = old
        assert abs((up - down) / (2 * eps) - g[k][at]) < 2e-3, k


def test_cache_gives_the_same():
    net = G.BiGRU(["a", "b"], seed=1)
    one, many = G.Reader(net.langs, net.p), G.Reader(net.langs, net.p)
    texts = [["abc", "xy"], ["abc", "q" * 100], ["zz"]]
    many.learn(texts)
    for t in texts:
        one.learn([t])
        a, b = one.pooled(t), many.pooled(t)
        assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-5


def test_letters_are_unicode_letters():
    assert G.letter_runs("² ½ Ⅷ ٣ _ 12") == [] and G.letter_runs("a²b ªß 東京9") == ["a", "b", "ªß", "東京"]


def test_a_repeated_id_and_a_huge_text_teach_once(spark):
    d = docs(spark, 60).select("doc_id", "text", "lang")
    more = spark.createDataFrame([(1, "ka lo mi " * 40_000, "aa")] * 20, "doc_id long, text string, lang string")
    net = G.train(d.union(more), max_docs=50, steps=20)
    assert net.langs == ["aa", "bb", "cc"]


def test_every_character_is_in_a_run_or_not_by_its_category():
    for top in (0xFFFF, sys.maxunicode):
        text = "".join(f"{chr(c)} " for c in range(top + 1) if not 0xD800 <= c < 0xE000).lower()
        want = "".join(c if unicodedata.category(c).startswith("L") else " " for c in text).split()
        assert G.letter_runs(text) == want


def test_runs_cost_what_a_plain_pattern_costs():
    """Numbers above U+FFFF were tried one by one at every letter, ten times the time."""
    text = "Straße und Wörter, über 12 Zeilen; çà et là. " * 3000
    plain = re.compile(r"[^\W\d_]+").findall

    def best(f):
        took = []
        for _ in range(5):
            start = time.thread_time()
            f()
            took.append(time.thread_time() - start)
        return min(took)

    assert G.letter_runs(text) == plain(text.lower())
    assert best(lambda: G.letter_runs(text)) < 4 * best(lambda: plain(text.lower()))
