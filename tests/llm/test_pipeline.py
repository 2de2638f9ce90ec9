import random
import re

from tokenizers import Tokenizer

import corpus_pipeline as C
from linemend.llm import mixing
from linemend.llm import toxicity as T
from linemend.llm.base import marked, table, tokenizer_file
from linemend.llm.pii import Pseudonyms
from tests.llm.test_parity_join import brute, shuffled


def test_stages_against_brute_force(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    start = {r.doc_id: r for r in docs.collect()}
    columns = docs.columns
    kept = []
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(C.STAGES) - 1:
            assert docs.columns == columns, name
        kept.append(docs.collect())
    toxic, near, private, mixed, encoded = kept

    dense = T.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).dense()
    assert {r.doc_id for r in toxic} == {i for i, r in start.items() if T.score(r.text, dense) < 0.7}
    groups = brute([(r.doc_id, r.text) for r in toxic])
    assert {r.doc_id for r in near} == {d for d, _, c in groups if d == c} and len(near) == len({r.doc_id for r in near})
    names = Pseudonyms()
    assert {(r.doc_id, r.text) for r in private} == {(r.doc_id, names.text(r.text)[0]) for r in near}
    assert sorted(map(tuple, mixed), key=str) == sorted(map(tuple, private), key=str)
    library = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in mixed}
    assert len(encoded) == len(mixed)
    for r in encoded:
        assert r.token_ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids


def test_run(spark, sf_dir):
    out = C.run(spark, sf_dir)
    n = out.count()
    assert 0 < n <= table(spark, sf_dir, "documents").count()
    assert [name for name, _ in C.STAGES] and all(re.fullmatch(r"\w+", name) for name, _ in C.STAGES)


def test_odd_rows(spark, sf_dir):
    rows = [(None, None, None, None, None), (None, "a b", "en", "s", 3), (1, None, "en", None, 0), (2, "", "en", "s", 0), (3, "x y z", "en", "s", 5), (3, "x y z", "en", "s", 5), (4, "X Y Z", "en", "t", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in C.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert sorted((r.doc_id for r in docs.collect()), key=str) == sorted([None, None, 1, 2, 3], key=str)
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in C.STAGES:
        empty = stage(spark, empty, sf_dir)
    assert empty.count() == 0


def test_schedule_reaches_the_result(spark, sf_dir, tmp_path):
    """Position survives part files that are dealt anew when they are read."""
    rows = [(i, f"t{i} " * (1 + i % 5 * 400), "en", "ab"[i % 7 > 4], 3) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = [r.doc_id for r in mixing.mix(docs).orderBy("position").collect()]
    C.mix_sources(spark, docs, sf_dir).write.parquet(str(tmp_path / "mixed"))
    files = list((tmp_path / "mixed").glob("part-*"))
    assert len(files) > 1
    out = C.encode(spark, spark.read.parquet(str(tmp_path / "mixed")), sf_dir).collect()
    assert [r.doc_id for r in sorted(out, key=lambda r: r.position)] == want
    assert sorted(r.position for r in out) == list(range(len(rows)))
    direct = C.encode(spark, C.mix_sources(spark, docs, sf_dir), sf_dir).collect()
    assert [r.doc_id for r in sorted(direct, key=lambda r: r.position)] == want


def test_near_copies_by_five_words_and_four_fifths(spark, sf_dir):
    """Copies at 0.80-0.85 of five-word shingles go; below 0.80 they stay."""
    base = [f"w{i}" for i in range(300)]
    edits = lambda at: [f"z{i}" if i in at else w for i, w in enumerate(base)]
    texts = [base, base[:273] + [f"y{i}" for i in range(27)], [f"u{i}" for i in range(1000)], [f"x{i}" if i % 45 == 20 else f"u{i}" for i in range(1000)], edits(range(50, 300, 20))]
    rows = [(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = {d for d, _, c in brute([r[:2] for r in rows], 80, 100, 5) if d == c}
    assert want == {0, 2, 4} and {r.doc_id for r in C.one_of_each_group(spark, docs, sf_dir).collect()} == want


def test_repeated_ids_go_by_their_own_group(spark, sf_dir):
    """An id that repeats with different texts: only the row that heads its group stays."""
    text = lambda p, n=40: " ".join(f"{p}{i}" for i in range(n))
    rows = [(1, text("a")), (2, text("a") + " end"), (2, text("b")), (3, text("b") + " end"), (4, text("c")), (4, text("c") + " end"), (5, ""), (5, text("a")), (5, None), (5, ""), (6, text("d")), (None, text("a"))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = sorted(((r.doc_id, r.text) for r in C.one_of_each_group(spark, docs, sf_dir).collect()), key=str)
    assert out == sorted([(1, text("a")), (2, text("b")), (4, text("c")), (5, ""), (5, None), (6, text("d")), (None, text("a"))], key=str)


def test_texts_that_surely_stay_are_not_shuffled(spark, sf_dir):
    """Only the texts of doubtful ids meet the table of ids; the rest pass."""
    rng = random.Random(4)
    texts = [" ".join("%016x" % rng.getrandbits(64) for _ in range(500)) for _ in range(240)]
    rows = [(i, texts[i % 220], "en", "s", 1) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = C.one_of_each_group(spark, docs, sf_dir)
        ids, written = shuffled(spark, lambda: sorted(r.doc_id for r in out.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert ids == list(range(220)) and written["bytes"] < sum(len(r[1]) for r in rows) / 4


def test_marks_miss_no_id(spark, monkeypatch):
    """Every listed id is marked, few others are; with too few bits more are marked, never fewer."""
    ids = [-(1 << 63), -7, -1, 0, (1 << 63) - 1, *range(1, 3000, 3)]
    rows = spark.createDataFrame([(i, "t") for i in [*ids, None, *range(10_000, 13_000)]], "doc_id long, text string")
    listed = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    found = marked(rows, "doc_id", listed, "_m").collect()
    assert {r.doc_id for r in found if r._m} >= set(ids) and 0 <= sum(r._m for r in found) - len(ids) < 500 and len(found) == len(ids) + 3001
    monkeypatch.setattr("linemend.llm.base.MARK_BITS", 8)
    monkeypatch.setattr("linemend.llm.base.BITMAP", 8)
    assert {r.doc_id for r in marked(rows, "doc_id", listed, "_m").collect() if r._m} >= set(ids)
    assert not any(r._m for r in marked(rows, "doc_id", listed.limit(0), "_m").collect())
