"""Golden cases of notes, evaluation, reports, confusions, files and small helpers."""

import pytest
from pyspark.sql import functions as F

from linemend.functions import text as T
from linemend.operators import correction as K
from linemend.operators import evaluation as V
from linemend.operators import lexicon as L
from linemend.operators import lineends as E
from linemend.operators import notes as N
from linemend.operators import stores as S
from linemend.sources import corpus as D
from linemend.sources import files, tei


def test_gate(spark):
    cols = "left string, right string, left_correct string, right_correct string, confidence string, approved string"
    rows = [
        ("a", "*", "b", "*", "high", ""), ("a", "*", "a", "x", "high", "yes"), ("a", "*", "b", "*", "high", "no"), ("a", "*", "b", "*", "low", "yes"), ("a", "c", "a", "d", "high", ""), ("a", "c", "a", "c", "high", "yes"),
        ("a", "*", "b", "*", "medium", ""), ("a", "*", "b", "*", "sure", ""),
    ]
    df = spark.createDataFrame(rows, cols)
    assert [r.x for r in df.select(N.applies().alias("x")).collect()] == [True, False, False, True, True, False, False, False]
    assert [r.x for r in df.select(N.applies("medium").alias("x")).collect()][6:] == [True, False]


def test_note_answers(spark):
    rows = [("an", "dern", '{"left":"an","right":"deren","confidence":" High ","reason":"r"}'), ("an", "dern", "no"), ("an", "dern", '{"left":"so many words","right":"","confidence":"?"}')]
    out = [tuple(r) for r in N.note_answers(spark.createDataFrame(rows, "left string, right string, reply string")).collect()]
    assert out == [("an", "dern", "an", "deren", "high", "r"), ("an", "dern", "an", "dern", "low", "unparseable reply: no"), ("an", "dern", "an", "dern", "low", "")]


def test_confusions():
    assert E.confusions("r:nm, l:rl") == {"r": "nm", "l": "r"} and E.confusions("rnm") == {"r": "nm", "n": "rm", "m": "rn"}
    assert len(E.confusions("all")) == 30 and "a" not in E.confusions("all")["a"]
    for bad in ("", "rr:a,", "r:,b:c"):
        with pytest.raises(ValueError):
            E.confusions(bad)


def test_legacy_breaks(spark):
    for text, want in (("Hof¬ und x", "Hof-XXXund x"), ("a¬ Wien", "a-Wien"), ("fiel¬ geb. x", "fiel geb. x"), ("Vor¬ trag", "Vortrag"), ("Vaci¬ utca", "Vaci-utca"), ("a¬ ¬ b", "ab")):
        assert spark.createDataFrame([(text,)], "t string").select(T.without_breaks(F.col("t"), "¬ ").alias("x")).head().x == want


def test_small_helpers():
    assert S.parse_shard(" 1/4 ") == (1, 4) and [S.duration(x) for x in (47, 750, 11520.9)] == ["47s", "12m 30s", "3h 12m"]
    for bad in ("0/4", "5/4", "1", "a/b", "1/0"):
        with pytest.raises(ValueError):
            S.parse_shard(bad)


def test_lexicon_scope_flips_a_verdict(spark):
    """Words of one-line paragraphs do not count for breaks, but do for line ends."""
    paras = spark.createDataFrame([(1, 1, "s", ["x vor trag x"] * 6), (2, 1, "s", ["y vortrag y"]), (2, 2, "s", ["y vortrag vortrag y"])], "file long, para long, subtype string, lines array<string>")
    lines = D.lines_of(paras)
    uni, big = L.unigrams(lines), L.bigrams(lines)
    assert {r.w: (r.c, r.c_long) for r in uni.collect()} == {"vor": (6, 6), "trag": (6, 6), "vortrag": (3, 0)}
    assert {r.w for r in L.long_scope(uni).collect()} == {"vor", "trag"} and [tuple(r) for r in L.long_scope(big).collect()] == [("vor", "trag", 6, 0, 0)]


def test_recall_needs_both_classes(spark):
    paras = spark.createDataFrame([(1, 1, "s", ["x die auf nahme war y", "x der aufnahme nach y"] * 4), (1, 2, "s", ["x ge gend y"] * 3)], "file long, para long, subtype string, lines array<string>")
    lines = D.lines_of(paras, min_lines=2)
    uni, big = L.long_scope(L.unigrams(lines)), L.long_scope(L.bigrams(lines))
    pairs = spark.createDataFrame([("auf", "nahme"), ("ge", "gend")], "left string, right string")
    out = V.break_recall(V.break_gold(lines, pairs), uni, big, L.totals(uni)).collect()
    assert [(r.left, r.n_join, r.n_split, r.majority) for r in out] == [("auf", 4, 4, 0.5)] and 0 <= out[0].balanced <= 1


def test_rule_chains_without_cross_join(spark):
    rules = spark.createDataFrame([("a", "xbx"), ("b", "c"), ("bx", "d"), ("", "b"), ("q", "q")], "old string, new string")
    chains = K.rule_chains(rules)
    assert {tuple(r) for r in chains.collect()} == {("a", "xbx", "b"), ("a", "xbx", "bx")}
    assert "NestedLoop" not in chains._jdf.queryExecution().executedPlan().toString()


def test_report_files(spark, tmp_path):
    (tmp_path / "v.csv").write_text("verdict,reason,seen_at_line_end\nMISREAD,r->n,3\nMISREAD,r->n,2\nREVIEW,r->m,9\n")
    (tmp_path / "t.csv").write_text("missing,completion\n1,Antrag\n1,Tag\n2,Antrag\n")
    assert [tuple(r) for r in files.read_substitutions(spark, str(tmp_path / "v.csv")).collect()] == [("r", "n", 5)]
    assert [tuple(r) for r in files.read_deletions(spark, str(tmp_path / "t.csv")).collect()] == [("g", 2)]
    for day in ("2026-01-02", "2026-01-01"):
        (tmp_path / f"{day}_r.csv").write_text("x\n")
    assert files.newest(spark, str(tmp_path / "*_r.csv")).endswith("2026-01-02_r.csv") and files.dated("/a/", "r.csv", "2026-01-02") == "/a/2026-01-02_r.csv"
    with pytest.raises(FileNotFoundError):
        files.newest(spark, str(tmp_path / "none*.csv"))
    (tmp_path / "p.md").write_text("intro\n## system\nBe brief.\n\n## user\nPair: {left}\n")
    assert files.read_prompt(spark, str(tmp_path / "p.md"), ("system", "user")) == {"system": "Be brief.", "user": "Pair: {left}"}
    with pytest.raises(ValueError):
        files.read_prompt(spark, str(tmp_path / "p.md"), ("other",))
    one = spark.createDataFrame([("a", 1)], "k string, n int")
    files.append_rows(one, str(tmp_path / "store"))
    files.append_rows(one, str(tmp_path / "store"))
    assert spark.read.option("header", True).csv(str(tmp_path / "store")).count() == 2


def test_character_references(spark):
    for raw, want in (("a&#60;b", "a<b"), ("&#xFC;&#XFC;", "üü"), ("&amp;lt; &#38;lt; &lt;", "&lt; &lt; <"), ("&#128512; &#0; &no;", "😀 &#0; &no;")):
        assert spark.createDataFrame([(raw,)], "t string").select(tei._decoded(F.col("t")).alias("x")).head().x == want
