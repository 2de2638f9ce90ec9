"""TEI reading and writing, files, steps, streaming, and planted damage."""

import json

import pytest
from pyspark.sql import functions as F

from linemend.operators import steps as ST
from linemend.operators.breaks import breaks
from linemend.sources import corpus as D
from linemend.sources import files, tei
from linemend.streaming import growing

HEAD = "<TEI><teiHeader><encodingDesc><appInfo><application ident='marks' version='2.0' when='2026-08-14'/></appInfo></encodingDesc></teiHeader>"
ISSUE = (
    HEAD + "<facsimile><surface><zone points='0,0 900,0 900,200 0,200' rendition='TextRegion' subtype='paragraph' xml:id='r1'><zone points='0,0' rendition='Line' xml:id='l1'/></zone>"
    "<zone xml:id=\"r2\" subtype=\"ad\" rendition=\"TextRegion\" points='1,1'/><zone rendition='TextRegion' xml:id='r3' points=''/></surface></facsimile>"
    "<text><body><pb facs='#facs_1'/><p facs='#r1' n='1'><lg><l facs='#l1' wsb:break='word'>Auguste, &quot;Ge¬</l><l facs='#l2'>mahlin</l><l facs='#l3'></l></lg></p>"
    "<p n='2' facs=\"#r2\"><l n='1' facs='#l4'>a <hi>b</hi> &amp; c</l><pb facs='#facs_2'/></p><p facs='#r3'><l facs='#l5'>end¬</l></p></body></text></TEI>"
)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "b.xml").write_text(ISSUE, encoding="utf-8")
    (tmp_path / "a.xml").write_text(ISSUE.replace("version='2.0'", "version='1.9'"), encoding="utf-8")
    return str(tmp_path)


def test_reader(spark, folder):
    issues = tei.read_files(spark, folder, first=1)
    rows = [tuple(r) for r in tei.paragraphs(issues).orderBy("para").select("file", "para", "page", "region", "subtype", "lines", "facs", "marks", "has_markup").collect()]
    assert rows == [
        ("a.xml", 1, 1, "r1", "paragraph", ['Auguste, "Ge¬', "mahlin"], ["l1", "l2"], ["word", None], False),
        ("a.xml", 2, 1, "r2", "ad", ["a b & c"], ["l4"], [None], True),
        ("a.xml", 3, 2, "r3", "", ["end¬"], ["l5"], [None], False),
    ]
    assert {(r.region, r.subtype) for r in tei.regions(issues).collect()} == {("r1", "paragraph"), ("r2", "ad"), ("r3", "")}
    lines = D.lines_of(tei.paragraphs(issues), min_lines=1, skip_subtypes=("ad",))
    assert [(r.left, r.right) for r in breaks(lines).collect()] == [("Ge", "mahlin")]


def test_no_files_and_no_head(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tei.read_files(spark, str(tmp_path))
    bad = spark.createDataFrame([("x.xml", "<TEI><text/></TEI>")], "file string, xml string")
    with pytest.raises(Exception, match="no </teiHeader>"):
        tei.marker_versions(bad, "marks").collect()


def test_markers_and_steps(spark, folder):
    versions = {r.file: r.version for r in tei.marker_versions(tei.read_files(spark, folder), "marks").collect()}
    assert versions == {"a.xml": "1.9", "b.xml": "2.0"}
    steps = ST.step_table(spark, [(1, "read", None, True), (2, "correct", "fix", True), (3, "mark", "marks", True)])
    assert [r.name for r in ST.steps_after(steps, "correct").collect()] == ["mark"]
    markers = spark.createDataFrame([("a.xml", "marks", "1"), ("a.xml", "fix", "1")], "file string, ident string, version string")
    assert [r.ident for r in ST.outdated_markers(markers, steps, "correct").collect()] == ["marks"]
    with pytest.raises(ValueError):
        ST.steps_after(steps, "nowhere")


def test_writer_touches_one_line(spark, folder, tmp_path):
    new = tei.rewrite(ISSUE, {"l2": 'mah"lin', "l4": "never"}, {"l1": None, "l5": "unknown"})
    want = ISSUE.replace(">mahlin<", ">mah&quot;lin<").replace(" wsb:break='word'", "").replace("<l facs='#l5'>", "<l facs='#l5' wsb:break='unknown'>")
    assert new == want and tei.rewrite(ISSUE, {}) == ISSUE
    out = tmp_path / "out"
    out.mkdir()
    changes = spark.createDataFrame([("a.xml", "l2", "x")], "file string, facs string, after string")
    done = tei.write_issues(tei.read_files(spark, folder), changes, str(out)).collect()
    assert {r.file: r.n for r in done} == {"a.xml": 1, "b.xml": 0} and ">x<" in (out / "a.xml").read_text(encoding="utf-8") and (out / "b.xml").read_text(encoding="utf-8") == ISSUE


def test_image_lines_go(spark, folder):
    paras = tei.paragraphs(tei.read_files(spark, folder)).withColumn("subtype", F.when(F.col("region") == "r1", "image").otherwise(F.col("subtype")))
    assert all((r.lines == []) == (r.region == "r1") for r in tei.drop_image_lines(paras).collect())


def test_files(spark, tmp_path):
    assert files.read_store(spark, str(tmp_path / "none.csv"), "pairs").count() == 0
    (tmp_path / "s.csv").write_text("left,right,form,source,model,decided_on,note\na,b,join,llm,m,2026-01-01,\n")
    assert files.read_store(spark, str(tmp_path / "s.csv"), "pairs").head().form == "join"
    (tmp_path / "r.csv").write_text("﻿ Selte ; Seite \na;b\nc;d\na;x\nbad line\nHof;OHof\n", encoding="utf-8")
    rules = files.read_rules(spark, str(tmp_path / "r.csv"))
    assert rules == [(" Selte ", " Seite "), ("a", "x"), ("c", "d"), ("Hof", "OHof")] and files.compounding(rules) == [("Hof", "OHof")]
    (tmp_path / "ch.csv").write_text("kind,observed,intended,count,source,fitted_on\nsubstitution,r,n,5,x,d\ndeletion,,t,2,x,d\nline_ends,,n,100,x,d\n")
    subs, dels, ends = files.read_channel(spark, str(tmp_path / "ch.csv"))
    assert [tuple(r) for r in subs.collect()] == [("r", "n", 5)] and dels.head().n == 2 and ends.head().n == 100
    files.write_queue(spark.createDataFrame([("a", 1)], "k string, n int"), str(tmp_path / "q"))
    assert files.read_queue(spark, str(tmp_path / "q"), "k string, n int").head().n == 1
    files.write_report(spark.createDataFrame([("b", 2), ("a", 1)], "k string, n int"), str(tmp_path / "rep"), ["k"])
    assert spark.read.option("header", True).csv(str(tmp_path / "rep")).count() == 2


def test_growing_store(spark, tmp_path):
    arriving = tmp_path / "in"
    arriving.mkdir()
    put = lambda name, **row: (arriving / name).write_text(json.dumps(row))
    put("1.json", row_no=1, left="a", right="b", form="join", source="llm", note="")
    run = lambda: growing.merge_stream(spark, str(arriving), str(tmp_path / "store"), str(tmp_path / "ck")).awaitTermination()
    run()
    put("2.json", row_no=1, left="a", right="b", form="split", source="rule", note="")
    run()
    assert growing.latest(spark, str(tmp_path / "store")).head().form == "join"
    put("3.json", row_no=1, left="a", right="b", form="split", source="manual", note="")
    run()
    assert growing.latest(spark, str(tmp_path / "store")).head().form == "split"


def test_planted_damage_rejoins(spark, sf_dir):
    """Wrapped lines hold the document's tokens: only planted damage differs."""
    rows = D.rewrapped(D.table(spark, sf_dir, "documents")).limit(300).collect()
    for r in rows:
        assert len(r.lines) == len(r.labels) and r.labels[-1] is None and all(r.lines)
