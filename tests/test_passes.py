"""How often queries read and wrap the documents, and that workers read lines as columns do."""

import random
import re

import pytest
from pyspark.sql import functions as F

from linemend.functions import text as T
from linemend.functions import words as W
from linemend.operators import lexicon as L
from linemend.operators import lineends as E
from linemend.plans import catalog
from linemend.sources import corpus as D


@pytest.fixture
def passes(spark, sf_dir, monkeypatch):
    """Runs a query and tells how many times it read every document's text."""
    read, whole = spark.sparkContext.accumulator(0), catalog.Corpus.table

    def counted(self, name):
        def run(batches):
            for b in batches:
                read.add(b.num_rows)
                yield b

        df = whole(self, name)
        return df.mapInArrow(run, df.schema) if name == "documents" else df

    def of(name):
        catalog.Corpus.forget()
        before = read.value
        catalog.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return (read.value - before) / n

    n = D.table(spark, sf_dir, "documents").count()
    monkeypatch.setattr(catalog.Corpus, "table", counted)
    yield of
    catalog.Corpus.forget()


@pytest.mark.parametrize("name", ["pair_evidence", "verdict_totals", "break_eval", "truncation_hits", "substitution_histogram", "channel_fit", "line_end_set_recall", "mark_counts", "find_replace", "planted_recall"])
def test_documents_are_read_once_or_twice(passes, name):
    """Four to six times before: once for each table of counts, and for each use of line ends."""
    assert passes(name) <= (3 if name in ("channel_fit", "mark_counts", "find_replace", "planted_recall") else 2)


def test_workers_read_lines_as_columns_do(spark):
    rnd = random.Random(5)
    parts = ["Haus", "gar-", "ten¬", "a=b", "«x»", "¬", "=", ".", "", " ", " ", " ", "\x1c", "\u0085", "\t", "ü,", '"Wort."', "b", "-", "d''"]
    lines = ["".join(rnd.choice(parts) + rnd.choice(("", " ", " ")) for _ in range(rnd.randrange(7))) for _ in range(600)]
    rows = spark.createDataFrame(list(zip(lines, lines[1:], strict=False)), "a string, b string")
    pair = T.break_pair(F.col("a"), F.col("b"))
    out = rows.select("a", "b", pair.alias("p"), T.tokens(F.col("a")).alias("t"), T.strip_token(F.col("a")).alias("s"), T.separator(F.col("a")).alias("k")).collect()
    for r in out:
        got = W.break_words(r.a, r.b)
        assert (got and got[:5]) == (r.p and tuple(r.p)) and W.tokens(r.a) == r.t and W.strip_token(r.a) == r.s and ("plain", "period", "comma")[W.separator(r.a)] == r.k


def test_long_paragraphs_cost_in_proportion(spark):
    """A row of a line holds its neighbours, not all lines of its paragraph."""
    paras = spark.createDataFrame([(1, 1, "s", ["a b c"] * 3)], "file long, para long, subtype string, lines array<string>")
    rows = D.lines_of(paras)
    carried = re.search(r", \[([^\[\]]*)\], false, \[i#", rows._jdf.queryExecution().executedPlan().toString()).group(1)
    assert "file#" in carried and "lines#" not in carried
    assert [(r.prev_line, r.next_line, r.toks) for r in rows.orderBy("pos").collect()] == [(None, "a b c", ["a", "b", "c"]), ("a b c", "a b c", ["a", "b", "c"]), ("a b c", None, ["a", "b", "c"])]


def test_gold_is_one_row_a_word(spark):
    """Candidates are not multiplied with occurrences: counts of a word come back, not rows."""
    paras = spark.createDataFrame([(1, 1, "s", ["x der hut war y"] * 30 + ["x der hur war y"] * 20 + ["x die hut lag y"] * 2)], "file long, para long, subtype string, lines array<string>")
    lines = D.lines_of(paras)
    uni = L.unigrams(lines)
    out = {r.w: r for r in E.answered(lines, uni, L.bigrams(lines), L.totals(uni)).collect()}
    assert {w: (r.n, r.correct, r.members, r.common) for w, r in out.items()} == {"hut": (32, 32, "hur/hut", "hut"), "hur": (20, 0, "hur/hut", "hut")}
