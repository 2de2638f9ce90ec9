"""A corpus pipeline over ``documents``: five stages, each by one operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which the caller
writes as Parquet and rereads as the next stage's documents.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linemend.llm import bpe, mixing, parity_join, pii, toxicity
from linemend.llm.base import cut_table, drop_table, local_table, marked, table

#: Near copies in the pipeline: shingles of five words, Jaccard at least 80 : 100.
NEAR = (5, 80, 100)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the classifier learns from ``labels``."""
    weights = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.toxicity(docs, weights, carry=True)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Rows with a null id stay, as no group can be told from them.  Rows that
    repeat an id and its text count as copies of each other.  Where an id repeats with
    different texts, each row goes by its own group; of several rows of one id in a
    group the first by text stays."""
    joined = cut_table(parity_join.jaccard_join(docs, *NEAR).select("doc_id", "component_id", "links_to", "set_id"), "pipeline-groups")
    named = docs.where(F.col("doc_id").isNotNull())
    by_id = joined.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.bool_or(F.col("doc_id") == F.col("component_id")).alias("heads"))
    by_id = cut_table(by_id, "pipeline-ids")
    # most ids stay: the texts of the others alone, and of what shares a bit with them, are shuffled
    placed = marked(named, "doc_id", by_id.where("not (rows = 1 and coalesce(heads, false))").select("doc_id"), "_doubtful")
    kept = placed.where("_doubtful").join(by_id.where("rows = 1 and heads").select("doc_id"), "doc_id", "left_semi")
    kept = placed.where("not _doubtful").unionByName(kept).select(docs.columns)
    repeated = by_id.where("rows > 1").select("doc_id")
    if not repeated.isEmpty():
        heads = joined.where("doc_id = component_id").join(repeated, "doc_id", "left_semi").select(F.col("doc_id").alias("_id"), F.col("set_id").alias("_set"), "links_to").distinct()
        several = parity_join.with_set_id(named.join(repeated, "doc_id", "left_semi"), NEAR[0])
        several = several.join(heads, (F.col("doc_id") == F.col("_id")) & F.col("set_id").eqNullSafe(F.col("_set")))
        # texts without shingles are in no group: only equal ones are copies
        group = [F.col("doc_id"), F.col("links_to"), F.when(F.col("links_to").isNull(), F.coalesce(F.concat(F.lit("t"), "text"), F.lit("")))]
        first = F.row_number().over(Window.partitionBy(*group).orderBy("text"))
        kept = kept.unionByName(several.withColumn("_k", first).where("_k = 1").select(docs.columns))
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text give way to pseudonyms."""
    return pii.pseudonymise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the schedule: within each part and from part to
    part.  Readers deal parts anew, so ``in_written_order`` recovers it."""
    return mixing.mix_in_order(docs).select(docs.columns)


def in_written_order(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Adds ``position``: the place, from 0, of a row in a table as it was written, by
    the number of its part file and the row within; however the parts are read.  What
    is no table as read is written out first."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = cut_table(docs, "pipeline-ordered")
    path = F.col("_metadata.file_path")
    # one row for each part file, whose footers hold the counts
    parts = docs.groupBy(path.alias("_path")).agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.element_at(F.split("_path", "/"), -1))
    found = sorted(parts.withColumn("part", F.regexp_extract("name", r"^part-(\d+)", 1)).collect(), key=lambda r: (int(r.part or 0), r.name))
    ends = list(itertools.accumulate((r.n for r in found), initial=0))
    starts = local_table(spark, [(r._path, k) for r, k in zip(found, ends)], "_path string, _start long")
    placed = docs.select(*docs.columns, path.alias("_path"), F.col("_metadata.row_index").alias("_row")).join(F.broadcast(starts), "_path")
    return placed.select(*docs.columns, (F.col("_start") + F.col("_row")).alias("position"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and decoded text, and its
    ``position`` in the mixed order."""
    return bpe.bpe_encode(in_written_order(spark, docs), with_text=False, place_col="position")


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("pii", pseudonymise),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The stages learn a classifier, hash and tokenise: SQL can't express them.
#: tests/llm/test_pipeline.py holds them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, former = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = cut_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if former is not None:  # nothing reads it any more
            drop_table(former)
        former = docs
    return STAGES[-1][1](spark, docs, sf_dir)
