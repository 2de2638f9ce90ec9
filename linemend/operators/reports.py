"""Report rows, with the columns and orders that readers of the CSV files know."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linemend.operators.breaks import modes, surfaces


def find_replace() -> tuple[Column, Column]:
    """What to find in joined text, and what to put there, from surface forms and verdict."""
    v, sl, sr = F.col("verdict"), F.col("surface_left"), F.col("surface_right")
    glued, apart = F.concat(sl, sr), F.concat(sl, F.lit(" "), sr)
    bare = F.rtrim(sl, F.lit(".,"))
    sentence = v.isin("PERIOD", "COMMA")
    find = F.when(v == "FALSE_POSITIVE", glued).when(v == "FALSE_NEGATIVE", apart).when(sentence & sr.rlike(r"^\p{Lu}"), F.concat(sl, F.lit("-"), sr)).when(sentence, glued).otherwise("")
    put = F.when(v == "FALSE_POSITIVE", apart).when(v == "FALSE_NEGATIVE", glued).when(v == "PERIOD", F.concat(bare, F.lit(". "), sr)).when(v == "COMMA", F.concat(bare, F.lit(", "), sr)).otherwise("")
    return find, put


def pair_report(judged: DataFrame, occ: DataFrame, wanted: tuple[str, ...], keep: Callable[[DataFrame], DataFrame], least: int = 1) -> DataFrame:
    """Verdicts as reported: by verdict, then most affected first.  ``CONTEXT`` pairs are
    held to their occurrences.  Only reported pairs are looked up among the occurrences,
    which are read once: ``keep`` persists their distinct forms."""
    kept = judged.where(F.col("verdict").isin(*wanted) & (F.when(F.col("verdict") == "CONTEXT", F.col("total")).otherwise(F.col("affected")) >= least))
    forms = keep(surfaces(occ.join(kept.select("left", "right"), ["left", "right"], "left_semi")))
    slots = forms.groupBy("left", "right", F.when(F.col("hyphenated"), "hyphenated").otherwise("plain").alias("slot")).agg(F.min("at").alias("x")).select("left", "right", "slot", "x.file", "x.para", "x.context")
    shown = slots.groupBy("left", "right").agg(F.map_from_entries(F.collect_list(F.struct("slot", F.struct("context", "file", "para")))).alias("x"))  # two at most
    find, put = find_replace()
    v = F.col("verdict")
    slot = F.when(v.isin("FALSE_POSITIVE", "PERIOD", "COMMA"), "hyphenated").when(v == "FALSE_NEGATIVE", "plain").when(F.map_contains_key("x", F.lit("hyphenated")), "hyphenated").otherwise("plain")
    one = F.coalesce(F.try_element_at("x", slot), F.try_element_at(F.map_values("x"), F.lit(1)))
    rows = kept.join(modes(forms), ["left", "right"]).join(shown, ["left", "right"]).withColumn("e", one)
    return rows.select(
        "verdict", "reason", "left", "right", find.alias("find"), put.alias("replace"), "affected", F.col("hyphenated").alias("seen_hyphenated"), F.col("plain").alias("seen_plain"),
        F.col("join_count").alias("compound_freq"), F.col("bigram_count").alias("bigram_freq"), F.col("dash_count").alias("dashed_freq"), F.col("period_count").alias("period_freq"),
        F.col("comma_count").alias("comma_freq"), F.col("left_count").alias("left_freq"), F.col("right_count").alias("right_freq"), F.col("e.context").alias("example_context"),
        F.col("e.file").alias("example_file"), F.col("e.para").alias("example_para"),
    )


def token_report(judged: DataFrame, finals: DataFrame) -> DataFrame:
    """Misread and doubtful line-final words with their first occurrence."""
    kept = judged.where(F.col("verdict").isin("MISREAD", "REVIEW"))
    first = F.min(F.struct("file", "para", "pos", "line", "subtype")).alias("e")
    shown = finals.join(kept.select("w"), "w", "left_semi").groupBy("w").agg(first)
    return kept.join(shown, "w").select(
        "verdict", "reason", F.col("w").alias("observed"), F.coalesce("best", F.lit("")).alias("suggested"), F.col("seen").alias("seen_at_line_end"), F.col("observed_count").alias("observed_freq"),
        F.col("best_count").alias("suggested_freq"), F.coalesce("runner_up", F.lit("")).alias("runner_up"), F.col("runner_count").alias("runner_up_freq"), F.col("e.line").alias("example_context"),
        F.col("e.file").alias("example_file"), F.col("e.para").alias("example_para"), F.col("e.subtype").alias("region_subtype"),
    )


def token_review(judged: DataFrame, variants: DataFrame) -> DataFrame:
    """Queue records of doubtful words: (observed, record), the record as JSON.  The
    evidence has a key for each candidate word (an alphabet of them at most)."""
    kept = judged.where("verdict = 'REVIEW'")
    ranked = variants.join(kept.select("w"), "w", "left_semi").groupBy("w").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "ord", "cand", "n"))).alias("c"))
    rows = kept.join(ranked, "w", "left")
    evidence = F.map_concat(F.create_map(F.lit("observed_freq"), F.col("observed_count")), F.map_from_entries(F.transform(F.filter("c", lambda x: x["cand"] != "observed_freq"), lambda x: F.struct(x["cand"], x["n"]))))
    record = F.struct(
        F.col("w").alias("observed"), F.transform("c", lambda x: x["cand"]).alias("candidates"), F.col("verdict").alias("statistical_verdict"), F.coalesce("best", F.lit("")).alias("suggested"),
        F.col("seen").alias("seen_at_line_end"), evidence.alias("evidence"), "reason",
    )
    return rows.select(F.col("w").alias("observed"), F.to_json(record).alias("record"))


def promotions(evidence: DataFrame, store: DataFrame) -> DataFrame:
    """Draft store rows that make contested pairs ``context``: left, right, form, source,
    note, n.  Pairs that already are stay out.  ``evidence``: the contested pairs, whose
    breaks (n) it has counted."""
    known = store.select("left", "right", F.col("form").alias("old"), F.col("source").alias("by"))
    rows = evidence.withColumn("n", F.col("hyphenated") + F.col("plain")).join(known, ["left", "right"], "left").where(F.coalesce("old", F.lit("")) != "context")
    apart = F.col("bigram_count") + F.col("period_count") + F.col("comma_count")
    was = F.when(F.col("old").isNull(), "; previously undecided").otherwise(F.concat(F.lit("; was "), "old", F.lit(" ("), F.coalesce("by", F.lit("")), F.lit(")")))
    text = lambda c: c.cast("string")
    note = F.concat(F.lit("both readings live in the corpus: joined "), text(F.col("join_count") + F.col("dash_count")), F.lit("x, apart "), text(apart), F.lit("x over "), text(F.col("n")), F.lit(" breaks"), was)
    return rows.select("left", "right", F.lit("context").alias("form"), F.lit("manual").alias("source"), note.alias("note"), "n")
