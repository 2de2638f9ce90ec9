"""Corrections told in notes: which pairs to ask about, the question, the answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linemend.operators.replies import REASON_LENGTH, clean_token, reply_object

LEVELS = ("low", "medium", "high")


def note_queue(store: DataFrame, corrections: DataFrame, contexts: DataFrame, pattern: str) -> DataFrame:
    """(left, right, form, note, contexts) of stored pairs whose note matches (in any
    case) and that no correction has been extracted for.  ``contexts``: left, right, contexts."""
    asked = store.where(F.coalesce("note", F.lit("")).rlike(f"(?i){pattern}"))
    asked = asked.join(corrections.select("left", "right").distinct(), ["left", "right"], "left_anti")
    return asked.select("left", "right", "form", "note").join(contexts.select("left", "right", "contexts"), ["left", "right"], "left")


def note_prompt() -> Column:
    """The question about a queued pair."""
    known = F.when(F.col("contexts").isNotNull(), F.concat(F.lit("\nSeen in: "), F.col("contexts"))).otherwise("")
    return F.concat(F.lit("Left: "), "left", F.lit("\nRight: "), "right", F.lit("\nForm: "), F.coalesce("form", F.lit("?")), F.lit("\nNote: "), "note", known)


def note_answers(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """(left, right, left_correct, right_correct, confidence, reason) of replies about
    pairs.  An unreadable one changes nothing, with low confidence, and says so."""
    p = F.from_json(reply_object(F.col(reply)), "left string, right string, confidence string, reason string", {"mode": "PERMISSIVE"})
    rows = replies.withColumn("p", p).withColumn("broken", F.coalesce(F.col("p.left"), F.col("p.right"), F.col("p.confidence"), F.col("p.reason")).isNull())
    level = F.lower(F.btrim(F.coalesce("p.confidence", F.lit(""))))
    said = lambda side: F.when(F.col("broken"), F.col(side)).otherwise(clean_token(F.coalesce(f"p.{side}", F.lit("")), F.col(side)))
    return rows.select(
        "left", "right", said("left").alias("left_correct"), said("right").alias("right_correct"), F.when(~F.col("broken") & level.isin(*LEVELS), level).otherwise("low").alias("confidence"),
        F.when(F.col("broken"), F.concat(F.lit("unparseable reply: "), F.left(reply, F.lit(REASON_LENGTH)))).otherwise(F.left(F.btrim(F.coalesce("p.reason", F.lit(""))), F.lit(REASON_LENGTH))).alias("reason"),
    )


def _rank(level: Column) -> Column:
    out = F.lit(-1)
    for k, name in enumerate(LEVELS):
        out = F.when(level == name, k).otherwise(out)
    return out


def applies(least: str = "high") -> Column:
    """Whether a correction may change text: never if it changes no word, else as a person
    approved, else by its confidence.  A ``*`` row corrects its left word only."""
    changes = ~F.col("left_correct").eqNullSafe(F.col("left")) | ((F.col("right") != "*") & ~F.col("right_correct").eqNullSafe(F.col("right")))
    return F.when(~changes | (F.col("approved") == "no"), False).when(F.col("approved") == "yes", True).otherwise(_rank(F.col("confidence")) >= _rank(F.lit(least)))
