"""Adjudication: prompts, replies, and the judge as an injected callable.

Replies are parsed in Catalyst.  The judge runs in ``mapInPandas`` with whatever
callable is passed; without one, a rule-based stand-in answers, stored as ``rule``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON_LENGTH = 200


def reply_object(reply: Column) -> Column:
    """The first flat JSON object of a reply, after its thinking; '' if none."""
    return F.regexp_extract(F.regexp_replace(reply, r"(?s)<think>.*?</think>", ""), r"(?s)\{.*?\}", 0)


def form_answers(replies: DataFrame, reply: str = "reply", carry: tuple[str, ...] = ()) -> DataFrame:
    """(reply, form, reason), and the columns ``carry``.  Labels that spell alike (``period/split``) count as the
    last; unknown forms as skip; an unreadable reply has no form and says so."""
    parsed = F.from_json(reply_object(F.col(reply)), "form string, reason string", {"mode": "PERMISSIVE"})
    named = F.element_at(F.split(F.lower(F.col("p.form")), "/"), -1)
    known = named.isin("join", "hyphen", "period", "comma", "split", "skip")
    broken = F.col("p.form").isNull()
    return replies.withColumn("p", parsed).select(
        *carry, F.col(reply).alias("reply"), F.when(broken, None).when(known, named).otherwise("skip").alias("form"),
        F.when(broken, F.concat(F.lit("unparseable reply: "), F.left(F.col(reply), F.lit(REASON_LENGTH)))).otherwise(F.left(F.col("p.reason"), F.lit(REASON_LENGTH))).alias("reason"),
    )


def balanced_object(reply: str) -> str | None:
    """The first object with balanced braces, braces inside strings not counted."""
    start = reply.find("{")
    while start >= 0:
        depth, quoted, i = 0, False, start
        while i < len(reply):
            ch = reply[i]
            if quoted:
                if ch == "\\":
                    i += 1
                elif ch == '"':
                    quoted = False
            elif ch == '"':
                quoted = True
            elif ch == "{":
                depth += 1
            elif ch == "}":
                depth -= 1
                if not depth:
                    return reply[start : i + 1]
            i += 1
        start = reply.find("{", start + 1)
    return None


def clean_token(token: Column, fallback: Column) -> Column:
    """One plausible word, or the fallback: no spaces, not much longer than it."""
    bare = F.rtrim(F.btrim(token), F.lit("¬-="))
    n = F.char_length(fallback)
    return F.when((bare != "") & ~bare.rlike(r"\s") & (F.char_length(bare) <= F.greatest(3 * n, n + 12)), bare).otherwise(fallback)


def pair_prompt(sighted: bool = True) -> Column:
    """The question about a pair; without evidence when blind."""
    base = F.concat(F.lit("Left: "), F.col("left"), F.lit("\nRight: "), F.col("right"), F.lit("\nReadings: "), F.col("candidates"))
    return F.concat(base, F.lit("\nWhy asked: "), F.col("reason")) if sighted else base


def stand_in(left: str, right: str) -> str:
    """Deterministic answers for tests: lower case joins, upper case takes a hyphen."""
    if right[:1].islower() and right not in ("und", "oder"):
        return "join"
    return "hyphen" if right[:1].isupper() else "skip"


def adjudicate(queue: DataFrame, judge: Callable[[str, str], str] | None = None) -> DataFrame:
    """(left, right, form, source) for each question; one call a row, batch by batch."""
    ask, source = (stand_in, "rule") if judge is None else (judge, "llm")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"left": b["left"], "right": b["right"], "form": [ask(x, y) for x, y in zip(b["left"], b["right"], strict=True)], "source": source})

    return queue.select("left", "right").mapInPandas(run, "left string, right string, form string, source string")


def confusion(answers: DataFrame, truth: str = "expected", said: str = "form") -> DataFrame:
    """(expected, form, n, right): confusion counts of a benchmark run."""
    return answers.groupBy(F.col(truth).alias("expected"), F.col(said).alias("form")).agg(F.count(F.lit(1)).alias("n")).withColumn("right", F.col("expected") == F.col("form"))
