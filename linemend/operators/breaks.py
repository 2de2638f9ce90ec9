"""Line breaks: occurrences, pair evidence, forms and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField

from linemend.constants import CONTESTED_FLOOR, FORM_FLOOR, HYPHEN_RATIO, USUAL_FLOOR
from linemend.functions.text import ends_with_mark
from linemend.functions.words import break_words, with_words

ORDER = ("file", "para", "pos")
COUNTS = ("join_count", "dash_count", "bigram_count", "period_count", "comma_count", "left_count", "right_count")


def with_breaks(lines: DataFrame, whole: bool = False) -> DataFrame:
    """Rows of (line, next_line, ...) with the pair of the break between the two lines, its
    surface forms and the words beside it (h, t; null: none), as ``functions.text.break_pair``
    reads it.  Rows without a usable pair go, or with ``whole`` stay, with nulls."""
    strings = [StructField(n, StringType()) for n in ("left", "right", "raw_left", "raw_right", "h", "t")]
    return with_words(lines, break_words, [*strings[:4], StructField("hyphenated", BooleanType()), *strings[4:]], whole)


def breaks(lines: DataFrame) -> DataFrame:
    """One row per usable break: position, pair, surface forms, words beside it, context."""
    out = with_breaks(lines.where(F.col("next_line").isNotNull()).select(*ORDER, "subtype", "line", "next_line"))
    return out.withColumn("context", F.concat_ws(" | ", "line", "next_line"))


def pair_counts(occ: DataFrame) -> DataFrame:
    """(left, right, hyphenated, plain)."""
    return occ.groupBy("left", "right").agg(F.count(F.when(F.col("hyphenated"), 1)).alias("hyphenated"), F.count(F.when(~F.col("hyphenated"), 1)).alias("plain"))


def surface_modes(occ: DataFrame) -> DataFrame:
    """(left, right, surface_left, surface_right): commonest surface form of each
    side, the earliest of equals.  Forms are counted first, so only distinct forms
    meet in a window."""
    at = F.min(F.struct(*ORDER)).alias("at")
    return modes(occ.groupBy("left", "right", "raw_left", "raw_right").agg(F.count(F.lit(1)).alias("c"), at))


def modes(counted: DataFrame) -> DataFrame:
    """``surface_modes`` from rows of forms with their number ``c`` and first position ``at``."""

    def mode(side: str) -> DataFrame:
        forms = counted.groupBy("left", "right", side).agg(F.sum("c").alias("c"), F.min(F.struct(*[f"at.{x}" for x in ORDER])).alias("at"))
        best = F.max_by(F.col(side), F.struct(F.col("c"), -F.col("at.file"), -F.col("at.para"), -F.col("at.pos")))
        return forms.groupBy("left", "right").agg(best.alias(side.replace("raw", "surface")))

    return mode("raw_left").join(mode("raw_right"), ["left", "right"])


def surfaces(occ: DataFrame) -> DataFrame:
    """(left, right, raw_left, raw_right, hyphenated, c, at): what surface forms and first
    examples are read from, in one pass over the occurrences; ``at``: the first position and its context."""
    return occ.groupBy("left", "right", "raw_left", "raw_right", "hyphenated").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct(*ORDER, "context")).alias("at"))


def first_examples(occ: DataFrame) -> DataFrame:
    """(left, right, slot, file, para, context): first occurrence of either kind."""
    slot = F.when(F.col("hyphenated"), "hyphenated").otherwise("plain")
    best = F.min(F.struct(*ORDER, "context")).alias("x")
    return occ.withColumn("slot", slot).groupBy("left", "right", "slot").agg(best).select("left", "right", "slot", "x.file", "x.para", "x.context")


def first_contexts(occ: DataFrame, keys: tuple[str, ...] = ("left", "right"), keep: int = 3) -> DataFrame:
    """The first few contexts of each key, joined by `` || ``.  The rank filter is
    pushed below the shuffle (window group limit), so a frequent key sends few rows."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ORDER))
    kept = occ.withColumn("k", rank).where(F.col("k") <= keep)
    return kept.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "context"))), lambda x: x["context"]), " || ").alias("contexts"))


def pair_evidence(pairs: DataFrame, uni: DataFrame, big: DataFrame, dash: DataFrame) -> DataFrame:
    """Pairs with their seven counts; equi-joins only, small sides broadcast by size."""
    one = lambda key, name: uni.select(F.col("w").alias(key), F.col("c").alias(name))
    return (
        pairs.withColumn("both", F.concat("left", "right"))
        .join(one("both", "join_count"), "both", "left").join(one("left", "left_count"), "left", "left").join(one("right", "right_count"), "right", "left")
        .join(big.select(F.col("a").alias("left"), F.col("b").alias("right"), F.col("plain").alias("bigram_count"), F.col("period").alias("period_count"), F.col("comma").alias("comma_count")), ["left", "right"], "left")
        .join(dash.select(F.col("a").alias("left"), F.col("b").alias("right"), F.col("c").alias("dash_count")), ["left", "right"], "left")
        .select("left", "right", "hyphenated", "plain", *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS])
    )


def _separator_form(ratio: float) -> Column:
    """Struct (form, reason) among the separated readings."""
    c, p, s = F.col("comma_count"), F.col("period_count"), F.col("bigram_count")
    answer = lambda form, why: F.struct(F.lit(form).alias("form"), F.lit(why).alias("reason"))
    best = F.greatest(c, p, s)
    return (
        F.when((best >= FORM_FLOOR) & (p == best) & (p >= ratio * F.greatest(c, s, F.lit(1))), answer("period", "sentence-boundary-attested"))
        .when((best >= FORM_FLOOR) & (c == best) & (c >= ratio * F.greatest(p, s, F.lit(1))), answer("comma", "comma-attested"))
        .otherwise(answer("split", "bigram-attested"))
    )


def decide_form(ratio: float = HYPHEN_RATIO) -> Column:
    """Struct (form, reason) of a pair from its counts; form null if undecided."""
    j, d, left, right = F.col("join_count"), F.col("dash_count"), F.col("left_count"), F.col("right_count")
    h, plain = F.col("hyphenated"), F.col("plain")
    s = F.col("bigram_count") + F.col("comma_count") + F.col("period_count")
    answer = lambda form, why: F.struct(F.lit(form).cast("string").alias("form"), F.lit(why).alias("reason"))
    at_least = lambda x, y: x >= ratio * F.greatest(y, F.lit(1))
    capital = (
        F.when(F.greatest(d, s) < FORM_FLOOR, answer(None, "capitalised-right"))
        .when((d >= FORM_FLOOR) & at_least(d, s), answer("hyphen", "dashed-compound-attested"))
        .when((s >= FORM_FLOOR) & at_least(s, d), _separator_form(ratio))
        .otherwise(answer(None, "capitalised-right"))
    )
    return (
        F.when(F.col("right").rlike(r"^\p{Lu}"), capital)
        .when((left == 0) & (j >= FORM_FLOOR) & (s == 0), answer("join", "left-is-fragment"))
        .when((j >= FORM_FLOOR) & at_least(j, s), answer("join", "compound-attested"))
        .when((s >= FORM_FLOOR) & at_least(s, j), _separator_form(ratio))
        .when((j >= FORM_FLOOR) & (s >= FORM_FLOOR), answer(None, "contested"))
        .when((h >= USUAL_FLOOR) & at_least(h, plain), answer("join", "pair-usually-hyphenated"))
        .when((plain >= USUAL_FLOOR) & at_least(plain, h) & (j == 0), answer("split", "pair-usually-plain"))
        .when((j == 0) & (left >= USUAL_FLOOR) & (right >= USUAL_FLOOR), answer("split", "both-common-words"))
        .otherwise(answer(None, "insufficient-evidence"))
    )


def verdicts(evidence: DataFrame, store: DataFrame | None = None, ratio: float = HYPHEN_RATIO) -> DataFrame:
    """Evidence with form, reason, verdict, bad_hyphenated, bad_plain, affected, total.
    A row of the decision store (left, right, form, source) outranks the counts."""
    ev = evidence.withColumn("_c", decide_form(ratio))
    if store is not None:
        ev = ev.join(store.select("left", "right", F.col("form").alias("_sf"), F.col("source").alias("_ss")), ["left", "right"], "left")
    else:
        ev = ev.withColumn("_sf", F.lit(None).cast("string")).withColumn("_ss", F.lit(None).cast("string"))
    stored = F.col("_sf").isNotNull()
    ev = (
        ev.withColumn("form", F.coalesce("_sf", "_c.form"))
        .withColumn("reason", F.when(stored, F.concat(F.lit("decided:"), F.coalesce("_ss", F.lit("")))).otherwise(F.col("_c.reason")))
        .withColumn("_settled", stored)
    )
    h, p, f = F.col("hyphenated"), F.col("plain"), F.col("form")
    s = F.col("bigram_count") + F.col("comma_count") + F.col("period_count")
    j, d, open_ = F.col("join_count"), F.col("dash_count"), ~F.col("_settled")
    contested = F.when((f == "join") & (p > 0) & (s >= FORM_FLOOR) & open_, True).when((f == "split") & (h > 0) & ((j >= FORM_FLOOR) | (d >= FORM_FLOOR)) & open_, True).otherwise(False)
    verdict = (
        F.when(f.isNull(), F.when((h > 0) & (p > 0), "REVIEW").otherwise("OK"))
        .when(f.isin("hyphen", "skip"), "OK").when(f == "context", "CONTEXT")
        .when(f == "join", F.when(p == 0, "OK").when(contested, "REVIEW").otherwise("FALSE_NEGATIVE"))
        .when(h == 0, "OK").when(f == "period", "PERIOD").when(f == "comma", "COMMA")
        .otherwise(F.when(contested, "REVIEW").otherwise("FALSE_POSITIVE"))
    )
    out = (
        ev.withColumn("verdict", verdict)
        .withColumn("reason", F.when(contested, "contested-both-readings").otherwise(F.col("reason")))
        .withColumn("bad_hyphenated", F.when(f.isNull() & (h > 0) & (p > 0), h).when(f.isin("period", "comma", "split"), h).otherwise(F.lit(0)))
        .withColumn("bad_plain", F.when((f == "join") & (p > 0), p).otherwise(F.lit(0)))
    )
    return out.withColumn("affected", F.col("bad_hyphenated") + F.col("bad_plain")).withColumn("total", h + p).drop("_c", "_sf", "_ss", "_settled")


def verdict_totals(judged: DataFrame) -> DataFrame:
    """(verdict, pairs, occurrences): OK also takes what other verdicts leave unaffected."""
    own = judged.select("verdict", F.lit(1).alias("p"), F.when(F.col("verdict").isin("OK", "CONTEXT"), F.col("total")).otherwise(F.col("affected")).alias("o"))
    rest = judged.where(~F.col("verdict").isin("OK", "CONTEXT")).select(F.lit("OK").alias("verdict"), F.lit(0).alias("p"), (F.col("total") - F.col("affected")).alias("o"))
    return own.union(rest).groupBy("verdict").agg(F.sum("p").alias("pairs"), F.sum("o").alias("occurrences"))


def paragraph_final_marks(lines: DataFrame) -> DataFrame:
    """(subtype, n): break marks on last lines, which no pair can judge."""
    return lines.where(F.col("next_line").isNull() & ends_with_mark(F.col("line"))).groupBy("subtype").agg(F.count(F.lit(1)).alias("n"))


def notation(lines: DataFrame) -> DataFrame:
    """(file, n_not, n_eq, notation): majority mark of a file, ``¬`` on a tie."""
    tail = F.right("line", F.lit(1))
    out = lines.groupBy("file").agg(F.count(F.when(tail == "¬", 1)).alias("n_not"), F.count(F.when(tail == "=", 1)).alias("n_eq"))
    return out.withColumn("notation", F.when(F.col("n_eq") > F.col("n_not"), "=").otherwise("¬"))


def contested(evidence: DataFrame, floor: int = CONTESTED_FLOOR) -> DataFrame:
    """Pairs whose rarer reading is attested at least ``floor`` times."""
    one = F.col("join_count") + F.col("dash_count")
    other = F.col("bigram_count") + F.col("period_count") + F.col("comma_count")
    return evidence.withColumn("minority", F.least(one, other)).where(F.col("minority") >= floor)


def candidate_spellings() -> Column:
    """The five readings of a pair, as one string for queues and prompts."""
    left, right = F.col("left"), F.col("right")
    bare = F.rtrim(left, F.lit(".,"))
    return F.concat_ws("; ", F.concat(F.lit("join="), left, right), F.concat(F.lit("hyphen="), left, F.lit("-"), right), F.concat(F.lit("period="), bare, F.lit(". "), right), F.concat(F.lit("comma="), bare, F.lit(", "), right), F.concat(F.lit("split="), left, F.lit(" "), right))
