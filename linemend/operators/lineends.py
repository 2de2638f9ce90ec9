"""Line-final tokens: misread and cut-off letters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from linemend import constants as C
from linemend.functions.text import ends_with_mark, is_word, without_last
from linemend.functions.words import final_words, with_words
from linemend.operators.lexicon import trigrams


def line_finals(lines: DataFrame) -> DataFrame:
    """One row per line end without a break mark: raw, w, prev_w, next_w, context.
    ``next_w`` is null without a next line and '' where it strips to nothing."""
    rows = lines.where(~ends_with_mark(F.col("line"))).select("file", "para", "pos", "subtype", "line", "next_line")
    return with_words(rows, final_words, [StructField(n, StringType()) for n in ("raw", "w", "prev_w", "next_w")])


def final_tally(finals: DataFrame) -> DataFrame:
    """(w, seen): line-final words."""
    return finals.where(is_word(F.col("w"))).groupBy("w").agg(F.count(F.lit(1)).alias("seen"))


def final_variants(words: DataFrame, uni: DataFrame, min_count: int) -> DataFrame:
    """(w, cand, n, ord): attested words that differ from w in the last letter only.

    Both sides are keyed by the word without its last letter, one equi-join instead
    of a candidate for each letter of the alphabet; rare words go before it."""
    letters = F.create_map(*[F.lit(x) for pair in ((ch, i) for i, ch in enumerate(C.ALPHABET)) for x in pair])
    known = uni.where(F.col("c") >= min_count).select(without_last(F.col("w")).alias("stem"), F.col("w").alias("cand"), F.col("c").alias("n"), letters[F.right("w", F.lit(1))].alias("ord"))
    probe = words.select("w", without_last(F.col("w")).alias("stem"), F.lower(F.right("w", F.lit(1))).alias("own")).distinct()
    return probe.join(known.where(F.col("ord").isNotNull()), "stem").where(F.right("cand", F.lit(1)) != F.col("own")).select("w", "cand", "n", "ord")


def confusions(spec: str) -> dict[str, str]:
    """Candidate letters of each observed one, from ``all``, a set of letters (each for
    each other) or ``x:ab,y:c``."""
    spec = spec.strip()
    if spec == "all":
        return {ch: C.ALPHABET.replace(ch, "") for ch in C.ALPHABET}
    if ":" not in spec:
        if not spec:
            raise ValueError("no letters given")
        return {ch: "".join(x for x in dict.fromkeys(spec) if x != ch) for ch in spec}
    out = {}
    for part in filter(None, map(str.strip, spec.split(","))):
        own, _, others = (x.strip() for x in part.partition(":"))
        if len(own) != 1 or not others:
            raise ValueError(f"expected x:abc, got {part!r}")
        out[own] = others.replace(own, "")
    return out


def confused(variants: DataFrame, spec: str) -> DataFrame:
    """Variants whose last letter may be misread so: a literal map, no join."""
    allowed = confusions(spec)
    table = F.create_map(*[F.lit(x) for pair in allowed.items() for x in pair])
    return variants.where(F.coalesce(table[F.lower(F.right("w", F.lit(1)))], F.lit("")).contains(F.right("cand", F.lit(1))))


def token_verdicts(tally: DataFrame, uni: DataFrame, min_count: int = C.TOKEN_MIN_COUNT, ratio: float = C.TOKEN_RATIO, report_ambiguous: bool = False) -> DataFrame:
    """(w, seen, observed_count, best, best_count, runner_up, runner_count, verdict, reason)."""
    ranked = final_variants(tally, uni, min_count).groupBy("w").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), "ord", "cand", "n"))), 1, 2).alias("top"))
    rows = (
        tally.join(uni.select("w", F.col("c").alias("oc")), "w", "left").join(ranked, "w", "left")
        .select("w", "seen", F.coalesce("oc", F.lit(0)).alias("observed_count"), F.try_element_at("top", F.lit(1)).alias("a"), F.try_element_at("top", F.lit(2)).alias("b"))
    )
    n, best, runner = F.col("observed_count"), F.coalesce(F.col("a.n"), F.lit(0)), F.coalesce(F.col("b.n"), F.lit(0))
    change = F.concat(F.lower(F.right("w", F.lit(1))), F.lit("->"), F.right(F.col("a.cand"), F.lit(1)))
    long = F.char_length("w") >= C.TOKEN_MIN_LENGTH
    case = lambda a, b, c, d, e, f, g: (
        F.when(~long, a).when(best == 0, b).when(n >= C.AMBIGUOUS_AT, c).when(n * ratio > best, d).when(runner * 2 > best, e).when(n > C.TOKEN_MAX_OBSERVED, f).otherwise(g)
    )
    lit = F.lit
    return rows.select(
        "w", "seen", "observed_count", F.col("a.cand").alias("best"), best.alias("best_count"), F.col("b.cand").alias("runner_up"), runner.alias("runner_count"),
        case(lit("OK"), lit("OK"), lit("REVIEW" if report_ambiguous else "OK"), lit("OK"), lit("REVIEW"), lit("REVIEW"), lit("MISREAD")).alias("verdict"),
        case(lit("too-short"), lit("no-attested-variant"), lit("observed-is-a-word"), lit("observed-attested"), lit("competing-variants"),
             F.concat(change, lit("?  observed "), n.cast("string"), lit("x inside a line")), change).alias("reason"),
    )


def misread_corrections(judged: DataFrame) -> DataFrame:
    """Store rows of the MISREAD verdicts."""
    return judged.where("verdict = 'MISREAD'").select(F.col("w").alias("left"), F.lit("*").alias("right"), F.col("best").alias("left_correct"), F.lit("*").alias("right_correct"), F.lit("high").alias("confidence"), F.lit("rule").alias("source"))


def completion_index(uni: DataFrame, min_count: int = C.TRUNC_MIN_COUNT, most: int = C.TRUNC_SHOWN, min_length: int = C.TRUNC_MIN_LENGTH) -> DataFrame:
    """(prefix, word, n, missing): every attested word under its shorter prefixes."""
    rows = uni.where(F.col("c") >= min_count).select(F.col("w").alias("word"), F.col("c").alias("n"), F.explode(F.sequence(F.lit(1), F.lit(most))).alias("missing"))
    keep = F.char_length("word") - F.col("missing")
    return rows.where(keep >= min_length).select(F.expr("left(word, char_length(word) - missing)").alias("prefix"), "word", "n", F.col("missing").cast("long").alias("missing"))


def truncations(finals: DataFrame, uni: DataFrame, big: DataFrame, dash: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(hits, held) of cut-off line ends.  ``keep`` persists what is read several times: line
    ends that may be cut off, and the few of them with a completion.

    hits: position, observed, completions (top three as text), best, missing,
    beside, substitution, type_count.  held: (reason, n)."""
    index = completion_index(uni)
    observed = finals.where(F.col("raw").rlike(r"\p{L}$") & F.col("w").rlike(r"^\p{L}+$") & (F.char_length("w") >= C.TRUNC_MIN_LENGTH))
    rare = observed.join(uni.select("w", F.col("c").alias("oc")), "w", "left").where(F.coalesce("oc", F.lit(0)) <= C.TRUNC_MAX_OBSERVED)
    some = index.where(F.col("missing") <= C.TRUNC_MAX_MISSING).select(F.col("prefix").alias("w")).distinct()
    judged = keep(rare.join(some, "w", "left_semi").select("file", "para", "pos", "subtype", "w", "prev_w", "next_w", F.col("next_line").isNotNull().alias("has_next")))
    last_ones = judged.where(~F.col("has_next"))
    inner = judged.where("has_next").withColumn("lead", F.regexp_extract("next_w", f"^([{C.LETTERS}]+)", 1))
    # a word carried over a dropped mark: four equi-joins instead of a disjunction
    lead = F.when(F.col("lead") != "", F.col("lead"))
    probes = inner.withColumn("j1", F.concat("w", "next_w")).withColumn("j2", F.concat(F.col("w"), lead)).withColumn("lead", lead)
    word = uni.select(F.col("w").alias("_w"))
    compound = dash.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    free = (
        probes.join(word, F.col("j1") == F.col("_w"), "left_anti").join(word, F.col("j2") == F.col("_w"), "left_anti")
        .join(compound, (F.col("w") == F.col("_a")) & (F.col("next_w") == F.col("_b")), "left_anti")
        .join(compound, (F.col("w") == F.col("_a")) & (F.col("lead") == F.col("_b")), "left_anti")
        .drop("j1", "j2", "lead")
    )
    plain = big.where("plain > 0")
    offered = (
        free.join(index.withColumnRenamed("prefix", "w"), "w")
        .join(plain.select(F.col("a").alias("prev_w"), F.col("b").alias("word"), F.col("plain").alias("before")), ["prev_w", "word"], "left")
        .join(plain.select(F.col("a").alias("word"), F.col("b").alias("next_w"), F.col("plain").alias("after")), ["word", "next_w"], "left")
        .withColumn("beside", F.coalesce("before", F.lit(0)) + F.coalesce("after", F.lit(0)))
    )
    order = F.struct((-F.col("beside")).alias("o1"), (-F.col("n")).alias("o2"), F.char_length("word").alias("o3"), F.col("word"), F.col("n"), F.col("beside"), F.col("missing"))
    ranked = keep(offered.groupBy("file", "para", "pos", "subtype", F.col("w").alias("observed")).agg(
        F.slice(F.array_sort(F.collect_list(order)), 1, C.TRUNC_TOP).alias("top"), F.max(F.when(F.col("missing") <= C.TRUNC_MAX_MISSING, F.col("beside")).otherwise(F.lit(0))).alias("support")
    ))
    subs = final_variants(ranked.select(F.col("observed").alias("w")), uni, C.TRUNC_MIN_COUNT).groupBy(F.col("w").alias("observed")).agg(F.min_by("cand", F.struct(-F.col("n"), F.col("ord"))).alias("substitution"))
    kept = ranked.where("support > 0")
    types = kept.groupBy("observed").agg(F.count(F.lit(1)).alias("type_count"))
    hits = (
        kept.join(types, "observed").join(subs, "observed", "left")
        .select(
            "file", "para", "pos", "subtype", "observed", F.col("top")[0]["word"].alias("completion"), F.col("top")[0]["missing"].alias("missing"), F.col("top")[0]["beside"].alias("beside"),
            F.array_join(F.transform("top", lambda t: F.concat(t["word"], F.lit(":"), t["n"].cast("string"), F.lit("/"), t["beside"].cast("string"))), " ").alias("completions"),
            "substitution", "type_count",
        )
    )
    held = last_ones.select(F.lit("paragraph-final").alias("reason")).union(ranked.where("support = 0").select(F.lit("no completion beside a neighbour")))
    return hits, held.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def ambiguous(finals: DataFrame, uni: DataFrame, tally: DataFrame, completions: bool = True) -> DataFrame:
    """(position, w, prev_w, next_w, raw, cand): readings other than the observed one
    of line ends whose spelling is itself a frequent word.  ``tally``: the finals' words."""
    known = uni.where(F.col("c") >= C.MIN_CANDIDATE)
    words = tally.select("w").join(uni.where(F.col("c") >= C.AMBIGUOUS_AT).select("w"), "w", "left_semi")
    words = words.where((F.char_length("w") >= C.AMBIGUOUS_MIN_LENGTH) & ~((F.char_length("w") == 1) & F.col("w").rlike(r"^\p{Lu}")))
    cands = final_variants(words, uni, C.MIN_CANDIDATE).select("w", "cand", "ord")
    if completions:
        letters = F.create_map(*[F.lit(x) for pair in ((ch, 100 + i) for i, ch in enumerate(C.ALPHABET)) for x in pair])
        longer = known.select(F.col("w").alias("cand"), without_last(F.col("w")).alias("w"), letters[F.right("w", F.lit(1))].alias("ord")).where(F.col("ord").isNotNull())
        cands = cands.union(longer.join(words, "w", "left_semi").select("w", "cand", "ord"))
    return finals.where(is_word(F.col("w"))).select("file", "para", "pos", "w", "raw", "prev_w", "next_w", F.col("next_line").isNotNull().alias("has_line")).join(cands, "w")


def logp(prev_count: Column, pair_count: Column, word_count: Column, v: Column, n: Column) -> Column:
    """Interpolated bigram log probability; unigram where the previous word is unknown."""
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    p1 = (zero(word_count) + 1.0) / (n + v)
    mixed = F.lit(C.BIGRAM_WEIGHT) * zero(pair_count) / F.greatest(zero(prev_count), F.lit(1.0)) + (F.lit(1.0) - F.lit(C.BIGRAM_WEIGHT)) * p1
    return F.when(zero(prev_count) > 0, F.ln(F.greatest(mixed, F.lit(C.FLOOR_P)))).otherwise(F.ln(F.greatest(p1, F.lit(C.FLOOR_P))))


def with_counts(df: DataFrame, uni: DataFrame, big: DataFrame, words: dict[str, str], pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Left-joins unigram counts (name -> word column) and plain bigram counts
    (name -> two columns)."""
    for name, col in words.items():
        df = df.join(uni.select(F.col("w").alias(col), F.col("c").alias(name)), col, "left")
    for name, (a, b) in pairs.items():
        df = df.join(big.where("plain > 0").select(F.col("a").alias(a), F.col("b").alias(b), F.col("plain").alias(name)), [a, b], "left")
    return df


def channel_tables(judged: DataFrame, cut: DataFrame, tally: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Substitutions (own, intended, n), deletions (intended, n) and line ends by
    final letter (intended, n): at most a few thousand rows each, being letters."""
    subs = judged.where("verdict = 'MISREAD'").select(F.split("reason", "->")[0].alias("own"), F.split("reason", "->")[1].alias("intended"), "seen").groupBy("own", "intended").agg(F.sum("seen").alias("n"))
    dels = cut.where("missing = 1").groupBy(F.lower(F.right("completion", F.lit(1))).alias("intended")).agg(F.count(F.lit(1)).alias("n"))
    ends = tally.groupBy(F.lower(F.right("w", F.lit(1))).alias("intended")).agg(F.sum("seen").alias("n"))
    return subs, dels, ends


def frozen_channel(subs: DataFrame, dels: DataFrame, ends: DataFrame) -> DataFrame:
    """The channel in long form: kind, observed, intended, count."""
    empty = F.lit("").alias("observed")
    return (
        subs.select(F.lit("substitution").alias("kind"), F.col("own").alias("observed"), "intended", F.col("n").alias("count"))
        .union(dels.select(F.lit("deletion").alias("kind"), empty, "intended", F.col("n").alias("count")))
        .union(ends.select(F.lit("line_ends").alias("kind"), empty, "intended", F.col("n").alias("count")))
    )


def scored(items: DataFrame, uni: DataFrame, big: DataFrame, total: DataFrame, channel: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """Best reading of each ambiguous line end: margin, channel, score, evidence,
    gate reason.  One argmax aggregate, no window."""
    subs, dels, ends = channel
    df = items.withColumn("pw", F.when(F.col("prev_w") != "", F.col("prev_w"))).withColumn("nw", F.when(F.col("next_w") != "", F.col("next_w")))
    df = with_counts(
        df, uni, big, {"c_prev": "pw", "c_obs": "w", "c_cand": "cand", "c_next": "nw"},
        {"b_prev_obs": ("pw", "w"), "b_prev_cand": ("pw", "cand"), "b_obs_next": ("w", "nw"), "b_cand_next": ("cand", "nw")},
    )
    # letters only: one row for each pair of letters at most
    own, intended = F.lower(F.right("w", F.lit(1))), F.lower(F.right("cand", F.lit(1)))
    damaged = subs.select("intended", "n").union(dels.select("intended", "n")).groupBy(F.col("intended").alias("own")).agg(F.sum("n").alias("damaged"))
    df = (
        df.withColumn("own", own).withColumn("intended", intended).crossJoin(F.broadcast(total))
        .join(F.broadcast(subs.withColumnRenamed("n", "n_sub")), ["own", "intended"], "left").join(F.broadcast(dels.withColumnRenamed("n", "n_del")), "intended", "left")
        .join(F.broadcast(ends.select(F.col("intended"), F.col("n").alias("f_intended"))), "intended", "left")
        .join(F.broadcast(ends.select(F.col("intended").alias("own"), F.col("n").alias("f_own"))), "own", "left").join(F.broadcast(damaged), "own", "left")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    v, n, none = F.col("v"), F.col("n"), F.lit(None).cast("long")

    def total_of(word_count: str, before: str, after: str) -> Column:
        head = F.when(F.col("pw").isNotNull(), logp(none, none, F.col("c_prev"), v, n)).otherwise(F.lit(0.0))
        word = F.when(F.col("pw").isNotNull(), logp(F.col("c_prev"), F.col(before), F.col(word_count), v, n)).otherwise(logp(none, none, F.col(word_count), v, n))
        tail = F.when(F.col("nw").isNotNull(), logp(F.col(word_count), F.col(after), F.col("c_next"), v, n)).otherwise(F.lit(0.0))
        return head + word + tail

    keep = F.lit(1.0) - zero("damaged") / F.greatest(zero("f_own"), F.lit(1.0))
    hits = F.when(F.char_length("cand") == F.char_length("w") + 1, zero("n_del")).otherwise(zero("n_sub"))
    damage = (hits + C.SMOOTHING) / F.greatest(zero("f_intended"), F.lit(1.0))
    df = (
        df.withColumn("margin", total_of("c_cand", "b_prev_cand", "b_cand_next") - total_of("c_obs", "b_prev_obs", "b_obs_next"))
        .withColumn("channel", F.ln(damage) - F.ln(F.greatest(keep, F.lit(1e-9))))
        .withColumn("score", F.col("margin") + F.col("channel"))
        .withColumn("left_evidence", F.col("prev_w").isNotNull() & (zero("b_prev_obs") + zero("b_prev_cand") > 0))
        .withColumn("right_evidence", F.col("next_w").isNotNull() & (zero("b_obs_next") + zero("b_cand_next") > 0))
    )
    best = F.max(F.struct(F.round("score", 9).alias("r"), (-F.col("ord")).alias("o"), "cand", "margin", "channel", "score", "left_evidence", "right_evidence")).alias("x")
    top = df.groupBy("file", "para", "pos", "w", "raw", F.col("next_w").isNotNull().alias("has_next")).agg(best)
    out = top.select("file", "para", "pos", "w", "raw", "has_next", F.col("x.cand").alias("best"), "x.margin", "x.channel", "x.score", "x.left_evidence", "x.right_evidence")
    gate = (
        F.when(~F.col("has_next"), "paragraph-final").when(~F.col("raw").rlike(r"\p{L}$"), "trailing-punctuation").when(~F.col("right_evidence"), "no-right-bigram")
        .when(~F.col("left_evidence"), "no-left-bigram").when(F.col("w").rlike(r"^\p{Lu}") & F.col("best").rlike(r"^\p{Lu}"), "capitalised-pair").otherwise("passed")
    )
    return out.withColumn("gate", gate)


def break_margins(occ: DataFrame, uni: DataFrame, big: DataFrame, total: DataFrame) -> DataFrame:
    """Log odds of one word against two at each break, with one word of context."""
    return margins(occ, uni, big, total).select("file", "para", "pos", "left", "right", "hyphenated", "margin")


def margins(rows: DataFrame, uni: DataFrame, big: DataFrame, total: DataFrame) -> DataFrame:
    """Adds ``margin`` to rows of (left, right, h, t): log odds of one word against two
    between a word before and one after (null: unknown).

    A window of one word is the widest that matters in a bigram model: what stands
    further off is the same under both readings.  Rows of words hardly repeat, so they
    are looked up as they come, in one pass; words without one beside them need no lookup."""
    df = rows.withColumn("both", F.concat("left", "right"))
    df = with_counts(
        df, uni, big, {"c_h": "h", "c_left": "left", "c_right": "right", "c_both": "both", "c_t": "t"},
        {"b_h_both": ("h", "both"), "b_both_t": ("both", "t"), "b_h_left": ("h", "left"), "b_pair": ("left", "right"), "b_right_t": ("right", "t")},
    ).crossJoin(F.broadcast(total))
    v, n, c = F.col("v"), F.col("n"), F.col
    joined = logp(c("c_h"), c("b_h_both"), c("c_both"), v, n) + F.when(c("t").isNotNull(), logp(c("c_both"), c("b_both_t"), c("c_t"), v, n)).otherwise(F.lit(0.0))
    apart = logp(c("c_h"), c("b_h_left"), c("c_left"), v, n) + logp(c("c_left"), c("b_pair"), c("c_right"), v, n) + F.when(c("t").isNotNull(), logp(c("c_right"), c("b_right_t"), c("c_t"), v, n)).otherwise(F.lit(0.0))
    return df.select(*rows.columns, (joined - apart).alias("margin"))


def top_by(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def families(uni: DataFrame) -> DataFrame:
    """(stem, w, k, size, letter, ord, c): frequent words by what stands before their last
    letter; k numbers a stem's words (an alphabet of them and some capitals), size is their number."""
    letters = F.create_map(*[F.lit(x) for pair in ((ch, i) for i, ch in enumerate(C.ALPHABET)) for x in pair])
    last = F.right("w", F.lit(1))
    frequent = uni.where((F.col("c") >= C.AMBIGUOUS_AT) & (F.char_length("w") >= C.AMBIGUOUS_MIN_LENGTH))
    words = frequent.select(without_last(F.col("w")).alias("stem"), F.struct("w", F.ascii(last).alias("letter"), F.coalesce(letters[last], F.lit(-1)).alias("ord"), "c").alias("x"))
    sets = words.groupBy("stem").agg(F.array_sort(F.collect_list("x")).alias("x")).where(F.size("x") > 1)
    return sets.select("stem", F.size("x").alias("size"), F.posexplode("x").alias("k", "m")).select("stem", "m.w", "k", "size", "m.letter", "m.ord", "m.c")


def candidate_sets(uni: DataFrame) -> DataFrame:
    """(w, members, common): the words that a frequent word is chosen among, itself among
    them, as one text, and the commonest of them."""
    frequent = uni.where((F.col("c") >= C.AMBIGUOUS_AT) & (F.char_length("w") >= C.AMBIGUOUS_MIN_LENGTH))
    others = final_variants(frequent.select("w"), uni, C.MIN_CANDIDATE)
    own = others.select("w").distinct().join(uni.select("w", F.col("c").alias("n")), "w").select("w", F.col("w").alias("cand"), "n", F.lit(-1).alias("ord"))
    return others.union(own).groupBy("w").agg(F.array_join(F.array_sort(F.collect_set("cand")), "/").alias("members"), F.max_by("cand", F.struct("n", -F.col("ord"))).alias("common"))


def _log(prev: np.ndarray, pair: np.ndarray, word: np.ndarray, total: float) -> np.ndarray:
    """``logp`` over arrays; ``total``: n + v."""
    p1 = (word + 1.0) / total
    mixed = C.BIGRAM_WEIGHT * pair / np.maximum(prev, 1.0) + (1.0 - C.BIGRAM_WEIGHT) * p1
    return np.log(np.maximum(np.where(prev > 0, mixed, p1), C.FLOOR_P))


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether the model picks the written word: (w, n, correct).  All candidates of a batch
    lie in one array, a stretch of it for each row."""
    for b in batches:
        of = lambda name: b.column(b.schema.get_field_index(name))
        flat = lambda name: of(name).flatten().to_numpy(zero_copy_only=False)
        one = lambda name: of(name).to_numpy(zero_copy_only=False)
        size = one("size").astype(np.int64)
        start = np.cumsum(size) - size
        row = np.repeat(np.arange(len(size)), size)

        def spread(which: str) -> np.ndarray:
            """Counts of a row's pairs, at their words' places."""
            out = np.zeros(len(row))
            out[np.repeat(start, of(f"{which}_k").value_lengths().to_numpy(zero_copy_only=False)) + flat(f"{which}_k")] = flat(f"{which}_n")
            return out

        if not len(size):
            continue
        letter, order, c = flat("letters"), flat("ords"), flat("cs").astype(float)
        own = letter == one("own")[row]
        allowed = own | ((order >= 0) & (letter != one("low")[row]))
        total = float(one("total")[0])
        before, after = one("c_prev").astype(float)[row], one("c_next").astype(float)[row]
        value = np.round(_log(before, spread("before"), c, total) + _log(c, spread("after"), after, total), 9)
        value[~allowed] = -np.inf
        order = np.where(own, -1, order)
        best = value == np.maximum.reduceat(value, start)[row]
        first = np.minimum.reduceat(np.where(best, order, len(C.ALPHABET)), start)
        n, several = one("n"), np.add.reduceat(allowed.astype(np.int64), start) > 1
        yield pa.RecordBatch.from_arrays([of("w"), pa.array(n), pa.array(np.where(first == -1, n, 0))], ["w", "n", "correct"]).filter(pa.array(several))


def answered(lines: DataFrame, uni: DataFrame, big: DataFrame, total: DataFrame) -> DataFrame:
    """(w, members, common, n, correct) of interior words as labelled line ends, which no line
    break touched: occurrences of each frequent word, and how often the model picks it among
    its substitutions.

    An occurrence stays one row: the counts of all candidates beside its neighbour are one row
    of a table by (neighbour, stem), so that candidates are never multiplied with occurrences
    in a shuffle.  Alike occurrences of a task go as one."""
    fam = families(uni)
    known = fam.select("stem", "w", "k")
    side = lambda of, by, word: (
        big.select(F.col(by), F.col(word).alias("w"), "plain").join(known, "w").groupBy("stem", by).agg(F.collect_list("k").alias("k"), F.collect_list("plain").alias("n"))
        .join(uni.select(F.col("w").alias(by), F.col("c").alias(f"c_{of}")), by)
    )
    before = side("prev", "a", "b").select(F.col("a").alias("prev_w"), "stem", "c_prev", F.col("k").alias("before_k"), F.col("n").alias("before_n"))
    sets = fam.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("k", "letter", "ord", "c"))).alias("x"))
    sets = sets.select("stem", F.size("x").alias("size"), F.col("x.letter").alias("letters"), F.col("x.ord").alias("ords"), F.col("x.c").alias("cs"))
    after = side("next", "b", "a").join(sets, "stem").select(F.col("b").alias("next_w"), "stem", "c_next", F.col("k").alias("after_k"), F.col("n").alias("after_n"), "size", "letters", "ords", "cs")
    last = F.right("w", F.lit(1))
    rows = trigrams(lines).withColumn("stem", without_last(F.col("w"))).join(before.hint("merge"), ["prev_w", "stem"]).drop("prev_w").join(after.hint("merge"), ["stem", "next_w"])
    rows = rows.select("*", F.ascii(last).alias("own"), F.ascii(F.lower(last)).alias("low")).drop("next_w", "stem").crossJoin(F.broadcast(total.select((F.col("n") + F.col("v")).alias("total"))))
    said = rows.mapInArrow(_chosen, "w string, n long, correct long").groupBy("w").agg(F.sum("n").alias("n"), F.sum("correct").alias("correct"))
    return said.join(candidate_sets(uni), "w").select("w", "members", "common", "n", "correct")


def evaluated(answers: DataFrame) -> DataFrame:
    """(w, n, correct, majority): per true word, how often the model and the commonest
    reading pick it."""
    return answers.select("w", "n", "correct", F.when(F.col("common") == F.col("w"), F.col("n")).otherwise(F.lit(0)).alias("majority"))
