"""Query catalogue: each query as a Spark plan with its SQL twin.

``Corpus`` names the shared tables of one input, lazily.  Lines, breaks and line ends are
read from the columnar input each time, being as large as the corpus itself; what is
counted from them (lexicon, evidence, verdicts, scores of doubtful line ends) feeds many
queries and is persisted (memory, then disk): a plan reads it as a leaf, lost parts are
recomputed, and ``release`` lets it go.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from linemend import constants as C
from linemend.functions import text as T
from linemend.operators import breaks as B
from linemend.operators import correction as K
from linemend.operators import lexicon as L
from linemend.operators import lineends as E
from linemend.operators import replies as R
from linemend.operators import steps as P
from linemend.operators import stores as S
from linemend.plans.oracles import GOLD, over, over_gold
from linemend.sources import corpus as D

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

SKIPPED = ("src0", "src3")
KNOWN = ("src0", "src1", "src2", "src3", "src4", "src5")
RULES = (("Lancut", "Lańcut"), ("Lańcut", "Łańcut"), (" the ", " ye "), (" ye of ", " of ye "), ("und ", "vnd "), (" la ", " là "), ("ción", "çión"))
#: Floors for the test corpus, which is far smaller than a real one.
SMALL_FLOOR = 3


class Corpus:
    _known: dict[tuple[str, str], Corpus] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._held: list[DataFrame] = []

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Corpus:
        """The corpus of an input in this application; the former input's is released."""
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._known:
            for old in cls._known.values():
                if old.spark.sparkContext._jsc is not None and old.spark.sparkContext.applicationId == key[0]:
                    old.release()
            cls._known.clear()
            cls._known[key] = cls(spark, sf_dir)
        return cls._known[key]

    @classmethod
    def forget(cls) -> None:
        """Releases every input."""
        for old in cls._known.values():
            old.release()
        cls._known.clear()

    def held(self, df: DataFrame) -> DataFrame:
        self._held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def release(self) -> None:
        for df in self._held:
            df.unpersist()
        self._held.clear()

    def table(self, name: str) -> DataFrame:
        return D.table(self.spark, self.dir, name)

    @cached_property
    def paragraphs(self) -> DataFrame:
        return D.rewrapped(self.table("documents"))

    @cached_property
    def lines(self) -> DataFrame:
        return D.lines_of(self.paragraphs)

    @cached_property
    def lexicon(self) -> DataFrame:
        """All counts, made in one pass over the lines; what needs pairs of words reads it
        first, so that ``uni`` and ``dash`` need no pass of their own."""
        return self.held(L.lexicon(self.lines))

    @cached_property
    def uni(self) -> DataFrame:
        return self.held(L.unigrams_of(self.lexicon) if "lexicon" in self.__dict__ else L.unigrams(self.lines))

    @cached_property
    def big(self) -> DataFrame:
        return L.bigrams_of(self.lexicon)

    @cached_property
    def dash(self) -> DataFrame:
        return self.held(L.dashed_of(self.lexicon) if "lexicon" in self.__dict__ else L.dashed(self.lines))

    @cached_property
    def totals(self) -> DataFrame:
        return self.held(L.totals(self.uni))

    @cached_property
    def long(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """The lexicon that breaks are judged by: uni, big, dash, totals."""
        big = L.long_scope(self.big)
        uni = L.long_scope(self.uni)
        return uni, big, L.long_scope(self.dash), L.totals(uni)

    @cached_property
    def long_lines(self) -> DataFrame:
        return D.lines_of(self.paragraphs, min_lines=L.LONG)

    @cached_property
    def breaks(self) -> DataFrame:
        return B.breaks(self.lines)

    @cached_property
    def evidence(self) -> DataFrame:
        return self.held(B.pair_evidence(B.pair_counts(self.breaks), *self.long[:3]))

    @cached_property
    def contested(self) -> DataFrame:
        """The contested pairs, counted here and now: they are few, and a plan that knows it
        sends them to the lines instead of shuffling lines to them."""
        found = self.held(B.contested(self.evidence, SMALL_FLOOR))
        found.count()
        return found

    @cached_property
    def verdicts(self) -> DataFrame:
        return self.held(B.verdicts(self.evidence))

    @cached_property
    def store(self) -> DataFrame:
        """A stand-in for answers of a judge: some undecided pairs, as rule rows."""
        open_ = self.evidence.withColumn("d", B.decide_form()).where(F.col("d.form").isNull() & (F.col("hyphenated") > 0) & (F.col("plain") > 0))
        form = F.when(F.char_length("left") % 2 == 0, "join").otherwise("context")
        return open_.where(F.char_length("right") % 3 == 0).select("left", "right", form.alias("form"), F.lit("rule").alias("source"))

    @cached_property
    def finals(self) -> DataFrame:
        return E.line_finals(self.lines)

    @cached_property
    def tally(self) -> DataFrame:
        return self.held(E.final_tally(self.finals))

    @cached_property
    def tokens_judged(self) -> DataFrame:
        return self.held(E.token_verdicts(self.tally, self.uni))

    @cached_property
    def truncated(self) -> tuple[DataFrame, DataFrame]:
        big = self.big
        hits, held = E.truncations(self.finals, self.uni, big, self.dash, self.held)
        return self.held(hits), held

    @cached_property
    def channel(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        cut = self.truncated[0]
        subs, dels, ends = E.channel_tables(self.tokens_judged, cut, self.tally)
        return self.held(subs), self.held(dels), self.held(ends)

    @cached_property
    def scored(self) -> DataFrame:
        channel = self.channel
        return self.held(E.scored(E.ambiguous(self.finals, self.uni, self.tally), self.uni, self.big, self.totals, channel))

    @cached_property
    def answers(self) -> DataFrame:
        big = self.big
        return E.answered(self.lines, self.uni, big, self.totals)

    @cached_property
    def marks(self) -> DataFrame:
        return K.break_marks(self.lines, self.verdicts)


def query(sql: str | None = None, plain: bool = False) -> Callable[[Callable[[Corpus], DataFrame]], Query]:
    """Registers a query; ``plain`` SQL stands by itself, other SQL reads the layers."""

    def put(build: Callable[[Corpus], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Corpus.of(spark, sf_dir))

        _QUERIES[build.__name__] = run
        if sql is not None:
            _SQL[build.__name__] = sql if plain else over(sql)
        return run

    return put


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def count(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


# ---- lines, tokens, lexicon -----------------------------------------------------------


@query("SELECT file, count(*) AS n_lines, CAST(sum(len(toks)) AS BIGINT) AS n_tokens, count(*) FILTER (right(line, 1) IN ('¬', '-', '=')) AS n_marked FROM nb GROUP BY file")
def lines_scan(c: Corpus) -> DataFrame:
    return c.lines.groupBy("file").agg(count("n_lines"), F.sum(F.size("toks")).alias("n_tokens"), F.count(F.when(T.ends_with_mark(F.col("line")), 1)).alias("n_marked"))


@query(f"SELECT subtype, count(*) AS n_lines, count(*) FILTER (n_lines >= 2) AS n_in_long FROM nb WHERE subtype NOT IN {SKIPPED} GROUP BY subtype")
def lines_skip_subtypes(c: Corpus) -> DataFrame:
    return D.lines_of(c.paragraphs, skip_subtypes=SKIPPED).groupBy("subtype").agg(count("n_lines"), F.count(F.when(F.col("n_lines") >= 2, 1)).alias("n_in_long"))


@query(f"SELECT DISTINCT source AS subtype FROM documents WHERE source NOT IN {KNOWN}", plain=True)
def unknown_subtypes(c: Corpus) -> DataFrame:
    return c.table("documents").select(F.col("source").alias("subtype")).where(~F.col("subtype").isin(*KNOWN)).distinct()


@query("SELECT raw, w, count(*) AS n FROM it WHERE raw <> w GROUP BY ALL")
def tokens_normalised(c: Corpus) -> DataFrame:
    return L.interior_tokens(c.lines).where("raw <> w").groupBy("raw", "w").agg(count())


@query("SELECT file, count(*) AS n, count(DISTINCT w) AS types FROM it GROUP BY file")
def interior_tokens(c: Corpus) -> DataFrame:
    return L.interior_tokens(c.lines).groupBy("file").agg(count(), F.countDistinct("w").alias("types"))


@query("SELECT u.w, u.c, coalesce(l.c, 0) AS c_long FROM uni u LEFT JOIN unil l ON l.w = u.w")
def lexicon_unigrams(c: Corpus) -> DataFrame:
    return c.uni


@query("SELECT a, b, plain FROM big WHERE plain > 0")
def lexicon_bigrams(c: Corpus) -> DataFrame:
    return c.big.where("plain > 0").select("a", "b", "plain")


@query("SELECT a, b, plain, period, comma FROM big")
def lexicon_bigrams_by_separator(c: Corpus) -> DataFrame:
    return c.big.select("a", "b", "plain", "period", "comma")


@query("SELECT a, b, plain, period, comma FROM bigl")
def lexicon_bigrams_long(c: Corpus) -> DataFrame:
    return c.long[1]


@query("SELECT d.a, d.b, d.c, coalesce(l.c, 0) AS c_long FROM dash d LEFT JOIN dashl l ON l.a = d.a AND l.b = d.b")
def lexicon_dashed(c: Corpus) -> DataFrame:
    return c.dash


@query("SELECT v, n, (SELECT v FROM totl) AS v_long, (SELECT n FROM totl) AS n_long FROM tot")
def lexicon_totals(c: Corpus) -> DataFrame:
    # one row each
    return c.totals.crossJoin(F.broadcast(c.long[3].select(F.col("v").alias("v_long"), F.col("n").alias("n_long"))))


# ---- breaks ---------------------------------------------------------------------------


@query('SELECT file, para, pos, "left", "right", raw_left, raw_right, hyphenated FROM brk')
def break_pairs(c: Corpus) -> DataFrame:
    return c.breaks.select("file", "para", "pos", "left", "right", "raw_left", "raw_right", "hyphenated")


@query('SELECT "left", "right", hyphenated, plain FROM prs')
def break_pair_counts(c: Corpus) -> DataFrame:
    return B.pair_counts(c.breaks)


def _mode_sql(side: str) -> str:
    raw = f"raw_{side}"
    return (
        f'SELECT "left", "right", {raw} AS surface FROM (SELECT *, row_number() OVER (PARTITION BY "left", "right" ORDER BY n DESC, f, p, q) AS k FROM ('
        f'SELECT "left", "right", {raw}, count(*) AS n, min(file) AS f, min(para) FILTER (r = 1) AS p, min(pos) FILTER (r = 1) AS q FROM ('
        f'SELECT *, row_number() OVER (PARTITION BY "left", "right", {raw} ORDER BY file, para, pos) AS r FROM brk) GROUP BY "left", "right", {raw})) WHERE k = 1'
    )


@query(f'SELECT a."left", a."right", a.surface AS surface_left, b.surface AS surface_right FROM ({_mode_sql("left")}) a JOIN ({_mode_sql("right")}) b ON a."left" = b."left" AND a."right" = b."right"')
def pair_surface_modes(c: Corpus) -> DataFrame:
    return B.surface_modes(c.breaks)


@query(
    """SELECT "left", "right", slot, file, para, context FROM (SELECT *, row_number() OVER (PARTITION BY "left", "right", slot ORDER BY file, para, pos) AS k FROM (
    SELECT *, CASE WHEN hyphenated THEN 'hyphenated' ELSE 'plain' END AS slot FROM brk)) WHERE k = 1"""
)
def pair_first_examples(c: Corpus) -> DataFrame:
    return B.first_examples(c.breaks)


@query(
    """SELECT "left", "right", string_agg(context, ' || ' ORDER BY k) AS contexts FROM (
    SELECT *, row_number() OVER (PARTITION BY "left", "right" ORDER BY file, para, pos) AS k FROM brk) WHERE k <= 3 GROUP BY ALL"""
)
def pair_contexts_top3(c: Corpus) -> DataFrame:
    return B.first_contexts(c.breaks)


@query('SELECT "left", "right", hyphenated, plain, join_count, dash_count, bigram_count, period_count, comma_count, left_count, right_count FROM ev')
def pair_evidence(c: Corpus) -> DataFrame:
    return c.evidence


@query('SELECT "left", "right", form0 AS form, reason0 AS reason FROM frm')
def pair_forms(c: Corpus) -> DataFrame:
    return c.evidence.select("left", "right", B.decide_form().alias("d")).select("left", "right", "d.form", "d.reason")


_V = '"left", "right", form, reason, verdict, bad_hyphenated, bad_plain, affected, total'


@query(f"SELECT {_V} FROM vd")
def pair_verdicts(c: Corpus) -> DataFrame:
    return c.verdicts.select(*_V.replace('"', "").split(", "))


def _totals_sql(table: str) -> str:
    return (
        f"SELECT verdict, CAST(sum(p) AS BIGINT) AS pairs, CAST(sum(o) AS BIGINT) AS occurrences FROM (SELECT verdict, 1 AS p, CASE WHEN verdict IN ('OK', 'CONTEXT') THEN total ELSE affected END AS o FROM {table} "
        f"UNION ALL SELECT 'OK', 0, total - affected FROM {table} WHERE verdict NOT IN ('OK', 'CONTEXT')) GROUP BY verdict"
    )


@query(_totals_sql("vd"))
def verdict_totals(c: Corpus) -> DataFrame:
    return B.verdict_totals(c.verdicts).select("verdict", F.col("pairs").cast("long").alias("pairs"), "occurrences")


@query("SELECT subtype, count(*) AS n FROM nb WHERE next_line IS NULL AND right(line, 1) IN ('¬', '-', '=') GROUP BY subtype")
def paragraph_final_marks(c: Corpus) -> DataFrame:
    return B.paragraph_final_marks(c.lines)


@query("SELECT file, n_not, n_eq, CASE WHEN n_eq > n_not THEN '=' ELSE '¬' END AS notation FROM nota")
def notation_by_doc(c: Corpus) -> DataFrame:
    return B.notation(c.long_lines)


@query(f"SELECT {_V} FROM vds")
def pair_verdicts_with_store(c: Corpus) -> DataFrame:
    return B.verdicts(c.evidence, c.store).select(*_V.replace('"', "").split(", "))


@query(
    """SELECT v."left", v."right", affected, reason, 'join=' || v."left" || v."right" || '; hyphen=' || v."left" || '-' || v."right" || '; period=' || rtrim(v."left", '.,') || '. ' || v."right" || '; comma=' || rtrim(v."left", '.,') || ', ' || v."right"
    || '; split=' || v."left" || ' ' || v."right" AS candidates FROM vd v WHERE verdict = 'REVIEW' AND NOT EXISTS (SELECT 1 FROM store s WHERE s."left" = v."left" AND s."right" = v."right")"""
)
def review_queue(c: Corpus) -> DataFrame:
    open_ = S.unsettled(c.verdicts.where("verdict = 'REVIEW'"), c.store, ["left", "right"])
    return open_.select("left", "right", "affected", "reason", B.candidate_spellings().alias("candidates"))


@query(
    """SELECT form, "left", "right", CAST(k AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY form ORDER BY md5("left" || '|' || "right")) AS k FROM vd
    WHERE verdict <> 'REVIEW' AND form IN ('join', 'hyphen', 'period', 'comma', 'split')) WHERE k <= 25"""
)
def benchmark_set(c: Corpus) -> DataFrame:
    sure = c.verdicts.where((F.col("verdict") != "REVIEW") & F.col("form").isin("join", "hyphen", "period", "comma", "split"))
    return E.top_by(sure, ["form"], [F.md5(F.concat_ws("|", "left", "right"))], 25).select("form", "left", "right", "rank")


@query('SELECT verdict, reason, count(*) AS pairs, CAST(sum(affected) AS BIGINT) AS affected FROM vd GROUP BY ALL')
def verdict_reasons(c: Corpus) -> DataFrame:
    return c.verdicts.groupBy("verdict", "reason").agg(count("pairs"), F.sum("affected").alias("affected"))


# ---- line ends ------------------------------------------------------------------------


@query("SELECT w, seen FROM tally")
def line_final_tally(c: Corpus) -> DataFrame:
    return c.tally


@query("SELECT w, cand, n FROM vars20")
def final_letter_candidates(c: Corpus) -> DataFrame:
    return E.final_variants(c.tally, c.uni, C.TOKEN_MIN_COUNT).select("w", "cand", "n")


@query("SELECT w, seen, observed_count, best, best_count, runner_up, runner_count, verdict, reason FROM tv")
def token_verdicts(c: Corpus) -> DataFrame:
    return c.tokens_judged


@query("SELECT verdict, count(*) AS tokens, CAST(sum(seen) AS BIGINT) AS seen FROM tv GROUP BY verdict")
def token_verdict_totals(c: Corpus) -> DataFrame:
    return c.tokens_judged.groupBy("verdict").agg(count("tokens"), F.sum("seen").alias("seen"))


@query("SELECT reason, count(*) AS tokens, CAST(sum(seen) AS BIGINT) AS seen FROM tv WHERE verdict = 'MISREAD' GROUP BY reason")
def substitution_histogram(c: Corpus) -> DataFrame:
    return c.tokens_judged.where("verdict = 'MISREAD'").groupBy("reason").agg(count("tokens"), F.sum("seen").alias("seen"))


@query("SELECT w AS \"left\", '*' AS \"right\", best AS left_correct, '*' AS right_correct, 'high' AS confidence, 'rule' AS source FROM tv WHERE verdict = 'MISREAD'")
def misread_store_rows(c: Corpus) -> DataFrame:
    return E.misread_corrections(c.tokens_judged)


@query("SELECT prefix, word, n, missing FROM cidx")
def completion_index(c: Corpus) -> DataFrame:
    return E.completion_index(c.uni)


@query("SELECT file, para, pos, subtype, observed, completion, missing, beside, completions, substitution, type_count FROM hits")
def truncation_hits(c: Corpus) -> DataFrame:
    return c.truncated[0]


@query("SELECT reason, n FROM held")
def truncation_held(c: Corpus) -> DataFrame:
    return c.truncated[1]


@query("SELECT missing, subtype, count(*) AS n, count(DISTINCT observed) AS types FROM hits GROUP BY ALL")
def truncation_by_missing(c: Corpus) -> DataFrame:
    return c.truncated[0].groupBy("missing", "subtype").agg(count(), F.countDistinct("observed").alias("types"))


# ---- context model --------------------------------------------------------------------

_CONTESTED = f"(SELECT *, least(join_count + dash_count, bigram_count + period_count + comma_count) AS minority FROM ev WHERE least(join_count + dash_count, bigram_count + period_count + comma_count) >= {SMALL_FLOOR})"


@query(f'SELECT "left", "right", hyphenated, plain, minority FROM {_CONTESTED}')
def contested_pairs(c: Corpus) -> DataFrame:
    return B.contested(c.evidence, SMALL_FLOOR).select("left", "right", "hyphenated", "plain", "minority")


@query(f'SELECT b.file, b.para, b.pos, b."left", b."right", b.hyphenated, b.context FROM brk b JOIN {_CONTESTED} c ON c."left" = b."left" AND c."right" = b."right"')
def contested_breaks(c: Corpus) -> DataFrame:
    return c.breaks.join(c.contested.select("left", "right"), ["left", "right"], "left_semi").select("file", "para", "pos", "left", "right", "hyphenated", "context")


@query('SELECT file, para, pos, "left", "right", hyphenated, round(margin, 6) AS margin FROM bm')
def break_margins(c: Corpus) -> DataFrame:
    return E.break_margins(c.breaks, c.long[0], c.long[1], c.long[3]).select("file", "para", "pos", "left", "right", "hyphenated", F.round("margin", 6).alias("margin"))


@query("SELECT CAST(gate AS INTEGER) AS gate, count(*) FILTER (round(margin, 6) >= gate) AS joined, count(*) FILTER (round(margin, 6) <= -gate) AS apart FROM bm, (VALUES (2), (4), (6), (8), (10), (12), (16)) AS g(gate) GROUP BY gate")
def break_gate_table(c: Corpus) -> DataFrame:
    m = F.round("margin", 6)
    rows = E.break_margins(c.breaks, c.long[0], c.long[1], c.long[3]).select(m.alias("m"))
    sums = rows.agg(*[F.count(F.when(F.col("m") >= g, 1)).alias(f"j{g}") for g in C.MARGIN_GATES], *[F.count(F.when(F.col("m") <= -g, 1)).alias(f"a{g}") for g in C.MARGIN_GATES])
    gates = F.array(*[F.struct(F.lit(g).alias("gate"), F.col(f"j{g}").alias("joined"), F.col(f"a{g}").alias("apart")) for g in C.MARGIN_GATES])
    return sums.select(F.explode(gates).alias("x")).select("x.gate", "x.joined", "x.apart")


@query("SELECT hyphenated, count(*) AS n, count(*) FILTER ((round(margin, 6) > 0) = hyphenated) AS agree, round(avg(round(margin, 6)), 4) AS mean_margin FROM bm GROUP BY hyphenated")
def break_eval(c: Corpus) -> DataFrame:
    m = F.round("margin", 6)
    rows = E.break_margins(c.breaks, c.long[0], c.long[1], c.long[3]).select("hyphenated", m.alias("m"))
    return rows.groupBy("hyphenated").agg(count(), F.count(F.when((F.col("m") > 0) == F.col("hyphenated"), 1)).alias("agree"), F.round(F.avg("m"), 4).alias("mean_margin"))


@query(f'SELECT c."left", c."right", u.c AS joined, coalesce(b.plain, 0) AS apart FROM {_CONTESTED} c LEFT JOIN unil u ON u.w = c."left" || c."right" LEFT JOIN bigl b ON b.a = c."left" AND b.b = c."right"')
def break_gold(c: Corpus) -> DataFrame:
    """Interior occurrences as labels of contested pairs: joined and apart."""
    pairs = B.contested(c.evidence, SMALL_FLOOR).select("left", "right", F.concat("left", "right").alias("both"))
    return (
        pairs.join(c.long[0].select(F.col("w").alias("both"), F.col("c").alias("joined")), "both", "left")
        .join(c.long[1].select(F.col("a").alias("left"), F.col("b").alias("right"), "plain"), ["left", "right"], "left")
        .select("left", "right", "joined", F.coalesce("plain", F.lit(0)).alias("apart"))
    )


@query("SELECT file, para, pos, w, cand FROM amb")
def ambiguous_line_ends(c: Corpus) -> DataFrame:
    return E.ambiguous(c.finals, c.uni, c.tally).select("file", "para", "pos", "w", "cand")


@query("SELECT file, para, pos, w, best, round(margin, 6) AS margin, round(channel, 6) AS channel, left_evidence, right_evidence, gate FROM sc")
def line_end_scores(c: Corpus) -> DataFrame:
    return c.scored.select("file", "para", "pos", "w", "best", F.round("margin", 6).alias("margin"), F.round("channel", 6).alias("channel"), "left_evidence", "right_evidence", "gate")


@query("SELECT gate, count(*) AS n FROM sc WHERE round(margin, 6) >= 4 GROUP BY gate")
def line_end_gates(c: Corpus) -> DataFrame:
    return c.scored.where(F.round("margin", 6) >= 4).groupBy("gate").agg(count())


@query("SELECT file, para, pos, w, best, round(score, 6) AS score FROM sc WHERE gate = 'passed' AND round(margin, 6) >= 4 ORDER BY round(score, 6) DESC, file, para, pos LIMIT 100")
def proposals_topk(c: Corpus) -> DataFrame:
    kept = c.scored.where((F.col("gate") == "passed") & (F.round("margin", 6) >= 4)).withColumn("score", F.round("score", 6))
    return kept.orderBy(F.desc("score"), "file", "para", "pos").select("file", "para", "pos", "w", "best", "score").limit(100)


@query("SELECT CASE WHEN length(w) >= 4 THEN 'long' ELSE 'short' END AS band, count(*) FILTER (round(margin, 6) >= 2) AS g2, count(*) FILTER (round(margin, 6) >= 6) AS g6, count(*) FILTER (round(margin, 6) >= 10) AS g10 FROM sc GROUP BY 1")
def line_end_bands(c: Corpus) -> DataFrame:
    m = F.round("margin", 6)
    band = F.when(F.char_length("w") >= 4, "long").otherwise("short").alias("band")
    return c.scored.groupBy(band).agg(*[F.count(F.when(m >= g, 1)).alias(f"g{g}") for g in (2, 6, 10)])


@query(
    """SELECT band, CAST(kk AS INTEGER) AS rank, file, para, pos, w, best FROM (SELECT *, row_number() OVER (PARTITION BY band ORDER BY md5(file || '/' || para || '/' || pos)) AS kk FROM (
    SELECT *, CASE WHEN round(margin, 6) >= 10 THEN '10' WHEN round(margin, 6) >= 8 THEN '08' WHEN round(margin, 6) >= 6 THEN '06' ELSE '00' END AS band FROM sc)) WHERE kk <= 20"""
)
def line_end_sample(c: Corpus) -> DataFrame:
    m = F.round("margin", 6)
    banded = c.scored.withColumn("band", F.when(m >= 10, "10").when(m >= 8, "08").when(m >= 6, "06").otherwise("00"))
    return E.top_by(banded, ["band"], [F.md5(F.concat_ws("/", "file", "para", "pos"))], 20).select("band", "rank", "file", "para", "pos", "w", "best")


@query(
    """SELECT kind, observed, intended, "count" FROM (SELECT 'substitution' AS kind, own AS observed, intended, n AS "count" FROM csub UNION ALL SELECT 'deletion', '', intended, n FROM cdel UNION ALL SELECT 'line_ends', '', intended, n FROM cend)"""
)
def channel_fit(c: Corpus) -> DataFrame:
    return E.frozen_channel(*c.channel)


@query("SELECT a.own, a.intended, a.n, coalesce(b.n, 0) AS back, round(a.n::DOUBLE / greatest(coalesce(b.n, 0), 1)::DOUBLE, 6) AS ratio FROM csub a LEFT JOIN csub b ON b.own = a.intended AND b.intended = a.own")
def channel_asymmetry(c: Corpus) -> DataFrame:
    subs = c.channel[0]
    back = subs.select(F.col("intended").alias("own"), F.col("own").alias("intended"), F.col("n").alias("b"))
    rows = subs.join(back, ["own", "intended"], "left").withColumn("back", F.coalesce("b", F.lit(0)))
    return rows.select("own", "intended", "n", "back", F.round(F.col("n") / F.greatest("back", F.lit(1)), 6).alias("ratio"))


# ---- stores ---------------------------------------------------------------------------

_FORMS = ("join", "hyphen", "period", "comma", "split", "skip", "context", "nonsense")
_BY_RANK = "CASE source WHEN 'manual' THEN 3 WHEN 'llm' THEN 2 WHEN 'rule' THEN 1 ELSE 0 END DESC"


def _pick(number: str, options: tuple[str, ...]) -> str:
    return f"CASE ({number}) % {len(options)} " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(options)) + " END"


def _chosen(number: Column, options: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in options]), (number % len(options) + 1).cast("int"))


# Rows of a store and of an arriving batch, made of all pairs: three and two rows a pair.
_ROWS = f"""(SELECT "left", "right", j, {_pick('length("left") + j', _FORMS)} AS form, {_pick('length("right") + 2 * j', ("manual", "llm", "rule", "other"))} AS source, 'n' || j AS note FROM prs, (VALUES (1), (2), (3)) AS v(j))"""
_BATCH = f"""(SELECT CASE WHEN length("right") % 3 = 0 THEN "left" || '§' ELSE "left" END AS "left", "right", j, {_pick('length("left") + 3 * j', _FORMS[:5])} AS form, {_pick('length("right") + j', ("manual", "llm", "rule"))} AS source, 'b' || j AS note
  FROM prs, (VALUES (1), (2)) AS v(j))"""
_OLD = f"""(SELECT "left", "right", form, source, note FROM (SELECT *, row_number() OVER (PARTITION BY "left", "right" ORDER BY {_BY_RANK}, j DESC) AS k FROM {_ROWS} WHERE form <> 'nonsense') WHERE k = 1)"""
_NEW = f"""(SELECT "left", "right", form, source, note FROM (SELECT *, row_number() OVER (PARTITION BY "left", "right" ORDER BY {_BY_RANK}, j) AS k FROM {_BATCH}) WHERE k = 1)"""
_RANK = "CASE {x}.source WHEN 'manual' THEN 3 WHEN 'llm' THEN 2 WHEN 'rule' THEN 1 ELSE 0 END"


def _merge_sql(extra: str) -> str:
    better = f"({_RANK.format(x='n')} > {_RANK.format(x='o')}{extra})"
    pick = lambda c: f"CASE WHEN o.\"left\" IS NULL OR (n.\"left\" IS NOT NULL AND {better}) THEN n.{c} ELSE o.{c} END AS {c}"
    return (
        f'SELECT coalesce(o."left", n."left") AS "left", coalesce(o."right", n."right") AS "right", {pick("form")}, {pick("source")}, {pick("note")}, '
        f"CASE WHEN o.\"left\" IS NULL THEN 'inserted' WHEN n.\"left\" IS NOT NULL AND {better} THEN 'replaced' ELSE 'kept' END AS state FROM {_OLD} o FULL OUTER JOIN {_NEW} n ON o.\"left\" = n.\"left\" AND o.\"right\" = n.\"right\""
    )


def _numbered(c: Corpus, rows: int, forms: tuple[str, ...], step: int, sources: tuple[str, ...], times: int, note: str) -> DataFrame:
    j = F.col("row_no")
    pairs = B.pair_counts(c.breaks).select("left", "right", F.explode(F.sequence(F.lit(1), F.lit(rows))).alias("row_no"))
    return pairs.select("left", "right", "row_no", _chosen(F.char_length("left") + step * j, forms).alias("form"), _chosen(F.char_length("right") + times * j, sources).alias("source"), F.concat(F.lit(note), j.cast("string")).alias("note"))


def _old(c: Corpus) -> DataFrame:
    return S.load_pairs(_numbered(c, 3, _FORMS, 1, ("manual", "llm", "rule", "other"), 2, "n")).drop("row_no")


def _new(c: Corpus) -> DataFrame:
    rows = _numbered(c, 2, _FORMS[:5], 3, ("manual", "llm", "rule"), 1, "b")
    return rows.withColumn("left", F.when(F.char_length("right") % 3 == 0, F.concat("left", F.lit("§"))).otherwise(F.col("left")))


@query(f"SELECT * FROM {_OLD}")
def store_load_dedupe(c: Corpus) -> DataFrame:
    return _old(c)


@query(_merge_sql(" AND n.form <> o.form"))
def store_merge_pairs(c: Corpus) -> DataFrame:
    return S.merge_pairs(_old(c), _new(c))


@query(_merge_sql(""))
def store_merge_corrections(c: Corpus) -> DataFrame:
    return S.merge_corrections(_old(c), _new(c))


_OCC = 'file, line_facs, "left", "right", form, source'
_OCC_OLD = f"(SELECT file, para, pos, para || '_' || pos AS line_facs, \"left\", CASE WHEN (file + pos) % 7 = 0 THEN \"right\" || 'x' ELSE \"right\" END AS \"right\", 'split' AS form, CASE WHEN pos % 2 = 0 THEN 'manual' ELSE 'rule' END AS source FROM brk)"
_OCC_NEW = "(SELECT file, para, pos, para || '_' || pos AS line_facs, \"left\", \"right\", 'join' AS form, 'llm' AS source FROM brk)"


def _occurrences(c: Corpus) -> DataFrame:
    return c.breaks.withColumn("line_facs", F.concat_ws("_", "para", "pos"))


def _occ_old(c: Corpus) -> DataFrame:
    right = F.when((F.col("file") + F.col("pos")) % 7 == 0, F.concat("right", F.lit("x"))).otherwise(F.col("right"))
    return _occurrences(c).select("file", "line_facs", "left", right.alias("right"), F.lit("split").alias("form"), F.when(F.col("pos") % 2 == 0, "manual").otherwise("rule").alias("source"))


@query(
    f"""SELECT coalesce(o.file, n.file) AS file, coalesce(o.line_facs, n.line_facs) AS line_facs, CASE WHEN take THEN n."left" ELSE o."left" END AS "left", CASE WHEN take THEN n."right" ELSE o."right" END AS "right",
    CASE WHEN take THEN n.form ELSE o.form END AS form, CASE WHEN take THEN n.source ELSE o.source END AS source, CASE WHEN o.file IS NULL THEN 'inserted' WHEN take THEN 'replaced' ELSE 'kept' END AS state
    FROM {_OCC_OLD} o FULL OUTER JOIN {_OCC_NEW} n ON n.file = o.file AND n.para = o.para AND n.pos = o.pos,
    LATERAL (SELECT o.file IS NULL OR (n.file IS NOT NULL AND ({_RANK.format(x='n')} > {_RANK.format(x='o')} OR n."left" <> o."left" OR n."right" <> o."right")) AS take)"""
)
def store_merge_occurrences(c: Corpus) -> DataFrame:
    new = _occurrences(c).select("file", "line_facs", "left", "right", F.lit("join").alias("form"), F.lit("llm").alias("source"), F.lit(1).alias("row_no"))
    return S.merge_occurrences(_occ_old(c), new)


@query(
    f"""SELECT o.file, o.line_facs, o."left", o."right", b."left" AS left_now, b."right" AS right_now FROM {_OCC_OLD} o JOIN brk b ON b.file = o.file AND b.para = o.para AND b.pos = o.pos WHERE o."left" <> b."left" OR o."right" <> b."right" """
)
def stale_occurrences(c: Corpus) -> DataFrame:
    return S.stale(_occurrences(c), _occ_old(c)).select("file", "line_facs", "left", "right", "left_now", "right_now")


@query('SELECT "left", "right", hyphenated, plain FROM (SELECT *, row_number() OVER (ORDER BY "left", "right") AS k FROM prs) WHERE (k - 1) % 4 = 1')
def shard_round_robin(c: Corpus) -> DataFrame:
    return S.shard(B.pair_counts(c.breaks), [F.col("left"), F.col("right")], 2, 4)


# ---- joining, marking, correcting -----------------------------------------------------


@query(
    """SELECT file, para, string_agg(CASE WHEN next_line IS NULL THEN line WHEN right(line, 1) IN ('¬', '-', '=') THEN left(line, length(line) - 1) || CASE action WHEN 'space' THEN ' ' WHEN 'hyphen' THEN '-' ELSE '' END ELSE line || ' ' END, '' ORDER BY pos) AS text
    FROM act GROUP BY ALL"""
)
def joined_text_rule(c: Corpus) -> DataFrame:
    return c.paragraphs.select("file", "para", T.joined_by_rule(F.col("lines")).alias("text"))


@query(
    """SELECT n.file, n.para, string_agg(CASE WHEN n.next_line IS NULL THEN n.line ELSE CASE WHEN right(n.line, 1) IN ('¬', '-', '=') THEN left(n.line, length(n.line) - 1) ELSE n.line END
    || CASE m.break WHEN 'word' THEN '' WHEN 'compound' THEN '-' ELSE ' ' END END, '' ORDER BY n.pos) AS text FROM nb n LEFT JOIN mk m ON m.file = n.file AND m.para = n.para AND m.pos = n.pos GROUP BY ALL"""
)
def joined_text_marks(c: Corpus) -> DataFrame:
    marks = c.marks.groupBy("file", "para").agg(F.map_from_entries(F.collect_list(F.struct("pos", "break"))).alias("m"))
    rows = c.paragraphs.join(marks, ["file", "para"], "left")
    aligned = F.transform(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.try_element_at(F.col("m"), i.cast("long")))
    return rows.select("file", "para", T.joined_by_marks(F.col("lines"), aligned).alias("text"))


@query("SELECT file, para, pos, break, source, CASE WHEN source = 'rule' THEN 'low' ELSE 'high' END AS cert FROM mk")
def break_marks(c: Corpus) -> DataFrame:
    return c.marks


@query("SELECT coalesce(break, 'none') AS break, source, count(*) AS n FROM mk GROUP BY ALL")
def mark_counts(c: Corpus) -> DataFrame:
    return c.marks.groupBy(F.coalesce("break", F.lit("none")).alias("break"), "source").agg(count())


@query(
    """SELECT file, para, pos, "left", "right", form, line AS before, after FROM (SELECT *, CASE WHEN hyphenated AND ending IN ('¬', '-', '=') THEN line WHEN hyphenated AND ending = '.' AND right(body, 1) = '.' THEN body WHEN hyphenated THEN body || ending
    WHEN form = 'join' THEN line || ending ELSE line END AS after FROM (SELECT b.file, b.para, b.pos, b."left", b."right", b.line, b.hyphenated, v.form, left(b.line, length(b.line) - 1) AS body,
      CASE v.form WHEN 'join' THEN CASE WHEN n_eq > n_not THEN '=' ELSE '¬' END WHEN 'hyphen' THEN CASE WHEN n_eq > n_not THEN '=' ELSE '-' END WHEN 'period' THEN '.' WHEN 'comma' THEN ',' WHEN 'split' THEN '' END AS ending
      FROM brk b JOIN vd v ON v."left" = b."left" AND v."right" = b."right" JOIN nota n ON n.file = b.file WHERE v.verdict IN ('FALSE_POSITIVE', 'FALSE_NEGATIVE', 'PERIOD', 'COMMA') AND v.affected >= 1)) WHERE after IS NOT NULL AND after <> line"""
)
def hyphen_corrections(c: Corpus) -> DataFrame:
    return K.mark_corrections(c.lines, c.verdicts, B.notation(c.long_lines)).select("file", "para", "pos", "left", "right", "form", "before", "after")


def _rules_sql(x: str) -> str:
    for old, new in RULES:
        x = f"replace({x}, '{old}', '{new}')"
    return x


@query(f"SELECT doc_id, {_rules_sql('text')} AS text FROM documents WHERE text IS NOT NULL", plain=True)
def replacements_applied(c: Corpus) -> DataFrame:
    return c.table("documents").where(F.col("text").isNotNull()).select("doc_id", T.apply_rules(F.col("text"), list(RULES)).alias("text"))


_CHAINED = """(SELECT w AS "old", best AS "new" FROM tv WHERE best IS NOT NULL UNION ALL SELECT left(w, length(w) - 1), w FROM tv WHERE length(w) > 2)"""


@query(f"""SELECT DISTINCT a."old", a."new", b."old" AS next_old FROM {_CHAINED} a JOIN (SELECT DISTINCT "old" FROM {_CHAINED}) b ON b."old" <> a."old" AND contains(a."new", b."old") AND NOT contains(a."old", b."old") WHERE a."old" <> a."new" """)
def rule_chains(c: Corpus) -> DataFrame:
    """Rules made of the line-final words: misread ones, and ones that lack their last letter."""
    judged = c.tokens_judged
    misread = judged.where(F.col("best").isNotNull()).select(F.col("w").alias("old"), F.col("best").alias("new"))
    cut = judged.where(F.char_length("w") > 2).select(T.without_last(F.col("w")).alias("old"), F.col("w").alias("new"))
    return K.rule_chains(misread.union(cut)).distinct()


_UHR = "doc_id * 37 % 2400"


@query(f"""SELECT doc_id, regexp_replace(coalesce(text, '') || ' um ' || ({_UHR}) || ' Uhr', '(^|[^0-9])(1[0-2]|[1-9])([0-5][0-9]) Uhr', '\\1\\2.\\3 Uhr', 'g') AS fixed FROM documents""", plain=True)
def uhr_fix(c: Corpus) -> DataFrame:
    text = F.concat(F.coalesce("text", F.lit("")), F.lit(" um "), F.expr(_UHR).cast("string"), F.lit(" Uhr"))
    return c.table("documents").select("doc_id", T.times_before(text).alias("fixed"))


# A sentence with a date, page numbers, a time and a school year for each document; letters
# stand for some of its digits, and the SQL says what they were.
_DAY, _YEAR, _PAGE, _HOUR, _MINUTE, _SCHOOL = "doc_id % 31 + 1", "doc_id * 7 % 229 + 1701", "doc_id % 99 + 1", "doc_id % 12 + 1", "doc_id * 11 % 60", "doc_id % 78 + 1860"


@query(
    f"""SELECT doc_id, 'am ' || ({_DAY}) || '. Mai ' || ({_YEAR}) || ', Nummer ' || ({_PAGE}) || ' und Seite ' || ({_PAGE}) || ' um ' || ({_HOUR}) || '.' || lpad(({_MINUTE})::VARCHAR, 2, '0') || ' Uhr, ' || ({_SCHOOL}) || '/' || lpad((({_SCHOOL}) % 100 + 1)::VARCHAR, 2, '0')
    || '; aber ' || ({_SCHOOL}) || '00 und Seite zeigen' AS fixed FROM documents WHERE ({_SCHOOL}) % 100 <> 99""",
    plain=True,
)
def digit_fixes(c: Corpus) -> DataFrame:
    text = lambda e: F.expr(e).cast("string")
    swap = lambda s, a, b: F.translate(s, a, b)
    day, year, page = text(_DAY), text(_YEAR), text(_PAGE)
    two = F.char_length(day) == 2
    day = F.when(two, F.concat(swap(F.left(day, F.lit(1)), "1", "r"), swap(F.right(day, F.lit(1)), "015", "ors"))).otherwise(swap(day, "1", "r"))
    year = F.concat(F.lit("r"), F.substring(year, 2, 1), swap(F.substring(year, 3, 1), "025", "ozs"), swap(F.substring(year, 4, 1), "125", "rzs"))
    time = F.concat(text(_HOUR), F.lpad(text(_MINUTE), 2, "0"))
    school, then = text(_SCHOOL), F.lpad((F.expr(_SCHOOL) % 100 + 1).cast("string"), 2, "0")
    wrong = F.concat(
        F.lit("am "), day, F.lit(". Mai "), year, F.lit(", Nummer "), swap(page, "1025", "rozs"), F.lit(" und Seite "), swap(page, "15", "rs"), F.lit(" um "), time, F.lit(" Uhr, "), school, then, F.lit("; aber "), school, F.lit("00 und Seite zeigen"),
    )
    docs = c.table("documents").where(F.expr(f"({_SCHOOL}) % 100 <> 99"))
    return docs.select("doc_id", K.digit_fixes(wrong)["text"].alias("fixed"))


# ---- other inputs ---------------------------------------------------------------------


@query(
    r"""SELECT page_id AS file, CAST(i AS BIGINT) AS para, array_to_string(list_filter(string_split(trim(regexp_replace(x, '<[^>]+>', '', 'g'), ' '), chr(10)), lambda s: trim(s) <> ''), ' ') AS text FROM (
    SELECT page_id, unnest(regexp_extract_all(coalesce(html, ''), '(?s)<p(?:\s[^>]*)?>(.*?)</p>', 1)) AS x, generate_subscripts(regexp_extract_all(coalesce(html, ''), '(?s)<p(?:\s[^>]*)?>(.*?)</p>', 1), 1) AS i FROM pages)""",
    plain=True,
)
def pages_paragraphs(c: Corpus) -> DataFrame:
    return D.page_paragraphs(c.table("pages")).select("file", "para", F.array_join("lines", " ").alias("text"))


@query(
    """SELECT conv_id, turn, role, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text, right(text, 1) IN ('¬', '-', '=') AS marked FROM conversations""",
    plain=True,
)
def conversation_lines(c: Corpus) -> DataFrame:
    """Turns as lines of a paragraph whose lines are rows of their own."""
    return c.table("conversations").select("conv_id", "turn", "role", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn")).alias("next_text"), T.ends_with_mark(F.col("text")).alias("marked"))


_KIND = '(length("left") + length("right")) % 5'


@query(
    f"""SELECT "left", "right", CASE {_KIND} WHEN 0 THEN 'split' WHEN 1 THEN 'split' WHEN 2 THEN 'split' WHEN 3 THEN NULL ELSE 'skip' END AS form,
    CASE WHEN {_KIND} = 3 THEN 'unparseable reply: nope ' || m ELSE m END AS reason FROM (SELECT *, md5("left" || '|' || "right") AS m FROM prs)"""
)
def reply_json_parse(c: Corpus) -> DataFrame:
    """A reply for each pair: plain, after thinking, alike labels, unreadable, unknown label."""
    m = F.md5(F.concat_ws("|", "left", "right"))
    answer = lambda form: F.to_json(F.struct(F.lit(form).alias("form"), m.alias("reason")))
    kind = (F.char_length("left") + F.char_length("right")) % 5
    reply = (
        F.when(kind == 0, answer("split")).when(kind == 1, F.concat(F.lit('<think>{"form":"join"}</think>'), answer("split"))).when(kind == 2, F.concat(F.lit("so: "), answer("period/split")))
        .when(kind == 3, F.concat(F.lit("nope "), m)).otherwise(answer("nonsense"))
    )
    asked = B.pair_counts(c.breaks).select("left", "right", reply.alias("reply"))
    parsed = R.form_answers(asked, carry=("left", "right"))
    return parsed.select("left", "right", "form", "reason")


_ISSUE = "'issue_' || strftime(DATE '1914-01-01' + CAST(doc_id % 400 AS INTEGER), '%Y%m%d') || '_' || doc_id || '.xml'"


@query(
    f"""WITH d AS (SELECT doc_id, strftime(DATE '1914-01-01' + CAST(doc_id % 400 AS INTEGER), '%Y-%m-%d') AS day, {_ISSUE} AS file, CASE WHEN doc_id % 3 > 0 THEN doc_id % 3 END AS page FROM documents),
    ids AS (SELECT day, min(doc_id) AS id FROM d GROUP BY day HAVING min(doc_id) % 2 = 0)
    SELECT file, page, CASE WHEN id IS NOT NULL THEN 'https://example.org/doc/' || id || CASE WHEN page IS NOT NULL THEN '/page/' || page ELSE '' END END AS link FROM d LEFT JOIN ids ON ids.day = d.day""",
    plain=True,
)
def links(c: Corpus) -> DataFrame:
    """Issue files named by date and the mapping of half the dates, written in two ways."""
    docs = c.table("documents")
    day = F.date_add(F.lit("1914-01-01").cast("date"), (F.col("doc_id") % 400).cast("int"))
    file = F.concat(F.lit("issue_"), F.date_format(day, "yyyyMMdd"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".xml"))
    ids = docs.groupBy(day.alias("day")).agg(F.min("doc_id").alias("id")).where("id % 2 = 0")
    ids = ids.select(F.when(F.col("id") % 4 == 0, F.date_format("day", "yyyy-MM-dd")).otherwise(F.date_format("day", "yyyy/MM/dd")).alias("day"), F.col("id").cast("string").alias("id"))
    rows = docs.select(file.alias("file"), F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 3).alias("page"))
    return P.document_links(rows, ids, "https://example.org/doc/")


@query(
    "SELECT kind, own, CAST(sum(n) AS BIGINT) AS n FROM (SELECT 'substitution' AS kind, intended AS own, n FROM csub UNION ALL SELECT 'deletion', intended, n FROM cdel) GROUP BY ALL"
)
def damage_by_letter(c: Corpus) -> DataFrame:
    subs, dels, _ = c.channel
    both = subs.select(F.lit("substitution").alias("kind"), F.col("intended").alias("own"), "n").union(dels.select(F.lit("deletion").alias("kind"), F.col("intended").alias("own"), "n"))
    return both.groupBy("kind", "own").agg(F.sum("n").alias("n"))


@query(
    """SELECT label, count(*) AS planted, count(*) FILTER (v.verdict IN ('FALSE_POSITIVE', 'FALSE_NEGATIVE')) AS flagged FROM lines l LEFT JOIN brk b ON b.file = l.file AND b.para = l.para AND b.pos = l.pos
    LEFT JOIN vd v ON v."left" = b."left" AND v."right" = b."right" WHERE label IN ('spur', 'nohy', 'split') GROUP BY label"""
)
def planted_recall(c: Corpus) -> DataFrame:
    """How much planted damage the pair verdicts flag."""
    ends = F.transform("labels", lambda x, i: F.struct(x.alias("label"), F.try_element_at("lines", i + 1).alias("line"), F.try_element_at("lines", i + 2).alias("next_line")))
    labels = c.paragraphs.select(F.explode(F.filter(ends, lambda x: x["label"].isin("spur", "nohy", "split"))).alias("x")).select("x.label", "x.line", "x.next_line")
    judged = B.with_breaks(labels, whole=True).select("label", "left", "right").join(c.verdicts.select("left", "right", "verdict"), ["left", "right"], "left")
    return judged.groupBy("label").agg(count("planted"), F.count(F.when(F.col("verdict").isin("FALSE_POSITIVE", "FALSE_NEGATIVE"), 1)).alias("flagged"))


@query(
    over_gold(
        f"""SELECT w, count(*) AS n, count(*) FILTER (best = w) AS correct, count(*) FILTER (common = w) AS majority FROM (SELECT file, para, pos, k, w, max(cand) FILTER (r1 = 1) AS best, max(cand) FILTER (r2 = 1) AS common FROM (
    SELECT *, row_number() OVER (PARTITION BY file, para, pos, k ORDER BY value DESC, ord) AS r1, row_number() OVER (PARTITION BY file, para, pos, k ORDER BY cc DESC, ord) AS r2 FROM {GOLD}) GROUP BY file, para, pos, k, w) GROUP BY w"""
    ),
    plain=True,
)
def line_end_eval(c: Corpus) -> DataFrame:
    return E.evaluated(c.answers)


@query(
    """SELECT form AS expected, said AS form, count(*) AS n, form = said AS "right" FROM (SELECT form, CASE WHEN regexp_matches("right", '^\\p{Ll}') AND "right" NOT IN ('und', 'oder') THEN 'join' WHEN regexp_matches("right", '^\\p{Lu}') THEN 'hyphen' ELSE 'skip' END AS said
    FROM vd WHERE verdict <> 'REVIEW' AND form IN ('join', 'hyphen', 'period', 'comma', 'split')) GROUP BY ALL"""
)
def benchmark_scores(c: Corpus) -> DataFrame:
    """The stand-in judge against the confident pairs."""
    sure = c.verdicts.where((F.col("verdict") != "REVIEW") & F.col("form").isin("join", "hyphen", "period", "comma", "split")).select("left", "right", F.col("form").alias("expected"))
    return R.confusion(R.adjudicate(sure).join(sure, ["left", "right"]))


@query(
    """SELECT "left", "right", 'Left: ' || "left" || chr(10) || 'Right: ' || "right" || chr(10) || 'Readings: join=' || "left" || "right" || '; hyphen=' || "left" || '-' || "right" || '; period=' || rtrim("left", '.,') || '. ' || "right"
    || '; comma=' || rtrim("left", '.,') || ', ' || "right" || '; split=' || "left" || ' ' || "right" || chr(10) || 'Why asked: ' || reason AS prompt FROM vd WHERE verdict = 'REVIEW'"""
)
def review_prompts(c: Corpus) -> DataFrame:
    return c.verdicts.where("verdict = 'REVIEW'").withColumn("candidates", B.candidate_spellings()).select("left", "right", R.pair_prompt().alias("prompt"))


_GAP_ROWS = "(SELECT missing, 900 + pos AS w1, 900 + file % 60 AS w2, 8 * length(observed) + para AS x_max FROM hits)"


@query(f"SELECT missing, CAST(round_even((w1 + w2) / 2.0 - x_max, 0) AS INTEGER) AS gap_px, count(*) AS n FROM {_GAP_ROWS} GROUP BY ALL")
def truncation_gaps(c: Corpus) -> DataFrame:
    """Distances from a cut-off line's end to its region's slanted right edge at its height."""
    return _gaps(c).groupBy("missing", "gap_px").agg(count())


def _gaps(c: Corpus) -> DataFrame:
    w1, w2 = (F.col("pos") + 900).cast("string"), (F.col("file") % 60 + 900).cast("string")
    points = F.concat(F.lit("0,0 "), w1, F.lit(",0 "), w2, F.lit(",200 0,200"))
    gap = F.bround(K.polygon_right_edge(points, F.lit(100.0)) - (8 * F.char_length("observed") + F.col("para")), 0)
    return c.truncated[0].select("missing", gap.cast("int").alias("gap_px"))


@query(
    f"""SELECT missing, CAST(g AS INTEGER) AS gap_px FROM (SELECT missing, g, row_number() OVER (PARTITION BY missing ORDER BY g) AS k, count(*) OVER (PARTITION BY missing) AS n
    FROM (SELECT missing, round_even((w1 + w2) / 2.0 - x_max, 0) AS g FROM {_GAP_ROWS})) WHERE k = n // 2 + 1"""
)
def truncation_gap_median(c: Corpus) -> DataFrame:
    """The upper median of the gaps, from their counts: no list of gaps is gathered."""
    counted = _gaps(c).groupBy("missing", "gap_px").agg(count())
    up_to = F.sum("n").over(Window.partitionBy("missing").orderBy("gap_px"))
    total = F.sum("n").over(Window.partitionBy("missing"))
    return counted.withColumns({"u": up_to, "t": total}).where(F.col("u") > F.floor(F.col("t") / 2)).groupBy("missing").agg(F.min("gap_px").alias("gap_px"))


@query("SELECT doc_id AS file FROM documents WHERE doc_id % 11 NOT IN (3, 4) AND (doc_id % 3 > 1 OR (doc_id % 3 = 1 AND doc_id % 12 >= 9))", plain=True)
def current_issues(c: Corpus) -> DataFrame:
    """Issues whose header says version 1.9 or later; some versions are unreadable."""
    d = F.col("doc_id")
    version = F.when(d % 11 == 3, None).when(d % 11 == 4, "x.1").otherwise(F.concat((d % 3).cast("string"), F.lit("."), (d % 12).cast("string")))
    return c.table("documents").select(d.alias("file"), version.alias("version")).where(S.up_to_date(F.col("version"), "1.9")).select("file")


_STEPS = ((1, "read", None, True), (2, "correct", "fix", True), (3, "mark", "marks", True), (4, "review", None, False), (5, "check", "checked", True))


@query("SELECT doc_id AS file, CASE doc_id % 3 WHEN 0 THEN 'checked' ELSE 'marks' END AS ident FROM documents WHERE doc_id % 3 < 2", plain=True)
def steps_after(c: Corpus) -> DataFrame:
    """Markers that a change in the correcting step makes stale."""
    markers = c.table("documents").select(F.col("doc_id").alias("file"), _chosen(F.col("doc_id"), ("checked", "marks", "fix")).alias("ident"), F.lit("1.0").alias("version"))
    return P.outdated_markers(markers, P.step_table(c.spark, list(_STEPS)), "correct").select("file", "ident")


@query(f"""SELECT count(*) AS pairs, count(*) FILTER (form NOT IN ('skip', 'context')) AS acting, count(*) FILTER (source = 'manual') AS by_hand FROM {_OLD}""")
def store_metrics(c: Corpus) -> DataFrame:
    return _old(c).agg(count("pairs"), F.count(F.when(~F.col("form").isin("skip", "context"), 1)).alias("acting"), F.count(F.when(F.col("source") == "manual", 1)).alias("by_hand"))


# Queries of the later modules register themselves on import.
from linemend.plans import further as _further  # noqa: E402, F401
