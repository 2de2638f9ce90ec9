"""Further queries: corrections, reports, evaluation, notes, TEI issues made of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linemend import constants as C
from linemend.functions import text as T
from linemend.operators import breaks as B
from linemend.operators import correction as K
from linemend.operators import evaluation as V
from linemend.operators import lexicon as L
from linemend.operators import lineends as E
from linemend.operators import notes as N
from linemend.operators import reports as P
from linemend.operators import stores as S
from linemend.plans.catalog import _CONTESTED, _OLD, RULES, SMALL_FLOOR, Corpus, _old, count, query
from linemend.plans.oracles import GOLD, over_break_gold, over_gold, over_records
from linemend.sources import tei

_STRIP = C.STRIP_CHARS.replace("'", "''")


# ---- corrections ----------------------------------------------------------------------


@query(over_records("SELECT file, para, pos, before, after, outcome FROM records", RULES), plain=True)
def ocr_paragraph_diff(c: Corpus) -> DataFrame:
    return K.paragraph_corrections(c.paragraphs, list(RULES))


@query(over_records("SELECT outcome, count(*) AS n FROM records GROUP BY outcome", RULES), plain=True)
def correction_outcomes(c: Corpus) -> DataFrame:
    return K.paragraph_corrections(c.paragraphs, list(RULES)).groupBy("outcome").agg(count())


@query(
    f"""SELECT f.file, f.para, f.pos, trim(f.line) AS before, left(f.line, length(f.line) - length(f.raw)) || left(f.raw, length(f.raw) - length(ltrim(f.raw, '{_STRIP}'))) || t.best || right(f.raw, length(f.raw) - length(rtrim(f.raw, '{_STRIP}'))) AS after, 'applied' AS outcome
    FROM fin f JOIN tv t ON t.w = f.w AND t.verdict = 'MISREAD' WHERE trim(f.raw, '{_STRIP}') = f.w AND length(f.w) >= 2"""
)
def positional_fixes(c: Corpus) -> DataFrame:
    return K.positional_fixes(c.paragraphs, E.misread_corrections(c.tokens_judged).select("left", "right", "left_correct", "right_correct"))


_FIXES = """(SELECT w AS "left", '*' AS "right", CASE WHEN seen % 5 = 0 THEN w ELSE best END AS left_correct, CASE seen % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'low' END AS confidence,
  CASE length(w) % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE '' END AS approved FROM tv WHERE best IS NOT NULL)"""


@query(f"""SELECT "left", left_correct, confidence, approved, left_correct <> "left" AND approved <> 'no' AND (approved = 'yes' OR confidence = 'high') AS applies FROM {_FIXES}""")
def corrections_gated(c: Corpus) -> DataFrame:
    """Corrections as stored, cleaned when read, and whether each may change text."""
    seen, size = F.col("seen"), F.char_length("w")
    rows = c.tokens_judged.where(F.col("best").isNotNull()).select(
        F.lit(1).alias("row_no"), F.col("w").alias("left"), F.lit("*").alias("right"), F.when(seen % 5 == 0, F.col("w")).otherwise(F.col("best")).alias("left_correct"), F.lit("*").alias("right_correct"),
        F.when(seen % 4 == 0, "low").when(seen % 4 == 1, "Medium").when(seen % 4 == 2, "HIGH").otherwise("").alias("confidence"), F.when(size % 4 == 0, "YES").when(size % 4 == 1, "no").when(size % 4 == 2, "perhaps").alias("approved"), F.lit("llm").alias("source"),
    )
    return S.load_corrections(rows).select("left", "left_correct", "confidence", "approved", N.applies().alias("applies"))


@query("SELECT w, cand, n FROM vars20 WHERE lower(right(w, 1)) || right(cand, 1) IN ('nr', 'nm', 'rn', 'te', 'el')")
def final_letter_confusions(c: Corpus) -> DataFrame:
    return E.confused(E.final_variants(c.tally, c.uni, C.TOKEN_MIN_COUNT), "n:rm,r:n,t:e,e:l").select("w", "cand", "n")


_MARKED = "string_agg(CASE WHEN next_line IS NULL THEN line WHEN right(line, 1) IN ('¬', '-', '=') THEN left(line, length(line) - 1) || '¬ ' ELSE line || ' ' END, '' ORDER BY pos)"


@query(
    rf"""SELECT file, para, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '¬ (geb\.|v\.|gew\.|z\.|\()', ' \1', 'g'), '¬ (\p{{Lu}})', '-\1', 'g'), '¬ und', '-XXXund', 'g'), '¬ (út|üt|ut|utca)', '-\1', 'g'), '¬ ', '', 'g') AS text
    FROM (SELECT file, para, {_MARKED} AS t FROM nb GROUP BY file, para)"""
)
def joined_text_legacy(c: Corpus) -> DataFrame:
    """Text whose breaks still show as ``¬ ``, cleaned."""
    last = F.size("lines") - 1
    piece = lambda line, i: F.when(i == last, line).when(T.ends_with_mark(line), F.concat(T.without_last(line), F.lit("¬ "))).otherwise(F.concat(line, F.lit(" ")))
    return c.paragraphs.select("file", "para", T.without_breaks(F.array_join(F.transform("lines", piece), ""), "¬ ").alias("text"))


@query(
    """SELECT file, para, sum(length(CASE WHEN next_line IS NOT NULL AND right(line, 1) IN ('¬', '-', '=') THEN left(line, length(line) - 1) ELSE line END))::BIGINT AS from_lines,
    count(*) FILTER (next_line IS NOT NULL AND (right(line, 1) NOT IN ('¬', '-', '=') OR action <> 'remove')) AS put_in FROM act GROUP BY file, para"""
)
def joined_text_origins(c: Corpus) -> DataFrame:
    """Characters of the joined text by where they come from."""
    at = K.origins(F.col("lines"))
    rows = c.paragraphs.select("file", "para", at.alias("o"))
    return rows.select("file", "para", F.size(F.filter("o", lambda x: x.isNotNull())).cast("long").alias("from_lines"), F.size(F.filter("o", lambda x: x.isNull())).cast("long").alias("put_in"))


# ---- reports --------------------------------------------------------------------------

_SURFACE = """(SELECT "left", "right", max(s) FILTER (k = 1) AS s FROM (SELECT "left", "right", {raw} AS s, row_number() OVER (PARTITION BY "left", "right" ORDER BY count(*) DESC, min(file * 1000000000000 + para * 1000000 + pos)) AS k FROM brk GROUP BY "left", "right", {raw}) GROUP BY ALL)"""
_SHOWN = """(SELECT "left", "right", hyphenated, file, para, context FROM (SELECT *, row_number() OVER (PARTITION BY "left", "right", hyphenated ORDER BY file, para, pos) AS k FROM brk) WHERE k = 1)"""
_WANTED = ("FALSE_POSITIVE", "FALSE_NEGATIVE", "PERIOD", "COMMA", "CONTEXT")
_REPORT = f"""SELECT v.verdict, v.reason, v."left", v."right", CASE WHEN v.verdict = 'FALSE_POSITIVE' THEN sl || sr WHEN v.verdict = 'FALSE_NEGATIVE' THEN sl || ' ' || sr WHEN v.verdict IN ('PERIOD', 'COMMA') THEN sl || CASE WHEN regexp_matches(sr, '^\\p{{Lu}}') THEN '-' ELSE '' END || sr ELSE '' END AS find,
  CASE v.verdict WHEN 'FALSE_POSITIVE' THEN sl || ' ' || sr WHEN 'FALSE_NEGATIVE' THEN sl || sr WHEN 'PERIOD' THEN rtrim(sl, '.,') || '. ' || sr WHEN 'COMMA' THEN rtrim(sl, '.,') || ', ' || sr ELSE '' END AS replace, v.affected, v.hyphenated AS seen_hyphenated, v.plain AS seen_plain,
  v.join_count AS compound_freq, v.bigram_count AS bigram_freq, v.dash_count AS dashed_freq, v.period_count AS period_freq, v.comma_count AS comma_freq, v.left_count AS left_freq, v.right_count AS right_freq,
  coalesce(e.context, o.context) AS example_context, coalesce(e.file, o.file) AS example_file, coalesce(e.para, o.para) AS example_para
  FROM (SELECT *, verdict IN ('FALSE_POSITIVE', 'PERIOD', 'COMMA') OR (verdict = 'CONTEXT' AND hyphenated > 0) AS slot FROM vds WHERE verdict IN {_WANTED} AND (CASE WHEN verdict = 'CONTEXT' THEN total ELSE affected END) >= 1) v
  JOIN (SELECT "left", "right", s AS sl FROM {_SURFACE.format(raw="raw_left")}) x ON x."left" = v."left" AND x."right" = v."right" JOIN (SELECT "left", "right", s AS sr FROM {_SURFACE.format(raw="raw_right")}) y ON y."left" = v."left" AND y."right" = v."right"
  LEFT JOIN {_SHOWN} e ON e."left" = v."left" AND e."right" = v."right" AND e.hyphenated = v.slot LEFT JOIN {_SHOWN} o ON o."left" = v."left" AND o."right" = v."right" AND o.hyphenated <> v.slot"""


@query(_REPORT)
def pair_report(c: Corpus) -> DataFrame:
    return P.pair_report(B.verdicts(c.evidence, c.store), c.breaks, _WANTED, c.held)


@query(f'SELECT verdict, "left", "right", affected, find, replace FROM ({_REPORT}) WHERE verdict <> \'CONTEXT\'')
def find_replace(c: Corpus) -> DataFrame:
    return P.pair_report(B.verdicts(c.evidence, c.store), c.breaks, _WANTED[:4], c.held).select("verdict", "left", "right", "affected", "find", "replace")


@query(
    """SELECT verdict, reason, t.w AS observed, coalesce(best, '') AS suggested, seen AS seen_at_line_end, observed_count AS observed_freq, best_count AS suggested_freq, coalesce(runner_up, '') AS runner_up, runner_count AS runner_up_freq,
    line AS example_context, file AS example_file, para AS example_para, subtype AS region_subtype FROM tv t JOIN (SELECT *, row_number() OVER (PARTITION BY w ORDER BY file, para, pos) AS k FROM fin) f ON f.w = t.w AND k = 1 WHERE verdict IN ('MISREAD', 'REVIEW')"""
)
def token_report(c: Corpus) -> DataFrame:
    return P.token_report(c.tokens_judged, c.finals)


@query("""SELECT t.w AS observed, string_agg(v.cand || '=' || v.n, ' ' ORDER BY v.n DESC, v.ord) AS evidence, any_value(t.observed_count) AS observed_freq, any_value(t.reason) AS reason FROM tv t JOIN vars20 v ON v.w = t.w WHERE verdict = 'REVIEW' GROUP BY t.w""")
def token_review(c: Corpus) -> DataFrame:
    """Queue records, read back."""
    rows = P.token_review(c.tokens_judged, E.final_variants(c.tally, c.uni, C.TOKEN_MIN_COUNT))
    read = rows.select("observed", F.from_json("record", "candidates array<string>, evidence map<string, bigint>, reason string").alias("r"))
    of = F.transform("r.candidates", lambda x: F.concat(x, F.lit("="), F.col("r.evidence")[x].cast("string")))
    return read.select("observed", F.array_join(of, " ").alias("evidence"), F.col("r.evidence")["observed_freq"].alias("observed_freq"), "r.reason")


@query(
    f"""SELECT e."left", e."right", 'context' AS form, 'manual' AS source, 'both readings live in the corpus: joined ' || (join_count + dash_count) || 'x, apart ' || (bigram_count + period_count + comma_count) || 'x over ' || (hyphenated + plain) || ' breaks'
    || CASE WHEN o.form IS NULL THEN '; previously undecided' ELSE '; was ' || o.form || ' (' || o.source || ')' END AS note, hyphenated + plain AS n FROM {_CONTESTED} e LEFT JOIN {_OLD} o ON o."left" = e."left" AND o."right" = e."right" WHERE coalesce(o.form, '') <> 'context'"""
)
def context_promotions(c: Corpus) -> DataFrame:
    return P.promotions(B.contested(c.evidence, SMALL_FLOOR), _old(c))


@query("SELECT file, para, pos, observed, type_count, CAST(row_number() OVER (ORDER BY type_count DESC, lower(observed), file, para, pos) AS INTEGER) AS rank FROM hits QUALIFY rank <= 200")
def truncation_report_head(c: Corpus) -> DataFrame:
    """The first 200 rows of the truncation report, in its order."""
    head = c.truncated[0].orderBy(F.desc("type_count"), F.lower("observed"), "file", "para", "pos").limit(200)
    return E.top_by(head.withColumn("one", F.lit(1)), ["one"], [F.desc("type_count"), F.lower("observed"), F.col("file"), F.col("para"), F.col("pos")], 200).select("file", "para", "pos", "observed", "type_count", "rank")


# ---- evaluation -----------------------------------------------------------------------


@query(
    over_break_gold(
        """SELECT "left", "right", nj AS n_join, round(a / nj, 6) AS join_recall, ns AS n_split, round(b / ns, 6) AS split_recall, round((a / nj + b / ns) / 2, 6) AS balanced, round(greatest(nj, ns) / (nj + ns), 6) AS majority
        FROM (SELECT "left", "right", count(*) FILTER (hyphenated = 'join') AS nj, count(*) FILTER (hyphenated = 'split') AS ns, count(*) FILTER (hyphenated = 'join' AND round(margin, 9) > 0) AS a, count(*) FILTER (hyphenated = 'split' AND round(margin, 9) <= 0) AS b FROM bg GROUP BY ALL) WHERE nj > 0 AND ns > 0""",
        _CONTESTED,
    ),
    plain=True,
)
def break_pair_recall(c: Corpus) -> DataFrame:
    return V.break_recall(V.break_gold(c.long_lines, c.contested), c.long[0], c.long[1], c.long[3])


_SETS = f"""(SELECT members, sum(seen)::BIGINT AS n, round(avg(hit / seen), 6) AS balanced, round(max(seen) / sum(seen), 6) AS majority FROM (SELECT members, w, count(*) AS seen, count(*) FILTER (best = w) AS hit FROM (
  SELECT file, para, pos, k, w, max(cand) FILTER (r1 = 1) AS best, string_agg(DISTINCT cand, '/' ORDER BY cand) AS members FROM (SELECT *, row_number() OVER (PARTITION BY file, para, pos, k ORDER BY value DESC, ord) AS r1 FROM {GOLD}) GROUP BY ALL) GROUP BY ALL) GROUP BY members HAVING count(*) > 1)"""


@query(over_gold(f"SELECT * FROM {_SETS}"), plain=True)
def line_end_set_recall(c: Corpus) -> DataFrame:
    return V.set_recall(c.answers)


@query(over_gold(f"SELECT count(*) AS sets, round(sum(n * balanced) / sum(n), 6) AS balanced, round(sum(n * majority) / sum(n), 6) AS majority FROM {_SETS}"), plain=True)
def line_end_set_weighted(c: Corpus) -> DataFrame:
    return V.weighted(V.set_recall(c.answers))


@query(f"""SELECT count(*) AS comparable, count(*) FILTER ((round(b.margin, 9) > 0) <> (o.form IN ('join', 'hyphen'))) AS disagree FROM bm b JOIN {_OLD} o ON o."left" = b."left" AND o."right" = b."right" WHERE o.form NOT IN ('skip', 'context')""")
def break_disagreement(c: Corpus) -> DataFrame:
    return V.disagreement(E.break_margins(c.breaks, c.long[0], c.long[1], c.long[3]), _old(c))


# ---- notes ----------------------------------------------------------------------------

_QUEUE = f"""(SELECT o."left", o."right", o.form, o.note, x.contexts FROM {_OLD} o LEFT JOIN (SELECT "left", "right", string_agg(context, ' || ' ORDER BY k) AS contexts FROM (SELECT *, row_number() OVER (PARTITION BY "left", "right" ORDER BY file, para, pos) AS k FROM brk) WHERE k <= 3 GROUP BY ALL) x
  ON x."left" = o."left" AND x."right" = o."right" WHERE o.note IN ('n1', 'n3') AND length(o."left") % 4 <> 0)"""


def _queue(c: Corpus) -> DataFrame:
    done = B.pair_counts(c.breaks).where(F.char_length("left") % 4 == 0)
    return N.note_queue(_old(c), done, B.first_contexts(c.breaks), "N[13]")


@query(f"""SELECT "left", "right", 'Left: ' || "left" || chr(10) || 'Right: ' || "right" || chr(10) || 'Form: ' || form || chr(10) || 'Note: ' || note || chr(10) || 'Seen in: ' || contexts AS prompt FROM {_QUEUE}""")
def note_prompts(c: Corpus) -> DataFrame:
    return _queue(c).select("left", "right", N.note_prompt().alias("prompt"))


_N = 'length("left") % 4'


@query(
    f"""SELECT "left", "right", CASE {_N} WHEN 1 THEN "left" || 's' ELSE "left" END AS left_correct, CASE {_N} WHEN 1 THEN "right" || 'e' ELSE "right" END AS right_correct, CASE {_N} WHEN 1 THEN 'high' ELSE 'low' END AS confidence,
    CASE {_N} WHEN 1 THEN 'sure' WHEN 2 THEN 'two words' ELSE 'unparseable reply: no idea' END AS reason FROM {_QUEUE} WHERE length("right") < 60"""
)
def note_answers(c: Corpus) -> DataFrame:
    """Replies by rule: a correction, a phrase that is refused, an unreadable one."""
    n = F.char_length("left") % 4
    good = F.to_json(F.struct(F.concat("left", F.lit("s")).alias("left"), F.concat("right", F.lit("e¬")).alias("right"), F.lit("HIGH").alias("confidence"), F.lit("sure").alias("reason")))
    phrase = F.to_json(F.struct(F.concat("left", F.lit(" more words")).alias("left"), F.lit("").alias("right"), F.lit("certain").alias("confidence"), F.lit("two words").alias("reason")))
    asked = _queue(c).where(F.char_length("right") < 60).withColumn("reply", F.when(n == 1, good).when(n == 2, phrase).otherwise("no idea"))
    return N.note_answers(asked)


# ---- TEI issues -----------------------------------------------------------------------

_VERSION = "CAST(file % 3 AS VARCHAR) || '.' || CAST(file % 12 AS VARCHAR)"


def _issues(c: Corpus) -> DataFrame:
    """(file, xml): each document as an issue, a region for each paragraph, a page break
    after every third, some regions images."""

    def escaped(x: Column) -> Column:
        for ch, ref in (("&", "&amp;"), ("<", "&#60;"), (">", "&gt;"), ('"', "&quot;"), ("ü", "&#xFC;")):
            x = F.replace(x, F.lit(ch), F.lit(ref))
        return x

    para = F.col("para").cast("string")
    kind = F.when((F.col("file") + F.col("para")) % 17 == 0, "image").otherwise(F.coalesce("subtype", F.lit("")))
    zone = F.concat(F.lit("<zone points='0,0' rendition='TextRegion' subtype=\""), kind, F.lit("\" xml:id='r"), para, F.lit("'/>"))
    lines = F.array_join(F.transform("lines", lambda x, i: F.concat(F.lit("<l facs='#"), para, F.lit("_"), i.cast("string"), F.lit("'>"), escaped(x), F.lit("</l>"))), "")
    body = F.concat(F.lit("<p facs='#r"), para, F.lit("'><lg>"), lines, F.lit("</lg>"), F.when(F.col("para") % 3 == 0, F.concat(F.lit("<pb facs='#facs_"), para, F.lit("'/>"))).otherwise(""), F.lit("</p>"))
    rows = c.paragraphs.select("file", "para", zone.alias("zone"), body.alias("body"))
    whole = rows.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("para", "zone", "body"))).alias("p"))  # the paragraphs of one document
    version = F.concat((F.col("file") % 3).cast("string"), F.lit("."), (F.col("file") % 12).cast("string"))
    head = F.concat(F.lit("<TEI><teiHeader><application ident='marks' version='"), version, F.lit("'/></teiHeader><facsimile>"))
    return whole.select("file", F.concat(head, F.array_join("p.zone", ""), F.lit("</facsimile><text><body>"), F.array_join("p.body", ""), F.lit("</body></text></TEI>")).alias("xml"))


_KIND = "CASE WHEN (file + para) % 17 = 0 THEN 'image' ELSE coalesce(subtype, '') END"
_TEI = f"""(SELECT file, para AS src, row_number() OVER (PARTITION BY file ORDER BY para) AS para, coalesce(max(CASE WHEN para % 3 = 0 THEN para END) OVER (PARTITION BY file ORDER BY para ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER AS page, 'r' || para AS region, kind AS subtype, text, n
  FROM (SELECT file, para, any_value({_KIND}) AS kind, string_agg(line, '|' ORDER BY pos) AS text, count(*) AS n FROM lines GROUP BY file, para))"""


@query(f"SELECT file, para, page, region, subtype, text FROM {_TEI}")
def tei_paragraphs(c: Corpus) -> DataFrame:
    return tei.paragraphs(_issues(c)).select("file", "para", "page", "region", "subtype", F.array_join("lines", "|").alias("text"))


@query(f"SELECT DISTINCT file, {_VERSION} AS version FROM lines")
def tei_markers(c: Corpus) -> DataFrame:
    return tei.marker_versions(_issues(c), "marks")


@query(f"SELECT file, count(*) AS paragraphs, sum(n)::BIGINT AS lines FROM {_TEI} WHERE subtype <> 'image' GROUP BY file")
def tei_without_images(c: Corpus) -> DataFrame:
    kept = tei.drop_image_lines(tei.paragraphs(_issues(c)), with_rows=False)
    return kept.groupBy("file").agg(count("paragraphs"), F.sum(F.size("lines")).alias("lines"))


@query(f"SELECT file, region, para FROM {_TEI}")
def tei_zone_map(c: Corpus) -> DataFrame:
    return tei.paragraph_by_zone(tei.paragraphs(_issues(c)))


@query(f"""SELECT file, para, pos, "left", "right", hyphenated FROM (SELECT t.file, t.para, b.pos, b."left", b."right", b.hyphenated FROM {_TEI} t JOIN brk b ON b.file = t.file AND b.para = t.src WHERE t.subtype <> 'image')""")
def tei_break_pairs(c: Corpus) -> DataFrame:
    """From issues to pairs: read, images left out, lines, breaks."""
    from linemend.sources.corpus import lines_of

    lines = lines_of(tei.paragraphs(_issues(c)), min_lines=L.LONG, skip_subtypes=("image",))
    return B.breaks(lines).select("file", "para", "pos", "left", "right", "hyphenated")
