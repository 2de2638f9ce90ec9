"""DuckDB SQL for the catalogue: common table expressions in layers, each query
selecting from them.  Written apart from the Spark plans, from the definitions."""

from __future__ import annotations

from linemend.constants import ALPHABET, LETTERS, STRIP_CHARS

_STRIP = STRIP_CHARS.replace("'", "''")
_W = f"^[{LETTERS}]+$"


def strip(x: str) -> str:
    once = f"trim({x}, '{_STRIP}')"
    for _ in range(2):  # twice, for overlapping matches
        once = f"regexp_replace({once}, '([{LETTERS}])=([{LETTERS}])', '\\1-\\2', 'g')"
    return once


def _label(token: str, line: str) -> str:
    h = f"((doc_id * 31 + ln * 17 + ({line}) * 7) % 12)"
    word, size = f"regexp_matches({token}, '{_W}')", f"length({token})"
    return (
        f"CASE WHEN {token} IS NULL THEN NULL WHEN {h} IN (0, 1, 2) AND {word} AND {size} >= 6 THEN 'split' WHEN {h} = 3 THEN 'spur' "
        f"WHEN {h} = 4 AND right({token}, 1) = 'n' THEN 'misread' WHEN {h} = 5 AND {word} AND {size} >= 5 THEN 'nohy' WHEN {h} = 6 AND {size} >= 4 THEN 'trunc' END"
    )


def _mark(x: str) -> str:
    return f"right({x}, 1) IN ('¬', '-', '=')"


def _letters_table() -> str:
    return "(VALUES " + ", ".join(f"('{ch}', {i})" for i, ch in enumerate(ALPHABET)) + ") AS letters(ch, ord)"


_TOKENS = "list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> '')"


def tokens(x: str) -> str:
    return _TOKENS.format(x=x)


LAYERS = f"""
src AS (SELECT doc_id, source, ln, CASE WHEN (doc_id * 13 + ln * 5) % 23 = 0 THEN list_append(td[1 : n - 1], td[n] || '¬') ELSE td END AS tk, n FROM (
  SELECT doc_id, source, ln, len(tk) AS n, CASE WHEN (doc_id * 3 + ln) % 5 = 0 AND len(tk) >= 9 AND regexp_matches(tk[8], '{_W}') AND regexp_matches(tk[9], '{_W}')
    THEN list_concat(tk[1 : 2], [tk[8] || '-' || tk[9]], tk[4 : len(tk)]) ELSE tk END AS td FROM (
  SELECT doc_id, source, CAST(i AS BIGINT) AS ln, {tokens('s')} AS tk FROM (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)) WHERE len(tk) > 0)),
chunks AS (SELECT doc_id, source, ln, tk, n, CAST(wl AS BIGINT) AS wl, CASE WHEN wl > 0 THEN tk[wl * 8] END AS pt, CASE WHEN wl * 8 + 8 < n THEN tk[wl * 8 + 8] END AS bt
  FROM src, unnest(generate_series(0, (n - 1) // 8)) AS u(wl)),
labelled AS (SELECT *, {_label('pt', 'wl - 1')} AS lp, {_label('bt', 'wl')} AS lb FROM chunks),
lines AS MATERIALIZED (SELECT doc_id AS file, ln AS para, wl AS pos, source AS subtype, CAST((n - 1) // 8 + 1 AS BIGINT) AS n_lines, lb AS label, array_to_string(list_concat(
    CASE WHEN lp IN ('split', 'nohy') THEN [substr(pt, length(pt) // 2 + 1)] ELSE [] END,
    CASE WHEN lb IS NULL THEN tk[wl * 8 + 1 : least(wl * 8 + 8, n)] ELSE list_append(tk[wl * 8 + 1 : wl * 8 + 7],
      CASE lb WHEN 'split' THEN left(bt, length(bt) // 2) || '¬' WHEN 'spur' THEN bt || '¬' WHEN 'misread' THEN left(bt, length(bt) - 1) || 'r'
        WHEN 'nohy' THEN left(bt, length(bt) // 2) ELSE left(bt, length(bt) - 1) END) END), ' ') AS line FROM labelled),
nb AS MATERIALIZED (SELECT *, {tokens('line')} AS toks, lead(line) OVER w AS next_line, lag(line) OVER w AS prev_line FROM lines WINDOW w AS (PARTITION BY file, para ORDER BY pos)),
it AS (SELECT file, para, pos, n_lines, CAST(k - 1 AS BIGINT) AS k, inner_[k] AS raw, {strip('inner_[k]')} AS w, {strip('inner_[k + 1]')} AS next_w FROM (
  SELECT file, para, pos, n_lines, toks[2 : len(toks) - 1] AS inner_, unnest(generate_series(1, len(toks) - 2)) AS k FROM nb WHERE len(toks) > 2)),
uni AS MATERIALIZED (SELECT w, count(*) AS c FROM it WHERE regexp_matches(w, '{_W}') GROUP BY w),
big AS MATERIALIZED (SELECT a, b, count(*) FILTER (kind = 'plain') AS plain, count(*) FILTER (kind = 'period') AS period, count(*) FILTER (kind = 'comma') AS comma FROM (
  SELECT w AS a, next_w AS b, CASE right(rtrim(raw, '»«"'')]'), 1) WHEN '.' THEN 'period' WHEN ',' THEN 'comma' ELSE 'plain' END AS kind
  FROM it WHERE regexp_matches(w, '{_W}') AND regexp_matches(next_w, '{_W}')) GROUP BY a, b),
dash AS MATERIALIZED (SELECT regexp_extract(w, '^([{LETTERS}]+)[-=]([{LETTERS}]+)$', 1) AS a, regexp_extract(w, '^([{LETTERS}]+)[-=]([{LETTERS}]+)$', 2) AS b, count(*) AS c
  FROM it WHERE regexp_matches(w, '^([{LETTERS}]+)[-=]([{LETTERS}]+)$') GROUP BY ALL),
tot AS (SELECT count(*) AS v, CAST(sum(c) AS BIGINT) AS n FROM uni),
itl AS (SELECT * FROM it WHERE (file, para) IN (SELECT file, para FROM lines GROUP BY file, para HAVING count(*) > 1)),
unil AS MATERIALIZED (SELECT w, count(*) AS c FROM itl WHERE regexp_matches(w, '{_W}') GROUP BY w),
bigl AS MATERIALIZED (SELECT a, b, sum(CASE kind WHEN 'plain' THEN 1 ELSE 0 END)::BIGINT AS plain, sum(CASE kind WHEN 'period' THEN 1 ELSE 0 END)::BIGINT AS period, sum(CASE kind WHEN 'comma' THEN 1 ELSE 0 END)::BIGINT AS comma FROM (
  SELECT w AS a, next_w AS b, CASE right(rtrim(raw, '»«"'')]'), 1) WHEN '.' THEN 'period' WHEN ',' THEN 'comma' ELSE 'plain' END AS kind
  FROM itl WHERE regexp_matches(w, '{_W}') AND regexp_matches(next_w, '{_W}')) GROUP BY a, b),
dashl AS MATERIALIZED (SELECT split_part(translate(w, '=', '-'), '-', 1) AS a, split_part(translate(w, '=', '-'), '-', 2) AS b, count(*) AS c FROM itl WHERE regexp_matches(w, '^[{LETTERS}]+[-=][{LETTERS}]+$') GROUP BY ALL),
totl AS (SELECT count(*) AS v, CAST(sum(c) AS BIGINT) AS n FROM unil),
brk0 AS (SELECT *, {_mark('line')} AS hyphenated, {tokens("CASE WHEN " + _mark('line') + " THEN left(line, length(line) - 1) ELSE line END")} AS hd, {tokens('next_line')} AS tl FROM nb WHERE next_line IS NOT NULL),
brk1 AS (SELECT *, hd[len(hd)] AS raw_left, CASE WHEN len(tl) = 1 AND {_mark('tl[1]')} THEN left(tl[1], length(tl[1]) - 1) ELSE tl[1] END AS raw_right FROM brk0),
brk AS MATERIALIZED (SELECT file, para, pos, subtype, line, next_line, {strip('raw_left')} AS "left", {strip('raw_right')} AS "right", raw_left, raw_right, hyphenated, hd, tl, line || ' | ' || next_line AS context
  FROM brk1 WHERE length({strip('raw_left')}) >= 2 AND length({strip('raw_right')}) >= 2),
prs AS (SELECT "left", "right", count(*) FILTER (hyphenated) AS hyphenated, count(*) FILTER (NOT hyphenated) AS plain FROM brk GROUP BY ALL),
ev AS MATERIALIZED (SELECT p."left", p."right", p.hyphenated, p.plain, coalesce(j.c, 0) AS join_count, coalesce(d.c, 0) AS dash_count, coalesce(b.plain, 0) AS bigram_count, coalesce(b.period, 0) AS period_count,
  coalesce(b.comma, 0) AS comma_count, coalesce(l.c, 0) AS left_count, coalesce(r.c, 0) AS right_count
  FROM prs p LEFT JOIN unil j ON j.w = p."left" || p."right" LEFT JOIN unil l ON l.w = p."left" LEFT JOIN unil r ON r.w = p."right"
  LEFT JOIN bigl b ON b.a = p."left" AND b.b = p."right" LEFT JOIN dashl d ON d.a = p."left" AND d.b = p."right"),
ev2 AS (SELECT *, bigram_count + period_count + comma_count AS s, greatest(comma_count, period_count, bigram_count) AS sbest, regexp_matches("right", '^\\p{{Lu}}') AS cap FROM ev),
ev3 AS (SELECT *, CASE WHEN sbest >= 2 AND period_count = sbest AND period_count >= 3.0 * greatest(comma_count, bigram_count, 1) THEN 'period|sentence-boundary-attested'
    WHEN sbest >= 2 AND comma_count = sbest AND comma_count >= 3.0 * greatest(period_count, bigram_count, 1) THEN 'comma|comma-attested' ELSE 'split|bigram-attested' END AS sep FROM ev2),
ev4 AS (SELECT *, CASE
    WHEN cap AND greatest(dash_count, s) < 2 THEN '|capitalised-right'
    WHEN cap AND dash_count >= 2 AND dash_count >= 3.0 * greatest(s, 1) THEN 'hyphen|dashed-compound-attested'
    WHEN cap AND s >= 2 AND s >= 3.0 * greatest(dash_count, 1) THEN sep
    WHEN cap THEN '|capitalised-right'
    WHEN left_count = 0 AND join_count >= 2 AND s = 0 THEN 'join|left-is-fragment'
    WHEN join_count >= 2 AND join_count >= 3.0 * greatest(s, 1) THEN 'join|compound-attested'
    WHEN s >= 2 AND s >= 3.0 * greatest(join_count, 1) THEN sep
    WHEN join_count >= 2 AND s >= 2 THEN '|contested'
    WHEN hyphenated >= 5 AND hyphenated >= 3.0 * greatest(plain, 1) THEN 'join|pair-usually-hyphenated'
    WHEN plain >= 5 AND plain >= 3.0 * greatest(hyphenated, 1) AND join_count = 0 THEN 'split|pair-usually-plain'
    WHEN join_count = 0 AND left_count >= 5 AND right_count >= 5 THEN 'split|both-common-words'
    ELSE '|insufficient-evidence' END AS fr FROM ev3),
frm AS MATERIALIZED (SELECT *, nullif(split_part(fr, '|', 1), '') AS form0, split_part(fr, '|', 2) AS reason0 FROM ev4),
store AS (SELECT "left", "right", CASE WHEN length("left") % 2 = 0 THEN 'join' ELSE 'context' END AS form, 'rule' AS source FROM frm
  WHERE form0 IS NULL AND hyphenated > 0 AND plain > 0 AND length("right") % 3 = 0),
jd0 AS (SELECT f.*, FALSE AS settled, form0 AS form, reason0 AS why FROM frm f),
jd AS MATERIALIZED (SELECT *, CASE WHEN form = 'join' AND plain > 0 AND s >= 2 AND NOT settled THEN TRUE WHEN form = 'split' AND hyphenated > 0 AND (join_count >= 2 OR dash_count >= 2) AND NOT settled THEN TRUE ELSE FALSE END AS cont FROM jd0),
jds0 AS (SELECT f.*, t.form IS NOT NULL AS settled, coalesce(t.form, form0) AS form, CASE WHEN t.form IS NOT NULL THEN 'decided:' || t.source ELSE reason0 END AS why
  FROM frm f LEFT JOIN store t ON t."left" = f."left" AND t."right" = f."right"),
jds AS (SELECT *, CASE WHEN form = 'join' AND plain > 0 AND s >= 2 AND NOT settled THEN TRUE WHEN form = 'split' AND hyphenated > 0 AND (join_count >= 2 OR dash_count >= 2) AND NOT settled THEN TRUE ELSE FALSE END AS cont FROM jds0),
vd AS MATERIALIZED (SELECT *, bad_hyphenated + bad_plain AS affected, hyphenated + plain AS total FROM (SELECT *, VERDICT_CASE FROM jd)),
vds AS (SELECT *, bad_hyphenated + bad_plain AS affected, hyphenated + plain AS total FROM (SELECT *, VERDICT_CASE FROM jds)),
fin AS MATERIALIZED (SELECT file, para, pos, subtype, line, next_line, toks[len(toks)] AS raw, {strip('toks[len(toks)]')} AS w, CASE WHEN len(toks) > 1 THEN {strip('toks[len(toks) - 1]')} END AS prev_w,
  CASE WHEN next_line IS NOT NULL THEN {strip(tokens('next_line') + '[1]')} END AS next_w FROM nb WHERE NOT {_mark('line')} AND len(toks) > 0),
tally AS (SELECT w, count(*) AS seen FROM fin WHERE regexp_matches(w, '{_W}') GROUP BY w),
vars20 AS (SELECT t.w, u.w AS cand, u.c AS n, ord FROM (SELECT DISTINCT w FROM tally) t, {_letters_table()} JOIN uni u ON u.w = left(t.w, length(t.w) - 1) || ch WHERE ch <> lower(right(t.w, 1)) AND u.c >= 20),
top AS (SELECT w, max(cand) FILTER (k = 1) AS best, max(n) FILTER (k = 1) AS bn, max(cand) FILTER (k = 2) AS runner_up, max(n) FILTER (k = 2) AS rn
  FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY n DESC, ord) AS k FROM vars20) WHERE k <= 2 GROUP BY w),
tv0 AS (SELECT t.w, t.seen, coalesce(u.c, 0) AS observed_count, best, coalesce(bn, 0) AS best_count, runner_up, coalesce(rn, 0) AS runner_count, lower(right(t.w, 1)) || '->' || right(best, 1) AS change
  FROM tally t LEFT JOIN uni u ON u.w = t.w LEFT JOIN top ON top.w = t.w),
tv AS MATERIALIZED (SELECT w, seen, observed_count, best, best_count, runner_up, runner_count,
  CASE WHEN length(w) < 4 OR best_count = 0 OR observed_count >= 20 OR observed_count * 50.0 > best_count THEN 'OK' WHEN runner_count * 2 > best_count OR observed_count > 1 THEN 'REVIEW' ELSE 'MISREAD' END AS verdict,
  CASE WHEN length(w) < 4 THEN 'too-short' WHEN best_count = 0 THEN 'no-attested-variant' WHEN observed_count >= 20 THEN 'observed-is-a-word' WHEN observed_count * 50.0 > best_count THEN 'observed-attested'
    WHEN runner_count * 2 > best_count THEN 'competing-variants' WHEN observed_count > 1 THEN change || '?  observed ' || observed_count || 'x inside a line' ELSE change END AS reason FROM tv0),
cidx AS MATERIALIZED (SELECT left(w, length(w) - m) AS prefix, w AS word, c AS n, CAST(m AS BIGINT) AS missing FROM uni, (VALUES (1), (2), (3)) AS k(m) WHERE c >= 10 AND length(w) - m >= 3),
tr0 AS (SELECT f.* FROM fin f LEFT JOIN uni u ON u.w = f.w WHERE regexp_matches(raw, '\\p{{L}}$') AND regexp_matches(f.w, '^\\p{{L}}+$') AND length(f.w) >= 3 AND coalesce(u.c, 0) <= 1
  AND f.w IN (SELECT prefix FROM cidx WHERE missing <= 1)),
tr1 AS (SELECT * FROM (SELECT *, nullif(regexp_extract(next_w, '^([{LETTERS}]+)', 1), '') AS lead_ FROM tr0 WHERE next_line IS NOT NULL) t
  WHERE NOT EXISTS (SELECT 1 FROM uni u WHERE u.w = t.w || t.next_w) AND NOT EXISTS (SELECT 1 FROM uni u WHERE u.w = t.w || t.lead_)
  AND NOT EXISTS (SELECT 1 FROM dash d WHERE d.a = t.w AND d.b = t.next_w) AND NOT EXISTS (SELECT 1 FROM dash d WHERE d.a = t.w AND d.b = t.lead_)),
tr2 AS (SELECT t.file, t.para, t.pos, t.subtype, t.w AS observed, i.word, i.n, i.missing, coalesce(b1.plain, 0) + coalesce(b2.plain, 0) AS beside FROM tr1 t JOIN cidx i ON i.prefix = t.w
  LEFT JOIN big b1 ON b1.a = t.prev_w AND b1.b = i.word LEFT JOIN big b2 ON b2.a = i.word AND b2.b = t.next_w),
tr3 AS (SELECT *, row_number() OVER (PARTITION BY file, para, pos ORDER BY beside DESC, n DESC, length(word), word) AS k, max(CASE WHEN missing <= 1 THEN beside ELSE 0 END) OVER (PARTITION BY file, para, pos) AS support FROM tr2),
hits0 AS (SELECT file, para, pos, subtype, observed, max(word) FILTER (k = 1) AS completion, max(missing) FILTER (k = 1) AS missing, max(beside) FILTER (k = 1) AS beside,
  string_agg(word || ':' || n || '/' || beside, ' ' ORDER BY k) AS completions FROM tr3 WHERE support > 0 AND k <= 3 GROUP BY ALL),
subs10 AS (SELECT w, cand AS substitution FROM (SELECT t.observed AS w, u.w AS cand, row_number() OVER (PARTITION BY t.observed ORDER BY u.c DESC, ord) AS k FROM (SELECT DISTINCT observed FROM hits0) t, {_letters_table()}
  JOIN uni u ON u.w = left(t.observed, length(t.observed) - 1) || ch WHERE ch <> lower(right(t.observed, 1)) AND u.c >= 10) WHERE k = 1),
hits AS MATERIALIZED (SELECT h.*, s.substitution, count(*) OVER (PARTITION BY observed) AS type_count FROM hits0 h LEFT JOIN subs10 s ON s.w = h.observed),
held AS (SELECT reason, count(*) AS n FROM (SELECT 'paragraph-final' AS reason FROM tr0 WHERE next_line IS NULL UNION ALL
  SELECT 'no completion beside a neighbour' FROM (SELECT DISTINCT file, para, pos FROM tr3 WHERE support = 0)) GROUP BY reason),
csub AS (SELECT split_part(reason, '->', 1) AS own, split_part(reason, '->', 2) AS intended, CAST(sum(seen) AS BIGINT) AS n FROM tv WHERE verdict = 'MISREAD' GROUP BY ALL),
cdel AS (SELECT lower(right(completion, 1)) AS intended, count(*) AS n FROM hits WHERE missing = 1 GROUP BY ALL),
cend AS (SELECT lower(right(w, 1)) AS intended, count(*) AS n FROM fin WHERE regexp_matches(w, '{_W}') GROUP BY ALL),
cdam AS (SELECT intended AS own, sum(n) AS damaged FROM (SELECT intended, n FROM csub UNION ALL SELECT intended, n FROM cdel) GROUP BY ALL),
awords AS (SELECT t.w FROM tally t JOIN uni u ON u.w = t.w WHERE u.c >= 20 AND length(t.w) >= 2),
acand AS (SELECT a.w, u.w AS cand, ord FROM awords a, {_letters_table()} JOIN uni u ON u.w = left(a.w, length(a.w) - 1) || ch WHERE ch <> lower(right(a.w, 1)) AND u.c >= 20
  UNION ALL SELECT a.w, u.w AS cand, 100 + ord FROM awords a, {_letters_table()} JOIN uni u ON u.w = a.w || ch WHERE u.c >= 20),
amb AS MATERIALIZED (SELECT f.file, f.para, f.pos, f.w, f.raw, f.prev_w, f.next_w, nullif(f.prev_w, '') AS pw, nullif(f.next_w, '') AS nw, c.cand, c.ord FROM fin f JOIN acand c ON c.w = f.w),
sc0 AS (SELECT a.*, v, t.n, coalesce(up.c, 0) AS cp, uo.c AS co, uc.c AS cc, coalesce(un.c, 0) AS cn, coalesce(b1.plain, 0) AS bpo, coalesce(b2.plain, 0) AS bpc, coalesce(b3.plain, 0) AS bon, coalesce(b4.plain, 0) AS bcn,
    coalesce(s.n, 0) AS nsub, coalesce(d.n, 0) AS ndel, coalesce(e1.n, 0) AS fint, coalesce(e2.n, 0) AS fown, coalesce(m.damaged, 0) AS damaged
  FROM amb a CROSS JOIN tot t LEFT JOIN uni up ON up.w = a.pw LEFT JOIN uni uo ON uo.w = a.w LEFT JOIN uni uc ON uc.w = a.cand LEFT JOIN uni un ON un.w = a.nw
  LEFT JOIN big b1 ON b1.a = a.pw AND b1.b = a.w LEFT JOIN big b2 ON b2.a = a.pw AND b2.b = a.cand LEFT JOIN big b3 ON b3.a = a.w AND b3.b = a.nw LEFT JOIN big b4 ON b4.a = a.cand AND b4.b = a.nw
  LEFT JOIN csub s ON s.own = lower(right(a.w, 1)) AND s.intended = lower(right(a.cand, 1)) LEFT JOIN cdel d ON d.intended = lower(right(a.cand, 1))
  LEFT JOIN cend e1 ON e1.intended = lower(right(a.cand, 1)) LEFT JOIN cend e2 ON e2.intended = lower(right(a.w, 1)) LEFT JOIN cdam m ON m.own = lower(right(a.w, 1))),
sc1 AS (SELECT *, HEAD + MIDC + TAILC - (HEAD + MIDO + TAILO) AS margin,
  ln(((CASE WHEN length(cand) = length(w) + 1 THEN ndel ELSE nsub END) + 0.5::DOUBLE) / greatest(fint, 1)::DOUBLE) - ln(greatest(1::DOUBLE - damaged::DOUBLE / greatest(fown, 1)::DOUBLE, 1e-9::DOUBLE)) AS channel FROM sc0),
sc AS MATERIALIZED (SELECT *, CASE WHEN next_w IS NULL THEN 'paragraph-final' WHEN NOT regexp_matches(raw, '\\p{{L}}$') THEN 'trailing-punctuation' WHEN NOT right_evidence THEN 'no-right-bigram' WHEN NOT left_evidence THEN 'no-left-bigram'
    WHEN regexp_matches(w, '^\\p{{Lu}}') AND regexp_matches(best, '^\\p{{Lu}}') THEN 'capitalised-pair' ELSE 'passed' END AS gate FROM (
  SELECT file, para, pos, w, raw, next_w, cand AS best, margin, channel, margin + channel AS score, prev_w IS NOT NULL AND bpo + bpc > 0 AS left_evidence, next_w IS NOT NULL AND bon + bcn > 0 AS right_evidence,
    row_number() OVER (PARTITION BY file, para, pos ORDER BY round(margin + channel, 9) DESC, ord) AS k FROM sc1) WHERE k = 1),
bm0 AS (SELECT *, CASE WHEN len(hd) > 1 THEN nullif({strip('hd[len(hd) - 1]')}, '') END AS h, CASE WHEN len(tl) > 1 THEN nullif({strip('tl[2]')}, '') END AS t FROM brk),
bm1 AS (SELECT b.file, b.para, b.pos, b."left", b."right", b.hyphenated, b.h, b.t, v, x.n, coalesce(u1.c, 0) AS ch, coalesce(u2.c, 0) AS cl, coalesce(u3.c, 0) AS cr, coalesce(u4.c, 0) AS cb, coalesce(u5.c, 0) AS ct,
    coalesce(b1.plain, 0) AS hb, coalesce(b2.plain, 0) AS bt, coalesce(b3.plain, 0) AS hl, coalesce(b4.plain, 0) AS lr, coalesce(b5.plain, 0) AS rt
  FROM bm0 b CROSS JOIN totl x LEFT JOIN unil u1 ON u1.w = b.h LEFT JOIN unil u2 ON u2.w = b."left" LEFT JOIN unil u3 ON u3.w = b."right" LEFT JOIN unil u4 ON u4.w = b."left" || b."right" LEFT JOIN unil u5 ON u5.w = b.t
  LEFT JOIN bigl b1 ON b1.a = b.h AND b1.b = b."left" || b."right" LEFT JOIN bigl b2 ON b2.a = b."left" || b."right" AND b2.b = b.t LEFT JOIN bigl b3 ON b3.a = b.h AND b3.b = b."left"
  LEFT JOIN bigl b4 ON b4.a = b."left" AND b4.b = b."right" LEFT JOIN bigl b5 ON b5.a = b."right" AND b5.b = b.t),
bm AS MATERIALIZED (SELECT *, BREAKMARGIN AS margin FROM bm1),
para AS MATERIALIZED (SELECT file, para, list(line ORDER BY pos) AS ls FROM lines GROUP BY ALL),
nota AS (SELECT file, count(*) FILTER (right(line, 1) = '¬') AS n_not, count(*) FILTER (right(line, 1) = '=') AS n_eq FROM lines WHERE n_lines > 1 GROUP BY file),
nextw AS (SELECT *, regexp_extract(coalesce(next_line, ''), '^([a-zA-ZäöüÄÖÜßáéíóúÁÉÍÓÚ.]+)', 1) AS nw FROM nb),
act AS MATERIALIZED (SELECT *, CASE WHEN nw = '' THEN 'remove' WHEN nw IN ('geb.', 'v.', 'gew.', 'z.', '(') THEN 'space' WHEN regexp_matches(nw, '^\\p{{Lu}}') THEN 'hyphen' WHEN nw IN ('und', 'út', 'üt', 'ut', 'utca') THEN 'hyphen' ELSE 'remove' END AS action FROM nextw),
mk AS MATERIALIZED (SELECT a.file, a.para, a.pos, a.line, a.next_line, CASE WHEN a.next_line IS NULL THEN 'unknown' WHEN nw IN ('geb.', 'v.', 'gew.', 'z.', '(') THEN NULL WHEN known AND form = 'join' THEN 'word' WHEN known AND form = 'hyphen' THEN 'compound'
    WHEN known AND byf THEN NULL WHEN action = 'remove' THEN 'word' WHEN action = 'hyphen' THEN 'compound' END AS break,
    CASE WHEN a.next_line IS NULL THEN 'paragraph-final' WHEN nw IN ('geb.', 'v.', 'gew.', 'z.', '(') THEN 'rule-guard' WHEN known AND byf THEN 'evidence' ELSE 'rule' END AS source
  FROM (SELECT x.*, v.form, coalesce(v.form IS NOT NULL AND v.verdict <> 'REVIEW', FALSE) AS known, coalesce(v.form IN ('join', 'hyphen', 'split', 'period', 'comma'), FALSE) AS byf FROM act x
    LEFT JOIN brk b ON b.file = x.file AND b.para = x.para AND b.pos = x.pos LEFT JOIN vd v ON v."left" = b."left" AND v."right" = b."right" WHERE {_mark('x.line')}) a)
"""


def _logp(prev: str, pair: str, word: str) -> str:
    p1 = f"((coalesce({word}, 0) + 1)::DOUBLE / (n + v)::DOUBLE)"
    if prev == "NULL":
        return f"ln(greatest({p1}, 1e-12::DOUBLE))"
    mixed = f"(0.99::DOUBLE * {pair}::DOUBLE / greatest({prev}, 1)::DOUBLE + (1::DOUBLE - 0.99::DOUBLE) * {p1})"
    return f"(CASE WHEN {prev} > 0 THEN ln(greatest({mixed}, 1e-12::DOUBLE)) ELSE ln(greatest({p1}, 1e-12::DOUBLE)) END)"


_VERDICT = """CASE WHEN form IS NULL THEN CASE WHEN hyphenated > 0 AND plain > 0 THEN 'REVIEW' ELSE 'OK' END WHEN form IN ('hyphen', 'skip') THEN 'OK' WHEN form = 'context' THEN 'CONTEXT'
    WHEN form = 'join' THEN CASE WHEN plain = 0 THEN 'OK' WHEN cont THEN 'REVIEW' ELSE 'FALSE_NEGATIVE' END WHEN hyphenated = 0 THEN 'OK' WHEN form = 'period' THEN 'PERIOD' WHEN form = 'comma' THEN 'COMMA'
    ELSE CASE WHEN cont THEN 'REVIEW' ELSE 'FALSE_POSITIVE' END END AS verdict, CASE WHEN cont THEN 'contested-both-readings' ELSE why END AS reason,
  CASE WHEN form IS NULL AND hyphenated > 0 AND plain > 0 THEN hyphenated WHEN form IN ('period', 'comma', 'split') THEN hyphenated ELSE 0 END AS bad_hyphenated, CASE WHEN form = 'join' AND plain > 0 THEN plain ELSE 0 END AS bad_plain"""
_HEAD = f"(CASE WHEN pw IS NOT NULL THEN {_logp('NULL', '', 'cp')} ELSE 0 END)"


def _mid(count: str, pair: str) -> str:
    return f"(CASE WHEN pw IS NOT NULL THEN {_logp('cp', pair, count)} ELSE {_logp('NULL', '', count)} END)"


def _tail(count: str, pair: str) -> str:
    return f"(CASE WHEN nw IS NOT NULL THEN {_logp(count, pair, 'cn')} ELSE 0 END)"


def _break_margin() -> str:
    def after(prev: str, pair: str, word: str) -> str:
        return f"(CASE WHEN h IS NOT NULL THEN {_logp(prev, pair, word)} ELSE {_logp('NULL', '', word)} END)"

    joined = f"({after('ch', 'hb', 'cb')} + (CASE WHEN t IS NOT NULL THEN {_logp('cb', 'bt', 'ct')} ELSE 0 END))"
    apart = f"({after('ch', 'hl', 'cl')} + {_logp('cl', 'lr', 'cr')} + (CASE WHEN t IS NOT NULL THEN {_logp('cr', 'rt', 'ct')} ELSE 0 END))"
    return f"({joined} - {apart})"


_FILLED = (
    LAYERS.replace("VERDICT_CASE", _VERDICT).replace("HEAD", _HEAD).replace("MIDC", _mid("cc", "bpc")).replace("MIDO", _mid("co", "bpo"))
    .replace("TAILC", _tail("cc", "bcn")).replace("TAILO", _tail("co", "bon")).replace("BREAKMARGIN", _break_margin())
)


def over(select: str) -> str:
    """A query over the layers."""
    return f"WITH {_FILLED.strip()}\n{select}"


#: Labelled line ends from interior tokens, with the counts their score needs.
GOLD = f"""(SELECT g.file, g.para, g.pos, g.k, g.w, c.cand, c.ord, uc.c AS cc, round({_logp('cp', 'bpc', 'uc.c')} + {_logp('uc.c', 'bcn', 'cn')}, 9) AS value FROM (
  SELECT a.file, a.para, a.pos, a.k, a.w, b.w AS pw, a.next_w AS nw FROM it a JOIN it b ON b.file = a.file AND b.para = a.para AND b.pos = a.pos AND b.k = a.k - 1
    WHERE regexp_matches(a.w, '{_W}') AND regexp_matches(b.w, '{_W}') AND regexp_matches(a.next_w, '{_W}')) g
  JOIN (SELECT * FROM goldcand UNION ALL SELECT DISTINCT w, w, -1 FROM goldcand) c ON c.w = g.w CROSS JOIN tot JOIN uni uc ON uc.w = c.cand,
  LATERAL (SELECT coalesce((SELECT u.c FROM uni u WHERE u.w = g.pw), 0) AS cp, coalesce((SELECT u.c FROM uni u WHERE u.w = g.nw), 0) AS cn) l1,
  LATERAL (SELECT coalesce((SELECT x.plain FROM big x WHERE x.a = g.pw AND x.b = c.cand), 0) AS bpc, coalesce((SELECT x.plain FROM big x WHERE x.a = c.cand AND x.b = g.nw), 0) AS bcn) l2)"""
_GOLD_WORDS = f""",
goldcand AS MATERIALIZED (SELECT a.w, u.w AS cand, ord FROM (SELECT w FROM uni WHERE c >= 20 AND length(w) >= 2) a, {_letters_table()} JOIN uni u ON u.w = left(a.w, length(a.w) - 1) || ch WHERE ch <> lower(right(a.w, 1)) AND u.c >= 20)"""


def over_gold(select: str) -> str:
    return f"WITH {_FILLED.strip()}{_GOLD_WORDS}\n{select}"


_PLAIN, _CUT, _DASHED, _SPACED = (f"chr({0xE000 + i})" for i in range(4))
_ANY = "'[' || chr(57344) || '-' || chr(57347) || ']'"


def _rule_columns(rules: tuple[tuple[str, str], ...]) -> tuple[str, list[str], str]:
    """Steps that rules take on a marked text: nested SELECTs that carry the text on, the
    note of each step that notes something, and the sum of join artifacts."""
    gap = "\ue001?"
    spell = lambda x: gap.join("[ \ue000\ue003]" if ch == " " else "[-\ue002]" if ch == "-" else ch.replace(".", "[.]") for ch in x)
    sql, notes, artifacts, i = "SELECT file, para, ls, t0 AS t FROM marked0", [], [], 0
    for old, new in rules:
        p = next(k for k in range(len(old) + 1) if k >= len(new) or k >= len(old) or old[k] != new[k])
        q = next(k for k in range(len(old) - p + 1) if k >= len(new) - p or k >= len(old) - p or old[-1 - k] != new[-1 - k])
        core, put, head, tail = old[p : len(old) - q], new[p : len(new) - q], spell(old[:p]), spell(old[len(old) - q :])
        head, tail = head + (gap if head and core else ""), (gap if tail and (core or head) else "") + tail
        present = f"contains(translate(t, chr(57344) || chr(57347) || chr(57346) || chr(57345), '  -'), '{old}')"

        def noted(pattern: str, kind: str) -> None:
            nonlocal sql, i
            sql = f"SELECT *, CASE WHEN {present} THEN len(regexp_extract_all(t, '{pattern}')) ELSE 0 END AS m{i} FROM ({sql})"
            notes.append(f"SELECT file, para, NULL::BIGINT AS pos, '{core}' AS before, '{put}' AS after, '{kind}' AS outcome, unnest(generate_series(1, m{i})) AS x FROM stepped WHERE m{i} > 0")
            if kind == "join-artifact":
                artifacts.append(f"m{i}")
            i += 1

        def replaced(pattern: str, by: str) -> None:
            nonlocal sql
            sql = f"SELECT * REPLACE (CASE WHEN {present} THEN regexp_replace(t, '{pattern}', '{by}', 'g') ELSE t END AS t) FROM ({sql})"

        for k, ch in enumerate(core):
            if ch in " -":
                noted(f"({head})" + gap.join(x for x in (spell(core[:k]), "[\ue000\ue003]" if ch == " " else "\ue002", spell(core[k + 1 :])) if x) + f"({tail})", "join-artifact")
        for k in range(1, len(core)):
            there = put + "\ue001" if 2 * k >= len(core) else "\ue001" + put
            noted(f"({head}){core[:k]}\ue001{core[k:]}({tail})", "straddles-break")
            replaced(f"({head}){core[:k]}\ue001{core[k:]}({tail})", f"\\\\1{there}\\\\2".replace("\\\\", "\\"))
        replaced(f"({head}){core}({tail})", f"\\1{put}\\2")
    for token, number in _misread_days():
        sql = f"SELECT * REPLACE (regexp_replace(t, '([ \ue000\ue003])' || '{token}[.]', '\\1{number}.', 'g') AS t) FROM ({sql})"
    return sql, notes, " + ".join(artifacts) or "0"


def _misread_days() -> list[tuple[str, str]]:
    """Days of a month with letters for digits, and what they mean.  The other patterns of
    digits do not occur in the invented prose."""
    out = []
    for a in "r123":
        for b in ("", *"0123456789ors"):
            number = (a + b).replace("r", "1").replace("o", "0").replace("s", "5")
            if any(x in "ros" for x in a + b) and 1 <= int(number) <= 31:
                out.append((a + b, number))
    return out


def paragraph_records(rules: tuple[tuple[str, str], ...]) -> str:
    """Change records of paragraphs corrected as joined text, as a table expression."""
    stepped, notes, artifacts = _rule_columns(rules)
    all_notes = " UNION ALL ".join(f"SELECT file, para, pos, before, after, outcome FROM ({n})" for n in notes) or "SELECT NULL::BIGINT AS file, NULL::BIGINT AS para, NULL::BIGINT AS pos, '' AS before, '' AS after, '' AS outcome WHERE FALSE"
    return f""",
marked0 AS MATERIALIZED (SELECT file, para, list(line ORDER BY pos) AS ls, string_agg(CASE WHEN next_line IS NULL THEN line WHEN {_mark('line')} THEN left(line, length(line) - 1) || CASE action WHEN 'space' THEN {_SPACED} WHEN 'hyphen' THEN {_DASHED} ELSE {_CUT} END
  ELSE line || {_PLAIN} END, '' ORDER BY pos) AS t0 FROM act GROUP BY file, para),
stepped AS MATERIALIZED ({stepped}),
cutup AS (SELECT file, para, t, {artifacts} AS artifacts, ls, regexp_split_to_array(t, {_ANY}) AS parts FROM stepped),
aft AS MATERIALIZED (SELECT file, para, t, artifacts, k - 1 AS pos, ls[k] AS line, CASE WHEN k < len(ls) AND {_mark('ls[k]')} THEN parts[k] || right(ls[k], 1) ELSE parts[k] END AS after FROM (SELECT *, unnest(generate_series(1, len(ls))) AS k FROM cutup)),
aft2 AS (SELECT *, lead(after) OVER (PARTITION BY file, para ORDER BY pos) AS following FROM aft),
aft3 AS (SELECT *, regexp_extract(coalesce(following, ''), '^([a-zA-ZäöüÄÖÜßáéíóúÁÉÍÓÚ.]+)', 1) AS nw FROM aft2),
again AS (SELECT file, para, any_value(artifacts) AS artifacts, bool_or(line <> after) AS changed, translate(any_value(t), {_PLAIN} || {_SPACED} || {_DASHED} || {_CUT}, '  -') AS reads,
  string_agg(CASE WHEN following IS NULL THEN after WHEN {_mark('after')} THEN left(after, length(after) - 1) || CASE WHEN nw = '' THEN '' WHEN nw IN ('geb.', 'v.', 'gew.', 'z.', '(') THEN ' ' WHEN regexp_matches(nw, '^\\p{{Lu}}') OR nw IN ('und', 'út', 'üt', 'ut', 'utca') THEN '-' ELSE '' END
  ELSE after || ' ' END, '' ORDER BY pos) AS joined FROM aft3 GROUP BY file, para),
refused AS (SELECT file, para, reads, joined FROM again WHERE artifacts = 0 AND joined <> reads AND (file, para) IN (SELECT file, para FROM aft WHERE line <> after UNION SELECT file, para FROM ({all_notes}))),
records AS (SELECT * FROM (SELECT file, para, pos, line AS before, after, 'applied' AS outcome FROM aft WHERE line <> after UNION ALL {all_notes}) r WHERE NOT EXISTS (SELECT 1 FROM refused x WHERE x.file = r.file AND x.para = r.para)
  UNION ALL SELECT file, para, NULL, reads, joined, 'changes-break' FROM refused)"""


def over_records(select: str, rules: tuple[tuple[str, str], ...]) -> str:
    return f"WITH {_FILLED.strip()}{paragraph_records(rules)}\n{select}"


_BM1 = _FILLED[_FILLED.index("bm1 AS (SELECT") : _FILLED.index("bm AS MATERIALIZED")]
_BM = _FILLED[_FILLED.index("bm AS MATERIALIZED") : _FILLED.index("para AS MATERIALIZED")]


def over_break_gold(select: str, contested: str) -> str:
    """A query over margins ``bg`` of interior occurrences of the ``contested`` pairs."""
    words = "nullif({0}, '')".format
    occurrences = f""",
itn AS MATERIALIZED (SELECT *, lead(w, 2) OVER (PARTITION BY file, para, pos ORDER BY k) AS next2_w, lag(w) OVER (PARTITION BY file, para, pos ORDER BY k) AS prev_w FROM itl),
bg0 AS (SELECT i.file, i.para, i.pos, c."left", c."right", 'join' AS hyphenated, {words('i.prev_w')} AS h, {words('i.next_w')} AS t FROM itn i JOIN {contested} c ON i.w = c."left" || c."right"
  UNION ALL SELECT i.file, i.para, i.pos, c."left", c."right", 'split', {words('i.prev_w')}, {words('i.next2_w')} FROM itn i JOIN {contested} c ON i.w = c."left" AND i.next_w = c."right"),
"""
    margins_ = _BM1.replace("bm1 AS", "bg1 AS").replace("FROM bm0 b", "FROM bg0 b") + _BM.replace("bm AS MATERIALIZED", "bg AS MATERIALIZED").replace("FROM bm1", "FROM bg1").rstrip().rstrip(",")
    return f"WITH {_FILLED.strip()}{occurrences}{margins_}\n{select}"
