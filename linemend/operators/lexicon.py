"""Reference lexicon from line-interior tokens (never a token beside a break).

Counts come for two scopes at once: all paragraphs (``c``, ``plain`` ...), which line ends
are judged by, and paragraphs of two or more lines (``_long`` names), which breaks are
judged by: a one-line paragraph holds no break, and admitting it would move every ratio.
``long_scope`` reads a table in the second scope.
"""

from __future__ import annotations

import gc
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linemend.functions import words
from linemend.functions.text import interior, strip_token


LONG = 2


def interior_tokens(lines: DataFrame) -> DataFrame:
    """(file, para, pos, n_lines, k, raw, w, prev_w, next_w, next2_w): interior tokens with the
    interior tokens beside them.  One generator, no shuffle."""
    cleaned = F.transform(interior(F.col("toks")), lambda t: F.struct(t.alias("raw"), strip_token(t).alias("w")))
    rows = lines.select("file", "para", "pos", "n_lines", cleaned.alias("x")).select("file", "para", "pos", "n_lines", "x", F.posexplode("x").alias("k", "t"))
    return rows.select("file", "para", "pos", "n_lines", F.col("k").cast("long").alias("k"), "t.raw", "t.w", F.when(F.col("k") > 0, F.try_element_at("x", F.greatest("k", F.lit(1)))["w"]).alias("prev_w"), F.try_element_at("x", F.col("k") + 2)["w"].alias("next_w"), F.try_element_at("x", F.col("k") + 3)["w"].alias("next2_w"))


#: Distinct tokens, or pairs of them, that a worker counts before it hands the counts on.
COUNTED = 200_000
KINDS = ("plain", "period", "comma")
UNI, BIG, DASH = range(3)


class _Read(dict):
    """What a raw token is: (its word or null, what follows it, the parts of a dashed compound
    or null).  Each spelling is read once; the table is bounded."""

    def __missing__(self, raw: str) -> tuple:
        w = words.strip_token(raw)
        parts = words.compound(w) if "-" in w else None
        got = w if words.is_word(w) else None, words.separator(raw), parts and parts.groups()
        if len(self) >= 2 * COUNTED:
            self.clear()
        self[raw] = got
        return got


def _counted(lines: DataFrame, found: Callable[[str], Iterable], put: Callable[[Counter, Counter], tuple[list, ...]]) -> DataFrame:
    """(t, a, b, code, n) of what ``found`` finds in each line: workers count it as it is
    written, and ``put`` reads each distinct find once when the counts are handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here holds itself
        short, long = Counter(), Counter()
        kinds = (pa.int8(), pa.string(), pa.string(), pa.int8(), pa.int64())

        def batch() -> pa.RecordBatch:
            rows = put(short, long)
            short.clear()
            long.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["t", "a", "b", "code", "n"])

        for b in batches:
            for n, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                (long if n >= LONG else short).update(found(line))
                if len(short) + len(long) >= COUNTED:
                    yield batch()
        yield batch()

    return lines.select("n_lines", "line").mapInArrow(run, "t tinyint, a string, b string, code tinyint, n long")


def _rows(big: tuple[list, ...], *singles: tuple[int, dict]) -> tuple[list, ...]:
    """Columns of counted rows: pairs as they are, and tables (key -> count) by their kind."""
    t, a, b, code, n = [BIG] * len(big[0]), *big
    for kind, table in singles:
        t += [kind] * len(table)
        a += [k[0] for k in table]
        b += [k[1] for k in table]
        code += [k[2] for k in table]
        n += table.values()
    return t, a, b, code, n


def _put_words(read: _Read, kind: int) -> Callable[[Counter, Counter], tuple[list, ...]]:
    def put(short: Counter, long: Counter) -> tuple[list, ...]:
        sums: dict = Counter()
        for seen, more in ((short, 0), (long, 3)):
            for raw, n in seen.items():
                w, _, parts = read[raw]
                if kind == UNI and w is not None:
                    sums[w, "", more] += n
                elif kind == DASH and parts is not None:
                    sums[(*parts, more)] += n
        return _rows(([], [], [], []), (kind, sums))

    return put


def _put_pairs(read: _Read) -> Callable[[Counter, Counter], tuple[list, ...]]:
    def put(short: Counter, long: Counter) -> tuple[list, ...]:
        uni, dash = Counter(), Counter()
        a, b, code, n = [], [], [], []
        for seen, more in ((short, 0), (long, 3)):
            for (x, y), k in seen.items():
                w, follows, parts = read[x]
                if w is not None:
                    uni[w, "", more] += k
                    if y is not None and (v := read[y][0]) is not None:
                        a.append(w)
                        b.append(v)
                        code.append(follows + more)
                        n.append(k)
                elif parts is not None:
                    dash[(*parts, more)] += k
        return _rows((a, b, code, n), (UNI, uni), (DASH, dash))

    return put


def _inside(line: str) -> list[str]:
    return words.tokens(line)[1:-1]


def _followed(line: str) -> Iterable:
    """Interior tokens, each with the one after it (null after the last)."""
    inner = words.tokens(line)[1:-1]
    return zip(inner, (*inner[1:], None), strict=True) if inner else ()


def _alike(lines: DataFrame, names: tuple[str, ...], found: Callable[[str], Iterable], word: int) -> DataFrame:
    """(names, n): runs of interior tokens of each line, stripped; alike runs are counted by
    each task as far as its memory goes, so that a row may come several times.  ``word``: -1
    if all must be words, else tokens that strip to nothing are null, but for the one at ``word``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here holds itself
        seen: Counter = Counter()
        read = _Read()
        bare: dict[str | None, str | None] = {}

        def of(y: str | None) -> str | None:
            if y not in bare:
                if len(bare) >= 2 * COUNTED:
                    bare.clear()
                bare[y] = None if y is None else words.strip_token(y)
            return bare[y]

        def batch() -> pa.RecordBatch:
            if word < 0:
                rows = [(*w, n) for x, n in seen.items() if None not in (w := tuple(read[y][0] for y in x))]
            else:
                rows = [(*(of(y) if i == word else of(y) or None for i, y in enumerate(x)), n) for x, n in seen.items()]
            seen.clear()
            columns = zip(*rows, strict=True) if rows else [()] * (len(names) + 1)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.string()] * len(names) + [pa.int64()], strict=True)], [*names, "n"])

        for b in batches:
            for line in b.column(0).to_pylist():
                seen.update(found(line))
                if len(seen) >= COUNTED:
                    yield batch()
        yield batch()

    return lines.select("line").mapInArrow(run, ", ".join(f"{x} string" for x in names) + ", n long")


def _three(line: str) -> Iterable:
    inner = words.tokens(line)[1:-1]
    return zip(inner, inner[1:], inner[2:], strict=False)


def _four(line: str) -> Iterable:
    inner = words.tokens(line)[1:-1]
    return zip((None, *inner), inner, (*inner[1:], None), (*inner[2:], None, None), strict=False)


def trigrams(lines: DataFrame) -> DataFrame:
    """(prev_w, w, next_w, n): three interior words in a row."""
    return _alike(lines, ("prev_w", "w", "next_w"), _three, -1)


def windows(lines: DataFrame) -> DataFrame:
    """(prev_w, w, next_w, next2_w, n): interior tokens with those beside them; null where
    there is none, or nothing but punctuation."""
    return _alike(lines, ("prev_w", "w", "next_w", "next2_w"), _four, 1)


def _summed(rows: DataFrame) -> DataFrame:
    of = lambda *codes: F.sum(F.when(F.col("code").isin(*codes), F.col("n")).otherwise(F.lit(0)))
    return rows.groupBy("t", "a", "b").agg(*[of(i, i + 3).alias(k) for i, k in enumerate(KINDS)], *[of(i + 3).alias(f"{k}_long") for i, k in enumerate(KINDS)])


def lexicon(lines: DataFrame) -> DataFrame:
    """All counts of interior tokens in one pass and one shuffle: (t, a, b, plain, period, comma
    and their ``_long`` counts), read by ``unigrams_of``, ``bigrams_of`` and ``dashed_of``."""
    return _summed(_counted(lines, _followed, _put_pairs(_Read())))


def unigrams_of(lexicon_: DataFrame) -> DataFrame:
    """(w, c, c_long)."""
    return lexicon_.where(F.col("t") == UNI).select(F.col("a").alias("w"), F.col("plain").alias("c"), F.col("plain_long").alias("c_long"))


def bigrams_of(lexicon_: DataFrame) -> DataFrame:
    """(a, b, plain, period, comma, and their ``_long`` counts): adjacent interior words
    by what separates them."""
    return lexicon_.where(F.col("t") == BIG).drop("t")


def dashed_of(lexicon_: DataFrame) -> DataFrame:
    """(a, b, c, c_long): compounds written with a dash inside a line."""
    return lexicon_.where(F.col("t") == DASH).select("a", "b", F.col("plain").alias("c"), F.col("plain_long").alias("c_long"))


def unigrams(lines: DataFrame) -> DataFrame:
    """(w, c, c_long), where no pairs are wanted."""
    return unigrams_of(_summed(_counted(lines, _inside, _put_words(_Read(), UNI))))


def bigrams(lines: DataFrame) -> DataFrame:
    return bigrams_of(lexicon(lines))


def dashed(lines: DataFrame) -> DataFrame:
    """(a, b, c, c_long), where no other counts are wanted."""
    marked = lines.where(F.col("line").contains("-") | F.col("line").contains("="))
    return dashed_of(_summed(_counted(marked, _inside, _put_words(_Read(), DASH))))


def long_scope(counts: DataFrame) -> DataFrame:
    """A table of counts over paragraphs of two or more lines, under the plain names."""
    names = [c.removesuffix("_long") for c in counts.columns if c.endswith("_long")]
    kept = counts.where(F.greatest(F.lit(0), *[F.col(f"{n}_long") for n in names]) > 0)
    return kept.select(*[c for c in counts.columns if c not in names and not c.endswith("_long")], *[F.col(f"{n}_long").alias(n) for n in names])


def totals(uni: DataFrame) -> DataFrame:
    """(v, n): types and tokens, one row."""
    return uni.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"))
