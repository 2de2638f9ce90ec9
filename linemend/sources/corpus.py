"""Readers: every source becomes paragraphs of lines.

A paragraph row is (file, para, subtype, lines ARRAY<STRING>).  Neighbouring lines
sit in one row, so ``lines_of`` finds previous and next lines without a window or
a shuffle, at any size.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from linemend.functions.text import tokens
from linemend.functions.words import ascii_tokens, is_plain, is_word

WRAP = 8
#: Characters of text whose paragraphs a worker hands on at once.
BATCH_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(x: int, n: int) -> int:
    """Of a division that truncates, as in SQL."""
    return x % n if x >= 0 else -(-x % n)


def planted(doc: int | None, para: int, line: int, token: str | None) -> str | None:
    """Damage planted at the end of a wrapped line, by integer arithmetic."""
    if doc is None or token is None:
        return None
    h, size = _remainder(doc * 31 + para * 17 + line * 7, 12), len(token)
    if h in (0, 1, 2):
        return "split" if size >= 6 and is_word(token) else None
    if h == 4:
        return "misread" if token.endswith("n") else None
    if h == 5:
        return "nohy" if size >= 5 and is_word(token) else None
    return "spur" if h == 3 else "trunc" if h == 6 and size >= 4 else None


def _damaged(token: str, label: str) -> str:
    half = len(token) // 2
    return {"split": token[:half] + "¬", "spur": token + "¬", "misread": token[:-1] + "r", "nohy": token[:half], "trunc": token[:-1]}[label]


def wrap(doc: int | None, para: int, tk: list[str]) -> tuple[list[str], list[str | None]]:
    """Lines of eight tokens with planted damage, and the label of each line's end.

    Some third tokens become dashed compounds of the two words around the first break;
    some paragraphs end in a mark that no next line can judge."""
    n = len(tk)
    if doc is not None:
        if n > WRAP and (doc * 3 + para) % 5 == 0 and is_word(tk[WRAP - 1]) and is_word(tk[WRAP]):
            tk[2] = f"{tk[WRAP - 1]}-{tk[WRAP]}"
        if (doc * 13 + para * 5) % 23 == 0:
            tk[-1] += "¬"
    lines, labels, carried = [], [], None
    for i in range((n - 1) // WRAP + 1):
        end = i * WRAP + WRAP
        label = planted(doc, para, i, tk[end - 1]) if end < n else None
        body = tk[i * WRAP : end]
        if label is not None:
            body[-1] = _damaged(body[-1], label)
        if carried is not None:
            body.insert(0, carried)
        lines.append(" ".join(body))
        labels.append(label)
        carried = tk[end - 1][len(tk[end - 1]) // 2 :] if label in ("split", "nohy") else None
    return lines, labels


def rewrapped(docs: DataFrame, subtype: str = "source") -> DataFrame:
    """Paragraphs of ``documents`` wrapped to lines of eight tokens with planted
    damage: one paragraph for each text line, (file, para, subtype, lines, labels).

    In workers, as ``functions.words`` says; what a worker holds is bounded by a text."""
    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").alias("file"), F.col(subtype).alias("subtype"), "text")
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    strings = ArrayType(StringType())
    schema = StructType([StructField("file", kinds["file"]), StructField("para", LongType()), StructField("subtype", kinds["subtype"]), StructField("lines", strings), StructField("labels", strings)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here holds itself
        arrow = to_arrow_schema(schema)
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
        out, size = [], 0
        for b in batches:
            for file, kind, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                plain = is_plain(text)
                for p, s in enumerate(text.split("\n"), 1):
                    if tk := ascii_tokens(s, plain):
                        out.append((file, p, kind, *wrap(file, p, tk)))
                size += len(text)
                if out and size >= BATCH_CHARS:
                    yield batch()
                    out, size = [], 0
        if out:
            yield batch()

    return rows.mapInArrow(run, schema)


def lines_of(paragraphs: DataFrame, min_lines: int = 1, skip_subtypes: tuple[str, ...] = ()) -> DataFrame:
    """One row per line with its neighbours: file, para, pos, subtype, n_lines, line,
    prev_line, next_line, toks.  Skipped subtypes and short paragraphs go first."""
    kept = paragraphs.where(F.size("lines") >= min_lines)
    if skip_subtypes:
        kept = kept.where(~F.coalesce(F.col("subtype"), F.lit("")).isin(*skip_subtypes))
    # neighbours travel in the generator's rows: a row that carried all lines would make a paragraph's cost a square
    near = lambda x, i: (x.alias("line"), F.when(i > 0, F.try_element_at("lines", i)).alias("prev_line"), F.try_element_at("lines", i + 2).alias("next_line"))
    each = F.transform("lines", lambda x, i: F.struct(*near(x, i), F.size("lines").cast("long").alias("n_lines")))
    rows = kept.select("file", "para", "subtype", F.posexplode(each).alias("i", "t"))
    return rows.select("file", "para", F.col("i").cast("long").alias("pos"), "subtype", "t.n_lines", "t.line", "t.prev_line", "t.next_line", tokens(F.col("t.line")).alias("toks"))


def plain_paragraphs(docs: DataFrame, subtype: str = "source") -> DataFrame:
    """``documents`` as they are: one paragraph for each document."""
    lines = F.filter(F.transform(F.split("text", "\n"), F.trim), lambda x: x != "")
    return docs.where(F.col("text").isNotNull()).select(F.col("doc_id").alias("file"), F.lit(1).cast("long").alias("para"), F.col(subtype).alias("subtype"), lines.alias("lines")).where(F.size("lines") > 0)


def page_paragraphs(pages: DataFrame) -> DataFrame:
    """``<p>`` elements of HTML pages, tags removed: (file, para, lines)."""
    inner = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"(?s)<p(?:\s[^>]*)?>(.*?)</p>"), F.lit(1))
    text = lambda p: F.btrim(F.regexp_replace(p, "<[^>]+>", ""))
    rows = pages.select(F.col("page_id").alias("file"), F.posexplode(inner).alias("p", "x"))
    return rows.select("file", (F.col("p") + 1).cast("long").alias("para"), F.filter(F.split(text(F.col("x")), "\n"), lambda s: F.btrim(s) != "").alias("lines"))
