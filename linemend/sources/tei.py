"""TEI issues: reader, header markers, and text-preserving writer.

The reader is Catalyst only: the body is cut into page breaks and paragraphs by
``regexp_extract_all``, pages are carried forward inside the row's array, and lines
stay with their paragraph.  Attributes may come in any order and in either quote;
character references are decoded.  The writer replaces the text of single ``<l>``
elements in the original string, so everything else stays byte for byte.
"""

from __future__ import annotations

import html
import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEAD_BYTES = 262_144


def read_files(spark: SparkSession, folder: str, first: int | None = None) -> DataFrame:
    """(file, xml) of a folder, the first n by name if asked.  Raises if there is none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.decode("content", "UTF-8").alias("xml"))
    if first is not None:
        chosen = named.select("file").orderBy("file").limit(first)
        named = named.join(F.broadcast(chosen), "file", "left_semi")  # at most ``first`` names
    if named.select("file").isEmpty():
        raise FileNotFoundError(f"no XML files in {folder}")
    return named


def _attr(tag: Column, name: str) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(tag, rf"\s{name}\s*=\s*'([^']*)'", 1), F.lit("")), F.nullif(F.regexp_extract(tag, rf'\s{name}\s*=\s*"([^"]*)"', 1), F.lit("")))


def _decoded(text: Column) -> Column:
    """Character references of XML: the five named ones, decimal and hexadecimal numbers."""
    number = lambda r: F.when(F.lower(F.substring(r, 3, 1)) == "x", F.conv(F.regexp_extract(r, "(?i)&#x([0-9a-f]+);", 1), 16, 10)).otherwise(F.regexp_extract(r, "&#([0-9]+);", 1)).cast("int")
    # a code point in UTF-32 is one character
    char = lambda r: F.decode(F.unhex(F.lpad(F.hex(number(r)), 8, "0")), "UTF-32")
    found = F.array_distinct(F.regexp_extract_all(text, F.lit("(?i)(&#(?:x[0-9a-f]{1,6}|[0-9]{1,7});)"), F.lit(1)))
    text = F.aggregate(found, text, lambda now, r: F.replace(now, r, F.when(number(r) == 38, "&amp;").when(number(r).between(1, 0x10FFFF), char(r)).otherwise(r)))
    for ref, ch in (("&quot;", '"'), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(ref), F.lit(ch))
    return text


def regions(issues: DataFrame) -> DataFrame:
    """(file, region, subtype, points) of the text regions before ``<text``."""
    head = F.expr("if(locate('<text', xml) > 0, substring(xml, 1, locate('<text', xml) - 1), xml)")
    zones = F.regexp_extract_all(head, F.lit(r"(<zone\b[^>]*>)"), F.lit(1))
    rows = issues.select("file", F.explode(zones).alias("z")).where(_attr(F.col("z"), "rendition") == "TextRegion")
    return rows.select("file", _attr(F.col("z"), "xml:id").alias("region"), F.coalesce(_attr(F.col("z"), "subtype"), F.lit("")).alias("subtype"), _attr(F.col("z"), "points").alias("points"))


def paragraphs(issues: DataFrame) -> DataFrame:
    """(file, para, page, region, subtype, lines, facs, marks, has_markup).

    A page break inside a paragraph counts for later paragraphs.  Lines that are
    empty without their tags are left out; a paragraph without lines has none."""
    body = F.expr("substring(xml, greatest(locate('<text', xml), 1))")
    parts = F.regexp_extract_all(body, F.lit(r"(?s)(<pb\b[^>]*>|<p\b[^>]*>.*?</p>)"), F.lit(1))
    last_break = lambda x: F.element_at(F.concat(F.array(F.lit("0")), F.regexp_extract_all(x, F.lit(r"<pb\b[^>]*?facs_(\d+)[^>]*>"), F.lit(1))), -1)

    def step(acc: Column, x: Column) -> Column:
        found = last_break(x).cast("int")
        row = F.struct(x.alias("x"), acc["page"].alias("page"))
        return F.struct(F.when(found > 0, found).otherwise(acc["page"]).alias("page"), F.when(x.startswith("<p>") | x.startswith("<p "), F.concat(acc["rows"], F.array(row))).otherwise(acc["rows"]).alias("rows"))

    start = F.struct(F.lit(0).alias("page"), F.expr("cast(array() as array<struct<x: string, page: int>>)").alias("rows"))
    rows = issues.select("file", F.posexplode(F.aggregate(parts, start, step)["rows"]).alias("p", "r")).select("file", (F.col("p") + 1).cast("long").alias("para"), "r.page", "r.x")
    opening = F.regexp_extract("x", r"^(<p\b[^>]*>)", 1)
    items = F.regexp_extract_all("x", F.lit(r"(?s)(<l\b[^>]*>.*?</l>)"), F.lit(1))

    def item(x: Column) -> Column:
        tag, inner = F.regexp_extract(x, r"^(<l\b[^>]*>)", 1), F.regexp_extract(x, r"(?s)^<l\b[^>]*>(.*)</l>$", 1)
        return F.struct(
            F.btrim(_decoded(F.regexp_replace(inner, "<[^>]+>", ""))).alias("text"), F.ltrim(_attr(tag, "facs"), F.lit("#")).alias("facs"), _attr(tag, "wsb:break").alias("mark"), inner.contains("<").alias("markup")
        )

    parsed = rows.select("file", "para", "page", F.ltrim(_attr(opening, "facs"), F.lit("#")).alias("region"), F.filter(F.transform(items, item), lambda l: l["text"] != "").alias("l"))
    out = parsed.join(regions(issues).groupBy("file", "region").agg(F.max("subtype").alias("subtype")), ["file", "region"], "left")
    return out.select(
        "file", "para", "page", "region", F.coalesce("subtype", F.lit("")).alias("subtype"), F.col("l.text").alias("lines"), F.col("l.facs").alias("facs"), F.col("l.mark").alias("marks"), F.exists("l", lambda x: x["markup"]).alias("has_markup")
    )


def marker_versions(issues: DataFrame, ident: str) -> DataFrame:
    """(file, version) of a header marker, read from the head only; null without one.
    A head without its end raises."""
    head = F.substring("xml", 1, HEAD_BYTES)
    whole = F.when(head.contains("</teiHeader>"), F.regexp_extract(head, r"(?s)^(.*?</teiHeader>)", 1)).otherwise(F.raise_error(F.concat(F.lit("no </teiHeader> in the head of "), F.col("file"))))
    tags = F.filter(F.regexp_extract_all(whole, F.lit(r"(<application\b[^>]*>)"), F.lit(1)), lambda t: _attr(t, "ident") == ident)
    return issues.select("file", _attr(F.try_element_at(tags, F.lit(1)), "version").alias("version"))


_LINE = re.compile(r"(<l\b[^>]*>)(.*?)(</l>)", re.DOTALL)
_FACS = re.compile(r"""\sfacs\s*=\s*['"]#?([^'"]*)['"]""")


def rewrite(xml: str, changes: dict[str, str], breaks: dict[str, str | None] | None = None) -> str:
    """The issue with the text of some lines replaced (by id) and break marks set or
    cleared.  Lines with markup are left alone."""

    def put(m: re.Match) -> str:
        tag, inner, end = m.groups()
        found = _FACS.search(tag)
        facs = found.group(1) if found else None
        if facs in changes and "<" not in inner:
            lead = inner[: len(inner) - len(inner.lstrip())]
            tail = inner[len(inner.rstrip()) :]
            new = html.escape(changes[facs], quote=False).replace('"', "&quot;").replace("'", "&apos;")
            inner = lead + new + tail
        if breaks is not None and facs in breaks:
            tag = re.sub(r"\swsb:break\s*=\s*('[^']*'|\"[^\"]*\")", "", tag)
            if breaks[facs]:
                tag = tag[:-1] + f" wsb:break='{breaks[facs]}'>"
        return tag + inner + end

    return _LINE.sub(put, xml)


def write_issues(issues: DataFrame, changes: DataFrame, folder: str) -> DataFrame:
    """Writes every issue with its changed lines (file, facs, after) to a folder that
    executors share: a temporary name first, then one rename.  Returns (file, n)."""
    per_file = changes.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("facs", "after"))).alias("m"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, xml, m in zip(b["file"], b["xml"], b["m"], strict=True):
                target = os.path.join(folder, name)
                with open(target + ".part", "w", encoding="utf-8", newline="") as f:
                    f.write(rewrite(xml, m or {}))
                os.replace(target + ".part", target)
            yield pd.DataFrame({"file": b["file"], "n": [len(m or {}) for m in b["m"]]})

    return issues.join(per_file, "file", "left").select("file", "xml", "m").mapInPandas(run, "file string, n int")


def paragraph_by_zone(paras: DataFrame) -> DataFrame:
    """(file, region, para): the paragraph that transcribes a region, the last of several.
    Regions without one (images, rules) have no row."""
    return paras.where(F.coalesce("region", F.lit("")) != "").groupBy("file", "region").agg(F.max("para").alias("para"))


def drop_image_lines(paras: DataFrame, with_rows: bool = True) -> DataFrame:
    """Lines of image regions go; paragraphs keep their rows, or with ``with_rows`` off go
    too when they have no line left."""
    empty = F.expr("cast(array() as array<string>)")
    if not with_rows:
        return drop_image_lines(paras).where(F.size("lines") > 0)
    return paras.withColumns({c: F.when(F.col("subtype") == "image", empty).otherwise(F.col(c)) for c in ("lines", "facs", "marks")})
