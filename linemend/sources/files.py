"""CSV and JSONL tables: rules, stores, channel, queues, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STORES = {
    "pairs": "left string, right string, form string, source string, model string, decided_on string, note string",
    "occurrences": "file string, line_facs string, left string, right string, form string, score double, source string, model string, decided_on string, note string",
    "corrections": "left string, right string, left_correct string, right_correct string, confidence string, approved string, source string, model string, decided_on string, note string",
}


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_store(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows of a store with ``row_no`` in file order; a missing file is an empty table."""
    schema = STORES[kind]
    if not _exists(spark, path):
        return spark.createDataFrame([], schema).withColumn("row_no", F.lit(0).cast("long"))
    return spark.read.schema(schema).option("header", True).csv(path).withColumn("row_no", F.monotonically_increasing_id())


def read_rules(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Ordered replacement rules of ``old;new`` lines, no header, no quoting, spaces kept.
    Of a repeated rule the last replacement holds, at the first one's place."""
    rules: dict[str, str] = {}
    for row in spark.read.text(path, wholetext=False).collect():  # a hand-written list
        line = row.value.lstrip("﻿")
        if ";" in line:
            old, new = line.split(";")[:2]
            if old:
                rules[old] = new
    return list(rules.items())


def compounding(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Rules that match their own result, so that each run would apply them again."""
    return [(a, b) for a, b in rules if a != b and a in b]


def read_channel(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Substitutions, deletions and line ends of a frozen channel."""
    rows = spark.read.option("header", True).schema("kind string, observed string, intended string, count long, source string, fitted_on string").csv(path)
    subs = rows.where("kind = 'substitution'").groupBy(F.col("observed").alias("own"), "intended").agg(F.sum("count").alias("n"))
    one = lambda kind: rows.where(F.col("kind") == kind).groupBy("intended").agg(F.sum("count").alias("n"))
    return subs, one("deletion"), one("line_ends")


def write_report(df: DataFrame, path: str, sort: list[str] | None = None) -> None:
    """A CSV report, ordered if asked; parts in parallel, in order of their names."""
    out = df.repartitionByRange(*sort).sortWithinPartitions(*sort) if sort else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_queue(df: DataFrame, path: str) -> None:
    """A review queue, one JSON object a line."""
    df.write.mode("overwrite").json(path)


def read_queue(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_substitutions(spark: SparkSession, path: str) -> DataFrame:
    """(own, intended, n) from a report of token verdicts: misread rows, ``x->y`` reasons."""
    rows = spark.read.option("header", True).csv(path).where("verdict = 'MISREAD'")
    change = F.split("reason", "->")
    return rows.where(F.col("reason").contains("->")).groupBy(change[0].alias("own"), change[1].alias("intended")).agg(F.sum(F.col("seen_at_line_end").cast("long")).alias("n"))


def read_deletions(spark: SparkSession, path: str) -> DataFrame:
    """(intended, n) from a report of truncations: rows that lack one letter."""
    rows = spark.read.option("header", True).csv(path).where("missing = '1'")
    return rows.groupBy(F.lower(F.right("completion", F.lit(1))).alias("intended")).agg(F.count(F.lit(1)).alias("n"))


def newest(spark: SparkSession, pattern: str) -> str:
    """The last file of a pattern by name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    if not len(found):
        raise FileNotFoundError(pattern)
    return max(f.getPath().toString() for f in found)


def dated(folder: str, name: str, day: str) -> str:
    """Where a report of a day goes."""
    return f"{folder.rstrip('/')}/{day}_{name}"


def append_rows(df: DataFrame, path: str) -> None:
    """Rows added to a store or scorecard, which keeps what it has; read back, the later of
    equal rank wins."""
    df.write.mode("append").option("header", True).csv(path)


def read_prompt(spark: SparkSession, path: str, required: tuple[str, ...]) -> dict[str, str]:
    """Sections of a prompt file: ``## name`` lines and the text below each.  A section that
    is required and missing, empty or given twice is an error."""
    out: dict[str, str] = {}
    name, lines = None, []
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())  # one hand-written file
    for line in [*text.splitlines(), "## "]:
        if line.startswith("## ") or line.strip() == "##":
            if name is not None:
                if name in out:
                    raise ValueError(f"section {name} stands twice in {path}")
                out[name] = "\n".join(lines).strip()
            name, lines = line[2:].strip(), []
        else:
            lines.append(line)
    if missing := [r for r in required if not out.get(r)]:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return out
