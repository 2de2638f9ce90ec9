"""Processing steps of an issue and their header markers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STEPS = "pos int, name string, ident string, automated boolean"


def steps_after(steps: DataFrame, name: str) -> DataFrame:
    """Steps that come after one; an unknown step is an error."""
    at = steps.where(F.col("name") == name).select(F.col("pos").alias("p"))
    if at.isEmpty():
        raise ValueError(f"no step named {name}")
    # one row
    return steps.join(F.broadcast(at), F.col("pos") > F.col("p")).drop("p")


def outdated_markers(markers: DataFrame, steps: DataFrame, name: str) -> DataFrame:
    """Markers (file, ident, version) that a change in a step makes stale."""
    return markers.join(F.broadcast(steps_after(steps, name).where("ident is not null").select("ident")), "ident", "left_semi")


def step_table(spark: SparkSession, rows: list[tuple[int, str, str | None, bool]]) -> DataFrame:
    return spark.createDataFrame(rows, STEPS)


def document_links(files: DataFrame, ids: DataFrame, base: str) -> DataFrame:
    """(file, page, link) by the date in a file's name; null without a known date.
    ``ids``: (day, id), a row an issue, days with ``-`` or ``/`` or neither."""
    known = ids.select(F.regexp_replace("day", "[-/]", "").alias("_d"), F.col("id").alias("_id"))
    page = F.when(F.col("page").isNotNull(), F.concat(F.lit("/page/"), F.col("page").cast("string"))).otherwise("")
    rows = files.withColumn("_d", F.regexp_extract("file", r"(\d{8})", 1)).join(known, "_d", "left")
    return rows.select("file", "page", F.when(F.col("_id").isNotNull(), F.concat(F.lit(base), "_id", page)).alias("link"))
