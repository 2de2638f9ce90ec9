"""Growing inputs: answers that arrive as files are merged into a ranked store.

Arrival order does not matter for rows of different rank; of equal rank the first
stands.  The store is a Parquet table per version, replaced as a whole, so a failed
batch leaves the former version in place and a repeated batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from linemend.operators.stores import merge_pairs

PAIRS = "row_no long, left string, right string, form string, source string, note string"


def merge_stream(spark: SparkSession, arriving: str, store: str, checkpoint: str) -> StreamingQuery:
    """Merges every JSON file of ``arriving`` into the versions under ``store``."""

    def merged(batch: DataFrame, number: int) -> None:
        versions = _versions(spark, store)
        if versions and versions[-1] >= number + 1:
            return  # this batch was merged before the failure
        old = spark.read.parquet(f"{store}/v{versions[-1]}") if versions else spark.createDataFrame([], PAIRS).drop("row_no")
        merge_pairs(old, batch).drop("state").write.mode("overwrite").parquet(f"{store}/v{number + 1}")

    return (
        spark.readStream.schema(PAIRS).json(arriving).writeStream.foreachBatch(merged)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _versions(spark: SparkSession, store: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = [s.getPath() for s in fs.listStatus(path)]
    names = [p.getName() for p in done if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())


def latest(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{store}/v{_versions(spark, store)[-1]}")
