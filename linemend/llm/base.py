"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_built: dict[Any, Any] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A bounded table of the driver's.  It goes to the JVM as Arrow: lists of rows are pickled
    anew by Python workers of a kind of their own, which executors then hold for a while."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = to_arrow_schema(StructType.fromDDL(schema))
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields), schema=schema)


def once(key: tuple, build: Callable[[], Any]) -> Any:
    """Per-process memo, so that a Python worker builds an object once and not once a
    task.  ``key[0]`` names the operator: when another operator's object is built, the
    former ones go, so a worker never holds the caches of several operators."""
    if key not in _built:
        if former := [k for k in _built if k != "lean" and k[0] != key[0]]:
            for k in former:
                del _built[k]
            give_back()
        while len(_built) > 4:
            del _built[next(k for k in _built if k != "lean")]
        _built[key] = build()
    return _built[key]


def lean() -> None:
    """Makes a Python worker hand freed memory back: Arrow buffers come from the C
    library, which takes blocks above 256 KB from the system one by one and returns them
    when they are freed.  Called first by functions that run on executors; once a process."""
    if "lean" in _built:
        return
    import ctypes

    pa.set_memory_pool(pa.system_memory_pool())
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt is not None:
        trim_threshold, mmap_threshold = -1, -3
        mallopt(mmap_threshold, 256 << 10)
        mallopt(trim_threshold, 1 << 20)
    _built["lean"] = True


def give_back() -> None:
    """Returns freed memory to the system, where the C library can."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tokenizer_file(name: str) -> str:
    """Default place of a public vocabulary file; every caller may pass another."""
    import public_tokenizers

    return public_tokenizers.path(name)


def file_bytes(path: str) -> bytes:
    """A vocabulary file, read by the driver (a few MB, fixed by the vocabulary)
    and broadcast from there: executors need no copy of their own."""
    with open(path, "rb") as f:
        return f.read()


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, list[int]]]:
    """Whole groups of rows sorted by their first ``keys`` columns, some at a time: a table
    and the bounds of its groups.  The last group of a batch waits for the next batch."""
    import numpy as np

    rest: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = now if rest is None else pa.concat_tables([rest, now])
        columns = [now.column(i).to_numpy() for i in range(keys)]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1 if now.num_rows > 1 else []
        if len(cuts):
            yield now.slice(0, cuts[-1]).combine_chunks(), [0, *(int(c) for c in cuts)]
            now = now.slice(cuts[-1])
        rest = now
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), [0, rest.num_rows]


#: Arrow batches of long texts: bytes and rows, held by the JVM and the worker at once.
BATCH_BYTES, BATCH_ROWS = 2 << 20, 500


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batch limits where they are above ours, so that a
    task's memory does not follow the length of its rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", min(BATCH_ROWS, int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def hash_share(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """Rows of about ``rows`` distinct hashes, chosen by the hash of ``key``; all rows of a
    table with fewer.  A filter, so that what follows it (an order, a limit) handles
    a bounded sample and not the best rows of every partition."""
    total = df.count()
    if total <= rows:
        return df
    of = 1 << 40
    return df.where(F.pmod(F.xxhash64(key), F.lit(of)) < max(1, of * rows // total))


#: Bits of a bitmap, as Spark builds them (4 KB), and of all bitmaps of ``marked`` (8 MB).
BITMAP, MARK_BITS = 15, 26


def marked(df: DataFrame, key: str, ids: DataFrame, name: str) -> DataFrame:
    """Adds the boolean ``name``: false where ``key`` is surely none of ``ids`` (a table of
    that one column, no nulls), so that rows as large as texts are shuffled only where it is
    true.  Bits of hashes are broadcast, more the more ids there are, up to 2**MARK_BITS;
    beyond that more rows are marked than need be, and none is missed."""
    bits = min(MARK_BITS, max(BITMAP, (16 * ids.count()).bit_length()))
    place = F.shiftrightunsigned(F.xxhash64(F.col(key).cast("long")), 64 - bits)
    row, at = F.shiftright(place, BITMAP), place.bitwiseAND((1 << BITMAP) - 1)
    bitmaps = ids.select(row.alias("_mark_row"), at.alias("_mark_at")).groupBy("_mark_row").agg(F.bitmap_construct_agg("_mark_at").alias("_mark_bits"))
    byte = F.conv(F.hex(F.substring(F.col("_mark_bits"), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, at.bitwiseAND(7).cast("int")) == 1, F.lit(False))
    return df.join(F.broadcast(bitmaps), row == F.col("_mark_row"), "left").select(*df.columns, hit.alias(name))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The cluster names the shared folder in ``spark.checkpoint.dir``; only
    where it is unset (a local session, tests) a temporary one is made."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        named = tempfile.mkdtemp(prefix="linemend-ckpt-")
    sc.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_table(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage with a Parquet table in the shared checkpoint folder:
    smaller than checkpoint() where columns compress.  ``drop_table`` removes it."""
    import uuid

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._linemend_path = path
    return out


def drop_table(df: DataFrame) -> None:
    """Removes a table that ``cut_table`` made, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._linemend_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
