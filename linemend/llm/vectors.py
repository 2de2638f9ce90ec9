"""What the vector operators share: reading, validity, packing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linemend.llm.base import hash_share


def valid(vector: Column) -> Column:
    """Not null, not empty, every component a finite number, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(lists: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """Rows of a list column as double vectors (rows may differ in length)."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1].astype(int)) if len(ends) else []


def bounded_sample(df: DataFrame, id_col: str, vector_col: str, rows: int) -> np.ndarray:
    """At most ``rows`` vectors of the commonest length, chosen by a hash of the id."""
    chosen = hash_share(df, F.col(id_col), 4 * rows).select(F.xxhash64(id_col).alias("h"), F.col(id_col).alias("i"), F.col(vector_col).cast("array<double>").alias("v")).orderBy("h", "i").limit(rows).select("v").toArrow()
    found = matrix(chosen.column("v")) if chosen.num_rows else []
    if not found:
        return np.zeros((0, 0))
    sizes = [len(x) for x in found]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    return np.stack([x for x in found if len(x) == size])
