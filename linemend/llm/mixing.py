"""Operator 10: mixing sources to target weights by Pfair scheduling.

Rows of a source form blocks of ``block_rows``.  With w a source's exact (rational)
part of the weights, its block k may run from slot ``floor(k / w)`` and must by
``ceil((k + 1) / w)``.  Earliest deadline first places one block a slot; as the parts
add up to 1, every window is met, and at any slot each source has run within one block
of its target.  Weights are not rounded: a decimal number is taken as written.  When a
source runs out, its part falls to the others in proportion and a new phase begins, one
phase a source at most.  No row is dropped or repeated.

The schedule is laid out on the driver, one number for each block, and broadcast.  Its
size is bounded: without a given ``block_rows`` a block has ``BLOCK_ROWS`` rows, or as many
as make ``MOST_BLOCKS`` blocks of the whole table; a smaller one may be given up to 16 times
as many blocks, beyond which ``mix`` refuses it, as it does more than ``MOST_SOURCES`` sources.

Rows are numbered within a source by a hash of the id, without gathering a source
in one task: ranges of hashes are counted (``MOST_CELLS`` sources and ranges at most), the
counts summed up to offsets, and only rows of one source and range are ordered together.

Results: ``block`` and ``slot`` count from 0; ``position = slot * block_rows +
index in block`` orders all rows (a source's last block may be short).  A null
source is a source of its own.  Without given weights, the target is the square
root of a source's rows.  A source without a given weight (or with one that is
null, not finite or below 0) counts as weight 0 and follows when all others have run
out, again by square roots.  Ties in deadline go to the source first in order,
nulls last; repeated rows are placed one by one.  Columns named like the new ones
are replaced; no other name clashes.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linemend.llm.base import local_table, table

BLOCK_ROWS, MOST_BLOCKS, MOST_SOURCES = 16, 1 << 18, 10_000
RANGE_ROWS, MOST_CELLS, PIECE = 256, 1 << 20, 1024


def exact_shares(weights: Sequence[float | Decimal | Fraction]) -> list[int]:
    """The least whole shares in exactly the ratio of the weights, all above 0."""
    exact = [Fraction(w) if isinstance(w, (int, Decimal, Fraction)) else Fraction(repr(float(w))) for w in weights]
    common = math.lcm(*(w.denominator for w in exact))
    whole = [int(w * common) for w in exact]
    by = math.gcd(*whole)
    return [w // by for w in whole]


def phase(share: list[int], most: list[int]) -> list[list[int]]:
    """Slots, from 0, of each source's blocks until the first source has run its ``most``
    blocks: earliest deadline first among released blocks."""
    period = sum(share)
    slots: list[list[int]] = [[] for _ in share]
    waiting = [(0, i, 0) for i in range(len(share))]  # (release, source, block)
    ready: list[tuple[int, int, int]] = []  # (deadline, source, block)
    slot = 0
    while True:
        while waiting and waiting[0][0] <= slot:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * period // share[i]), i, k))
        _, i, k = heapq.heappop(ready)
        slots[i].append(slot)
        slot += 1
        if k + 1 == most[i]:
            return slots
        heapq.heappush(waiting, ((k + 1) * period // share[i], i, k + 1))


def schedule(blocks: dict[str | None, int], weights: dict[str | None, float]) -> dict[str | None, list[int]]:
    """The slot of every block of each source."""
    order = sorted((s for s in blocks if blocks[s] > 0), key=lambda s: (s is None, s or ""))
    out: dict[str | None, list[int]] = {s: [] for s in order}
    start = 0
    while order:
        active = [s for s in order if weights.get(s, 0) > 0]
        left = {s: blocks[s] - len(out[s]) for s in order}
        aim = [weights[s] for s in active]
        if not active:
            active, aim = order, [math.sqrt(left[s]) for s in order]
        ran = phase(exact_shares(aim), [left[s] for s in active])
        for s, at in zip(active, ran, strict=True):
            out[s] += [start + x for x in at]
        start += sum(map(len, ran))
        order = [s for s in order if len(out[s]) < blocks[s]]
    return out


class Mixer:
    """The plan of one table: its schedule and the hash ranges of its sources.  Works on
    rows (row, id, source), so that no column of theirs clashes."""

    def __init__(self, narrow: DataFrame, weights: dict[str | None, float] | None, block_rows: int | None):
        """``narrow``: id, source."""
        self.spark = narrow.sparkSession
        self.counts = {r.source: r.n for r in narrow.groupBy("source").agg(F.count(F.lit(1)).alias("n")).limit(MOST_SOURCES + 1).collect()}
        rows = sum(self.counts.values())
        self.block_rows = block_rows or max(BLOCK_ROWS, -(-rows // MOST_BLOCKS))
        blocks = {s: -(-n // self.block_rows) for s, n in self.counts.items()}
        if len(blocks) > MOST_SOURCES or sum(blocks.values()) > 16 * MOST_BLOCKS + MOST_SOURCES:
            raise ValueError("too many sources, or blocks too small, to lay the schedule out")
        if weights is None:
            weights = {s: math.sqrt(n) for s, n in self.counts.items()}
        weights = {s: w for s, w in weights.items() if w is not None and math.isfinite(w) and w > 0}
        self.slots = schedule(blocks, weights)
        self.last = max((at[-1] for at in self.slots.values()), default=-1)
        most = max(1, MOST_CELLS // max(1, len(self.counts)))
        wanted = max(self.counts.values(), default=1) // RANGE_ROWS
        self._bits = max(1, min(wanted.bit_length(), most.bit_length() - 1))
        pieces = [(s, k // PIECE, at[k : k + PIECE]) for s, at in self.slots.items() for k in range(0, len(at), PIECE)]
        self._pieces = local_table(self.spark, pieces, "p_source string, piece long, slots array<int>")

    def hashed(self, rows: DataFrame) -> DataFrame:
        """Adds ``h`` and its range ``r``: the order within a source is (r, h, id)."""
        return rows.withColumn("h", F.xxhash64(F.col("id").cast("string"))).withColumn("r", F.shiftrightunsigned("h", 64 - self._bits).cast("int"))

    def cells(self, rows: DataFrame) -> DataFrame:
        """(c_source, c_r, offset): rows of a source in lower ranges; ``MOST_CELLS`` rows at most."""
        counts = self.hashed(rows.select("id", "source")).groupBy(F.col("source").alias("c_source"), F.col("r").alias("c_r")).agg(F.count(F.lit(1)).alias("n"))
        before = Window.partitionBy("c_source").orderBy("c_r").rowsBetween(Window.unboundedPreceding, -1)
        return counts.select("c_source", "c_r", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    def numbered(self, rows: DataFrame) -> DataFrame:
        """Adds ``n``: from 0 within a source."""
        within = Window.partitionBy("source", "r").orderBy("h", "id")
        ranked = self.hashed(rows).withColumn("k", F.row_number().over(within))
        joined = ranked.join(F.broadcast(self.cells(rows)), F.col("source").eqNullSafe(F.col("c_source")) & (F.col("r") == F.col("c_r")))
        return joined.withColumn("n", F.col("offset") + F.col("k") - 1).drop("c_source", "c_r", "offset", "k")

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows with ``n`` get block, slot and position."""
        rows = rows.withColumn("block", F.floor(F.col("n") / self.block_rows))
        # a number for each block: bounded, see the module
        found = rows.join(F.broadcast(self._pieces), F.col("source").cast("string").eqNullSafe(F.col("p_source")) & (F.floor(F.col("block") / PIECE) == F.col("piece")))
        found = found.withColumn("slot", F.element_at("slots", (F.col("block") % PIECE + 1).cast("int")).cast("long"))
        return found.withColumn("position", F.col("slot") * self.block_rows + F.col("n") % self.block_rows).drop("p_source", "piece", "slots")

    def slices(self, narrow: DataFrame, parts: int) -> DataFrame:
        """(c_source, c_r, starts): which slice of positions the rows of a source and range
        fall into, as (hash from which, slice, number of the slice's first row), ascending.

        Along a source positions rise with the hash, so a slice begins at one hash."""
        ranked = self.placed(self.numbered(narrow))
        # rows of one hash (repeated ids) go to one slice: where the first of them stands
        found = ranked.groupBy("source", "r", "h").agg(F.min("n").alias("n"), F.min("position").alias("position"))
        slice_ = F.floor(F.col("position") * parts / ((self.last + 1) * self.block_rows)).cast("int")
        edges = found.groupBy("source", slice_.alias("slice")).agg(F.min(F.struct("r", "h")).alias("low"), F.min("n").alias("base"))
        inside = edges.groupBy(F.col("source").alias("e_source"), F.col("low.r").alias("e_r")).agg(F.sort_array(F.collect_list(F.struct(F.col("low.h").alias("h"), "slice", "base"))).alias("own"))
        both = self.cells(narrow).join(inside, F.col("c_source").eqNullSafe(F.col("e_source")) & (F.col("c_r") == F.col("e_r")), "left")
        before = Window.partitionBy("c_source").orderBy("c_r").rowsBetween(Window.unboundedPreceding, -1)
        carried = F.last(F.element_at("own", -1), ignorenulls=True).over(before)
        first = F.struct(F.lit(-(1 << 63)).alias("h"), carried["slice"].alias("slice"), carried["base"].alias("base"))
        none = F.expr("cast(array() as array<struct<h: bigint, slice: int, base: bigint>>)")
        return both.select("c_source", "c_r", F.concat(F.when(carried.isNotNull(), F.array(first)).otherwise(none), F.coalesce("own", none)).alias("starts"))


def _read(docs: DataFrame, id_col: str, source_col: str) -> tuple[list[str], DataFrame]:
    columns = [c for c in docs.columns if c not in ("block", "slot", "position")]
    return columns, docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"))


def mix(
    docs: DataFrame, weights: dict[str | None, float] | None = None, block_rows: int | None = None, id_col: str = "doc_id", source_col: str = "source"
) -> DataFrame:
    """Every row with block, slot and position, in no order; see the module."""
    _, rows = _read(docs, id_col, source_col)
    mixer = Mixer(rows.select("id", "source"), weights, block_rows)
    return mixer.placed(mixer.numbered(rows)).select("row.*", "block", "slot", "position")


def mix_in_order(
    docs: DataFrame, weights: dict[str | None, float] | None = None, block_rows: int | None = None, id_col: str = "doc_id", source_col: str = "source"
) -> DataFrame:
    """As ``mix``, with the rows in the order of ``position`` within and across
    partitions, and the wide columns shuffled once.

    Positions are found from ids and sources alone; a small table of hashes then sends
    each row to its slice of positions, where rows are numbered again and sorted."""
    _, rows = _read(docs, id_col, source_col)
    narrow = rows.select("id", "source")
    mixer = Mixer(narrow, weights, block_rows)
    parts = int(mixer.spark.conf.get("spark.sql.shuffle.partitions"))
    slices = mixer.slices(narrow, parts)
    if parts * len(mixer.counts) <= MOST_CELLS:  # a row for each cell, an entry for each source and slice
        slices = F.broadcast(slices)
    found = mixer.hashed(rows).join(slices, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("r") == F.col("c_r")))
    own = F.element_at(F.filter("starts", lambda x: x["h"] <= F.col("h")), -1)
    sent = found.withColumn("own", own).select("row", "id", "source", "r", "h", F.col("own.slice").alias("slice"), F.col("own.base").alias("base")).repartitionById(parts, F.col("slice"))
    within = Window.partitionBy("slice", "source").orderBy("r", "h", "id")
    again = sent.withColumn("n", F.col("base") + F.row_number().over(within) - 1)
    return mixer.placed(again.select("row", "source", "n")).select("row.*", "block", "slot", "position").sortWithinPartitions("position")


def op10_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix_in_order(docs)
