"""Minimax contiguous sharding: the smallest feasible shard capacity over ordered atomic groups.

Groups (rows of equal key, here equal texts) are ordered by their smallest id
and are never split.  The capacity is binary-searched; a capacity is feasible
if greedily filling shards in order needs no more than ``shards``.  The cuts
of the smallest feasible capacity are final.

The group table is distributed, so the search runs on a summary that is refined
where it matters: id ranges with their byte totals.  A summary gives two
bounds on the best capacity -- cutting at known range borders only (feasible,
hence an upper bound) and cutting anywhere inside a range of several groups (a
lower bound).  Only ranges that a cut may fall into are split further, by one
aggregation of the group table; the bounds then meet and the result is exact.
The driver holds at most ``SUMMARY_ROWS`` new ranges for each pass, whatever the input.

Rows: null texts count as empty (size 1, CRC 0) and are one group with empty ones;
null ids sort first; groups with equal smallest ids stay together; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arlark.llm.common import bucket_count, byte_length, staged

#: Ranges made by one refinement pass.
SUMMARY_ROWS = 16_384
LEAST_LONG = -(1 << 63)


class Ranges:
    """Ordered id ranges [low, high] with byte totals and group counts."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        rows = sorted(rows)
        self.rows = rows
        self.bytes = np.array([r[2] for r in rows], dtype=np.int64)
        self.open = np.array([r[3] > 1 and r[0] < r[1] for r in rows], dtype=bool)
        self.ends = np.cumsum(self.bytes)

    def cuts(self, capacity: int, shards: int, inside: bool) -> list[int] | None:
        """Greedy byte positions of the cuts, None if ``shards`` shards do not hold everything.

        ``inside``: a range of several groups may be cut at any byte.
        """
        total, at, out = int(self.ends[-1]), 0, []
        for _ in range(shards):
            if at + capacity >= total:
                return out
            k = int(np.searchsorted(self.ends, at + capacity, side="right"))
            border = int(self.ends[k - 1]) if k else 0
            reach = at + capacity if inside and self.open[k] else border
            if reach <= at:
                return None
            out.append(reach)
            at = reach
        return None

    def smallest(self, shards: int, inside: bool, low: int, high: int) -> int:
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, inside) is None:
                low = middle + 1
            else:
                high = middle
        return low

    def doubtful(self, shards: int, low: int, high: int) -> list[int]:
        """Open ranges that a cut may fall into for capacities from ``low`` to ``high``."""
        late = self.cuts(high, shards, inside=True) or []
        marks, at, total = np.zeros(len(self.rows), bool), 0, int(self.ends[-1])
        for i in range(shards - 1):
            # earliest place of cut i: known borders only, at the smallest capacity
            k = int(np.searchsorted(self.ends, at + low, side="right"))
            at = max(at, int(self.ends[k - 1]) if k else 0)
            if at >= total:
                break
            until = late[i] if i < len(late) else min(total, (i + 1) * high)
            first = int(np.searchsorted(self.ends, at, side="right"))
            last = int(np.searchsorted(self.ends, max(until, at), side="left"))
            marks[first:last + 1] = True
        return np.flatnonzero(marks & self.open).tolist()


def _summarise(groups: DataFrame, ranges: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(low, high, bytes, groups) of equal-width parts of the given id ranges, empty parts left out."""
    parts = max(2, SUMMARY_ROWS // len(ranges))
    lows = F.array(*[F.lit(low).cast("long") for low, _ in ranges])
    highs = F.array(*[F.lit(high).cast("long") for _, high in ranges])
    widths = F.array(*[F.lit(max(1, math.ceil((high - low + 1) / parts))).cast("decimal(20,0)") for low, high in ranges])
    k = F.size(F.filter(lows, lambda low: low <= F.col("first"))) - 1
    inside = groups.withColumn("k", k).where((F.col("k") >= 0) & (F.col("first") <= F.get(highs, F.col("k"))))
    gap = F.col("first").cast("decimal(20,0)") - F.get(lows, F.col("k")).cast("decimal(20,0)")
    part = F.floor(gap / F.get(widths, F.col("k"))).cast("long")
    found = inside.withColumn("part", part).groupBy("k", "part").agg(
        F.min("first"), F.max("first"), F.sum("bytes"), F.count(F.lit(1))).collect()
    return [tuple(r)[2:] for r in found]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(capacity, cut ids): a group is in shard j if j cut ids are <= its ``first``.

    ``groups``: (first long, bytes long), one row for each atomic group.
    """
    ends = groups.agg(F.min("first"), F.max("first"), F.sum("bytes"), F.max("bytes"), F.count(F.lit(1))).first()
    if ends[0] is None:
        return 0, []
    total, largest = int(ends[2]), int(ends[3])
    ranges = Ranges(_summarise(groups, [(ends[0], ends[1])]))
    while True:
        low = ranges.smallest(shards, True, max(largest, -(-total // shards)), total)
        high = ranges.smallest(shards, False, low, total)
        doubtful = ranges.doubtful(shards, low, high) if low < high else []
        if not doubtful:
            break
        split = set(doubtful)
        kept = [r for i, r in enumerate(ranges.rows) if i not in split]
        ranges = Ranges(kept + _summarise(groups, [ranges.rows[i][:2] for i in doubtful]))
    starts = [int(np.searchsorted(ranges.ends, cut, side="right")) for cut in ranges.cuts(high, shards, False)]
    return high, [ranges.rows[k][0] for k in starts]


def shard_of(first: Column, cuts: list[int]) -> Column:
    out = F.lit(0)
    for cut in cuts:
        out = out + (first >= F.lit(cut)).cast("int")
    return out


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot): contiguous shards of whole equal-text groups, slots gapless from 0.

    Slots number a shard's rows by (hash bucket, id): bucket sizes are summed
    first, so no task numbers a whole shard.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(docs.select(F.col(id_col).cast("long").alias("id"), (byte_length(text) + 1).alias("size"),
                              F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest")), "shard-rows")
    groups = staged(rows.groupBy("digest").agg(
        F.coalesce(F.min("id"), F.lit(LEAST_LONG)).alias("first"), F.sum("size").alias("bytes"),
        F.count(F.lit(1)).alias("n")), "shard-groups")
    _, cuts = minimax_cuts(groups, shards)
    placed = rows.join(groups.select("digest", shard_of(F.col("first"), cuts).alias("shard")), "digest")
    n = groups.agg(F.sum("n")).first()[0] or 0
    buckets = bucket_count(math.isqrt(n), 1)
    placed = staged(placed.select("id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("bucket")),
                    "shard-placed")
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("id", "size", "text_crc32")
    numbered = placed.withColumn("inside", F.row_number().over(inside) - 1).join(offsets, ["shard", "bucket"])
    return numbered.select(F.col("id").alias(id_col), "size", "text_crc32", "shard",
                           (F.col("offset") + F.col("inside")).alias("slot"))
