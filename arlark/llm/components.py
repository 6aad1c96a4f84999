"""Connected components of a link table by alternating large-star and small-star.

Large-star links every larger neighbour of a node to the smallest node of its
neighbourhood; small-star links a node and its smaller neighbours to the smallest of them.  Alternated until
nothing changes, every node hangs on its component's smallest node.  All steps are grouped
minima (combined before the shuffle) and joins; links never leave the cluster, and
only a count and a checksum of the link table reach the driver.  Each round is
written to shared storage, so lost executors do not replay earlier rounds.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from arlark.llm.common import shared_uri


#: Links of one file of a round's table.
LINKS_PER_FILE = 50_000


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The table on shared storage and its (rows, checksum)."""
    spark = links.sparkSession
    seen = Observation(f"links_{uuid.uuid4().hex[:8]}")
    path = shared_uri(spark, "links")
    links.observe(seen, F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64("a", "b")).alias("sum")).write.parquet(path)
    got = seen.get
    return spark.read.schema("a long, b long").parquet(path), (got["rows"], got["sum"])


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link; ``component`` is the smallest node reachable.

    Links are undirected; repeated links, both directions, self-links and nulls are allowed.
    """
    ends = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    table, state = _written(ends.select(F.col("a").cast("long"), F.col("b").cast("long")).distinct())
    while state[0]:
        both = table.union(table.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(lower)
        # a round never has more links than the one before
        table, new_state = _written(small.distinct().coalesce(max(1, math.ceil(state[0] / LINKS_PER_FILE))))
        if new_state == state:
            break
        state = new_state
    roots = table.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return table.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def merge_labels(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Labels after joining every row with the columns it hits, and (2, n) links that say so.

    ``hit`` is a boolean matrix inside one task; ``left`` and ``right`` are node
    labels.  The links form a spanning forest: one for each label that changed, not one for each hit.
    """
    rows, columns = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    if not len(rows):
        return left, right, []
    part, far = hit[np.ix_(rows, columns)], np.iinfo(np.int64).max
    a, b = left[rows], right[columns]
    while True:
        new_b = np.minimum(b, np.where(part, a[:, None], far).min(axis=0))
        new_a = np.minimum(a, np.where(part, new_b[None, :], far).min(axis=1))
        if (new_a == a).all() and (new_b == b).all():
            break
        a, b = new_a, new_b
    links = []
    for old, new in ((left[rows], a), (right[columns], b)):
        changed = old != new
        if changed.any():
            links.append(np.unique(np.stack([old[changed], new[changed]]), axis=1))
    left, right = left.copy(), right.copy()
    left[rows], right[columns] = a, b
    return left, right, links
