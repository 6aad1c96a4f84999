"""Near-duplicate embeddings by an exact metric range join.

Unit vectors are compared by chord length, a metric: cosine >= c exactly when the
chord is at most r = sqrt(2 - 2c).  Pivots (a bounded sample of the vectors) split the
space into cells by nearest pivot.  A vector y with home pivot h is compared in cell p, too, if it
may be within r of a vector whose home is p: by the triangle inequality that
needs d(y, p) <= d(y, h) + 2r, and, sharper on the same grounds, the distance of y to the bisecting plane of
h and p is at most r.  Of two cells one takes the pairs between them (``_takes``), so every pair meets once.

Equal vectors are one class with a multiplicity.  Every class is written once, in the precision of its column, to a file
of about ``CHUNK`` vectors of its home cell, and names the other cells that compare it.  A task holds one file's vectors and streams the
files that its cell needs past them, read where they lie: the disk used follows the number of vectors, the
memory ``CHUNK``, whatever the number of comparisons.  A task emits a link count for each vector with links and a
spanning forest of the links, never the pairs.  Candidates come from a single-precision product with a
proven error margin; pairs inside the margin are decided in double precision.

How many pivots pay is estimated on the same bounded sample (``SAMPLE`` vectors): where the data have
no cluster structure (distances concentrate in high dimensions) every cell needs nearly every
vector, one pivot is chosen and the work is that of a blocked comparison; the
result does not depend on the choice.

Rows: vectors that are null, zero, empty or hold null or non-finite components,
and rows with a null id, link with nothing; vectors of different lengths do not link;
rows with equal ids are one node, whatever vectors they hold, and ``n_links`` of a row counts the other ids at
its own vector and the ids at each vector linked with it (a repeated row counts once); other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arlark.llm.common import SharedFiles, shared_uri, staged
from arlark.llm.components import connected_components, merge_labels

#: Least cosine of a link.
COSINE = 0.95
#: Vectors that pivots are chosen from; with the largest count it bounds what is broadcast.
SAMPLE, PIVOT_COUNTS = 2048, (1, 8, 32, 128, 512)
#: Vectors of one file and of one side of a comparison, vectors compared with them at once, files that a task streams.
CHUNK, STREAM, SPAN = 8192, 1024, 16
#: Measured costs used to choose the number of pivots: seconds per compared component, per vector read, per file opened.
COMPARE_COST, READ_COST, FILE_COST = 1e-10, 1e-6, 3e-3
#: Numbers of classes whose smallest id is that of another class, too: above all ids.
EXTRA = (1 << 63) - (1 << 41)


def _units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows at length 1 in double precision, whether a row can link)."""
    x = x.astype(np.float64)
    usable = np.isfinite(x).all(axis=1)
    x[~usable] = 0
    largest = np.abs(x).max(axis=1, initial=0)
    usable &= largest > 0
    x[usable] /= largest[usable, None]
    x[usable] /= np.sqrt(np.einsum("ij,ij->i", x[usable], x[usable]))[:, None]
    return x, usable


def _component(rows: DataFrame, vector_col: str) -> tuple[str, type]:
    """(SQL type, numpy type) that holds the column's components exactly."""
    kind = rows.schema[vector_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return ("float", np.float32) if single else ("double", np.float64)


def packed_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, digest, vector): the components' bytes; ``digest`` tells equal vectors; null where a row links with nothing."""
    sql_type, kind = _component(rows, vector_col)

    def run(batches):
        for batch in batches:
            lists = batch.column("vector")
            lengths = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
            parts = pc.fill_null(lists.flatten(), math.nan).to_numpy(zero_copy_only=False) + kind(0)
            ends = np.cumsum(lengths)
            named = ~np.asarray(pc.is_null(batch.column("id")))
            dims, digests, vectors = ([None] * len(lists) for _ in range(3))
            for dim in np.unique(lengths[lengths > 0]).tolist():
                at = np.flatnonzero((lengths == dim) & named)
                x = parts[(ends[at] - dim)[:, None] + np.arange(dim)]
                for k, row, usable in zip(at.tolist(), x, _units(x)[1].tolist()):
                    if usable:
                        dims[k], vectors[k] = dim, row.tobytes()
                        digests[k] = xxhash.xxh128_digest(vectors[k])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())],
                names=["id", "dim", "digest", "vector"])

    source = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{sql_type}>").alias("vector"))
    return source.mapInArrow(run, "id long, dim int, digest binary, vector binary")


def _cells(x: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """(home cell of each row, boolean rows x cells of the cells each row is sent to, home included)."""
    near = x @ pivots.T
    home = near.argmax(axis=1)
    rows = np.arange(len(x))
    apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0.0))[home]
    distance = np.sqrt(np.maximum(2 - 2 * near, 0.0))
    slack = 1e-9
    sent = distance <= distance[rows, home][:, None] + 2 * radius + slack
    sent &= near[rows, home][:, None] - near <= (radius + slack) * apart + slack
    sent[rows, home] = True
    return home, sent


def _takes(cell, home):
    """Whether ``cell`` compares its vectors with those of the cell ``home``: one of the two does, half of all for each."""
    return (cell < home) == ((cell + home) % 2 == 0)


def choose_pivots(sample: np.ndarray, n: int, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Pivots from the sample and the share of vectors at home with each; their number minimises the estimated cost."""
    best, chosen, shares = math.inf, sample[:1], np.ones(1)
    for count in PIVOT_COUNTS:
        if count > 1 and count * 4 > len(sample):
            break
        home, sent = _cells(sample, sample[:count], radius)
        homes, members = np.bincount(home, minlength=count) / len(sample), sent.sum(axis=0) / len(sample)
        files = np.ceil(homes * n / CHUNK)
        needs = np.stack([sent[home == h].any(axis=0) for h in range(count)])
        compared = float((homes * members).sum()) * n * n / 2
        opened = float(files @ needs @ files) / 2
        cost = compared * sample.shape[1] * COMPARE_COST + float(homes @ needs @ files) * n / 2 * READ_COST + opened * FILE_COST
        if cost < best:
            best, chosen, shares = cost, sample[:count], homes
    return chosen, shares


class Block:
    """The vectors of one file: their class ids, multiplicities, units and the other cells that compare them."""

    def __init__(self, table: pa.Table, kind: type):
        table = table.combine_chunks()
        self.ids, self.copies = np.asarray(table["id"]), np.asarray(table["copies"])
        vectors = table["vector"].chunk(0) if table.num_rows else pa.array([], pa.binary())
        ends = np.frombuffer(vectors.buffers()[1], np.int32)[vectors.offset:][:len(vectors) + 1] if len(vectors) else [0, 0]
        raw = np.frombuffer(vectors.buffers()[2], np.uint8)[ends[0]:ends[-1]] if len(vectors) else np.empty(0, np.uint8)
        self.units = _units(raw.view(kind).reshape(len(vectors), -1))[0] if len(vectors) else np.empty((0, 1))
        cells = table["cells"].chunk(0) if table.num_rows else pa.array([], pa.list_(pa.int32()))
        self.cells, self.rows = np.asarray(cells.flatten()), np.asarray(pc.list_parent_indices(cells))

    def of(self, cell: int) -> np.ndarray:
        """Rows that ``cell`` compares, which is not their home."""
        return self.rows[self.cells == cell]


class ChunkJoin:
    """One file's vectors; ``see`` takes further vectors to compare with them and returns their link counts."""

    def __init__(self, ids: np.ndarray, units: np.ndarray, copies: np.ndarray, cosine: float):
        self.ids, self.units, self.copies, self.cosine = ids, units, copies, cosine
        self.single = units.astype(np.float32)
        self.margin = 1e-6 + 1.2e-7 * units.shape[1]
        self.links = np.zeros(len(ids), np.int64)
        self.label = ids.copy()
        self.edges: list[np.ndarray] = []

    def see(self, ids: np.ndarray, units: np.ndarray, copies: np.ndarray) -> np.ndarray:
        links = [self._block(ids[at:at + STREAM], units[at:at + STREAM], copies[at:at + STREAM]) for at in range(0, len(ids), STREAM)]
        return np.concatenate(links) if links else np.zeros(0, np.int64)

    def _block(self, ids: np.ndarray, units: np.ndarray, copies: np.ndarray) -> np.ndarray:
        close = self.single @ units.astype(np.float32).T
        hit = close >= self.cosine - self.margin
        if not hit.any():
            return np.zeros(len(ids), np.int64)
        i, j = np.nonzero(hit & (close <= self.cosine + self.margin))
        if len(i):
            hit[i, j] = np.einsum("ij,ij->i", self.units[i], units[j]) >= self.cosine
        hit &= self.ids[:, None] != ids[None, :]
        if not hit.any():
            return np.zeros(len(ids), np.int64)
        self.links += hit @ copies
        self.label, _, edges = merge_labels(hit, self.label, ids)
        self.edges.extend(edges)
        return self.copies @ hit


OUT = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _matrix(column: list[bytes], kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def _counts(ids: np.ndarray, links: np.ndarray):
    some = np.flatnonzero(links)
    none = pa.nulls(len(some), pa.int64())
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), none, none], schema=OUT)


def _edges(join: ChunkJoin):
    for edge in join.edges:
        none = pa.nulls(edge.shape[1], pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.array(edge[0]), pa.array(edge[1])], schema=OUT)


def range_join(classes: DataFrame, pivots: np.ndarray, shares: np.ndarray, dim: int, dims: DataFrame, kind: type,
               cosine: float = COSINE) -> DataFrame:
    """(id, links) of classes with links and (a, b) edges of a spanning forest, from (id, dim, copies, vector).

    ``dims`` counts the classes of each length.
    """
    spark = classes.sparkSession
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))
    shared = spark.sparkContext.broadcast(pivots)

    def assign(batches):
        for batch in batches:
            lengths = np.asarray(batch.column("dim"))
            vectors = batch.column("vector").to_pylist()
            usual = np.flatnonzero(lengths == dim)
            # vectors of another length have a cell of their own for each length
            cells, homes = [[]] * len(vectors), -lengths
            if len(usual):
                near, sent = _cells(_units(_matrix([vectors[k] for k in usual], kind))[0], shared.value, radius)
                homes[usual] = near
                sent &= _takes(np.arange(len(shared.value))[None, :], near[:, None])
                sent[np.arange(len(usual)), near] = False
                for k, r in zip(usual.tolist(), sent):
                    cells[k] = np.flatnonzero(r).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("copies"), batch.column("vector"), pa.array(homes, pa.int32()),
                 pa.array(cells, pa.list_(pa.int32()))], names=["id", "copies", "vector", "home", "cells"])

    # files of each cell: by the sample's shares, or by the count where a length is its own cell
    n = F.col("count") * F.when(F.col("dim") == dim, F.element_at(F.lit(shares.tolist()), F.col("at") + 1)).otherwise(1.0)
    sizes = staged(dims.select("dim", "count", F.explode(F.when(F.col("dim") == dim, F.sequence(F.lit(0), F.lit(len(pivots) - 1)))
                                                         .otherwise(F.array(-F.col("dim")))).alias("home")).withColumn("at", F.greatest("home", F.lit(0)))
                   .select("home", F.greatest(F.lit(1), F.ceil(n / CHUNK)).cast("int").alias("files")), "cell-sizes")
    total = sizes.agg(F.sum("files")).first()[0]
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total)
    uri = shared_uri(spark, "cells")
    assigned = classes.mapInArrow(assign, "id long, copies long, vector binary, home int, cells array<int>")
    placed = assigned.join(F.broadcast(sizes), "home").withColumn("file", F.pmod(F.xxhash64("id"), F.col("files")).cast("int"))
    placed.drop("files").repartition(width, "home", "file").write.partitionBy("home", "file").parquet(uri)

    # (cell, home): a cell compares its files with each other and with those of homes that have a vector for it
    found = spark.read.schema("cells array<int>, home int").option("basePath", uri).parquet(uri)
    pairs = found.select(F.explode("cells").alias("cell"), "home").distinct().union(sizes.select(F.col("home").alias("cell"), "home"))
    files = pairs.join(F.broadcast(sizes.select(F.col("home").alias("cell"), F.col("files").alias("own"))), "cell").join(
        F.broadcast(sizes), "home")
    # inside a cell file k meets itself and the next half of the ring of files
    others = F.when(F.col("home") == F.col("cell"), F.floor(F.col("own") / 2) + 1).otherwise(F.col("files")).cast("int")
    spans = files.select("cell", "home", "own", others.alias("others"), F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("file")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("others") - 1, F.lit(SPAN))).alias("first"))
    spans = spans.select("cell", "file", "home", "own", "first", F.least(F.col("first") + SPAN, "others").alias("last")).repartition(width)

    def run(batches):
        store = SharedFiles(uri)

        def block(home: int, file: int) -> Block:
            at = f"{store.root}/home={home}/file={file}"
            names = sorted(f.path for f in store.files(at) if f.base_name.startswith("part-"))
            tables = [pq.ParquetFile(store.fs.open_input_file(name)).read(["id", "copies", "vector", "cells"]) for name in names]
            return Block(pa.concat_tables(tables) if tables else EMPTY, kind)

        for batch in batches:
            for item in batch.to_pylist():
                cell, file, home, own = item["cell"], item["file"], item["home"], item["own"]
                mine = block(cell, file)
                if not len(mine.ids):
                    continue
                join = ChunkJoin(mine.ids, mine.units, mine.copies, cosine)
                for k in range(item["first"], item["last"]):
                    if home != cell:
                        other = block(home, k)
                        some = other.of(cell)
                        yield from _counts(other.ids[some], join.see(other.ids[some], other.units[some], other.copies[some]))
                    elif k == 0:
                        join.see(mine.ids, mine.units, mine.copies)     # both sides are its own: counted once
                    elif 2 * k < own or file < k:
                        other = block(home, (file + k) % own)
                        yield from _counts(other.ids, join.see(other.ids, other.units, other.copies))
                yield from _counts(join.ids, join.links)
                yield from _edges(join)

    return spans.mapInArrow(run, "id long, links long, a long, b long")


#: What a file without rows would hold: a cell may have fewer vectors than files.
EMPTY = pa.table({"id": pa.array([], pa.int64()), "copies": pa.array([], pa.int64()), "vector": pa.array([], pa.binary()),
                  "cells": pa.array([], pa.list_(pa.int32()))})


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``rows``."""
    kind = _component(rows, vector_col)[1]
    units = staged(packed_vectors(rows, id_col, vector_col), "vectors")
    holders = units.where("id is not null").select("id", "digest").distinct()
    members = units.where("digest is not null").select("digest", "dim", "id").distinct().groupBy("digest").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("dim").alias("dim"))
    # a class is known by its smallest id; where several vectors have the same one, by a number of its own but for the first
    leads = members.groupBy("rep").agg(F.min("digest").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    named = members.join(leads, "rep", "left").withColumn("class", F.when(
        F.col("lead").isNull() | (F.col("lead") == F.col("digest")), F.col("rep")).otherwise(
        F.lit(EXTRA) + F.pmod(F.xxhash64("digest"), F.lit(1 << 40)))).drop("lead")
    members = staged(named, "vector-classes")
    # an id with several vectors is one node: it links to the class of each
    several = holders.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    own = holders.join(several, "id").join(members.select("digest", "class"), "digest").select(F.col("id").alias("a"), F.col("class").alias("b"))
    dims = staged(members.groupBy("dim").count(), "vector-lengths")
    usual = dims.orderBy(F.desc("count"), "dim").first()
    if usual is None:
        return rows.select(F.col(id_col), F.lit(0).cast("long").alias("n_links"), F.col(id_col).cast("long").alias("component_id"),
                           F.lit(True).alias("kept"))
    dim, n = usual["dim"], usual["count"]
    some = members.where(F.col("dim") == dim).orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("digest", "class")
    drawn = units.select("digest", "vector").join(F.broadcast(some), "digest").groupBy("digest", "class").agg(F.first("vector").alias("vector"))
    sample = drawn.orderBy(F.xxhash64("class"), "class").collect()
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))
    pivots, shares = choose_pivots(_units(_matrix([bytes(r["vector"]) for r in sample], kind))[0], n, radius)
    # one row for each class, whichever row carries it: combined before the shuffle, so a common vector moves a few times only
    vectors = units.where("digest is not null").groupBy("digest").agg(F.first("vector").alias("vector"))
    reps = vectors.join(members.select("digest", F.col("class").alias("id"), "copies", "dim"), "digest").drop("digest")
    joined = staged(range_join(reps, pivots, shares, dim, dims, kind, cosine), "range-join")
    counts = joined.where("id is not null").groupBy("id").agg(F.sum("links").alias("links"))
    labels = connected_components(joined.where("a is not null").select("a", "b").union(own))
    found = units.select("id", "digest").join(members.select("digest", "class", "rep", "copies"), "digest", "left")
    found = found.join(counts.withColumnRenamed("id", "class"), "class", "left").join(
        labels, F.coalesce("class", "id") == F.col("node"), "left")
    component = F.coalesce("component", "rep", "id")
    # a class without links to others still has its own copies
    links = (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long")
    return found.select(F.col("id").alias(id_col), links.alias("n_links"), component.alias("component_id"),
                        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def oracle_sql() -> str:
    """DuckDB text of the registered query: all pairs, then reachability."""
    return f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
usable AS (SELECT * FROM vectors WHERE norm > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= {COSINE}),
reach AS (
  SELECT vec_id, vec_id AS node FROM embeddings
  UNION SELECT r.vec_id, l.y FROM reach r JOIN links l ON l.x = r.node),
least AS (SELECT vec_id, min(node) AS component_id FROM reach GROUP BY vec_id)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE x = e.vec_id)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id)"""
