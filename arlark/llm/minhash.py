"""MinHash near-duplicate documents: universal hash minima, banding, signature check, full-set check, components.

1. Sketch: a document's set is its distinct 5-word shingles (64-bit hashes of
   lower-cased words).  ``HASHES`` multiply-shift universal hashes give the
   signature.  Documents of equal sets are one class; only its smallest id goes on.
2. Banding: ``BANDS`` bands of ``ROWS`` minima.  At the similarity threshold of 0.75 a pair shares no band
   with probability (1 - 0.75^4)^32 < 1e-5.
3. First pass: every member of a bucket is compared with the bucket's smallest id only,
   so a bucket of n members makes n - 1 pairs.  The signature check drops
   pairs whose estimate is six standard deviations below the threshold; the rest are
   confirmed on their full sets, recomputed from the texts.  Components follow.
4. Second pass, so that no link between the other members is lost: in buckets whose
   members are still in different components, signatures are compared in blocks inside
   tasks; what passes between components leaves a task as a spanning forest, not as pairs.  The
   forests' components are clusters; a cluster's members are then compared chunk by
   chunk, signatures first and full sets where they pass, and a task emits
   one link for each two components it joins.

Rows: null or empty texts and texts without words have the empty set (0
shingles) and link with nothing; rows with equal ids are one node,
which all their sets link to; a null id
links with nothing and is kept; columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arlark.llm.common import staged
from arlark.llm.components import connected_components, merge_labels
from arlark.llm.vocabulary import PieceCache, trim, worker_state

SHINGLE = 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Links have 100 * intersection >= LINK_PERCENT * union.
LINK_PERCENT = 75
#: Equal minima that a pair needs to go on: 6 standard deviations below the expectation at the threshold.
LEAST_EQUAL = int(HASHES * 0.75 - 6 * (HASHES * 0.75 * 0.25) ** 0.5)
#: Members of a bucket compared in one block.
BLOCK = 2048
#: Members checked against one copy of their partner's text; members of a cluster held by a task.
MEMBERS_PER_COPY, CHUNK = 256, 512

_FACTORS = np.random.Generator(np.random.PCG64(20_011)).integers(1, 1 << 63, size=(2, HASHES), dtype=np.uint64)
MULTIPLIERS, OFFSETS = (_FACTORS[0] << np.uint64(1) | np.uint64(1))[:, None], _FACTORS[1][:, None]
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(SHINGLE)]


def _word_hashes() -> PieceCache:
    return PieceCache(xxhash.xxh64_intdigest, longest=48)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; of all its words if there are fewer than ``SHINGLE``."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    cache = worker_state("word hashes", None, _word_hashes)
    hashes = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    n = len(hashes) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out += hashes[k:n + k] * _POWERS[k]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``HASHES`` minima of h(x) = high 32 bits of a * x + b over the 32-bit folded set."""
    folded = shingles >> np.uint64(32)
    best = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(folded), 1024):
        values = MULTIPLIERS * folded[None, at:at + 1024]
        values += OFFSETS
        np.minimum(best, values.min(axis=1), out=best)
    return (best >> np.uint64(32)).astype("<u4")


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, digest, signature) of every row; one narrow pass.  Empty sets have null digest and signature."""
    def run(batches):
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column("text").to_pylist():
                shingles = shingle_set(text)
                sizes.append(len(shingles))
                digests.append(xxhash.xxh128_digest(shingles.tobytes()) if len(shingles) else None)
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signatures, pa.binary())], names=["id", "n_shingles", "digest", "signature"])
        trim(worker_state("word hashes", None, _word_hashes))

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "id long, n_shingles long, digest binary, signature binary")


def _equal_minima(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal minima of every row of ``left`` with every row of ``right``."""
    out = np.zeros((len(left), len(right)), np.int16)
    for k in range(HASHES):
        out += left[:, k, None] == right[None, :, k]
    return out


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u4").reshape(-1, HASHES)


def _pass_signatures(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree often enough."""
    def run(batches):
        for batch in batches:
            left, right = (_matrix(batch.column(c).to_pylist()) for c in ("left", "right"))
            good = (left == right).sum(axis=1) >= LEAST_EQUAL
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good)), batch.column("b").filter(pa.array(good))],
                                             names=["a", "b"])

    left = signatures.select(F.col("id").alias("a"), F.col("signature").alias("left"))
    right = signatures.select(F.col("id").alias("b"), F.col("signature").alias("right"))
    # sort-merge at every size: the plan should not change with what fits a broadcast
    return pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").mapInArrow(run, "a long, b long").distinct()


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether two full sets link."""
    least, most = sorted((len(left), len(right)))
    if 100 * least < LINK_PERCENT * most:
        return False
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * shared >= LINK_PERCENT * (least + most - shared)


def confirm(pairs: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pairs (a, b) that link on their full shingle sets.

    Members meet their partner's text in (partner, part) groups of about
    ``MEMBERS_PER_COPY``; a task streams its sorted rows and holds one
    partner's sets and one member at a time.
    """
    parts = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / MEMBERS_PER_COPY).alias("parts"))
    placed = pairs.join(parts, "b").select("b", F.pmod(F.xxhash64("a"), F.col("parts")).alias("part"), F.col("a").alias("id"))
    heads = placed.select("b", "part", F.col("b").alias("id")).distinct()
    needed = placed.withColumn("member", F.lit(True)).unionByName(heads.withColumn("member", F.lit(False)))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = needed.join(texts.hint("merge"), "id").repartition(width, "b", "part").sortWithinPartitions("b", "part", "member")

    def run(batches):
        group, heads = None, []
        for batch in batches:
            found = []
            for b, part, doc, member, text in zip(*[batch.column(c).to_pylist() for c in ("b", "part", "id", "member", "text")]):
                if (b, part) != group:
                    group, heads = (b, part), []
                shingles = shingle_set(text)
                if not member:
                    heads.append(shingles)
                    continue
                for head in heads:
                    if similar(head, shingles):
                        found.append((doc, b))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def _cluster_links(members: DataFrame, sizes: DataFrame, signatures: DataFrame) -> DataFrame:
    """Links (a, b) of a spanning forest over the bucket members that pass the signature check across components.

    A bucket of n members is cut into n / ``BLOCK`` chunks by id hash; each pair of chunks is one group.
    """
    chunked = members.join(sizes, "key").withColumn("chunks", F.ceil(F.col("n") / BLOCK).cast("int"))
    chunked = chunked.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    spread = chunked.join(signatures.hint("merge"), "id").select(
        "key", "id", "label", "signature", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    grouped = spread.select("key", "id", "label", "signature", "chunk", F.least("chunk", "other").alias("low"),
                            F.greatest("chunk", "other").alias("high"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        low, high = group["low"].iloc[0], group["high"].iloc[0]
        left, right = group[group["chunk"] == low], group[group["chunk"] == high]
        signature, labels, ids = _matrix(right["signature"]), right["label"].to_numpy(), right["id"].to_numpy()
        found = []
        for at in range(0, len(left), 512):
            block = left.iloc[at:at + 512]
            passed = _equal_minima(_matrix(block["signature"]), signature) >= LEAST_EQUAL
            passed &= block["label"].to_numpy()[:, None] != labels[None, :]
            _, ids, links = merge_labels(passed, block["id"].to_numpy(), ids)
            found.extend(links)
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pd.DataFrame({"a": a, "b": b})

    return grouped.groupBy("key", "low", "high").applyInPandas(compare, "a long, b long").distinct()


class ClusterChunk:
    """One chunk of a cluster's members; ``see`` compares further members with them."""

    def __init__(self):
        self.ids: list[int] = []
        self.labels: list[int] = []
        self.signatures: list[bytes] = []
        self.texts: list[str] = []
        self.sets: dict[int, np.ndarray] = {}
        self.matrix = None
        self.parent: dict[int, int] = {}

    def add(self, doc: int, label: int, signature: bytes, text: str) -> None:
        self.ids.append(doc)
        self.labels.append(label)
        self.signatures.append(signature)
        self.texts.append(text)

    def _root(self, label: int) -> int:
        while (up := self.parent.get(label, label)) != label:
            label = self.parent[label] = self.parent.get(up, up)
        return label

    def see(self, ids: list[int], labels: list[int], signatures: list[bytes], texts: list[str]):
        """Yields (a, b) for each link that joins two components not joined in this task yet."""
        if self.matrix is None:
            self.matrix = _matrix(self.signatures)
            self.id_array, self.label_array = np.array(self.ids), np.array(self.labels)
        passed = _equal_minima(self.matrix, _matrix(signatures)) >= LEAST_EQUAL
        passed &= (self.label_array[:, None] != np.array(labels)[None, :]) & (self.id_array[:, None] > np.array(ids)[None, :])
        others: dict[int, np.ndarray] = {}
        for i, j in zip(*(x.tolist() for x in np.nonzero(passed))):
            a, b = self._root(self.labels[i]), self._root(labels[j])
            if a == b:
                continue
            if i not in self.sets:
                self.sets[i] = shingle_set(self.texts[i])
            if j not in others:
                others[j] = shingle_set(texts[j])
            if similar(self.sets[i], others[j]):
                self.parent[max(a, b)] = min(a, b)
                yield self.ids[i], ids[j]


def _join_clusters(clusters: DataFrame, labels: DataFrame, signatures: DataFrame, docs: DataFrame, id_col: str,
                   text_col: str) -> DataFrame:
    """Confirmed links (a, b) between different components of each cluster."""
    members = clusters.join(labels.select("node", F.col("component").alias("label")), "node", "left").select(
        F.col("node").alias("id"), F.col("component").alias("cluster"), F.coalesce("label", "node").alias("label"))
    chunks = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = members.join(chunks, "cluster").join(signatures.hint("merge"), "id").join(texts.hint("merge"), "id")
    own = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    seen = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(c.alias("chunk"), F.lit(True).alias("seen")))
    home = F.array(F.struct(own.alias("chunk"), F.lit(False).alias("seen")))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("cluster", "id", "label", "signature", "text", F.explode(F.concat(home, seen)).alias("place")).select(
        "cluster", "place.chunk", "place.seen", "id", "label", "signature", "text")
    rows = rows.repartition(width, "cluster", "chunk").sortWithinPartitions("cluster", "chunk", "seen")

    def run(batches):
        group, held = None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("cluster", "chunk", "seen", "id", "label", "signature", "text")]
            found, start, n = [], 0, batch.num_rows
            while start < n:
                key = (columns[0][start], columns[1][start])
                stop = start + 1
                while stop < n and stop - start < BLOCK and (columns[0][stop], columns[1][stop]) == key and (
                        columns[2][stop] == columns[2][start]):
                    stop += 1
                if key != group:
                    group, held = key, ClusterChunk()
                part = [c[start:stop] for c in columns[3:]]
                if columns[2][start]:
                    found.extend(held.see(*part))
                else:
                    for row in zip(*part):
                        held.add(*row)
                start = stop
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``."""
    rows = staged(sketch(docs, id_col, text_col), "sketches")
    classes = rows.where("digest is not null and id is not null").groupBy("digest").agg(F.min("id").alias("rep"))
    members = rows.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.col("digest")).alias("digest")).join(
        classes, "digest", "left").drop("digest")
    members = staged(members, "set-classes")
    reps = rows.join(classes.select("digest", F.col("rep").alias("id")), ["digest", "id"])
    signatures = staged(reps.select("id", "signature").dropDuplicates(["id", "signature"]), "signatures")

    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda band: F.xxhash64(
        F.substring(F.col("signature"), band * (4 * ROWS) + 1, F.lit(4 * ROWS)), band))
    cells = signatures.select("id", F.explode(keys).alias("key"))
    heads = cells.groupBy("key").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = staged(cells.join(heads, "key").where("id != lead"), "buckets")

    star = staged(_pass_signatures(buckets.select(F.col("id").alias("a"), F.col("lead").alias("b")).distinct(), signatures),
                  "star-pairs")
    # an id with several rows is one node: it links to the representative of each of its sets
    several = members.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    own = members.where("rep != id").select("id", "rep").distinct().join(several, "id").select(
        F.col("id").alias("a"), F.col("rep").alias("b"))
    links = staged(confirm(star, docs, id_col, text_col).select("a", "b").union(own), "links-1")
    labels = connected_components(links)

    labelled = staged(buckets.where("n > 2").join(labels, F.col("id") == F.col("node"), "left").select(
        "key", "id", F.coalesce("component", "id").alias("label")), "labelled")
    open_buckets = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                               F.count(F.lit(1)).alias("n")).where("low != high")
    forest = staged(_cluster_links(labelled, open_buckets.select("key", "n"), signatures), "cluster-links")
    if not forest.isEmpty():
        clusters = connected_components(forest)
        more = staged(_join_clusters(clusters, labels, signatures, docs, id_col, text_col), "links-2")
        if not more.isEmpty():
            labels = connected_components(links.union(more))

    found = members.join(labels, F.coalesce("rep", "id") == F.col("node"), "left")
    component = F.coalesce("component", "rep", "id")
    return found.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, and their own columns (rows of equal id stay or go together)."""
    dropped = near_duplicates(docs, id_col, text_col).where(~F.col("kept")).select(F.col(id_col).alias("_dropped")).distinct()
    return docs.join(dropped, docs[id_col] == dropped["_dropped"], "left_anti")


def oracle_sql() -> str:
    """DuckDB text of the registered query: all pairs that share a shingle, then reachability.

    The rows are exact; the operator may miss a pair with the probability of its banding.
    """
    return r"""
WITH RECURSIVE parts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM parts),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * both_have >= 75 * (p.n + q.n - both_have)),
ends AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS node FROM documents
  UNION SELECT r.doc_id, e.y FROM reach r JOIN ends e ON e.x = r.node),
least AS (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)"""
