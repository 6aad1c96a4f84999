"""Line dedup over a sharded minimal perfect hash.

A line's key is the line without space, tab and line-end characters at both ends, A-Z
lower-cased; keys of at least ``KEY_CHARS`` code points count, told apart by 128-bit hashes.

``build_line_index``: every chunk of documents sends its distinct hashes with the smallest and largest
document id holding them (a line found in a third of all documents is one entry of each
chunk).  A shard builds a minimal perfect hash of its distinct hashes: levels of bit arrays,
each holding the keys that are alone at their place, and a key's slot is the rank of its bit.  Slots index a
64-bit fingerprint, a count (1: one document, 2: more) and, for counts of 2, the smallest document id.

``remove_repeated_lines``: documents are dealt over blocks by hash and packed; a block sends its distinct
hashes to the shards, these probe the arrays and answer with the smallest ids of the
repeated ones, and the block drops the lines that a smaller document holds.  No line's text is sent or joined.

Rows: null or empty texts are one empty line; repeated rows of one id are one
document, each keeping the lines that its id owns; rows without an id keep all lines and count nowhere;
rows with equal id and text travel once with their number; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arlark.llm.common import byte_length, staged

KEY_CHARS = 10
#: Characters taken off both ends of a line.
EDGES = b" \t\n\x0b\x0c\r"
#: Lines of one shard, text of one block and of one task, text and hashes held before a flush.
LINES_PER_SHARD, BLOCK_BYTES, TASK_BYTES, HELD_BYTES, HELD_KEYS = 500_000, 8 << 20, 64 << 20, 32 << 20, 400_000
#: Places for each key of a level.
GAMMA = 2.0


def line_key(line: bytes, key_chars: int = KEY_CHARS) -> bytes | None:
    """128-bit hash of the line's key; None if the key is too short."""
    key = line.strip(EDGES)
    if len(key) < key_chars or (len(key) < 4 * key_chars and len(key.decode("utf-8", "replace")) < key_chars):
        return None
    return xxhash.xxh3_128_digest(key.lower())


# ---- the perfect hash -------------------------------------------------------------------------------

def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """The place of each key (n x 2 halves) in a level of ``size`` places."""
    mixed = keys[:, 0] + keys[:, 1] * np.uint64(2 * level + 1) + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    return mixed % np.uint64(size)


class PerfectHash:
    """Slots 0..n-1 for n distinct 128-bit keys; any other key gets some slot or -1."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.starts = np.cumsum(sizes) - sizes
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], keys
        while len(left):
            size = max(64, math.ceil(GAMMA * len(left) / 64) * 64)
            place = _places(left, len(sizes), size)
            alone = np.bincount(place.astype(np.int64), minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[place.astype(np.int64)]]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, "<u8"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out, at = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, start) in enumerate(zip(self.sizes.tolist(), self.starts.tolist())):
            if not len(at):
                break
            bit = _places(keys[at], level, size).astype(np.int64) + start
            word, shift = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            found = (word >> shift) & np.uint64(1) == 1
            below = word[found] & ((np.uint64(1) << shift[found]) - np.uint64(1))
            out[at[found]] = self.before[bit[found] >> 6] + np.bitwise_count(below)
            at = at[~found]
        return out


class ShardIndex:
    """Fingerprint and count arrays of one shard behind its perfect hash; ``owners`` holds ids where the count is 2."""

    def __init__(self, sizes: bytes, bits: bytes, fingerprints: bytes, counts: bytes, owners: bytes):
        self.hash = PerfectHash(np.frombuffer(sizes, "<i8"), np.frombuffer(bits, "<u8"))
        self.fingerprints, self.counts = np.frombuffer(fingerprints, "<u8"), np.frombuffer(counts, np.uint8)
        self.owners = np.frombuffer(owners, "<i8")
        self.owner_at = np.cumsum(self.counts == 2) - 1

    def repeated(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the keys that several documents hold, smallest document id of each)."""
        slots = self.hash.slots(keys)
        at = np.flatnonzero(slots >= 0)
        at = at[self.fingerprints[slots[at]] == keys[at, 1]]
        at = at[self.counts[slots[at]] == 2]
        return at, self.owners[self.owner_at[slots[at]]]


def _halves(hashes: bytes) -> np.ndarray:
    return np.frombuffer(hashes, "<u8").reshape(-1, 2)


def merge_entries(keys: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with the smallest and largest id of each."""
    if not len(keys):
        return keys, least, most
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    keys, least, most = keys[order], least[order], most[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    return keys[at], np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)


# ---- building ---------------------------------------------------------------------------------------

ENTRY_ROWS = pa.schema([("shard", pa.int64()), ("hashes", pa.binary()), ("least", pa.binary()), ("most", pa.binary())])
ENTRY_DDL = "shard long, hashes binary, least binary, most binary"
INDEX_DDL = "shard long, n_keys long, sizes binary, bits binary, fingerprints binary, counts binary, owners binary"
INDEX_ROWS = pa.schema([("shard", pa.int64()), ("n_keys", pa.int64()), *[
    (name, pa.binary()) for name in ("sizes", "bits", "fingerprints", "counts", "owners")]])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _shards(keys: np.ndarray, shards: int):
    """(shard, positions) of the keys."""
    shard = (keys[:, 1] % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(shard[part[0]]), part


def _send_entries(batches, shards: int, key_chars: int):
    found: dict[bytes, list[int]] = {}

    def flush():
        keys = _halves(b"".join(found))
        ids = np.array(list(found.values()), np.int64).reshape(-1, 2)
        found.clear()
        return [(shard, keys[at].tobytes(), ids[at, 0].tobytes(), ids[at, 1].tobytes()) for shard, at in _shards(keys, shards)]

    for batch in batches:
        rows = []
        for doc, text in zip(batch.column("doc").to_pylist(), (v.as_py() for v in batch.column("text"))):
            for line in text.split(b"\n"):
                key = line_key(line, key_chars)
                if key is None:
                    continue
                ids = found.get(key)
                if ids is None:
                    found[key] = [doc, doc]
                elif doc < ids[0]:
                    ids[0] = doc
                elif doc > ids[1]:
                    ids[1] = doc
                if len(found) >= HELD_KEYS:
                    rows.extend(flush())
        yield _batch(rows, ENTRY_ROWS)
    yield _batch(flush(), ENTRY_ROWS)


def _build_shards(batches):
    """One index row for each shard; rows arrive sorted by shard, one shard is held at a time."""
    shard, held = None, []

    def finish():
        keys, least, most = (np.concatenate(x) for x in zip(*held))
        keys, least, most = merge_entries(keys, least, most)
        index, several = PerfectHash.build(keys), least != most
        slots = index.slots(keys)
        order = np.argsort(slots)
        several = several[order]
        return _batch([(shard, len(keys), index.sizes.astype("<i8").tobytes(), index.words.tobytes(),
                        keys[order, 1].astype("<u8").tobytes(), (several + np.uint8(1)).astype(np.uint8).tobytes(),
                        least[order][several].astype("<i8").tobytes())], INDEX_ROWS)

    for batch in batches:
        columns = [batch.column("shard").to_pylist(), *[batch.column(c).to_pylist() for c in ("hashes", "least", "most")]]
        for s, hashes, least, most in zip(*columns):
            if s != shard and held:
                yield finish()
                held = []
            shard = s
            held.append((_halves(hashes), np.frombuffer(least, "<i8"), np.frombuffer(most, "<i8")))
    if held:
        yield finish()


def _width(docs: DataFrame, tasks: int) -> int:
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), tasks)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc"), text.cast("binary").alias("text"))


def build_line_index(docs: DataFrame, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text",
                     key_chars: int = KEY_CHARS) -> DataFrame:
    """The index as a table on shared storage, one row for each shard: (shard, n_keys, sizes, bits, fingerprints, counts, owners).

    ``shards`` is read from the number of lines if it is not given; probing needs the same number.
    """
    shards = shards or shard_count(docs, text_col)
    entries = _source(docs, id_col, text_col).where("doc is not null").mapInArrow(
        lambda b: _send_entries(b, shards, key_chars), ENTRY_DDL)
    width = _width(docs, math.ceil(shards / 4))
    built = entries.repartition(width, "shard").sortWithinPartitions("shard").mapInArrow(_build_shards, INDEX_DDL)
    return staged(built, "line-index")


def shard_count(docs: DataFrame, text_col: str = "text") -> int:
    """Shards so that each holds about ``LINES_PER_SHARD`` lines."""
    lines = docs.agg(F.sum(F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).cast("long"))).first()[0] or 0
    return max(1, math.ceil(lines / LINES_PER_SHARD))


# ---- probing ----------------------------------------------------------------------------------------

def _pack(rows: dict[tuple, int]) -> bytes:
    """(id, text) -> number of rows, as one compressed value."""
    ids = np.array([0 if doc is None else doc for doc, _ in rows], "<i8")
    known = np.array([doc is not None for doc, _ in rows], np.uint8)
    sizes, copies = np.array([len(t) for _, t in rows], "<i8"), np.array(list(rows.values()), "<i8")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(
        [struct.pack("<q", len(rows)), ids.tobytes(), copies.tobytes(), sizes.tobytes(), known.tobytes(), *[t for _, t in rows]]))


def _unpack(payload: bytes):
    """Yields (id, copies, text)."""
    data = zstandard.ZstdDecompressor().decompress(payload)
    n = struct.unpack_from("<q", data)[0]
    ids, copies, sizes = (np.frombuffer(data, "<i8", n, 8 + 8 * n * k).tolist() for k in range(3))
    at = 8 + 24 * n
    known = data[at:at + n]
    at += n
    for doc, number, size, has_id in zip(ids, copies, sizes, known):
        yield doc if has_id else None, number, data[at:at + size]
        at += size


BLOCK_ROWS = pa.schema([("block", pa.int64()), ("payload", pa.large_binary())])


def _pack_blocks(batches):
    blocks: dict[int, dict[tuple, int]] = {}
    held = 0

    def flush():
        rows = [(block, _pack(rows)) for block, rows in blocks.items()]
        blocks.clear()
        return _batch(rows, BLOCK_ROWS)

    for batch in batches:
        for block, doc, text in zip(batch.column("block").to_pylist(), batch.column("doc").to_pylist(),
                                    (v.as_py() for v in batch.column("text"))):
            rows = blocks.setdefault(block, {})
            seen = rows.get((doc, text))
            if seen is None:
                held += len(text) + 64
            rows[doc, text] = 1 if seen is None else seen + 1
            if held >= HELD_BYTES:
                yield flush()
                held = 0
    yield flush()


PROBE_ROWS = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary())])


def _send_probes(batches, shards: int, key_chars: int):
    """Each block's distinct hashes, packed by shard."""
    block, found = None, set()

    def finish():
        keys = _halves(b"".join(found))
        return _batch([(shard, block, keys[at].tobytes()) for shard, at in _shards(keys, shards)], PROBE_ROWS)

    for batch in batches:
        for b, payload in zip(batch.column("block").to_pylist(), (v.as_py() for v in batch.column("payload"))):
            if b != block:
                if found:
                    yield finish()
                block, found = b, set()
            for doc, _, text in _unpack(payload):
                if doc is not None:
                    found.update(line_key(line, key_chars) for line in text.split(b"\n"))
                    found.discard(None)
    if found:
        yield finish()


ANSWER_ROWS = pa.schema([("block", pa.int64()), ("hashes", pa.binary()), ("owners", pa.binary())])
ARRAYS = ("sizes", "bits", "fingerprints", "counts", "owners")


def _answer(batches):
    """Probes against the shard's arrays; the index row of a shard comes before its probes."""
    shard, index = None, None
    for batch in batches:
        rows = []
        for k, (s, block) in enumerate(zip(batch.column("shard").to_pylist(), batch.column("block").to_pylist())):
            if block is None:
                shard, index = s, ShardIndex(*(batch.column(c)[k].as_py() for c in ARRAYS))
            elif s == shard:
                keys = _halves(batch.column("hashes")[k].as_py())
                at, owners = index.repeated(keys)
                if len(at):
                    rows.append((block, keys[at].tobytes(), owners.astype("<i8").tobytes()))
        yield _batch(rows, ANSWER_ROWS)


def _drop_lines(batches, schema: pa.Schema, key_chars: int):
    """The final rows; a block's answers come before its documents."""
    block, owners = None, {}
    for batch in batches:
        rows, held = [], 0
        small = [batch.column(c).to_pylist() for c in ("block", "kind")]
        for k, (b, kind) in enumerate(zip(*small)):
            if b != block:
                block, owners = b, {}
            if kind == 0:
                hashes, ids = batch.column("hashes")[k].as_py(), np.frombuffer(batch.column("owners")[k].as_py(), "<i8")
                owners.update((hashes[16 * i:16 * i + 16], doc) for i, doc in enumerate(ids.tolist()))
                continue
            for doc, copies, text in _unpack(batch.column("payload")[k].as_py()):
                lines = text.split(b"\n")
                kept = lines
                if doc is not None and owners:
                    kept = [line for line in lines if owners.get(line_key(line, key_chars), doc) == doc]
                body = text if len(kept) == len(lines) else b"\n".join(kept)
                rows.extend([(doc, len(lines), len(lines) - len(kept), body)] * copies if copies < 64 else [])
                if copies >= 64:        # many equal rows: in batches of their own
                    for at in range(0, copies, 4096):
                        yield _batch([(doc, len(lines), len(lines) - len(kept), body)] * min(4096, copies - at), schema)
                held += len(body) * min(copies, 64)
                if held >= HELD_BYTES:
                    yield _batch(rows, schema)
                    rows, held = [], 0
        yield _batch(rows, schema)


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_chars: int = KEY_CHARS,
                          index: DataFrame | None = None, shards: int | None = None) -> DataFrame:
    """(id, n_lines, n_dropped, kept) of every row of ``docs``: ``kept`` (binary, UTF-8) is the text without the lines
    whose key a document of smaller id holds too.

    ``index`` (with its number of ``shards``) is built from ``docs`` unless it is given; one built from
    another corpus drops the lines that several of its documents hold, but for the smallest of them.
    """
    shards = shards or shard_count(docs, text_col)
    if index is None:
        index = build_line_index(docs, shards, id_col, text_col, key_chars)
    source = _source(docs, id_col, text_col)
    total = source.agg(F.sum(byte_length(F.col("text")))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    width = _width(docs, math.ceil(total / TASK_BYTES))
    packed = source.select(F.pmod(F.xxhash64("doc", "text"), F.lit(blocks)).alias("block"), "doc", "text").mapInArrow(
        _pack_blocks, "block long, payload binary")
    probes = packed.repartition(width, "block").sortWithinPartitions("block").mapInArrow(
        lambda b: _send_probes(b, shards, key_chars), "shard long, block long, hashes binary")
    asked = index.select("shard", F.lit(None).cast("long").alias("block"), F.lit(None).cast("binary").alias("hashes"), *ARRAYS).unionByName(
        probes, allowMissingColumns=True)
    answers = asked.repartition(_width(docs, math.ceil(shards / 4)), "shard").sortWithinPartitions(
        "shard", F.col("block").asc_nulls_first()).mapInArrow(_answer, "block long, hashes binary, owners binary")
    rows = answers.withColumn("kind", F.lit(0)).unionByName(packed.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    schema = pa.schema([("doc", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.binary())])
    out = rows.repartition(width, "block").sortWithinPartitions("block", "kind").mapInArrow(
        lambda b: _drop_lines(b, schema, key_chars), "doc long, n_lines long, n_dropped long, kept binary")
    return out.withColumnRenamed("doc", id_col)


def oracle_sql() -> str:
    """DuckDB text of the registered query."""
    edges = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, {edges}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= {KEY_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND r.owner <> k.doc_id AS gone FROM keyed k LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""
