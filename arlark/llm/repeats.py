"""Repeated passages by a join of minimizer runs, with radix passes where runs differ.

A byte is removed if it lies in a ``threshold``-byte string that also starts in a document of
smaller id.  Windows need telling apart only through their ``threshold`` bytes.  The dealt method,
a depth-limited radix order of all suffixes, would send ``threshold`` bytes for each byte of text, so it decides
only what hashing and equality of whole strings leave open:

1. Whole copies of a text are found by its SHA-256 and neither send nor ask.
2. The first digit of a window is its minimizer, the smallest hashed gram of ``GRAM`` bytes in it.  It is
   a function of the window alone, so equal windows share it, and runs
   of windows share one occurrence ("anchor"), about one for 16 bytes of text; a
   run is sent as one string instead of one for each window.  Pass one counts anchor
   hashes: anchors found in one document only are finished, which is nearly all of them.
3. Runs of the other anchors are sent with their smallest document.  Equal runs collapse as equal strings.  Where one
   anchor has several different runs, their windows are ordered by most-significant-digit passes of 8 bytes,
   group by group, to the full depth (``equal_windows``); a group of one is dropped as soon as a pass shows it.
4. Every run gets back the smallest id of each of its windows.  Replies name a run by a 96-bit hash within
   its block (about 10^5 runs: two share one with a chance of 10^-19); documents mark the covered bytes.

Documents are processed in blocks of about ``BLOCK_BYTES`` (id ranges cut by hash).  What a block sends is combined
first: an anchor, or a run, goes out once for a block however many of its documents hold it.  Anchors
found in more than ``HOT_SOURCES`` blocks send single windows, dealt by their own bytes,
so a passage that a third of all documents share is spread over all tasks.

Rows: a null text is empty; texts shorter than the threshold lose nothing; rows with equal ids do
not remove each other, and each is a whole copy or not by its own text; a null id neither removes nor loses anything; other columns may be carried along.
"""

from __future__ import annotations

import hashlib
import math
import struct

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arlark.llm.common import byte_length, staged

THRESHOLD = 50
#: Bytes of the grams that minimizers are chosen from.
GRAM = 20
#: Text of one block, and of one numpy buffer.
BLOCK_BYTES, BUFFER_BYTES = 8 << 20, 1 << 19
#: Anchors that one task counts together, and anchors held before a flush.
ANCHORS_PER_BUCKET, HELD_ANCHORS = 500_000, 1_500_000
#: Blocks from which an anchor is hot.
HOT_SOURCES = 128
#: Text of one block that is packed together, and text held while packing.
PACK_BYTES, HELD_BYTES = 1 << 20, 32 << 20
#: Windows ordered at once (a single group may be larger).
WINDOWS_AT_ONCE = 150_000
#: Text of one task of a block stream, and buckets of one task (the session's number of partitions is the least).
STREAM_BYTES, BUCKETS_PER_TASK = 64 << 20, 4
#: Most id ranges that blocks are cut from.
MOST_RANGES = 4096

_TABLE = np.random.Generator(np.random.PCG64(7_919)).integers(0, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_PLACE = (1 << 24) - 1


def _power(k: int) -> np.uint64:
    return np.uint64(pow(_BASE, k, 1 << 64))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed 64-bit polynomial hashes of every gram, by doubling lengths."""
    total, size, done = None, 1, 0
    current = _TABLE[data]
    while True:
        if gram & size:
            # the bits of ``gram`` from small to large: hash(xy) = hash(x) * base^|y| + hash(y)
            if total is None:
                total, done = current, size
            else:
                n = len(data) - (done + size) + 1
                total = total[:n] * _power(size) + current[done:done + n]
                done += size
        if done == gram:
            break
        current = current[:-size] * _power(size) + current[size:]
        size *= 2
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xD6E8FEB86659FD93)
    total ^= total >> np.uint64(32)
    return total


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return values if size == width else np.minimum(values[:size - width], values[width - size:])


def runs(data: bytes, ends: list[int], threshold: int, gram: int):
    """(start, windows, anchor place, anchor hash) of the runs of windows with one anchor.

    ``data`` holds several texts back to back, ``ends`` their ends; no window crosses an end.
    """
    if len(data) < threshold:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    hashes = gram_hashes(np.frombuffer(data, np.uint8), gram)
    packed = (hashes & np.uint64(~_PLACE & (1 << 64) - 1)) | np.arange(len(hashes), dtype=np.uint64)
    places = (_sliding_min(packed, threshold - gram + 1) & np.uint64(_PLACE)).astype(np.int64)
    valid = np.ones(len(places), bool)
    for end in ends:
        valid[max(0, end - threshold + 1):end] = False
    new = np.ones(len(places), bool)
    new[1:] = (places[1:] != places[:-1]) | (valid[1:] != valid[:-1])
    starts = np.flatnonzero(new)
    windows = np.diff(np.append(starts, len(places)))
    inside = valid[starts]
    starts, windows = starts[inside], windows[inside]
    anchor = places[starts]
    return starts, windows, anchor, hashes[anchor]


class Buffers:
    """Packs texts into buffers; a text longer than a buffer is cut with an overlap of ``threshold - 1`` bytes."""

    def __init__(self, threshold: int):
        self.threshold = threshold
        self.parts: list[tuple[int, int, bytes]] = []
        self.held = 0

    def add(self, owner: int, text: bytes):
        """Queues a text; yields full buffers."""
        if len(text) < self.threshold:
            return
        step = BUFFER_BYTES - self.threshold + 1
        for at in range(0, max(1, len(text) - self.threshold + 1), step):
            part = text[at:at + BUFFER_BYTES]
            self.parts.append((owner, at, part))
            self.held += len(part)
            if self.held >= BUFFER_BYTES:
                yield self.take()

    def take(self):
        """(data, ends, owners, offsets of the parts in their texts, starts of the parts in the buffer)."""
        parts, self.parts, self.held = self.parts, [], 0
        sizes = np.array([len(p[2]) for p in parts], np.int64)
        ends = np.cumsum(sizes)
        return (b"".join(p[2] for p in parts), ends.tolist(), np.array([p[0] for p in parts], np.int64),
                np.array([p[1] for p in parts], np.int64), ends - sizes)

    def rest(self):
        if self.parts:
            yield self.take()


def _bucket_keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """bucket << 32 | low 32 bits: the bucket is taken from the high bits."""
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | (hashes & np.uint64(0xFFFFFFFF))


def _split(keys: np.ndarray):
    """(bucket, slice) of sorted bucket keys."""
    if not len(keys):
        return
    high = (keys >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(high)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
        yield int(high[a]), slice(a, b)


# ---- pass one: anchors found in more than one document ------------------------------------------

def _send_anchors(batches, buckets: int, threshold: int, gram: int):
    """(bucket, block, hashes, several): distinct anchors of a block; ``several``: found in two of its documents."""
    buffers, keys, owners, blocks, held = Buffers(threshold), [], [], {}, 0

    def note(buffer):
        data, ends, docs, _, begins = buffer
        starts, _, _, hashes = runs(data, ends, threshold, gram)
        keys.append(_bucket_keys(hashes, buckets))
        owners.append(docs[np.searchsorted(begins, starts, side="right") - 1])
        return len(starts)

    def flush():
        key, owner = np.concatenate(keys), np.concatenate(owners)
        block_of = np.array([blocks[o] for o in range(len(blocks))], np.int64)[owner]
        for block in np.unique(block_of).tolist():
            mine = block_of == block
            order = np.lexsort((owner[mine], key[mine]))
            k, o = key[mine][order], owner[mine][order]
            first = np.ones(len(k), bool)
            first[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
            unique, documents = np.unique(k[first], return_counts=True)
            for bucket, part in _split(unique):
                yield bucket, block, unique[part].astype("<u4").tobytes(), np.packbits(documents[part] > 1).tobytes()

    for batch in batches:
        rows = []
        for block, text in zip(batch.column("block").to_pylist(), batch.column("text").to_pylist()):
            owner = len(blocks)
            blocks[owner] = block
            for buffer in buffers.add(owner, text.encode()):
                held += note(buffer)
        if held >= HELD_ANCHORS:
            for buffer in buffers.rest():
                note(buffer)
            rows.extend(flush())
            keys.clear(), owners.clear(), blocks.clear()
            held = 0
        yield _rows(rows, ANCHOR_ROWS)
    for buffer in buffers.rest():
        held += note(buffer)
    if held:
        yield _rows(list(flush()), ANCHOR_ROWS)


ANCHOR_ROWS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary()), ("several", pa.binary())])
REPLY_ROWS = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("hashes", pa.binary()), ("hot", pa.binary())])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _by_key(batches, columns: list[str]):
    """(key, rows) of batches sorted by their first column; a key's rows are held together."""
    key, held = None, []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in columns]):
            if row[0] != key and held:
                yield key, held
                held = []
            key = row[0]
            held.append(row)
    if held:
        yield key, held


def _count_anchors(batches):
    """For each source row the anchors that other documents hold too, with those that are hot."""
    for bucket, rows in _by_key(batches, ["bucket", "block", "hashes", "several"]):
        hashes = [np.frombuffer(r[2], "<u4") for r in rows]
        several = [np.unpackbits(np.frombuffer(r[3], np.uint8), count=len(h)).astype(bool) for r, h in zip(rows, hashes)]
        unique, sources = np.unique(np.concatenate(hashes), return_counts=True)
        shared = sources > 1
        for h, s in zip(hashes, several):
            shared[np.searchsorted(unique, h[s])] = True
        hot = sources > HOT_SOURCES
        out = []
        for (_, block, _, _), h in zip(rows, hashes):
            at = np.searchsorted(unique, h)
            take = shared[at]
            if take.any():
                out.append((block, bucket, h[take].tobytes(), np.packbits(hot[at[take]]).tobytes()))
        yield _rows(out, REPLY_ROWS)


# ---- passes two and three: a block's stream is its replies, its copies, then its documents ------

def _pack_documents(batches, schema: pa.Schema | None = None):
    """(block, payload): the documents of a block as compressed Arrow streams of about ``PACK_BYTES`` of text."""
    held: dict[int, list[pa.RecordBatch]] = {}
    sizes: dict[int, int] = {}

    def packed(block: int):
        table = pa.Table.from_batches(held.pop(block)).combine_chunks()
        sizes.pop(block)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
            out.write_table(table)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                          names=["block", "payload"])

    for batch in batches:
        blocks = np.asarray(batch.column("block"))
        rest = batch.drop_columns(["block"])
        for block in np.unique(blocks).tolist():
            part = rest.take(pa.array(np.flatnonzero(blocks == block)))
            held.setdefault(block, []).append(part)
            sizes[block] = sizes.get(block, 0) + part.get_total_buffer_size()
            if sizes[block] >= PACK_BYTES:
                yield packed(block)
        if sum(sizes.values()) >= HELD_BYTES:
            for block in list(held):
                yield packed(block)
    for block in list(held):
        yield packed(block)


def _unpack_documents(payload: bytes):
    """The rows of a packed stream, column by column, and the type of the carried row if there is one."""
    table = pa.ipc.open_stream(payload).read_all()
    rows = table.column("row").to_pylist() if "row" in table.column_names else [None] * len(table)
    return list(zip(table.column("doc").to_pylist(), table.column("text").to_pylist(), rows)), table.schema


class BlockText:
    """Finds a block's shared runs; fed with candidate anchors, then documents."""

    def __init__(self, buckets: int, threshold: int, gram: int):
        self.buckets, self.threshold, self.gram = buckets, threshold, gram
        self.parts: list[np.ndarray] = []
        self.hot_parts: list[np.ndarray] = []
        self.keys = None

    def reply(self, bucket: int, hashes: bytes, hot: bytes) -> None:
        keys = np.frombuffer(hashes, "<u4").astype(np.uint64) | np.uint64(bucket << 32)
        self.parts.append(keys)
        self.hot_parts.append(np.unpackbits(np.frombuffer(hot, np.uint8), count=len(keys)).astype(bool))

    def shared_runs(self, buffer):
        """(owner, start in its text, windows, anchor offset, bucket, hot, string) of the runs with a shared anchor."""
        if self.keys is None:
            keys = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint64)
            hot = np.concatenate(self.hot_parts) if self.parts else np.zeros(0, bool)
            self.keys, first = np.unique(keys, return_index=True)
            self.hot = hot[first]
        data, ends, docs, offsets, begins = buffer
        starts, windows, anchors, hashes = runs(data, ends, self.threshold, self.gram)
        if not len(self.keys) or not len(starts):
            return
        keys = _bucket_keys(hashes, self.buckets)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        take = np.flatnonzero(self.keys[at] == keys)
        starts, windows, anchors, at = starts[take], windows[take], anchors[take], at[take]
        part = np.searchsorted(begins, starts, side="right") - 1
        stops = starts + windows - 1 + self.threshold
        yield from zip(docs[part].tolist(), (starts - begins[part] + offsets[part]).tolist(), windows.tolist(),
                       (anchors - starts).tolist(), (self.keys[at] >> np.uint64(32)).astype(np.int64).tolist(),
                       self.hot[at].tolist(), [data[a:b] for a, b in zip(starts.tolist(), stops.tolist())])


def _window_bucket(window: bytes, buckets: int) -> int:
    return xxhash.xxh64_intdigest(window) % buckets


RUN_ROWS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("strings", pa.large_binary()), ("sizes", pa.binary()),
                      ("anchors", pa.binary()), ("ids", pa.binary())])


def _pack_runs(bucket: int, block: int, found: dict[bytes, tuple[int, int]]) -> tuple:
    strings = list(found)
    return (bucket, block, zstandard.ZstdCompressor(level=1).compress(b"".join(strings)), np.array([len(s) for s in strings], "<u2").tobytes(),
            np.array([found[s][0] for s in strings], "<u2").tobytes(), np.array([found[s][1] for s in strings], "<i8").tobytes())


def _is_copy(copies: dict[int, set[bytes]], doc: int | None, data: bytes) -> bool:
    """Whether this text of the document is a whole copy: an id may have other texts too."""
    return doc in copies and hashlib.sha256(data).digest() in copies[doc]


def _send_runs(batches, buckets: int, threshold: int, gram: int):
    """Distinct shared runs of each block with their smallest id, packed by bucket."""
    block, text, buffers, copies, ids, found = None, None, None, {}, [], {}

    def note(buffer):
        for owner, _, windows, anchor, bucket, hot, string in text.shared_runs(buffer):
            doc = ids[owner]
            if not hot:
                kept = found.setdefault(bucket, {})
                old = kept.get(string)
                if old is None or doc < old[1]:
                    kept[string] = (anchor, doc)
                continue
            for w in range(windows):
                window = string[w:w + threshold]
                kept = found.setdefault(_window_bucket(window, buckets), {})
                old = kept.get(window)
                if old is None or doc < old[1]:
                    kept[window] = (anchor - w, doc)

    def finish():
        for buffer in buffers.rest():
            note(buffer)
        for bucket, kept in found.items():
            yield _rows([_pack_runs(bucket, block, kept)], RUN_ROWS)

    for batch in batches:
        for b, kind, doc, bucket, payload, more in _stream_rows(batch):
            if b != block:
                if block is not None:
                    yield from finish()
                block, text, buffers, copies, ids, found = b, BlockText(buckets, threshold, gram), Buffers(threshold), {}, [], {}
            if kind == 0:
                text.reply(bucket, payload, more)
            elif kind == 1:
                copies.setdefault(doc, set()).add(more)
            else:
                for doc, body, _ in _unpack_documents(payload)[0]:
                    data = body.encode()
                    if doc is not None and not _is_copy(copies, doc, data):
                        ids.append(doc)
                        for buffer in buffers.add(len(ids) - 1, data):
                            note(buffer)
    if block is not None:
        yield from finish()


def equal_windows(groups: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Group numbers of equal rows of ``windows`` (n x depth bytes) within ``groups``; -1 where a row is alone.

    Most-significant-digit passes of 8 bytes: each pass orders the rows of the groups that are still
    open by their next digit and drops the rows that turn out to be alone.
    """
    n, depth = windows.shape
    padded = np.zeros((n, -(-depth // 8) * 8), np.uint8)
    padded[:, :depth] = windows
    digits = padded.view(">u8")
    active, group = np.arange(n), groups.astype(np.int64)
    for k in range(digits.shape[1]):
        if not len(active):
            break
        digit = digits[active, k].astype(np.uint64)
        order = np.lexsort((digit, group))
        active, group, digit = active[order], group[order], digit[order]
        new = np.ones(len(active), bool)
        new[1:] = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
        group = np.cumsum(new) - 1
        open_rows = np.bincount(group)[group] > 1
        active, group = active[open_rows], group[open_rows]
    out = np.full(n, -1, np.int64)
    out[active] = group
    return out


def _smallest_ids(strings: list[bytes], anchors: list[int], ids: list[int], threshold: int, gram: int) -> list[np.ndarray]:
    """For every distinct run the smallest id of each of its windows."""
    out = [np.full(len(s) - threshold + 1, i, np.int64) for s, i in zip(strings, ids)]
    by_gram: dict[bytes, list[int]] = {}
    for k, (s, a) in enumerate(zip(strings, anchors)):
        by_gram.setdefault(s[a:a + gram], []).append(k)

    def order(chunk: list[list[int]]) -> None:
        picked = [k for group in chunk for k in group]
        lengths = np.array([len(strings[k]) for k in picked])
        counts = lengths - threshold + 1
        data = np.frombuffer(b"".join(strings[k] for k in picked), np.uint8)
        base = np.repeat(np.cumsum(lengths) - lengths, counts)
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        # equal windows have their anchor at the same place
        place = np.repeat(np.array([anchors[k] for k in picked]), counts) - inner
        group = np.repeat(np.repeat(np.arange(len(chunk)), [len(g) for g in chunk]), counts) * threshold + place
        windows = np.lib.stride_tricks.sliding_window_view(data, threshold)[base + inner]
        equal = equal_windows(group, windows)
        values = np.concatenate([out[k] for k in picked])
        together = equal >= 0
        if together.any():
            least = np.full(equal.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, equal[together], values[together])
            values[together] = least[equal[together]]
        for k, part in zip(picked, np.split(values, np.cumsum(counts)[:-1])):
            out[k] = part

    chunk, size = [], 0
    for group in by_gram.values():
        if len(group) > 1:
            chunk.append(group)
            size += sum(len(out[k]) for k in group)
            if size >= WINDOWS_AT_ONCE:
                order(chunk)
                chunk, size = [], 0
    if chunk:
        order(chunk)
    return out


#: Bytes of a run's digest in a reply; it tells the runs of one block apart.
DIGEST = 12


def _digest(string: bytes) -> bytes:
    return xxhash.xxh3_128_digest(string)[:DIGEST]


ID_ROWS = pa.schema([("block", pa.int64()), ("payload", pa.large_binary()), ("more", pa.large_binary())])


def _order_runs(batches, threshold: int, gram: int):
    """For each block and run the smallest ids of its windows.

    A reply holds the runs' digests, and for each run the number of its
    (window count, id) stretches of equal ids, then these.
    """
    for _, rows in _by_key(batches, ["bucket", "block", "strings", "sizes", "anchors", "ids"]):
        index: dict[bytes, int] = {}
        anchors, ids, sent = [], [], []
        for _, block, strings, sizes, places, docs in rows:
            strings = zstandard.ZstdDecompressor().decompress(strings)
            at, mine = 0, []
            for size, place, doc in zip(np.frombuffer(sizes, "<u2").tolist(), np.frombuffer(places, "<u2").tolist(),
                                        np.frombuffer(docs, "<i8").tolist()):
                string = strings[at:at + size]
                at += size
                k = index.setdefault(string, len(ids))
                if k == len(ids):
                    anchors.append(place)
                    ids.append(doc)
                elif doc < ids[k]:
                    ids[k] = doc
                mine.append(k)
            sent.append((block, mine))
        strings = list(index)
        smallest = _smallest_ids(strings, anchors, ids, threshold, gram)
        stretches = []
        for values in smallest:
            cuts = np.flatnonzero(np.diff(values)) + 1
            begins = np.concatenate([[0], cuts])
            stretches.append(struct.pack(f"<B{'Bq' * len(begins)}", len(begins), *[
                x for a, b in zip(begins.tolist(), [*cuts.tolist(), len(values)]) for x in (b - a, int(values[a]))]))
        digests = [_digest(s) for s in strings]
        for block, mine in sent:
            yield _rows([(block, b"".join(digests[k] for k in mine), b"".join(stretches[k] for k in mine))], ID_ROWS)


STREAM = ["block", "kind", "doc", "bucket", "payload", "more"]


def _stream_rows(batch: pa.RecordBatch):
    """The rows of a block stream; payloads are taken out of the batch one at a time."""
    small = [batch.column(c).to_pylist() for c in STREAM[:4]]
    return zip(*small, *((v.as_py() for v in batch.column(c)) for c in STREAM[4:]))


class Marks:
    """Covered windows of a block's documents, from the replies of pass two."""

    def __init__(self):
        self.ids: dict[bytes, object] = {}

    def reply(self, digests: bytes, stretches: bytes) -> None:
        at = 0
        for k in range(0, len(digests), DIGEST):
            n = stretches[at]
            if n == 1:
                value: object = struct.unpack_from("<q", stretches, at + 2)[0]
            else:
                flat = struct.unpack_from("<" + "Bq" * n, stretches, at + 1)
                value = list(zip(flat[::2], flat[1::2]))
            self.ids[digests[k:k + DIGEST]] = value
            at += 1 + 9 * n

    def spans(self, doc: int, start: int, windows: int, hot: bool, string: bytes, threshold: int, out: list) -> None:
        """Appends the covered [start, stop) stretches of one run of document ``doc``."""
        if hot:
            for w in range(windows):
                if self.ids[_digest(string[w:w + threshold])] < doc:
                    out.append((start + w, start + w + threshold))
            return
        value = self.ids[_digest(string)]
        if isinstance(value, int):
            if value < doc:
                out.append((start, start + windows - 1 + threshold))
            return
        for count, least in value:
            if least < doc:
                out.append((start, start + count - 1 + threshold))
            start += count


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(s) for s in out]


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    if not spans:
        return text
    out, at = [], 0
    for start, stop in spans:
        out.append(text[at:start])
        at = stop
    out.append(text[at:])
    return b"".join(out)


def _mark(batches, buckets: int, threshold: int, gram: int, schema: pa.Schema, carry: bool, with_text: bool):
    """Final rows of every document of the blocks."""
    block, text, marks, buffers, copies, docs = None, None, None, None, {}, []

    def note(buffer):
        for owner, start, windows, _, _, hot, string in text.shared_runs(buffer):
            marks.spans(docs[owner][0], start, windows, hot, string, threshold, docs[owner][2])

    def results():
        for buffer in buffers.rest():
            note(buffer)
        rows = []
        for doc, body, spans, row in docs:
            spans = merge_spans(spans)
            kept = _kept(body, spans)
            rows.append([doc, len(body), len(body) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                         *([kept.decode("utf-8", "ignore")] if with_text else []), *([row] if carry else [])])
        docs.clear()
        return _rows(rows, schema)

    held, fields = 0, len(schema)
    for batch in batches:
        for b, kind, doc, bucket, payload, more in _stream_rows(batch):
            if b != block:
                if block is not None:
                    yield results()
                block, text, marks = b, BlockText(buckets, threshold, gram), Marks()
                buffers, copies, held = Buffers(threshold), {}, 0
            if kind == 0 and bucket is not None:
                text.reply(bucket, payload, more)
            elif kind == 0:
                marks.reply(payload, more)
            elif kind == 1:
                copies.setdefault(doc, set()).add(more)
            else:
                rows, packed = _unpack_documents(payload)
                if carry and len(schema) == fields:
                    schema = schema.append(packed.field("row"))
                for doc, body, row in rows:
                    data = body.encode()
                    spans: list = []
                    docs.append((doc, data, spans, row))
                    held += len(data)
                    if _is_copy(copies, doc, data):
                        spans.append((0, len(data)))
                    elif doc is not None:
                        for buffer in buffers.add(len(docs) - 1, data):
                            note(buffer)
                    if held >= 4 * BUFFER_BYTES:
                        yield results()
                        held = 0
    if block is not None:
        yield results()


def _blocks(ids: DataFrame, total_bytes: int) -> Column:
    """Block number of a document: equal-frequency id ranges (their borders are few), each cut by hash.

    Documents without an id are dealt by their text; they need nothing from their block.
    """
    wanted = max(1, math.ceil(total_bytes / BLOCK_BYTES))
    ranges = min(wanted, MOST_RANGES)
    cuts = math.ceil(wanted / ranges)
    borders = []
    if ranges > 1:
        borders = sorted({b for b in ids.agg(F.percentile_approx(
            "doc", [k / ranges for k in range(1, ranges)], 10 * MOST_RANGES)).first()[0] or []})
    table = F.array(*[F.lit(b).cast("long") for b in borders]) if borders else None
    part = F.size(F.filter(table, lambda b: b <= F.col("doc"))) if borders else F.lit(0)
    if len(borders) > 64:
        part = _bisect(borders, 0, len(borders))
    numbered = part * cuts + F.pmod(F.xxhash64("doc"), F.lit(cuts))
    return F.when(F.col("doc").isNotNull(), numbered).otherwise(F.pmod(F.xxhash64("text"), F.lit(ranges * cuts))).cast("long")


def _bisect(borders: list[int], low: int, high: int) -> Column:
    """Borders not above ``doc``, as a balanced tree of comparisons."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(F.col("doc") >= borders[middle], _bisect(borders, middle + 1, high)).otherwise(_bisect(borders, low, middle))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD,
                   gram: int = GRAM, with_text: bool = False, carry: list[str] = ()) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256 [, kept_text] [, row]) for every row of ``docs``.

    ``with_text`` adds what is left as text (a character cut by a removed stretch is dropped);
    ``carry`` packs input columns into a struct ``row`` that travels along.
    """
    if not 8 <= gram < threshold <= 250:
        raise ValueError("8 <= gram < threshold <= 250 is needed")
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc"), text.alias("text"),
                         *([F.struct(*[F.col(f"`{c}`").alias(c) for c in carry]).alias("row")] if carry else []))
    narrow = staged(source.select("doc", byte_length(F.col("text")).alias("size"), F.unhex(F.sha2("text", 256)).alias("digest")),
                    "text-digests")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    block = _blocks(narrow, total)
    buckets = max(1, math.ceil(total * 2 / (threshold - gram + 2) / ANCHORS_PER_BUCKET))
    bucket_tasks, stream_tasks = max(width, math.ceil(buckets / BUCKETS_PER_TASK)), max(width, math.ceil(total / STREAM_BYTES))

    # whole copies: every byte of theirs is repeated, so they neither send nor ask
    firsts = narrow.where((F.col("size") >= threshold) & F.col("doc").isNotNull()).groupBy("digest").agg(
        F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = narrow.join(firsts, "digest").where("doc > first").withColumn("text", F.lit("")).select(
        block.alias("block"), "doc", "digest").distinct()

    anchors = source.where(F.col("doc").isNotNull()).select(block.alias("block"), "text").mapInArrow(
        lambda b: _send_anchors(b, buckets, threshold, gram), "bucket long, block long, hashes binary, several binary")
    shared = anchors.repartition(bucket_tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(
        _count_anchors, "block long, bucket long, hashes binary, hot binary")
    shared = staged(shared, "shared-anchors")

    def stream(*parts: DataFrame, rows: bool = False) -> DataFrame:
        documents = source.select(block.alias("block"), "doc", "text", *(["row"] if rows else []))
        out = documents.mapInArrow(_pack_documents, "block long, payload binary").withColumn("kind", F.lit(2))
        for part in parts:
            out = out.unionByName(part, allowMissingColumns=True)
        for name, kind in (("bucket", "long"), ("more", "binary")):
            if name not in out.columns:
                out = out.withColumn(name, F.lit(None).cast(kind))
        return out.select(*STREAM).repartition(stream_tasks, "block").sortWithinPartitions("block", "kind")

    replies = shared.select("block", F.lit(0).alias("kind"), "bucket", F.col("hashes").alias("payload"), F.col("hot").alias("more"))
    twins = copies.select("block", F.lit(1).alias("kind"), "doc", F.col("digest").alias("more"))
    sent = stream(replies, twins).mapInArrow(
        lambda b: _send_runs(b, buckets, threshold, gram),
        "bucket long, block long, strings binary, sizes binary, anchors binary, ids binary")
    ordered = sent.repartition(bucket_tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(
        lambda b: _order_runs(b, threshold, gram), "block long, payload binary, more binary")

    answers = ordered.select("block", F.lit(0).alias("kind"), "payload", "more")
    names = [("doc", "long"), ("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"),
             *([("kept_text", "string")] if with_text else [])]
    schema = pa.schema([pa.field(n, pa.int64() if t == "long" else pa.string()) for n, t in names])
    fields = [T.StructField(n, T.LongType() if t == "long" else T.StringType()) for n, t in names]
    result = T.StructType([*fields, *([source.schema["row"]] if carry else [])])
    marked = stream(replies, twins, answers, rows=bool(carry)).mapInArrow(
        lambda b: _mark(b, buckets, threshold, gram, schema, bool(carry), with_text), result)
    return marked.withColumnRenamed("doc", id_col)


def trimmed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with their repeated passages cut out, and their own columns."""
    others = [c for c in docs.columns if c != text_col]
    out = remove_repeats(docs, id_col, text_col, with_text=True, carry=others, **options)
    return out.select(*[F.col("kept_text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
