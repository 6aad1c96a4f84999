"""Token-id files: independent zstandard frames, a trailing seek table and per-frame checksums.

File layout (all integers little-endian):

* data frames, each a complete zstandard frame of whole documents' ids back to back
  (unsigned 16-bit when the vocabulary allows, else 32-bit);
* one skippable frame (magic ``INDEX_MAGIC``) with the document index: a zstandard frame of
  three int64 arrays (doc ids, frame number, ids) after a 16-byte head (documents, id width);
* one skippable frame (magic ``SEEK_MAGIC``) with the seek table in the public seekable
  format: for each data frame compressed size, decompressed size and the low 32 bits of the XXH64 of
  the decompressed bytes; then the number of frames, a descriptor with the
  checksum bit, and ``SEEK_FOOTER``.

A reader opens the end of a file, reads the tables and then only the frames of
the documents it was asked for; every frame read is checked.

Writing: documents are range-partitioned by id and sorted inside the tasks, so
files in name order hold ascending ids.  A task writes under a name of its own
attempt and reports it; the manifest is a Parquet table that Spark commits, so
files of lost or repeated attempts are never read.

Rows: null and empty texts have only the end id; null ids sort first (kept as
missing in the index); equal ids are ordered by text hash; extra columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arlark.llm.common import SharedFiles, shared_uri, staged
from arlark.llm.vocabulary import PieceCache, broadcast_vocabulary, byte_alphabet, trim, worker_state

#: Fixed values of the zstandard seekable format.
SEEK_MAGIC, SEEK_FOOTER, CHECKSUM_BIT = 0x184D2A5E, 0x8F92EAB1, 0x80
INDEX_MAGIC = 0x184D2A50

#: Decompressed bytes after which a frame is closed (a document is never split over frames).
FRAME_BYTES = 1 << 18
MISSING = np.iinfo(np.int64).min


#: Words that are split here as the library would split them; any other word is left to it as a whole.
PLAIN_WORD = re.compile("[!-~¡-ɏ]+")
#: Fixed value: the published split pattern of the word-end vocabulary, without white space.
WORD_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class LibraryEncoder:
    """Ids from the tokenizers library, asked once for each distinct piece while it stays in use.

    Valid for vocabularies whose pre-tokenizer drops white space, so that a
    text's ids are those of its words in order; ``__init__`` checks that.
    Words of Latin letters, digits and signs are normalized and split here and
    their pieces go to the library's model; other words, and those that may hold special tokens, go through all of the library.
    """

    def __init__(self, compressed: bytes):
        from tokenizers import Tokenizer

        data = zlib.decompress(compressed).decode()
        self.library = Tokenizer.from_str(data)
        self.library.no_padding()
        self.library.no_truncation()
        self.model = self.library.model
        self.by_word, self.by_piece = PieceCache(self._word), PieceCache(self._piece)
        self.wide = self.library.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.kind, self.code = np.dtype("<u4" if self.wide else "<u2"), "I" if self.wide else "H"
        spec = json.loads(data)
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        patterns = [t.get("pattern", {}).get("Regex") for t in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.known = steps == ["NFC", "Replace", "Lowercase"] and patterns[:1] == [WORD_PIECES]
        self.split = regex.compile(WORD_PIECES).findall
        self.symbol = str.maketrans({chr(b): c for b, c in enumerate(byte_alphabet())})
        self.known = self.known and all(t["content"].startswith("<") for t in spec["added_tokens"])
        probe = "aB c\n\td.\x0b x"
        if self.library.encode(probe, add_special_tokens=False).ids != [
                i for w in probe.split() for i in self.library.encode(w, add_special_tokens=False).ids]:
            raise ValueError("this vocabulary's ids depend on white space; it cannot be cached by word")

    def _piece(self, piece: str) -> bytes:
        symbols = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.symbol)
        return array(self.code, [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if not self.known or "<" in text or not PLAIN_WORD.fullmatch(text):
            return array(self.code, self.library.encode(text, add_special_tokens=False).ids).tobytes()
        # the characters of a plain word are composed already, so lower case is all there is to normalize
        text = text.lower()
        letters = text.rstrip(",.;:!?")
        if letters.isalpha():
            ids = self.by_piece[letters]
            return ids if len(letters) == len(text) else ids + self.by_piece[text[len(letters):]]
        return b"".join(map(self.by_piece.__getitem__, self.split(text)))

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.by_word.__getitem__, text.encode().split()))


class TokenFileWriter:
    """Writes one file; ``add`` takes a document's ids as bytes of the file's id width."""

    def __init__(self, out, width: int, level: int = 3):
        self.out, self.width = out, width
        self.packer = zstandard.ZstdCompressor(level=level)
        self.pending: list[bytes] = []
        self.pending_bytes = self.tokens = 0
        self.frames: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.index.append((MISSING if doc_id is None else doc_id, len(self.frames), len(ids) // self.width))
        self.pending.append(ids)
        self.pending_bytes += len(ids)
        self.tokens += len(ids) // self.width
        if self.pending_bytes >= FRAME_BYTES:
            self._close_frame()

    def _close_frame(self) -> None:
        raw = b"".join(self.pending)
        packed = self.packer.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.pending, self.pending_bytes = [], 0

    def close(self) -> None:
        if self.pending:
            self._close_frame()
        columns = np.array(self.index, dtype="<i8").reshape(-1, 3).T.tobytes()
        body = struct.pack("<QQ", len(self.index), self.width) + self.packer.compress(columns)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(body)) + body)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        foot = struct.pack("<IBI", len(self.frames), CHECKSUM_BIT, SEEK_FOOTER)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table) + len(foot)) + table + foot)


class TokenFileReader:
    """Random access to one file (any object with ``seek``, ``read`` and ``tell``)."""

    def __init__(self, source):
        self.source = source
        source.seek(0, os.SEEK_END)
        end = source.tell()
        frames, descriptor, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEK_FOOTER or not descriptor & CHECKSUM_BIT:
            raise ValueError("no seek table with checksums at the end of the file")
        start = end - 9 - 12 * frames
        if struct.unpack("<II", self._at(start - 8, 8)) != (SEEK_MAGIC, 12 * frames + 9):
            raise ValueError("the seek table is damaged")
        self.frames = np.frombuffer(self._at(start, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        head = int(self.offsets[-1])
        magic, length = struct.unpack("<II", self._at(head, 8))
        if magic != INDEX_MAGIC or head + 8 + length != start - 8:
            raise ValueError("the document index is damaged")
        docs, self.width = struct.unpack("<QQ", self._at(head + 8, 16))
        columns = zstandard.ZstdDecompressor().decompress(self._at(head + 24, length - 16), max_output_size=24 * docs)
        self.doc_ids, self.doc_frame, self.doc_tokens = np.frombuffer(columns, "<i8").reshape(3, docs)

    def _at(self, offset: int, size: int) -> bytes:
        if offset < 0:
            raise ValueError("the file is too short")
        self.source.seek(offset)
        return self.source.read(size)

    def frame(self, k: int) -> np.ndarray:
        size, raw_size, checksum = map(int, self.frames[k])
        raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.offsets[k]), size), max_output_size=raw_size)
        if len(raw) != raw_size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} fails its checksum")
        return np.frombuffer(raw, f"<u{self.width}")

    def documents(self, wanted: set[int] | None = None):
        """(position in the file, doc id or None, ids) of the wanted documents (all if None); other frames stay packed."""
        take = np.arange(len(self.doc_ids)) if wanted is None else np.flatnonzero(
            np.isin(self.doc_ids, np.fromiter(wanted, np.int64, len(wanted))))
        frame_no, ids, starts = -1, None, None
        for i in take.tolist():
            k = int(self.doc_frame[i])
            if k != frame_no:
                frame_no, ids = k, self.frame(k)
                first = int(np.searchsorted(self.doc_frame, k))
                last = int(np.searchsorted(self.doc_frame, k, side="right"))
                starts = np.concatenate([[0], np.cumsum(self.doc_tokens[first:last])])
            a = i - first
            doc_id = int(self.doc_ids[i])
            yield i, None if doc_id == MISSING else doc_id, ids[starts[a]:starts[a + 1]]


def write_token_files(docs: DataFrame, vocabulary_path: str, path: str | None = None, end_id: int = 2,
                      id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Encode ``docs`` and write token files under ``path``; returns the manifest (file, part, n_docs, n_tokens).

    One shuffle: documents move once, by id range, and are coded where they land.
    """
    spark = docs.sparkSession
    path = path or shared_uri(spark, "token-files")
    SharedFiles(path).make()
    shared = broadcast_vocabulary(spark, vocabulary_path)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                         F.xxhash64(F.col(text_col)).alias("tie"))
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = source.repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie")
    ordered = ordered.select("id", "text", F.spark_partition_id().alias("part"))

    def run(batches):
        encoder = worker_state("library encoder", shared.value, LibraryEncoder)
        files, out, writer, name, part, docs_in = SharedFiles(path), None, None, None, None, 0
        end = np.array([end_id], encoder.kind).tobytes()
        for batch in batches:
            for doc_id, text, number in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(),
                                            batch.column("part").to_pylist()):
                if writer is None:
                    part, name = number, f"part-{number:06d}-{uuid.uuid4().hex}.ids.zst"
                    out = files.write(name)
                    writer = TokenFileWriter(out, encoder.kind.itemsize)
                writer.add(doc_id, (encoder.encode(text) if text else b"") + end)
                docs_in += 1
        trim(encoder.by_word, encoder.by_piece)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "part": part, "n_docs": docs_in, "n_tokens": writer.tokens}],
                                             schema=MANIFEST)

    # one row for each file: a manifest of many files would be mostly file heads
    return staged(ordered.mapInArrow(run, "file string, part int, n_docs long, n_tokens long").repartition(1),
                  "token-manifest").withColumn("root", F.lit(path))


MANIFEST = pa.schema([("file", pa.string()), ("part", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_token_digests(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decompressed and checked from the files.

    ``start`` counts the ids of all documents before; file totals are summed
    over the manifest, which has one row for each file, not for each document.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    width = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = listed.select("root", "file", "before", "part").repartition(width, "file")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with SharedFiles(row["root"]).read(row["file"]) as source:
                    at, rows = row["before"], []
                    for _, doc_id, ids in TokenFileReader(source).documents():
                        rows.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        at += len(ids)
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), ROWS)], schema=ROWS)
