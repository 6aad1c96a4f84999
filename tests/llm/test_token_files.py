"""Token files: format, random access, checksums, order."""

import io
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from arlark.llm import token_files
from arlark.llm.common import SharedFiles
from arlark.llm.vocabulary import vocabulary_bytes

PATH = public_tokenizers.path("word_bpe_49k.json")


def written(documents, monkeypatch=None):
    out = io.BytesIO()
    writer = token_files.TokenFileWriter(out, 2)
    for doc_id, ids in documents:
        writer.add(doc_id, np.array(ids, "<u2").tobytes())
    writer.close()
    return out.getvalue()


def test_round_trip_random_access_and_checksums(monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_BYTES", 64)
    rng = np.random.default_rng(3)
    documents = [(None, [2])] + [(i * 7, rng.integers(0, 50_000, rng.integers(1, 60)).tolist()) for i in range(200)]
    data = written(documents)
    reader = token_files.TokenFileReader(io.BytesIO(data))
    assert [(d, ids.tolist()) for _, d, ids in reader.documents()] == documents
    assert len(reader.frames) > 20
    opened = []
    monkeypatch.setattr(reader, "frame", lambda k, real=reader.frame: opened.append(k) or real(k))
    assert [(d, ids.tolist()) for _, d, ids in reader.documents({700, 707})] == documents[101:103]
    assert len(set(opened)) <= 2
    # frames stand alone: any zstandard reader can decompress the second one
    start, size = int(reader.offsets[1]), int(reader.frames[1][0])
    assert zstandard.ZstdDecompressor().decompress(data[start:start + size], max_output_size=1 << 20)
    damaged = bytearray(data)
    damaged[start + size - 1] ^= 0xFF
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.TokenFileReader(io.BytesIO(bytes(damaged))).documents())
    # a wrong checksum in the table is noticed although the frame itself is sound
    table = bytearray(data)
    table[-9 - 12 * len(reader.frames) + 8] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        list(token_files.TokenFileReader(io.BytesIO(bytes(table))).documents())
    with pytest.raises((ValueError, struct.error)):
        token_files.TokenFileReader(io.BytesIO(data[:-1]))


def test_word_cache_equals_the_library():
    rng = random.Random(2)
    library = Tokenizer.from_file(PATH)
    encoder = token_files.LibraryEncoder(zlib.compress(vocabulary_bytes(PATH)))
    letters = list("aAbéÉñßİ¿'´`.,-#019µªº²½ÆŒǅɏẞΣσ中\u0301\u00a0\u0085\u2028\x1c") + ["'ll", "'RE", "<|endoftext|>", "<|", "|>"]
    texts = ["".join(rng.choice(letters + [" ", "\n"]) for _ in range(rng.randrange(40))) for _ in range(4000)]
    for text, expected in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == expected.ids, repr(text)


def test_query_rows_equal_the_library(spark):
    library = Tokenizer.from_file(PATH)
    rows = [(5, "Hello, WORLD it's 3 pm"), (None, "x"), (2, None), (9, ""), (3, "<|endoftext|>a <|startoftext|>"),
            (7, "İstanbul ΣΑΣ é \x1c\x85 " * 50), (4, "word " * 20_000)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, part string, n_tokens int")
    manifest = token_files.write_token_files(docs, PATH, end_id=2, partitions=3)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_digests(manifest).collect()}
    at, expected = 0, {}
    for doc_id, text in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected[doc_id] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == expected
    listed = manifest.collect()
    assert sum(r.n_docs for r in listed) == len(rows) and sum(r.n_tokens for r in listed) == at
    with SharedFiles(listed[0].root).read(listed[0].file) as f:
        assert token_files.TokenFileReader(f).width == 2
    empty = token_files.read_token_digests(token_files.write_token_files(docs.limit(0), PATH))
    assert empty.count() == 0
