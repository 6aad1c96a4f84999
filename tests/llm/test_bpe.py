"""Token counts and the BPE codec against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from arlark.llm import bpe_codec, token_count
from arlark.llm.vocabulary import SETTLED, PieceCache, vocabulary_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def packed():
    return zlib.compress(vocabulary_bytes(PATH))


def sample_texts():
    rng = random.Random(5)
    symbols = list("ab  \n\n\t.,'<|>12é‍́中😀\x1c\x85sreltmvd ") + ["<|endoftext|>", "the ", " of", "'ll"]
    texts = ["".join(rng.choice(symbols) for _ in range(rng.randrange(50))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000), rng.randrange(600)]))
                      for _ in range(20)) for _ in range(500)]
    texts += ["a" * 4000, "".join(rng.choice("ab") for _ in range(3000)), " " * 999, "\n" * 300 + "x", "<|endoftext|>" * 3, " x", "x "]
    return texts


def test_counts_ids_and_decoding_equal_the_library(library, packed):
    counter, codec = token_count.TokenCounter(packed), bpe_codec.BpeCodec(packed)
    texts = sample_texts()
    for text, expected in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == expected.ids, repr(text)
        assert counter.count(text) == len(expected.ids), repr(text)
        assert codec.decode(ids) == library.decode(expected.ids, skip_special_tokens=False) == text


def test_decoding_ill_formed_ids_replaces_bytes(library, packed):
    codec = bpe_codec.BpeCodec(packed)
    ids = library.encode("é中", add_special_tokens=False).ids[:-1]
    assert codec.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_pieces_fall_back_to_the_library_for_unsettled_code_points():
    assert SETTLED.search("ok é Ж 中 かな 한 – €") is None
    assert SETTLED.search("\U00010940") and SETTLED.search("؀")


def test_cache_is_bounded_and_keeps_what_is_used():
    asked = []
    cache = PieceCache(lambda x: asked.append(x) or len(x), limit=3, longest=4)
    assert [cache[x] for x in ("a", "bb", "ccc", "dddd", "eeeeee", "a", "f", "a")] == [1, 2, 3, 4, 6, 1, 1, 1]
    assert len(cache) <= 3 and len(cache.old) <= 3 and "eeeeee" not in cache
    assert asked == ["a", "bb", "ccc", "dddd", "eeeeee", "f"]


def test_operators_on_edge_rows(spark, library):
    rows = [(1, None, "n", 1), (2, "", "n", 2), (3, "the cat <|endoftext|> sat\n", "n", 3), (None, "x", None, 4), (3, "the cat", "n", 5),
            (4, "lang " * 3000, "n", 6), (4, "lang " * 3000, "n", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, id int")
    counts = token_count.token_counts(docs, PATH).collect()
    coded = bpe_codec.round_trip(docs, PATH).collect()
    expected = sorted((-1 if d is None else d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
                      for d, t, *_ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in counts) == expected
    assert all(r.over_limit == (r.n_tokens > 1024) for r in counts)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted((sha(np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()), sha((t or "").encode()))
                  for _, t, *_ in rows)
    assert sorted((r.ids_sha256, r.decoded_sha256) for r in coded) == want
    back = bpe_codec.decode_documents(bpe_codec.encode_documents(docs, PATH), PATH).collect()
    assert sorted(r.text for r in back) == sorted(t or "" for _, t, *_ in rows)
    assert token_count.token_counts(docs.limit(0), PATH).count() == 0
    assert bpe_codec.round_trip(docs.limit(0), PATH).count() == 0
