"""The registered queries without SQL on a whole driver table, against the library or brute force."""

import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from arlark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def result(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    return {r.doc_id: r for r in rows}


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_token_counts_and_round_trip_equal_the_library(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counts, codec = result(spark, "op5_token_counts"), result(spark, "op9_bpe_codec")
    assert set(counts) == set(codec) == set(documents)
    for doc, text in documents.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert (counts[doc].n_bytes, counts[doc].n_tokens, counts[doc].over_limit) == (len(text.encode()), len(ids), len(ids) > 1024)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (codec[doc].n_tokens, codec[doc].ids_sha256, codec[doc].decoded_sha256) == (
            len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded.encode()))


def test_token_files_equal_the_library(spark, documents):
    library, got, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), result(spark, "op10_token_files"), 0
    for doc in sorted(documents):
        ids = [*library.encode(documents[doc], add_special_tokens=False).ids, 2]
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(documents)


def test_removed_bytes_equal_brute_force(spark, documents):
    first, got = {}, result(spark, "op8_repeats")
    for doc in sorted(documents):
        body = documents[doc].encode()
        gone = np.zeros(len(body), bool)
        for k in range(len(body) - 49):
            if first.setdefault(body[k:k + 50], doc) < doc:
                gone[k:k + 50] = True
        kept = bytes(np.frombuffer(body, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        assert (got[doc].n_bytes, got[doc].n_removed, got[doc].n_spans, got[doc].kept_sha256) == (len(body), int(gone.sum()), spans, sha(kept)), doc
    assert sum(r.n_removed for r in got.values()) > 0 and len(got) == len(documents)


def test_shards_are_a_minimax_partition(spark, documents):
    """Equal texts together, slots without gaps, and no smaller capacity takes the groups in the shards' order."""
    got, groups = result(spark, "op7_sharding"), {}
    for doc, text in documents.items():
        row, body = got[doc], text.encode()
        assert (row.size, row.text_crc32, row.law, row.grown_shard) == (len(body) + 1, zlib.crc32(body), "bytes", None)
        groups.setdefault(body, []).append(row)
    assert all(len({r.shard for r in rows}) == 1 for rows in groups.values())
    loads = {}
    for rows in groups.values():
        loads.setdefault(rows[0].shard, []).append(sum(r.size for r in rows))
    for shard, sizes in loads.items():
        assert sorted(r.slot for r in got.values() if r.shard == shard) == list(range(sum(r.shard == shard for r in got.values())))
    assert set(loads) <= set(range(8)) and len(got) == len(documents)
    largest, total = max(map(sum, loads.values())), sum(r.size for r in got.values())
    # contiguous groups: nothing beats an eighth of all, and a group more is the most a cut can miss
    assert total / 8 <= largest <= total / 8 + max(sum(r.size for r in rows) for rows in groups.values())
