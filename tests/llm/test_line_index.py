"""Line dedup and its perfect hash against brute force."""

import os
import random
import re

import numpy as np
import pytest

from arlark.llm import line_index as op

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(LOWER)


def brute(rows, chars=10):
    holders = {}
    for doc, text in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= chars:
                    holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if doc is None or len(holders.get(key(line), ())) < 2 or min(holders[key(line)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept).encode()))
    return out


def order(rows):
    return sorted(((d is None, d or 0, *r) for d, *r in (tuple(x) for x in rows)))


def texts(seed):
    rng = random.Random(seed)
    pool = [f"Common line number {k}" for k in range(30)] + ["ÀÉÎÕÜàéîõü", "àéîõüÀÉÎÕÜ", "123456789", "1234567890", "日本語日本語日本語日", "日本語日本語日本語", "a" * 5000]
    rows = []
    for doc in range(200):
        lines = []
        for _ in range(rng.randrange(12)):
            line = rng.choice(pool) if rng.random() < 0.6 else f"own line {rng.randrange(10**9)}"
            line = rng.choice([line, line.upper() if line.isascii() else line, f"  {line}\t", line + "\r", f"\x0b{line}\x0c", line + " ", ""])
            lines.append(line)
        rows.append((doc * 7 % 200, "\n".join(lines)))
    rows += [(None, rows[0][1]), (None, None), (500, None), (501, ""), (502, "\n\n"), (503, "A very common line\n" * 4), (-5, "a VERY common line"),
             (504, rows[3][1]), (504, "an other text, Common line number 3\nonly here, twice\nonly here, twice"), (505, "x\n" * 30000)]
    return rows + [rows[3]] * 3 + [(505, "x\n" * 30000)]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "q") for d, t in rows], "doc_id long, text string, n_lines int, kept string")


def test_against_brute_force(spark):
    rows = texts(1)
    got = op.remove_repeated_lines(frame(spark, rows).repartition(5))
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    expected = brute(rows)
    assert order((d, n, g, bytes(k)) for d, n, g, k in got.collect()) == order(expected)
    assert sum(r[2] for r in expected) > 200


def test_several_shards_and_key_length(spark):
    rows = texts(2)
    got = op.remove_repeated_lines(frame(spark, rows), shards=7, key_chars=3)
    assert order((d, n, g, bytes(k)) for d, n, g, k in got.collect()) == order(brute(rows, 3))


def test_one_line_in_every_document_and_equal_rows(spark):
    rows = [(k, f"the same line everywhere\nline of {k} alone") for k in range(3000)] + [(7, "one row many times over")] * 5000
    got = op.remove_repeated_lines(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert order((d, n, g, bytes(k)) for d, n, g, k in got) == order(brute(rows))


def test_empty_table(spark):
    assert op.remove_repeated_lines(frame(spark, [])).collect() == []


def test_an_index_of_another_corpus(spark):
    old = [(1, "shared by both of them\nalone in the first"), (2, "Shared by both of them ")]
    index = op.build_line_index(frame(spark, old), shards=3)
    assert sum(r.n_keys for r in index.collect()) == 2
    got = op.remove_repeated_lines(frame(spark, [(9, "alone in the first\nSHARED by both of them\nnew line, unseen")]), index=index, shards=3)
    assert [(r.n_dropped, bytes(r.kept)) for r in got.collect()] == [(1, b"alone in the first\nnew line, unseen")]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 20000])
def test_perfect_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, (n, 2), dtype=np.uint64)
    keys[: n // 2, 0] = 5      # half of the keys differ in one half only
    index = op.PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(n))
    assert 64 * len(index.words) <= 4 * n + 2048
    other = op.PerfectHash(index.sizes, index.words).slots(rng.integers(0, 1 << 63, (50, 2), dtype=np.uint64))
    assert (other < max(1, n)).all()


def test_packing_round_trip():
    rows = {(3, b"text"): 2, (None, b""): 1, (-1, "é\n".encode()): 70}
    assert list(op._unpack(op._pack(rows))) == [(3, 2, b"text"), (None, 1, b""), (-1, 70, "é\n".encode())]


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="driver tables are not here")
def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = brute([(r.doc_id, r.text) for r in table.collect()])
    assert order((d, n, g, bytes(k)) for d, n, g, k in op.remove_repeated_lines(table).collect()) == order(expected)
