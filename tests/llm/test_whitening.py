"""Whitening against a dense eigenvalue solver and exact integers."""

import os

import numpy as np
import pytest

from arlark.llm import whitening as op

SF = "/root/testdata/sf0.001"


def brute(rows, components=16):
    """id-less rows by input order: (deviations, whitened up to sign, explained) over the fit list."""
    x = np.array([[int(np.floor(float(np.float32(c)) * 64)) + 1_000_000 for c in v] for v in rows], object)
    fit = np.array(sorted(set(map(tuple, x.tolist()))), object)
    n, s = len(fit), fit.sum(axis=0)
    deviations = [int(sum((n * a - b) ** 2 for a, b in zip(row, s))) for row in x]
    centred = ((fit * n - s) / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    white = ((x * n - s) / n).astype(float) @ (vectors / np.sqrt(values))
    return n, deviations, white, values / np.trace(centred.T @ centred / n)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, "q") for i, v in rows], "vec_id long, embedding array<float>, whitened double, component string")


def check(spark, rows, components=16):
    n, deviations, white, explained = brute([v for _, v in rows], components)
    got = {}
    out = op.whiten(frame(spark, rows), components=components)
    for r in out.collect():
        got.setdefault((r.vec_id, r.component), []).append(r)
        assert r.n == n and r.identity_error <= 1e-9
    count = max(c for _, c in got)
    signs = {}
    for (i, v), d, w in zip(rows, deviations, white):
        for k in range(1, count + 1):
            r = got[i, k][0]
            assert int(r.deviation) == d and abs(r.explained / explained[k - 1] - 1) < 1e-9
            sign = signs.setdefault(k, 1.0 if abs(r.whitened - w[k - 1]) <= abs(r.whitened + w[k - 1]) else -1.0)
            assert abs(sign * r.whitened - w[k - 1]) < 1e-7
    return got, count


def random_rows(seed, number=300, dim=24):
    rng = np.random.default_rng(seed)
    data = rng.standard_normal((number, dim)) * np.linspace(0.3, 3, dim)
    return [(i, [float(c) for c in v]) for i, v in enumerate(data.astype(np.float32))]


def test_against_a_dense_solver(spark):
    rows = random_rows(1)
    got, count = check(spark, rows + [(900, rows[0][1]), (901, rows[0][1])])
    assert count == 16 and got[900, 3][0].whitened == got[0, 3][0].whitened


def test_repeated_rows_and_ids_come_back(spark):
    rows = random_rows(2, 60, 5)
    out = op.whiten(frame(spark, rows + [rows[3], rows[3], (None, rows[4][1])])).collect()
    assert len(out) == 63 * 5 and sum(r.vec_id == 3 for r in out) == 15 and sum(r.vec_id is None for r in out) == 5
    assert {r.n for r in out} == {60}


def test_unusable_rows_are_dropped(spark):
    rows = random_rows(3, 40, 4)
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, float("nan"), 0.0, 0.0]),
           (104, [float("inf"), 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [3e38, 0.0, 0.0, 0.0])]
    out = op.whiten(frame(spark, rows + bad)).collect()
    assert {r.vec_id for r in out} == set(range(40))


def test_rank_bounds_the_components(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(50):
        a, b = float(rng.integers(-9, 9)), float(rng.integers(-9, 9))
        rows.append((i, [a, b, a, 2.5, 0.0, -b]))
    got = {r.component for r in op.whiten(frame(spark, rows)).collect()}
    assert got == {1, 2}


def test_equal_eigenvalues(spark):
    rows = [(2 * k + s, [float((-1) ** s) if j == k else 0.0 for j in range(6)]) for k in range(6) for s in range(2)]
    out = op.whiten(frame(spark, rows)).collect()
    assert {r.component for r in out} == set(range(1, 7)) and max(r.identity_error for r in out) < 1e-9
    assert all(abs(r.explained - 1 / 6) < 1e-12 for r in out)


def test_one_vector_and_no_vector(spark):
    assert op.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    empty = op.whiten(frame(spark, []))
    assert empty.collect() == [] and empty.columns[0] == "vec_id"


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(3) * 1e9]) for i in range(50)]
    check(spark, rows)


def test_deviations_without_overflow():
    centre = op.Centre(1 << 20, [1 << 40, 5])
    matrix = np.array([[1 << 45, -(1 << 45)]])
    n = 1 << 20
    assert centre.deviations(matrix) == [(n * (1 << 45) - (1 << 40)) ** 2 + (-n * (1 << 45) - 5) ** 2]


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables are not here")
def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    check(spark, rows)
