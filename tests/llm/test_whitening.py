"""Embedding whitening against dense eigenvectors, exact sums and hard cases."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tallyhouse.llm import base, bidiagonal, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, whitened string, key string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 5, "x", "y") for i, v in vectors], SCHEMA).repartition(3)


def table(df):
    return {(r.vec_id, r.component): r for r in df.collect()}


def residual(r, values, vectors):
    return max((np.linalg.norm(r.T @ (r @ vectors[:, j]) - values[j] * vectors[:, j]) for j in range(len(values))), default=0.0)


def matrices():
    rng = np.random.default_rng(4)
    turn = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    x = rng.normal(size=(400, 20))
    x[:, 3], x[:, 7] = 0, x[:, 8]
    yield from (np.triu(rng.normal(size=(d, d))) for d in (1, 2, 3, 17, 64))
    yield np.eye(9)
    yield np.diag([3.0, 3, 3, 2, 2, 1, 0, 0])
    yield np.zeros((4, 4))
    yield np.linalg.qr(np.diag([5.0] * 5 + [4.9999999] * 5 + [1] * 20) @ turn)[1]
    yield np.linalg.qr(x)[1]
    yield np.diag(10.0 ** -np.arange(12)) + np.diag(10.0 ** -np.arange(11) / 7, 1)
    yield 1e150 * np.triu(rng.normal(size=(6, 6)))


@pytest.mark.parametrize("r", list(matrices()), ids=range(12))
def test_singular_values_and_vectors(r):
    values, vectors = bidiagonal.principal(r, r.shape[1])
    roots = np.linalg.svd(r)[1]
    assert np.allclose(np.sqrt(values), roots[: len(values)], rtol=1e-13, atol=1e-14 * max(roots[0], 1e-300))
    assert np.all(roots[len(values) :] <= 1e-11 * max(roots[0], 1e-300))
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-10)
    scale = max(roots[0], 1e-300)
    assert residual(r / scale, values / scale**2, vectors) < 1e-10


def test_dqds_keeps_small_values_accurate():
    a, b = 10.0 ** -np.arange(0, 12, 2), 0.5 * 10.0 ** -np.arange(0, 10, 2)
    values = np.sqrt(bidiagonal.squared_singular_values(a, b))
    # The product of the singular values is the determinant, here known exactly.
    assert math.isclose(np.prod(values), np.prod(a), rel_tol=1e-13)


def test_report_equals_dense_eigenvectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "MERGED", 2)
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(150, 20)) * np.linspace(0.2, 3, 20)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    # Copies count once in the fit and are all returned, whatever their ids.
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [(None, rows[8][1])]
    got = whitening.whitening_report(frame(spark, rows)).collect()
    x = np.floor(64 * vectors.astype(float)).astype(int) + 1_000_000
    x = np.unique(x, axis=0)
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    assert len(got) == 16 * len(rows) and {r.n for r in got} == {n}
    own = {i: np.floor(64 * np.array(v)).astype(int) + 1_000_000 for i, v in rows}
    signs = {}
    for r in got:
        v, j = own[r.vec_id], r.component - 1
        assert r.deviation == int(((n * v - sums) ** 2).sum())
        want = (v - sums / n) @ directions[:, j] / np.sqrt(values[j])
        sign = signs.setdefault(j, np.sign(want * r.whitened))
        assert abs(r.whitened - sign * want) < 1e-9
        assert math.isclose(r.explained, values[j] / values.sum(), rel_tol=1e-10)
        assert r.identity_error < 1e-9


def test_rows_left_out_and_degenerate_fits(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [2.0, 2.0])]
    bad = [(4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [-inf, 1.0]), (9, []), (10, [1.0]), (11, [1e30, 1.0])]
    got = table(whitening.whitening_report(frame(spark, good + bad)))
    assert set(got) == {(i, k) for i in (1, 2, 3) for k in (1, 2)}
    assert whitening.whitening_report(frame(spark, bad[:5])).count() == 0
    assert whitening.whitening_report(frame(spark, [(1, [3.0, 4.0])] * 5)).count() == 0
    assert whitening.whitening_report(frame(spark, [])).count() == 0
    # A constant dimension and a line: one component only.
    line = table(whitening.whitening_report(frame(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(10)])))
    assert {c for _, c in line} == {1} and math.isclose(line[1, 1].explained, 1.0)


def test_deviation_beyond_64_bits_is_null_and_sums_stay_exact(spark):
    big = 2.0**52
    rows = [(1, [big, 0.0]), (2, [-big, 1.0]), (3, [0.5, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit(df)
    x = [[math.floor(64 * Fraction(c)) + 1_000_000 for c in v] for _, v in rows]
    assert model.sums == [sum(c) for c in zip(*x)] and model.n == 3
    got = {r.vec_id: r.deviation for r in whitening.whitened(df, model).collect()}
    assert got[1] is None and got[2] is None
    assert got[3] == sum((3 * c - s) ** 2 for c, s in zip(x[2], model.sums))


def test_steps_survive_a_table_written_in_many_parts(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=6)]) for i in range(300)]
    one = table(whitening.whitening_report(frame(spark, rows).coalesce(1)))
    many = table(whitening.whitening_report(frame(spark, rows).repartition(40)))
    for at, row in one.items():
        assert abs(abs(row.whitened) - abs(many[at].whitened)) < 1e-9 and row.deviation == many[at].deviation


def test_registered_query(spark):
    from tallyhouse.llm import queries

    got = queries.op11_embedding_whitening(spark, "/root/testdata/sf0.001")
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = got.collect()
    ids = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()
    assert len(rows) == 16 * ids and max(r.identity_error for r in rows) < 1e-8
    assert base.shared_folder(spark)
