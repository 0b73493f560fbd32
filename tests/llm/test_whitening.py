"""Whitening against a dense eigendecomposition."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tablegate.llm import queries, whitening

SF = "/root/testdata/sf0.01"


def dense(rows: list[tuple]) -> dict:
    """(vec_id, component) to (n, deviation, whitened, explained) by numpy, for vectors of one length."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in good], np.int64)
    n, sums = len(x), x.sum(0)
    y = x - x.mean(0)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    off = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x]
    k = int((values[:32] > 1e-12 * values[0]).sum())
    white = y @ (vectors[:, :k] / np.sqrt(values[:k]))
    return {(i, c + 1): (n, off[j], white[j, c], values[c] / values.sum()) for j, (i, _) in enumerate(good) for c in range(k)}


def same(got: list, want: dict) -> None:
    assert len(got) == len(want)
    signs: dict[int, float] = {}
    for r in sorted(got, key=lambda r: -abs(r["whitened"])):
        n, off, white, explained = want[r["vec_id"], r["component"]]
        sign = signs.setdefault(r["component"], np.sign(white * r["whitened"]))
        assert (r["n"], r["deviation"]) == (n, off)
        assert abs(r["whitened"] - sign * white) < 1e-7 and abs(r["explained"] - explained) < 1e-12
    assert len({r["identity_error"] for r in got}) <= 1 and all(r["identity_error"] < 1e-9 for r in got)


def test_query_is_the_dense_result(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    same(queries.QUERIES["op11_whitening"](spark, SF).collect(), dense(rows))


def test_odd_rows_many_partitions(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(r.normal(0, 1, (300, 5)) * [9, 3, 1, 0.3, 3])]
    # A third of the rows is one vector; one dimension never varies.
    rows += [(1000 + i, rows[0][1]) for i in range(150)]
    rows = [(i, [*v, 0.5]) for i, v in rows]
    odd = [(-1, None), (-2, []), (-3, [1.0, None, 0.0, 0.0, 0.0, 0.5]), (-4, [math.nan, 0.0, 0.0, 0.0, 0.0, 0.5])]
    odd += [(-5, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.5]), (-6, [1e300, 0.0, 0.0, 0.0, 0.0, 0.5])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 AS n", "2 AS part", "3 AS size")
    want = dense(rows)
    for parts in (1, 40):
        same(whitening.whitened(df.repartition(parts)).collect(), want)


def test_small_tables(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whitened(frame([])).count() == 0
    assert whitening.whitened(frame([(1, [1.0, 2.0])] * 5)).count() == 0
    # Fewer rows than dimensions; repeated and null ids; lengths fitted apart.
    rows = [(1, [1.0, 0.0, 3.0]), (1, [1.0, 0.0, 3.0]), (None, [2.0, 5.0, 3.0]), (4, [1.0]), (5, [3.0])]
    got = whitening.whitened(frame(rows)).collect()
    assert sorted((r["vec_id"] or 0, r["component"], r["n"]) for r in got) == [(0, 1, 3), (1, 1, 3), (1, 1, 3), (4, 1, 2), (5, 1, 2)]
    assert sorted(round(abs(r["whitened"]), 9) for r in got if r["n"] == 2) == [1.0, 1.0]


def test_deviations_beyond_a_long():
    m = whitening.Whitening(10**12, [0, 0], np.ones(2), np.eye(2))
    assert m.deviations(np.array([[0, 0], [10**4, 1]])) == [0, None]
    assert whitening.Whitening(3, [2**61, 5], np.ones(2), np.eye(2)).deviations(np.array([[2**61, 1]])) == [None]


@pytest.mark.parametrize("seed", range(40))
def test_rank_one_updates(seed):
    """Random, equal, zero and tiny entries; the result is orthogonal and has the matrix's spectrum."""
    r = np.random.default_rng(seed)
    k = int(r.integers(1, 24))
    d = np.sort(r.choice([0.0, 1.0, 1.0 + 1e-14, 2.0, *r.random(4) * 10], k))
    base = np.linalg.qr(r.normal(size=(k, k)))[0]
    z = r.normal(size=k) * r.choice([0, 1e-18, 1e-9, 1, 1], k)
    rho = float(r.choice([1e-9, 1.0, 1e6]))
    matrix = base @ np.diag(d) @ base.T + rho * np.outer(base @ z, base @ z)
    values, vectors = whitening.rank_one(d, base, base @ z, rho)
    scale = max(1.0, np.abs(matrix).max())
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(vectors @ np.diag(values) @ vectors.T - matrix).max() < 1e-12 * scale
    assert (np.diff(values) >= 0).all()
