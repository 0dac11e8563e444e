"""Whitening against a dense eigenvalue solver."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationloom.llm.whitening import leading_pairs, minres, whiten


def expected(rows, k=4):
    """Usable rows: id, exact deviation, absolute whitened values; explained shares."""
    xs = [(i, [math.floor(256 * c) for c in v]) for i, v in rows]
    distinct = np.array(sorted({tuple(x) for _, x in xs}), dtype=float)
    n, sums = len(distinct), [sum(int(v) for v in col) for col in distinct.T]
    c = distinct - np.array(sums) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), np.abs((np.array(x) - np.array(sums) / n) @ vectors / np.sqrt(values))) for i, x in xs]
    return n, out, values / np.trace(c.T @ c / n)


def clouds(n: int, d: int, seed: int = 0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, d))
    return [(i, (centres[i % 5] + 0.4 * rng.normal(size=d)).tolist()) for i in range(n)]


@pytest.mark.parametrize("n, d", [(400, 12), (60, 3), (30, 40), (300, 64)])
def test_whiten(spark, n, d):
    rows = clouds(n, d)
    good = rows + [(None, rows[0][1]), (3, rows[0][1]), (3, rows[0][1])]
    bad = [(9000, None), (9001, []), (9002, [None, *rows[0][1][1:]]), (9003, [math.nan, *rows[0][1][1:]]), (9004, [-math.inf, *rows[0][1][1:]]),
           (9005, [1e300, *rows[0][1][1:]]), (9006, [0.5] * (d + 1))]
    table = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("n", F.lit("clash")).withColumn("x", F.lit(1)).repartition(3)
    found = whiten(table)
    assert dict(found.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    found = found.collect()
    size, want, explained = expected(good)
    k = min(4, d)
    assert len(found) == k * len(good)
    ours = sorted((repr(r["vec_id"]), r["component"], r["deviation"], round(abs(r["whitened"]), 7)) for r in found)
    theirs = sorted((repr(i), j + 1, dev, round(float(w[j]), 7)) for i, dev, w in want for j in range(k))
    assert [o[:3] for o in ours] == [t[:3] for t in theirs]
    assert max(abs(o[3] - t[3]) for o, t in zip(ours, theirs, strict=True)) < 1e-6
    for r in found:
        assert r["n"] == size and abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-10 and r["identity_error"] < 1e-9


def test_degenerate(spark):
    def of(rows):
        return whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()

    assert of([]) == [] and of([(1, None)]) == [] and of([(1, [0.5, 1.0]), (2, [0.5, 1.0])]) == []
    line = of([(1, [0.0, 0.0]), (2, [1.0, 2.0]), (3, [2.0, 4.0])])
    assert {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-12
    assert sorted(round(r["whitened"] ** 2, 9) for r in line) == [0.0, 1.5, 1.5]


@pytest.mark.parametrize("seed", range(12))
def test_pairs(seed):
    """Clustered, repeated and missing eigenvalues; residuals at rounding and none passed over."""
    rng = np.random.default_rng(seed)
    d = int(rng.choice([1, 3, 7, 40, 200]))
    values = np.sort(rng.choice([rng.uniform(0, 1, d), np.full(d, 2.0), np.geomspace(1, 1e-9, d), 1 + 1e-6 * np.arange(d)][seed % 4], d))[::-1].copy()
    if seed % 3 == 0:
        values[d // 2:] = 0
    basis = np.linalg.qr(rng.standard_normal((d, d)))[0]
    matrix = basis * values @ basis.T
    matrix = (matrix + matrix.T) / 2
    got, vectors = leading_pairs(lambda b: matrix @ b, d, 4)
    k = min(4, d)
    assert np.abs(got - values[:k]).max() < 1e-9
    assert np.linalg.norm(matrix @ vectors - vectors * got, axis=0).max() < 1e-10 and np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12


def test_minres_solves_indefinite_equations():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    right = rng.standard_normal(20)
    equation = minres(right, lambda v: v, 0.3, 60, 1e-12)
    image = None
    while True:
        try:
            v = next(equation) if image is None else equation.send(image)
        except StopIteration as end:
            assert np.linalg.norm((a - 0.3 * np.eye(20)) @ end.value - right) < 1e-8
            return
        image = a @ v
