"""Rank-one eigen updates and whitening against plain linear algebra."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from statlayer.llm import whitening
from statlayer.llm.queries import REGISTRY

from .conftest import SF


def plain(vectors, components=16):
    """n, sums, eigenvalues, eigenvectors (columns, falling) of the distinct whole-number vectors."""
    x = [tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), dtype=np.int64)
    mean = fit.sum(axis=0) / len(fit)
    centred = fit - mean
    values, vecs = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, len(fit), fit.sum(axis=0), values[::-1], vecs[:, ::-1]


def check(rows, ids, vectors):
    x, n, sums, values, vecs = plain(vectors)
    got = {}
    for r in rows:
        got.setdefault((r["vec_id"], r["component"]), []).append(r)
    k = int((values[:16] > 1e-12 * values[0]).sum())
    assert len(got) == len(set(ids)) * k and len(rows) == len(ids) * k
    signs = None
    for i, v in zip(ids, x):
        own = [got[i, c + 1][0] for c in range(k)]
        want = (np.array(v) - sums / n) @ vecs[:, :k] / np.sqrt(values[:k])
        have = np.array([r["whitened"] for r in own])
        signs = np.sign(have * want) if signs is None else signs
        assert np.allclose(have, want * signs, atol=1e-7), i
        assert {r["deviation"] for r in own} == {sum((n * a - int(s)) ** 2 for a, s in zip(v, sums))} and {r["n"] for r in own} == {n}
        assert np.allclose([r["explained"] for r in own], values[:k] / values.sum(), rtol=1e-9)
        assert max(r["identity_error"] for r in own) < 1e-9


@pytest.mark.parametrize("kind", ["plain", "sizes", "axes", "whole numbers", "with nothing"])
def test_rank_one_updates(kind):
    rng = np.random.default_rng(len(kind))
    for _ in range(40):
        d = int(rng.integers(1, 18))
        total, values, vectors = np.zeros((d, d)), np.zeros(d), np.eye(d)
        for j in range(int(rng.integers(1, 30))):
            row = {"plain": lambda: rng.normal(size=d), "sizes": lambda: rng.normal(size=d) * 10.0 ** rng.integers(-3, 4),
                   "axes": lambda: np.eye(d)[rng.integers(0, d)], "whole numbers": lambda: rng.integers(-2, 3, size=d).astype(float),
                   "with nothing": lambda: rng.normal(size=d) * (j % 2)}[kind]()
            total += np.outer(row, row)
            values, vectors = whitening.rank_one(values, vectors, row)
        scale = max(np.abs(total).max(), 1e-300)
        assert np.allclose(values / scale, np.linalg.eigvalsh(total) / scale, atol=1e-12)
        assert np.allclose(vectors.T @ vectors, np.eye(d), atol=1e-12)
        assert np.allclose(vectors * values @ vectors.T / scale, total / scale, atol=1e-12)


def test_spectra_of_parts_join():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 12)) * np.arange(1, 13) + 100
    parts = [whitening.Spectrum(12) for _ in range(4)]
    for k, s in enumerate(parts):
        for a in range(0, 300 if k < 3 else 0, 70):
            s.add(x[300 * k + a:300 * k + min(300, a + 70)])
    for s in parts[1:]:
        parts[0].join(s)
    centred = x - x.mean(axis=0)
    assert parts[0].n == 900 and np.allclose(parts[0].mean, x.mean(axis=0))
    assert np.allclose(parts[0].values, np.linalg.eigvalsh(centred.T @ centred))


def test_query_against_plain(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(REGISTRY["op13_whitening"][0](spark, SF).collect(), [r["vec_id"] for r in table], [r["embedding"] for r in table])


def test_many_tasks_and_repeated_vectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 2)
    rng = np.random.default_rng(4)
    mixed = rng.normal(size=(5, 5))
    rows = [(i, (rng.normal(size=5) @ mixed).tolist()) for i in range(200)] + [(200 + i, [0.5] * 5) for i in range(100)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    check(whitening.whiten(table).collect(), [i for i, _ in rows], [v for _, v in rows])


def test_flat_directions_have_no_component(spark):
    rows = [(i, [float(i % 7), float(i % 3), 2.0, float(i % 7)]) for i in range(60)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    check(got, [i for i, _ in rows], [v for _, v in rows])
    assert {r["component"] for r in got} == {1, 2}


def test_odd_rows_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (None, [4.0, -1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []),
            (8, [1.0]), (9, [0.25, 3.0])]
    table = spark.createDataFrame([(i, v, 1, "w") for i, v in rows], "vec_id long, embedding array<float>, x int, component string")
    got = whitening.whiten(table).collect()
    assert sorted((str(r["vec_id"]), r["component"]) for r in got) == sorted((str(i), c) for i in (1, 2, 2, 9, None) for c in (1, 2))
    assert {r["n"] for r in got} == {4}
    none = whitening.whiten(table.where("false"))
    assert none.count() == 0 and none.columns == whitening.whiten(table).columns
    assert whitening.whiten(table.where("vec_id = 1")).count() == 0
    big = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 1.0]), (3, [5.0, 1e18])], "vec_id long, embedding array<double>")
    assert {r["deviation"] for r in whitening.whiten(big).collect()} == {None}


def test_deviation_is_exact(spark):
    x = np.array([[1_000_000, 1_000_064], [1_000_000 + 10 ** 7, 3]])
    model = whitening.Whitener(3, [3_000_001, 2_999_999], np.ones(2), np.eye(2))
    assert model.deviations(x) == [sum((3 * int(a) - s) ** 2 for a, s in zip(r, model.sums)) for r in x]
    model.n = 10 ** 9
    model.sums = [10 ** 15, 10 ** 15 + 7]
    assert model.deviations(x[:1]) == [sum((10 ** 9 * int(a) - s) ** 2 for a, s in zip(x[0], model.sums)) if
                                       sum((10 ** 9 * int(a) - s) ** 2 for a, s in zip(x[0], model.sums)) < 2 ** 63 else None]
