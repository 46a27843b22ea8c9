"""Whitening against a plain eigendecomposition."""

import numpy as np
import pytest

from layerwright.llm import whiten


@pytest.mark.parametrize("size", [1, 2, 5, 40])
def test_rank_one_updates(size):
    rng = np.random.default_rng(size)
    rows = rng.normal(size=(300, size)) * 100 + 5
    if size == 5:
        rows[:, 3], rows[:, 4] = rows[:, 2], 7
    one, other = whiten.Spectrum.empty(size), whiten.Spectrum.empty(size)
    for i in range(0, 150, 7):
        one.add_rows(rows[i:min(i + 7, 150)])
    other.add_rows(rows[150:])
    one.merge(other)
    centred = rows - rows.mean(axis=0)
    want = centred.T @ centred
    assert one.n == 300 and np.allclose(one.mean, rows.mean(axis=0))
    assert np.abs(one.vectors * one.values @ one.vectors.T - want).max() < 1e-12 * np.abs(want).max()
    assert np.abs(one.vectors.T @ one.vectors - np.eye(size)).max() < 1e-13


def test_roots_lie_between_poles():
    rng = np.random.default_rng(3)
    poles = np.sort(np.concatenate([rng.normal(size=20), 1 + np.arange(5) * 1e-13, [1e9]]))
    squares = rng.random(26) ** 6 + 1e-12
    away, roots = whiten.secular(poles, squares / squares.sum(), 2.5)
    assert (np.diag(away) < 0).all() and (np.diag(away, -1) > 0).all() and (roots[:-1] <= poles[1:]).all()
    share = 2.5 * ((squares / squares.sum())[:, None] / away)
    assert (np.abs(1 + share.sum(axis=0)) <= 1e-9 * np.abs(share).sum(axis=0)).all()


def _reference(vectors):
    x = np.floor(np.array(vectors, float) * 1024).astype(int) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, centred @ basis[:, ::-1] / np.sqrt(np.maximum(values[::-1], 1e-300)), values[::-1] / values.sum()


def _frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string, component string").repartition(7)


def test_rows(spark):
    rng = np.random.default_rng(8)
    vectors = (rng.normal(size=(3000, 12)) * np.linspace(1, 3, 12)).astype(np.float32)
    vectors[1000:2000] = vectors[0]  # a third of the rows are one vector
    odd = [None, [], [1.0] * 11 + [None], [1.0] * 11 + [float("nan")], [float("inf")] * 12, [1.0, 2.0]]
    rows = [(i, v.tolist(), "x", None) for i, v in enumerate(vectors)] + [(-1 - i, v, "x", "y") for i, v in enumerate(odd)]
    rows += [(5, vectors[5].tolist(), "again", None), (None, vectors[6].tolist(), None, None)]
    df = _frame(spark, rows)
    got = whiten.whiten(df, whiten.fit(df, "embedding"), "vec_id", "embedding").toPandas()
    kept = np.vstack([vectors, vectors[5:7]])
    n, deviation, white, explained = _reference(kept)
    assert len(got) == 8 * len(kept) and set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10
    by = got[got.vec_id.notna()].groupby(["vec_id", "component"]).first()
    for c in range(1, 9):
        own = by.xs(c, level="component").reindex(range(3000))
        sign = np.sign((own.whitened * white[:3000, c - 1]).sum())
        assert np.abs(own.whitened * sign - white[:3000, c - 1]).max() < 1e-9
        assert np.allclose(own.explained, explained[c - 1], rtol=1e-10) and list(own.deviation.astype(int)) == deviation[:3000]


def test_few_and_flat_vectors(spark):
    for rows in ([], [(1, None, "", "")], [(1, [1.0, 2.0], "", "")], [(1, [1.0, 2.0], "", "")] * 5):
        df = _frame(spark, rows) if rows else spark.createDataFrame([], "vec_id long, embedding array<float>")
        assert whiten.whiten(df, whiten.fit(df, "embedding"), "vec_id", "embedding").collect() == []
    # three vectors in a plane, one entry constant: two components
    df = _frame(spark, [(1, [0.0, 1.0, 9.0], "", ""), (2, [1.0, 0.0, 9.0], "", ""), (3, [4.0, 4.0, 9.0], "", ""), (4, [2.0], "", "")])
    got = whiten.whiten(df, whiten.fit(df, "embedding"), "vec_id", "embedding").toPandas()
    assert sorted(set(got.component)) == [1, 2] and abs(got[got.vec_id == 1].explained.sum() - 1) < 1e-12 and got.identity_error.max() < 1e-10


def test_spectra_combine_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whiten, "FAN", 3)
    vectors = np.random.default_rng(2).normal(size=(200, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(20)
    model = whiten.fit(df, "embedding")
    _, _, _, explained = _reference(vectors)
    assert model.n == 200 and np.allclose(model.values / model.trace, explained, rtol=1e-12)


def test_deviation_beyond_long():
    assert whiten._deviation(np.array([2**40]), 2**20, np.array([0])) is None
    assert whiten._deviation(np.array([3, 1]), 2, np.array([4, 4])) == 8
