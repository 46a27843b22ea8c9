"""Recall where points crowd together."""

import numpy as np
from pyspark.sql import functions as F

from layerwright.llm import ann


def _nearest(x, asked, k=10):
    out = {}
    for q in asked:
        away = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        away[q] = np.inf
        out[int(q)] = set(np.lexsort((np.arange(len(x)), away))[:k].tolist())
    return out


def _recall(spark, x, asked, **how):
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(rows, "vec_id", "embedding", F.col("id").isin([int(q) for q in asked]), **how).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = _nearest(x, asked)
    return sum(len(got.get(q, set()) & w) for q, w in want.items()) / sum(map(len, want.values()))


def test_crowded_and_distant_vectors_keep_an_order():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16))
    x[:1000] = x[0] + rng.normal(size=(1000, 16)) * 1e-5
    x[1000:1500] = 40 * x[1000] + rng.normal(size=(500, 16))
    mean = x.mean(axis=0)
    for curve in range(3):
        keys = ann.curve_keys(x, mean, float(np.sqrt(((x - mean) ** 2).sum(axis=1).max())), curve)
        keys = np.stack(keys if isinstance(keys, list) else [keys], axis=1)
        for part in (keys[:1000], keys[1000:1500]):
            assert len(np.unique(part, axis=0)) == len(part)


def test_neighbours_within_a_crowd(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 8))
    x[:3000] = x[0] + rng.normal(size=(3000, 8)) * 1e-5
    recall = _recall(spark, x, range(0, 3000, 60), curves=8, spread=1.0)
    print("crowd recall", recall)
    assert recall >= 0.9


def test_recall_is_held_without_structure(spark):
    x = np.random.default_rng(5).normal(size=(6000, 16))
    recall = _recall(spark, x, range(0, 6000, 40), curves=4, spread=0.5)
    print("unstructured recall", recall)
    assert recall >= 0.9


def test_recall_where_little_is_compared(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = np.sin(rng.uniform(0, 2, size=(24_000, 3)) @ rng.normal(size=(3, 24)))
    windows, measured = [], ann._window
    monkeypatch.setattr(ann, "_window", lambda *a: windows.append(measured(*a)) or windows[-1])
    curves, spread = 6, 0.5
    recall = _recall(spark, x, range(0, len(x), 120), curves=curves, spread=spread)
    block = int(np.ceil(spread * np.sqrt(len(x))))
    share = curves * (2 * windows[0] + 1) * block / len(x)  # counts what several curves share more than once
    print("recall", recall, "window", windows, "at most compared", share)
    assert recall >= 0.9 and share < 0.2
