"""The curve, unusual vectors, and recall against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerwright.llm import ann
from layerwright.llm.common import table
from layerwright.llm.queries import op5_hilbert_neighbours


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2), (6, 1), (1, 5)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    places = ann.hilbert(cells, bits)
    assert sorted(places) == list(range(len(cells)))
    along = cells[np.argsort(places)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def _brute(rows, asked, k=10):
    out = []
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for i, v in {(i, tuple(v)) for i, v in good if asked(i)}:
        best = {}
        for j, w in good:
            if j != i and len(w) == len(v):
                d = float(np.sqrt(((w - np.array(v)) ** 2).sum()))
                best[j] = min(d, best.get(j, d))
        out += [(i, r, j, d) for r, (d, j) in enumerate(sorted((d, j) for j, d in best.items())[:k], 1)]
    return sorted(out)


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=5).round(1)]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [(200, None), (201, []), (202, [0.0] * 5), (203, [1.0, None, 1.0, 1.0, 1.0]),
             (204, [float("nan")] * 5), (205, [float("inf")] + [1.0] * 4), (None, [1.0] * 5), (3, rows[3][1]), (300, [1.0, 2.0]), (310, [1.0, 2.5])]
    vectors = spark.createDataFrame([(v, i, 1, 2) for i, v in rows], "embedding array<double>, vec_id long, score int, rank int")
    got = ann.search(vectors, "vec_id", "embedding", F.col("id") % 10 == 0).collect()
    want = _brute(rows, lambda i: i % 10 == 0)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [w[:3] for w in want]
    assert all(abs(a.score - b[3]) < 1e-12 for a, b in zip(sorted(got), want, strict=True))


def test_empty_table_and_single_vector(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.search(spark.createDataFrame([], schema), "vec_id", "embedding", F.lit(True)).count() == 0
    assert ann.search(spark.createDataFrame([(1, [1.0])], schema), "vec_id", "embedding", F.lit(True)).count() == 0


def test_recall(spark):
    sf = "/root/testdata/sf0.1"
    pdf = table(spark, sf, "embeddings").toPandas()
    ids, x = pdf.vec_id.to_numpy(), np.stack(pdf.embedding.to_numpy()).astype(float)
    found = op5_hilbert_neighbours(spark, sf).toPandas()
    right = total = 0
    for q in ids[ids % 100 == 0]:
        away = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        away[ids == q] = np.inf
        best = set(ids[np.lexsort((ids, away))[:10]])
        right, total = right + len(best & set(found[found.query_id == q].vec_id)), total + 10
    assert len(found) == total and right / total >= 0.95
