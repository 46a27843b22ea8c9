"""Approximate nearest neighbours by shifted space-filling curves.

Every curve projects the vectors to a few random directions, shifts them at random and orders them along a Hilbert curve.
Points that are near each other are close in at least some of the orders. An order is range-partitioned and cut into
blocks of `SPREAD` times the square root of the number of points; a query meets its own block and those beside it
on every curve, all by exact distance, and the best of all curves are merged. No block outgrows a task. Places have 50 bits a
direction over a range that holds every point, so vectors of a crowd stand in an order of their own however close they are
or far out.

How many blocks on either side a query meets is measured: the true neighbours of up to `SAMPLE` queries are found by brute
force, and the window is the smallest, one block at least, that holds `RECALL` of them. Points with structure need the least
window, and work that grows with the power 1.5 of the points; points without any need a wider one as they grow, up to the
whole table.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do null keys. Equal vectors are
one point on the curves, with the smallest keys of its copies; a query's own key is never among its results. If a key
stands at several vectors, its nearest counts. Vectors of different lengths are searched apart. Ties go to the smaller key.
Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwright import session

CURVES = 24
SPREAD = 4.0
DIMENSIONS, BITS = 6, 10   # of the projection; together at most 62 bits
LEVELS = 5                 # numbers of BITS bits a direction that make up a place
LEAST_BLOCK = 64
SAMPLE, RECALL = 200, 0.95  # asked points whose neighbours are found by brute force, and the share a window must hold of them
GATHERED = 500_000         # components of the vectors that a task places at a time
MOST_LENGTHS = 32


def _along(cells: np.ndarray, bits: int) -> list[np.ndarray]:
    """Skilling's transform of cell numbers: the bits of all directions, highest first, make up the place on the curve."""
    x = [c.astype(np.uint64) for c in cells.T]
    one, zero = np.uint64(1), np.uint64(0)
    for b in range(bits - 1, 0, -1):
        bit, low = one << np.uint64(b), (one << np.uint64(b)) - one
        for i in range(len(x)):
            on = (x[i] & bit) != 0
            swap = np.where(on, zero, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0]) ^ swap
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        bit = one << np.uint64(b)
        turn = np.where((x[-1] & bit) != 0, turn ^ (bit - one), turn)
    return [c ^ turn for c in x]


def _place(x: list[np.ndarray], high: int, low: int) -> np.ndarray:
    """The bits below `high` and from `low` on of all directions, as one number."""
    place = np.zeros_like(x[0])
    for b in range(high - 1, low - 1, -1):
        for c in x:
            place = (place << np.uint64(1)) | ((c >> np.uint64(b)) & np.uint64(1))
    return place.astype(np.int64)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cell numbers (n x d, each below 2**bits) on the Hilbert curve."""
    return _place(_along(cells, bits), bits, 0)


def curve_keys(vectors: np.ndarray, mean: np.ndarray, reach: float, curve: int) -> list[np.ndarray]:
    """Place of each vector on one curve, as LEVELS numbers, coarse to fine; the curve's number fixes its directions and
    its shift. No vector is further than `reach` from the mean, so none leaves the cells."""
    size, bits = vectors.shape[1], BITS * LEVELS
    rng = np.random.default_rng([curve, size])
    wide = min(DIMENSIONS, size)
    directions = np.linalg.qr(rng.normal(size=(size, wide)))[0]
    shift = rng.uniform(0.25, 0.75, wide)
    cells = (((vectors - mean) / (4 * reach)) @ directions + shift) * float(1 << bits)
    along = _along(np.clip(cells, 0, (1 << bits) - 1).astype(np.int64), bits)  # the clip is for rounding
    return [_place(along, high, high - BITS) for high in range(bits, 0, -BITS)]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors of one length as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and vectors of several small batches at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        held.append((batch.column(0).to_numpy(), _matrix(batch.column(1), size)))
        if sum(v.size for _, v in held) >= GATHERED:
            yield np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held])
            held = []
    if held:
        yield np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held])


def search(vectors: DataFrame, key: str, vector: str, asked: Column, k: int = 10, curves: int = CURVES,
           spread: float = SPREAD) -> DataFrame:
    """`query_id`, `rank`, `vec_id` and `score` (Euclidean distance) of the `k` nearest found for each row where `asked`
    holds (an expression over the column `id`, the key)."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).filter(
        F.col("id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    rows = rows.select("id", "v", F.size("v").alias("size"), F.xxhash64("v").alias("h1"), F.xxhash64(F.reverse("v"), F.lit(1)).alias("h2"))
    keys = ["size", "h1", "h2"]
    named = rows.select("id", *keys)
    firsts = named.groupBy(*keys).agg(F.min("id").alias("rep"))
    points = session.staged(rows.alias("r").join(firsts.alias("f"), [F.col(f"r.{c}") == F.col(f"f.{c}") for c in keys]
                                                 + [F.col("r.id") == F.col("f.rep")])
                            .select("r.size", "r.id", "r.h1", "r.h2", "r.v").dropDuplicates([*keys, "id"])
                            .select("size", F.col("id").alias("own"), F.xxhash64("h1", "h2").alias("point"), "v"), "ann-points")
    # a key may stand at several vectors: `point` tells them apart
    copies = _copies(named, keys, k)
    asks = session.staged(named.filter(asked).distinct().select("id", "size", F.xxhash64("h1", "h2").alias("point")), "ann-queries")
    sizes = [r.size_ for r in points.groupBy(F.col("size").alias("size_")).agg(F.lit(1)).limit(MOST_LENGTHS + 1).collect()]
    if len(sizes) > MOST_LENGTHS:
        raise ValueError(f"vectors of more than {MOST_LENGTHS} lengths")
    near = None
    for size in sorted(sizes):
        part = _nearest(points.filter(F.col("size") == size), asks.filter(F.col("size") == size).select("point").distinct(), size, k,
                        curves, spread)
        near = part if near is None else near.unionByName(part)
    itself = asks.select("id", "size", F.col("point").alias("found"), F.lit(0.0).alias("score"))
    if near is not None:
        itself = itself.unionByName(asks.join(near, ["size", "point"]).select("id", "size", "found", "score"))
    every = (itself.join(copies, (F.col("found") == F.col("point")) & (itself["size"] == copies["size"]))
             .filter(F.col("id") != F.col("copy"))
             .groupBy(F.col("id").alias("query_id"), F.col("copy").alias("vec_id")).agg(F.min("score").alias("score")))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _copies(named: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The smallest k + 1 keys of each point; Spark limits them in each task before it shuffles."""
    order = Window.partitionBy(*keys).orderBy("id")
    return (named.distinct().withColumn("nr", F.row_number().over(order)).filter(F.col("nr") <= k + 1)
            .select("size", F.xxhash64("h1", "h2").alias("point"), F.col("id").alias("copy")))


def _nearest(points: DataFrame, asked: DataFrame, size: int, k: int, curves: int, spread: float) -> DataFrame:
    """`size`, `point`, `found` and `score`: the k nearest other points found for each asked point."""
    count, mean, reach = _moments(points, size)
    levels = [f"place{i}" for i in range(LEVELS)]
    block = max(LEAST_BLOCK, int(np.ceil(spread * np.sqrt(count))))
    last = max(0, (count - 1) // block)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, own in _gathered(batches, size):
            for curve in range(curves):
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.full(len(own), curve, np.int32)),
                                                  *map(pa.array, curve_keys(own, mean, reach, curve))], names=["point", "curve", *levels])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.full(n, task, np.int32)), pa.array(np.arange(at, at + n))],
                                             names=["point", "curve", "task", "at"])
            at += n

    # what even the finest cells do not tell apart stands in another order on each curve
    order = ["curve", *levels, F.xxhash64("point", "curve"), "point"]
    ordered = session.staged(points.select("point", "v")
                             .mapInArrow(places, "point long, curve int, " + ", ".join(f"{c} long" for c in levels))
                             .repartitionByRange(*order).sortWithinPartitions(*order).select("point", "curve").mapInArrow(numbered, "point long, curve int, task int, at long"), "ann-order")
    # one row for each task of the sort
    ends = sorted((r.task, r.n) for r in ordered.groupBy("task").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for task, n in ends:
        starts.append((task, total))
        total += n
    offsets = F.broadcast(points.sparkSession.createDataFrame(starts, "task int, start long"))
    blocked = ordered.join(offsets, "task").select("point", F.struct("curve", (
        (F.col("start") + F.col("at") - F.col("curve").cast("long") * count) / block).cast("long").alias("block")).alias("place"))
    # a point has one place on each curve
    along = blocked.groupBy("point").agg(F.collect_list("place").alias("places"))
    placed = points.select("point", "v").join(along, "point").join(asked.withColumn("asks", F.lit(True)), "point", "left")
    window = _window(points, asked, blocked, size, k)
    own = placed.select("point", "v", F.lit(False).alias("asks"), F.explode("places").alias("p"))
    asks = (placed.filter("asks").select("point", "v", F.lit(True).alias("asks"), F.explode("places").alias("p"))
            .select("point", "v", "asks", F.explode(F.transform(
                F.sequence(F.greatest(F.lit(0).cast("long"), F.col("p.block") - window),
                           F.least(F.lit(last).cast("long"), F.col("p.block") + window)),
                lambda b: F.struct(F.col("p.curve").alias("curve"), b.alias("block")))).alias("p")))

    def compared(table: pa.Table) -> pa.Table:
        flags = table.column("asks").to_numpy()
        ids, values = table.column("point").to_numpy(), _matrix(table.column("v"), size)
        names, there = ids[~flags], values[~flags]
        left, found, scores = [], [], []
        for name, value in zip(ids[flags], values[flags], strict=True):
            away = np.sqrt(((there - value) ** 2).sum(axis=1))
            away[names == name] = np.inf
            best = _least(away, min(k, len(away)))
            best = best[np.isfinite(away[best])]
            left.append(np.full(len(best), name))
            found.append(names[best])
            scores.append(away[best])
        none = np.empty(0)
        return pa.table({"point": np.concatenate([none.astype(np.int64), *left]), "found": np.concatenate([none.astype(np.int64), *found]),
                         "score": np.concatenate([none, *scores])})

    found = (own.unionByName(asks).select("point", "v", "asks", "p.curve", "p.block").groupBy("curve", "block")
             .applyInArrow(compared, "point long, found long, score double"))
    # all that is as near as the k-th stays, so that ties are settled by keys later
    order = Window.partitionBy("point").orderBy("score")
    return (found.groupBy("point", "found").agg(F.min("score").alias("score")).withColumn("nr", F.rank().over(order))
            .filter(F.col("nr") <= k).select(F.lit(size).alias("size"), "point", "found", "score"))


def _window(points: DataFrame, asked: DataFrame, blocked: DataFrame, size: int, k: int) -> int:
    """Blocks on either side that a query meets: the fewest with which `RECALL` of the true neighbours of a sample of queries
    are in reach on some curve. The sample is bounded, and compared with every point."""
    chosen = asked.orderBy(F.xxhash64("point", F.lit(1)), "point").limit(SAMPLE)
    sample = points.select("point", "v").join(F.broadcast(chosen), "point").toArrow()
    if not sample.num_rows:
        return 1
    names, vectors = sample.column("point").to_numpy(), _matrix(sample.column("v"), size)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, scores = np.zeros((len(names), 0), np.int64), np.zeros((len(names), 0))
        for batch in batches:
            ids, there = batch.column(0).to_numpy(), _matrix(batch.column(1), size)
            away = np.stack([np.sqrt(((there - v) ** 2).sum(axis=1)) for v in vectors])
            away[names[:, None] == ids] = np.inf
            scores, found = np.concatenate((scores, away), axis=1), np.concatenate((found, np.broadcast_to(ids, away.shape)), axis=1)
            best = np.argsort(scores, axis=1)[:, :k]
            scores, found = np.take_along_axis(scores, best, 1), np.take_along_axis(found, best, 1)
        flat = scores.reshape(-1)
        there = np.isfinite(flat)
        yield pa.RecordBatch.from_arrays([pa.array(x[there]) for x in (np.repeat(names, scores.shape[1]), found.reshape(-1), flat)],
                                         names=["point", "found", "score"])

    order = Window.partitionBy("point").orderBy("score", "found")
    true = (points.select("point", "v").mapInArrow(nearest, "point long, found long, score double")
            .withColumn("nr", F.row_number().over(order)).filter(F.col("nr") <= k).select("point", "found").toArrow())
    if not true.num_rows:
        return 1
    pairs = np.stack([true.column(i).to_numpy() for i in range(2)])
    members, at = np.unique(pairs, return_inverse=True)
    wanted = points.sparkSession.createDataFrame(pa.table({"point": members}))
    seen = blocked.join(F.broadcast(wanted), "point").select("point", "place.curve", "place.block").toArrow()
    blocks = np.zeros((len(members), seen.column("curve").to_numpy().max() + 1), np.int64)
    blocks[np.searchsorted(members, seen.column("point").to_numpy()), seen.column("curve").to_numpy()] = seen.column("block").to_numpy()
    query, found = at.reshape(2, -1)
    apart = np.abs(blocks[query] - blocks[found]).min(axis=1)
    return max(1, int(np.quantile(apart, RECALL, method="inverted_cdf")))


def _least(away: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k smallest and of all that tie with the k-th."""
    return np.flatnonzero(away <= np.partition(away, k - 1)[k - 1])


def _moments(points: DataFrame, size: int) -> tuple[int, np.ndarray, float]:
    """Number of points, mean vector, and a distance from it that no point exceeds."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, most = 0, np.zeros(size), 0.0
        for batch in batches:
            own = _matrix(batch.column(0), size)
            if len(own):
                n, first, most = n + len(own), first + own.sum(axis=0), max(most, float(np.abs(own).max()))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([first]), pa.array([most])], names=["n", "first", "most"])

    parts = points.select("v").mapInArrow(sums, "n long, first array<double>, most double")
    n, first, most = 0, np.zeros(size), 0.0
    for row in parts.toLocalIterator():  # one row for each task
        n, first, most = n + row.n, first + np.array(row.first), max(most, row.most)
    mean = first / n
    return n, mean, max(float(np.sqrt(size) * (most + np.abs(mean).max())), 1e-300)
