"""A quality classifier by compression.

Two zstandard dictionaries are built, from texts labelled good and from texts labelled bad. A text that the good dictionary
compresses further than the bad one reads like the good texts. The text is compressed in blocks, so that a
dictionary counts in all parts of a long text, and the difference of the two sizes, divided by the length of the text, is
the only feature. A logistic curve, fitted to labelled texts that the dictionaries have not seen and shifted to
the share of good labels, turns it into a probability.

The fit takes a bounded sample: at most `SAMPLE` rows of each label, those with the smallest hash of their key, and
at most `BLOCKS_PER_TEXT` blocks of each, evenly spaced. Scores are made from whole texts.

Cases: null and empty texts have difference 0. Keys with labels that contradict each other teach nothing. Without labels of
both kinds every score is 0.5. Repeated rows are scored one by one; further columns of the input are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm.common import map_batches

SAMPLE = 3000
DICTIONARY = 256 << 10
BLOCK = 512            # bytes: about as much as a dictionary helps before a text is its own dictionary
BLOCKS_PER_TEXT = 32
LEVEL = 3
THRESHOLD = 0.7


def blocks(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8", "replace")
    return [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    trained = zstandard.ZstdCompressionDict(dictionary)
    trained.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=False, write_dict_id=False)


def difference(good: bytes, bad: bytes, parts: list[bytes]) -> float:
    """How much smaller the good dictionary makes the blocks of a text than the bad one does, as a share of their length."""
    if not parts:
        return 0.0
    by_good, by_bad = _compressor(good), _compressor(bad)
    saved = sum(len(by_bad.compress(p)) - len(by_good.compress(p)) for p in parts)
    return saved / sum(map(len, parts))


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def score(self, text: str | None) -> float:
        if not self.good:
            return 0.5
        at = self.slope * difference(self.good, self.bad, blocks(text)) + self.offset
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, at))))


NOTHING = Model(b"", b"", 0.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, allowed: Column) -> Model:
    """Learn from rows of `labels` for which `allowed` (over its columns) holds. Its label is 1 for good, 0 for bad."""
    known = (labels.filter(allowed & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("id"))
             .agg(F.min(label).alias("label"), F.max(label).alias("other")).filter(F.col("label") == F.col("other")))
    totals = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return NOTHING
    part = lambda value: (known.filter(F.col("label") == value).select("id", "label", F.xxhash64("id").alias("order"))
                          .orderBy("order", "id").limit(SAMPLE))
    # bounded: two times SAMPLE rows of three numbers
    sample = F.broadcast(part(0).unionByName(part(1)))
    rows = (docs.select(F.col(key).alias("id"), F.col(text).alias("text")).filter(F.length("text") > 0)
            .join(sample, "id").dropDuplicates(["id"]).withColumn("half", F.pmod("order", F.lit(2))))

    def sampled(batch: pa.RecordBatch) -> dict[str, object]:
        parts = []
        for value in batch.column(1).to_pylist():
            own = blocks(value)
            step = max(1, math.ceil(len(own) / BLOCKS_PER_TEXT))
            parts.append(own[::step])
        return {"label": batch.column(0), "half": batch.column(2), "blocks": pa.array(parts, pa.list_(pa.binary())),
                "id": batch.column(3)}

    kind = docs.schema[key].dataType.simpleString()
    cut = map_batches(rows.select("label", "text", "half", "id"), sampled, f"label int, half long, blocks array<binary>, id {kind}")
    groups: dict[tuple[int, int], list[list[bytes]]] = {(a, b): [] for a in (0, 1) for b in (0, 1)}
    for row in cut.orderBy("id").toLocalIterator():
        groups[row.label, row.half].append([bytes(b) for b in row.blocks])
    good, bad = (_trained(groups[value, 0]) for value in (1, 0))
    xs, ys = [], []
    for value in (0, 1):
        for parts in groups[value, 1]:
            xs.append(difference(good, bad, parts))
            ys.append(value)
    if len(set(ys)) < 2:
        return NOTHING
    slope, offset = logistic(np.array(xs), np.array(ys, float))
    seen = (sum(ys) / len(ys), totals[1] / (totals[0] + totals[1]))
    return Model(good, bad, slope, offset + math.log(seen[1] / (1 - seen[1])) - math.log(seen[0] / (1 - seen[0])))


def _trained(texts: list[list[bytes]]) -> bytes:
    samples = [b for parts in texts for b in parts]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples to choose from: they are the dictionary
        return b"".join(samples)[-DICTIONARY:]


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with targets drawn in a little so that a perfect split stays finite."""
    up, down = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    goal, scale = np.where(y > 0, up, down), max(float(np.abs(x).max()), 1e-9)
    a = np.stack([x / scale, np.ones_like(x)], 1)
    w = np.zeros(2)

    def loss(v: np.ndarray) -> float:
        z = a @ v
        return float(np.logaddexp(0, z).sum() - goal @ z)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -700, 700)))
        h = a.T @ (a * (p * (1 - p))[:, None]) + 1e-9 * np.eye(2)
        step, size = np.linalg.solve(h, a.T @ (p - goal)), 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(step).max() * size < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def score(docs: DataFrame, model: Model, key: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: the key, `score` and `predicted`."""
    def run(batch: pa.RecordBatch) -> dict[str, object]:
        found = [model.score(t) for t in batch.column(1).to_pylist()]
        return {"id": batch.column(0), "score": pa.array(found, pa.float64()),
                "predicted": pa.array([int(s >= threshold) for s in found], pa.int32())}

    kind = docs.schema[key].dataType.simpleString()
    out = map_batches(docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")), run,
                      f"id {kind}, score double, predicted int")
    return out.withColumnRenamed("id", key)
