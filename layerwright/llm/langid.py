"""Language identification by rank-order profiles.

A profile lists the most frequent character n-grams of a language in order of frequency. A document's own list is
compared with every profile: each of its n-grams costs the difference of the two ranks, or the length of a profile
if the profile lacks it (out-of-place distance). The language with the smallest distance wins.

Cases: a null text, or one without letters, is `und` with score 0; so is every text when nothing could be learned.
Texts of any length are read whole. Ties between n-grams go to the smaller code points, ties between languages to the
smaller name. Repeated rows are answered one by one, and further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerwright import session
from layerwright.llm.common import map_batches

PROFILE = 400          # n-grams in the list of a language and of a document
MOST_LANGUAGES = 8192  # more names than there are languages: then the column does not hold languages
UNKNOWN = "und"
_EDGE = 1              # stands for everything between words
_BITS = 21             # of a code point
_FLUSH = 2_000_000     # n-grams a task gathers before it passes them on


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray:
    """All 1- to 3-grams of the letters of a text, with one edge mark between words, as 63-bit numbers."""
    if not text:
        return np.empty(0, np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64)
    marked = np.where(letter, codes, _EDGE).astype(np.int64)
    marked = np.concatenate(([_EDGE], marked, [_EDGE]))
    marked = marked[np.concatenate(([True], (marked[1:] != _EDGE) | (marked[:-1] != _EDGE)))]
    pairs = (marked[:-1] << _BITS) | marked[1:]
    threes = (pairs[:-1] << _BITS) | marked[2:]
    return np.concatenate((marked[marked != _EDGE], pairs, threes))


def ranked(keys: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent keys, most frequent first."""
    return keys[np.lexsort((keys, -counts))[:size]]


def profiles(docs: DataFrame, text: str, lang: str, size: int = PROFILE) -> dict[str, np.ndarray]:
    """Learn a list of n-grams for every language of `docs`; rows without language or letters teach nothing.

    Counts cover all rows. Only the final lists reach the driver: `size` n-grams for each language.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            by: dict[str, list[np.ndarray]] = {}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(name, []).append(grams(value))
            for name, parts in by.items():
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                held[name] = _merged(held[name], (keys, counts)) if name in held else (keys, counts)
            if sum(len(keys) for keys, _ in held.values()) > _FLUSH:
                yield _counted(held)
                held = {}
        if held:
            yield _counted(held)

    known = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    total = (known.mapInArrow(count, "lang string, gram long, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = session.staged(total.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size), "profiles")
    names = top.select("lang").distinct().limit(MOST_LANGUAGES + 1).count()
    if names > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages in column {lang}")
    lists: dict[str, list[tuple[int, int]]] = {}
    for row in top.select("lang", "rank", "gram").collect():
        lists.setdefault(row.lang, []).append((row.rank, row.gram))
    return {name: np.array([g for _, g in sorted(items)], np.int64) for name, items in sorted(lists.items())}


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate((a[0], b[0])), return_inverse=True)
    return keys, np.bincount(at, np.concatenate((a[1], b[1])), len(keys)).astype(np.int64)


def _counted(held: dict[str, tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    names = pa.array([name for name, (keys, _) in held.items() for _ in range(len(keys))], pa.string())
    return pa.RecordBatch.from_arrays(
        [names, pa.array(np.concatenate([k for k, _ in held.values()])),
         pa.array(np.concatenate([c for _, c in held.values()]).astype(np.int64))], names=["lang", "gram", "n"])


class Profiles:
    """Learned lists, laid out for comparison."""

    def __init__(self, lists: dict[str, np.ndarray], size: int = PROFILE) -> None:
        self.names, self.size = sorted(lists), size
        self.known = np.unique(np.concatenate([np.empty(0, np.int64), *lists.values()]))
        # the last column is for n-grams that no profile has
        self.rank = np.full((len(self.names), len(self.known) + 1), -1, np.int32)
        for i, name in enumerate(self.names):
            self.rank[i, np.searchsorted(self.known, lists[name])] = np.arange(len(lists[name]))

    def compare(self, text: str | None) -> tuple[str, float]:
        """The nearest language, and 1 minus the distance as a share of the largest one possible."""
        own = grams(text)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        own = ranked(*np.unique(own, return_counts=True), self.size)
        at = np.searchsorted(self.known, own)
        at[at == len(self.known)] = 0
        at = np.where(self.known[at] == own, at, len(self.known))
        there = self.rank[:, at]
        away = np.where(there < 0, self.size, np.abs(there - np.arange(len(own), dtype=np.int32))).sum(axis=1)
        best = int(away.argmin())
        return self.names[best], float(1 - away[best] / (self.size * len(own)))


def detect(docs: DataFrame, learned: Profiles, key: str, text: str) -> DataFrame:
    """One row per row of `docs`: the key, `lang_pred` and `score`."""
    def run(batch: pa.RecordBatch) -> dict[str, object]:
        found = [learned.compare(t) for t in batch.column(1).to_pylist()]
        return {"id": batch.column(0), "lang_pred": pa.array([f[0] for f in found], pa.string()),
                "score": pa.array([f[1] for f in found], pa.float64())}

    kind = docs.schema[key].dataType.simpleString()
    out = map_batches(docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")), run,
                      f"id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("id", key)


def keep_known(docs: DataFrame, learned: Profiles, text: str) -> DataFrame:
    """The rows of `docs` that `detect` does not call `und`, with all their columns. Where nothing could be learned, every text
    with a letter stays."""
    at = docs.columns.index(text)
    known = (lambda t: learned.compare(t)[0] != UNKNOWN) if learned.names else lambda t: len(grams(t)) > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([known(t) for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
