"""Cross-entropy difference of two matched word models.

The target model is counted over chosen texts, the background model over all texts; both have the same tokens, the same
vocabulary and the same smoothing, so the difference of their losses is down to the counts alone. A document's score is the
mean over its tokens of background loss minus target loss: above 0 it reads more like the target.

Tokens are words (runs of letters, digits and marks, in lower case), single characters of scripts that write no spaces, other
characters that are no space, and an edge before and after each text. Words and pairs of words are 64-bit hashes. What is
counted grows with the corpus and never meets in one place: texts are read once, in chunks of about `CHUNK` tokens; each
chunk sends its distinct words and pairs with their counts to buckets by their hash, a bucket adds up the counts of all chunks,
and every chunk gets back the totals of its own items. A common item is one row of a chunk, however often it occurs.

Probabilities: p(c | b) = (n(bc) + WEIGHT p(c)) / (n(b) + WEIGHT), and p(c) from the uniform one over the words of all texts.

Cases: a null text is empty and consists of its edge. Without target texts the target model is uniform. Repeated rows count
and are scored one by one. A text longer than a chunk is scored in parts. Further columns of the input are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright import session

WEIGHT = 20.0
CHUNK = 1 << 21    # tokens
BUCKET = 1 << 20   # tokens of the corpus for each bucket: it holds fewer distinct items than that on average
EDGE = np.uint64(0)
_SPACE, _WORD, _ALONE = 0, 1, 2
# scripts that write no spaces between words: Thai to Myanmar, Khmer, kana to ideographs, their later planes
_SPACELESS = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xA4CF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_TABLE = ("chunk long, ids array<{0}>, rows array<long>, befores array<int>, targets array<boolean>, lens array<int>, "
          "codes binary, at binary, n_tokens long, n_target long")


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    word = lambda c: unicodedata.category(c)[0] in "LNM"
    kinds = np.fromiter((_WORD if word(c) else _SPACE if c.isspace() or unicodedata.category(c) == "Cc" else _ALONE
                         for c in map(chr, range(0x110000))), np.uint8, 0x110000)
    for low, high in _SPACELESS:
        part = kinds[low:high + 1]
        part[part == _WORD] = _ALONE
    return kinds


def _mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix: a one-to-one scramble of 64-bit numbers."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> np.ndarray:
    """An even number for each token, the edge last."""
    letters = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    kinds = _kinds()[letters]
    first = (kinds == _ALONE) | ((kinds == _WORD) & np.concatenate(([True], kinds[:-1] != _WORD)))
    there = kinds != _SPACE
    starts = np.flatnonzero(first[there])
    if not len(starts):
        return np.array([EDGE])
    letters = letters[there].astype(np.uint64)
    place = np.arange(len(letters), dtype=np.uint64) - np.repeat(starts, np.diff(starts, append=len(letters))).astype(np.uint64)
    code = _mixed(np.add.reduceat(_mixed(letters | (place << np.uint64(21))), starts)) & ~np.uint64(1)
    return np.append(np.where(code == EDGE, np.uint64(2), code), EDGE)


def read(docs: DataFrame, key: str, text: str, target: Column) -> DataFrame:
    """The texts as chunks, one row each: the distinct words of a chunk, and its tokens as places among them. Written, so that
    chunks stay the same. `target` marks the rows of the target model."""
    most = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, chunk, row, held, size = TaskContext.get().partitionId() << 40, 0, 0, [], 0
        for batch in batches:
            for own, value, chosen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens, before = words(value), EDGE
                for at in range(0, len(tokens), most):
                    part = tokens[at:at + most]
                    if held and size + len(part) > most:
                        yield _chunk(first + chunk, held, batch.schema.field(0).type)
                        chunk, held, size = chunk + 1, [], 0
                    held.append((own, first + row, before, chosen, part))
                    size, before = size + len(part), part[-1]
                row += 1
        if held:
            yield _chunk(first + chunk, held, batch.schema.field(0).type)

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"), F.coalesce(target, F.lit(False)).alias("target"))
    return session.staged(rows.mapInArrow(run, _TABLE.format(kind)), "lm-chunks")


def _chunk(number: int, held: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    ids, rows, befores, targets, parts = zip(*held, strict=True)
    lens = np.array([len(p) for p in parts], np.int32)
    tokens = np.concatenate([np.array(befores, np.uint64), *parts])
    codes, at = np.unique(tokens, return_inverse=True)
    before, at = at[:len(ids)].astype(np.int32), at[len(ids):].astype(np.int32)
    one = lambda values, of: pa.array([values], pa.list_(of))
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), one(list(ids), kind), one(np.array(rows), pa.int64()), one(before, pa.int32()), one(list(targets), pa.bool_()),
         one(lens, pa.int32()), pa.array([_packed(np.diff(codes, prepend=EDGE))], pa.binary()), pa.array([_packed(at)], pa.binary()), pa.array([int(lens.sum())]),
         pa.array([int(lens[np.array(targets, bool)].sum())])],
        names=["chunk", "ids", "rows", "befores", "targets", "lens", "codes", "at", "n_tokens", "n_target"])


class _Items:
    """Words and pairs of one chunk. `codes` has the words and then the pairs; `order` sorts them."""

    def __init__(self, table: pa.RecordBatch | pa.Table, i: int) -> None:
        of = lambda name: table.column(name)[i].values.to_numpy(zero_copy_only=False)
        self.lens, self.targets = of("lens"), of("targets").astype(bool)
        self.words = np.cumsum(_unpacked(table.column("codes")[i].as_py(), np.uint64), dtype=np.uint64)
        self.at = _unpacked(table.column("at")[i].as_py(), np.int32)
        self.starts = np.concatenate(([0], np.cumsum(self.lens[:-1], dtype=np.int64)))
        self.before = np.concatenate(([0], self.at[:-1]))
        self.before[self.starts] = of("befores")
        pair = _mixed(self.words[self.before] * np.uint64(0xD6E8FEB86659FD93) + _mixed(self.words)[self.at]) | np.uint64(1)
        pairs, self.one, self.pair = np.unique(pair, return_index=True, return_inverse=True)
        self.codes = np.concatenate((self.words, pairs))
        self.order = np.argsort(self.codes)

    def counts(self) -> np.ndarray:
        """Of each item, in all texts and in the target texts."""
        target = np.repeat(self.targets, self.lens)
        return np.stack([np.concatenate((np.bincount(self.at[of], minlength=len(self.words)),
                                         np.bincount(self.pair[of], minlength=len(self.codes) - len(self.words))))
                         for of in (slice(None), target)])


def _packed(values: np.ndarray) -> bytes:
    """Numbers compressed byte by byte, the bytes of equal weight together: most high ones are zero and cost nothing."""
    data = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True) if data else b""


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.empty(0, kind)
    plain = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def totals(chunks: DataFrame, buckets: int) -> DataFrame:
    """For every chunk and bucket: `n_all` and `n_target` of the chunk's items there over the whole corpus, in the order of their
    hashes, and `n_words`, the distinct words of the bucket."""
    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, chunk in enumerate(batch.column(0).to_pylist()):
                own = _Items(batch, i)
                codes, counts = own.codes[own.order], own.counts()[:, own.order]
                edges = np.searchsorted(((codes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1))
                parts = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(buckets)), pa.array(np.full(buckets, chunk)),
                     pa.array([_packed(np.diff(codes[p], prepend=np.uint64(0))) for p in parts], pa.binary()),
                     *(pa.array([_packed(n[p].astype(np.uint32)) for p in parts], pa.binary()) for n in counts)],
                    names=["bucket", "chunk", "codes", "n_all", "n_target"])

    def add(table: pa.Table) -> pa.Table:
        parts = [np.cumsum(_unpacked(x, np.uint64), dtype=np.uint64) for x in table.column("codes").to_pylist()]
        codes, at = np.unique(np.concatenate(parts), return_inverse=True)
        edges = np.cumsum([0, *map(len, parts)])
        out = {"bucket": table.column("bucket"), "chunk": table.column("chunk"),
               "n_words": pa.array(np.full(len(parts), int((codes & np.uint64(1) == 0).sum())))}
        for name in ("n_all", "n_target"):
            n = np.concatenate([_unpacked(x, np.uint32) for x in table.column(name).to_pylist()])
            n = np.bincount(at, n, len(codes)).astype(np.int64)[at]
            out[name] = pa.array([_packed(n[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())
        return pa.table(out)

    return (chunks.select("chunk", "befores", "targets", "lens", "codes", "at")
            .mapInArrow(items, "bucket long, chunk long, codes binary, n_all binary, n_target binary").groupBy("bucket")
            .applyInArrow(add, "bucket long, chunk long, n_words long, n_all binary, n_target binary"))


def score(docs: DataFrame, key: str, text: str, target: Column) -> DataFrame:
    """One row per row of `docs`: the key, `n_tokens` and `score`."""
    kind, chunks = docs.schema[key].dataType.simpleString(), read(docs, key, text, target)
    every = chunks.agg(F.sum("n_tokens").alias("n_all"), F.sum("n_target").alias("n_target")).first()
    sizes = {name: float(every[name] or 0) for name in ("n_all", "n_target")}
    buckets = max(1, int(sizes["n_all"] // BUCKET))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right, out = right.sort_by("bucket"), []
        known = {name: np.concatenate([_unpacked(x, np.int64) for x in right.column(name).to_pylist()]) for name in sizes}
        different = sum(right.column("n_words").to_pylist())
        own = _Items(left.combine_chunks(), 0)
        b, c = own.before[own.one], own.at[own.one]
        for name, size in sizes.items():
            n = np.empty(len(own.codes))
            n[own.order] = known[name]
            word, pair = n[:len(own.words)], n[len(own.words):]
            p = (word + WEIGHT / different) / (size + WEIGHT)
            out.append(np.log((pair + WEIGHT * p[c]) / (word[b] + WEIGHT)))
        sums = np.add.reduceat((out[1] - out[0])[own.pair], own.starts)
        return pa.table({"row": left.column("rows")[0].values, "id": left.column("ids")[0].values,
                         "n": pa.array(own.lens.astype(np.int64)), "sum": pa.array(sums)})

    parts = (chunks.drop("n_tokens", "n_target").groupBy("chunk").cogroup(totals(chunks, buckets).groupBy("chunk"))
             .applyInArrow(run, f"row long, id {kind}, n long, sum double"))
    return (parts.groupBy("row").agg(F.first("id").alias(key), F.sum("n").alias("n_tokens"), F.sum("sum").alias("sum"))
            .select(key, "n_tokens", (F.col("sum") / F.col("n_tokens")).alias("score")))
