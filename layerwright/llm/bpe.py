"""Byte-level BPE over overlapping chunks.

A text of up to `CHUNK` code points is one chunk. A longer one is cut into chunks that overlap. Each chunk is split into
pre-tokens in a task of its own; the split of a chunk is only right from the first pre-token boundary that it
shares with the split of the chunk before, since from a shared boundary on both read the same text. The text between
two such places is a piece; pieces are encoded in parallel and their ids joined in order. Places after white space are
passed over, as the pattern treats white space at an end differently. Where an overlap holds no shared boundary (a run
of letters longer than the overlap, say), the rest of the text is one piece.

Cases: runs of white space of any length are encoded as the pattern splits them. A null text counts as empty and has no ids. Equal rows are answered as often as they occur; rows that share a
key but not the text are kept apart. Further columns of the input are ignored. The vocabulary file is a parameter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright import session
from layerwright.llm.common import map_batches

CHUNK = 65_536   # code points
OVERLAP = 512
# A boundary closer to the end of a chunk may be due to the cut: the pattern looks this far beyond a match.
LOOK_AHEAD = 4
# Runs of white space (by the Unicode property) that are encoded on their own.
_SPACES = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}+")


class Vocabulary:
    """A file of ranks on the driver and the pattern that splits text before the merges; tasks get the file by Spark."""

    def __init__(self, spark, path: str, pattern: str) -> None:
        self.name, self.pattern = path.rsplit("/", 1)[-1], pattern
        with open(path, "rb") as f:
            self.size = 1 + max((int(line.split()[1]) for line in f), default=-1)
        if not any(f.rsplit("/", 1)[-1] == self.name for f in spark.sparkContext.listFiles):
            spark.sparkContext.addFile(path)

    def encoder(self) -> tiktoken.Encoding:
        return _encoder(SparkFiles.get(self.name), self.pattern)

    def words(self) -> list[bytes]:
        return _words(SparkFiles.get(self.name))


@lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def _words(path: str) -> list[bytes]:
    ranks = _ranks(path)
    words = [b""] * (max(ranks.values(), default=-1) + 1)
    for word, rank in ranks.items():
        words[rank] = word
    return words


def chunks(text: str, size: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Start and end of each chunk; the last ends with the text."""
    step, out, start = size - overlap, [], 0
    while True:
        out.append((start, min(len(text), start + size)))
        if start + size >= len(text):
            return out
        start += step


def boundaries(chunk: str, start: int, pattern: str) -> list[int]:
    """Where pre-tokens of a chunk end, counted in the whole text; its own start is one too."""
    return [start, *(start + m.end() for m in regex.finditer(pattern, chunk))]


def encode(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The key and `ids` (array of int) of every row."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def whole(batch: pa.RecordBatch) -> dict[str, object]:
        return {"id": batch.column(0), "ids": _encoded(vocabulary.encoder(), batch.column(1).to_pylist())}

    short = map_batches(rows.filter(F.length("text") <= size), whole, f"id {kind}, ids array<int>")
    long = _encode_long(rows.filter(F.length("text") > size), vocabulary, kind, size, overlap)
    return short.unionByName(long).withColumnRenamed("id", key)


def _ids(encoder: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a text. A long run of white space is taken out first, as the library's search for it goes too deep: the pattern
    makes one pre-token of all of the run at the end of a text, else of all but its last character, which may join what follows."""
    out, at = [], 0
    for run in _SPACES.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += [encoder.encode_to_numpy(text[at:run.start()], disallowed_special=()),
                np.array(encoder._encode_single_piece(text[run.start():end]), np.uint32)]
        at = end
    return np.concatenate([*out, encoder.encode_to_numpy(text[at:], disallowed_special=())]) if out else (
        encoder.encode_to_numpy(text, disallowed_special=()))


def _encoded(encoder: tiktoken.Encoding, texts: list[str]) -> pa.Array:
    found = [_ids(encoder, t) for t in texts]
    ends = np.cumsum([0, *map(len, found)])
    flat = np.concatenate([np.empty(0, np.uint32), *found]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def _encode_long(rows: DataFrame, vocabulary: Vocabulary, kind: str, size: int, overlap: int) -> DataFrame:
    pattern = vocabulary.pattern

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                value = batch.column(1)[at].as_py()
                spans = chunks(value, size, overlap)
                for first in range(0, len(spans), 64):
                    part = spans[first:first + 64]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([batch.column(0)[at].as_py()] * len(part), batch.schema.field(0).type),
                        pa.array([batch.column(2)[at].as_py()] * len(part), pa.string()),
                        pa.array(range(first, first + len(part)), pa.int32()),
                        pa.array([s for s, _ in part], pa.int64()), pa.array([e for _, e in part], pa.int64()),
                        pa.array([value[s:e] for s, e in part], pa.string())],
                        names=["id", "text_key", "chunk", "start", "end", "text"])

    # equal rows become one with a count; the digest keeps rows of one key but other texts apart
    once = (rows.withColumn("text_key", F.sha2("text", 256)).groupBy("id", "text_key")
            .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("times")))
    times = once.select("id", "text_key", "times")
    cuts = (once.select("id", "text", "text_key")
            .mapInArrow(cut, f"id {kind}, text_key string, chunk int, start long, end long, text string")
            .repartition("id", "text_key", "chunk"))

    def split(batch: pa.RecordBatch) -> dict[str, object]:
        heads, tails = [], []
        for start, end, value in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5)), strict=True):
            ends = boundaries(value, start, pattern)
            heads.append([b for b in ends if b <= start + overlap - LOOK_AHEAD])
            tails.append([b for b in ends if max(start + 1, end - overlap) <= b <= end - LOOK_AHEAD
                          and not value[b - start - 1].isspace()])
        return {"id": batch.column(0), "text_key": batch.column(1), "chunk": batch.column(2), "start": batch.column(3),
                "head": pa.array(heads, pa.list_(pa.int64())), "tail": pa.array(tails, pa.list_(pa.int64()))}

    # kept: two sides of a join read them
    marks = session.staged(map_batches(cuts, split, f"id {kind}, text_key string, chunk int, start long, head array<long>, tail array<long>"),
                           "bpe-marks")
    same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in ("id", "text_key")]
    # `from`: the shared boundary with the chunk before. Where there is none, the chunk's own split is not to be trusted,
    # nor what follows from it: the rest of the text is one piece.
    left = marks.select("id", "text_key", (F.col("chunk") + 1).alias("chunk"), "tail")
    met = (marks.alias("m").join(left.alias("l"), [*same("m", "l"), F.col("m.chunk") == F.col("l.chunk")], "left")
           .select("m.id", "m.text_key", "m.chunk", F.when(F.col("m.chunk") == 0, F.col("m.start")).otherwise(
               F.array_min(F.array_intersect("m.head", "l.tail"))).alias("from")))
    begins = (met.groupBy("id", "text_key")
              .agg(F.min(F.when(F.col("from").isNull(), F.col("chunk"))).alias("lost"),
                   F.array_sort(F.collect_list(F.struct("from", "chunk"))).alias("all"))
              .select("id", "text_key", F.expr(
                  "filter(all, x -> x.from IS NOT NULL AND (lost IS NULL OR x.chunk < lost))").alias("begins")))

    def wholes(batch: pa.RecordBatch) -> dict[str, object]:
        return {"id": batch.column(0), "text_key": batch.column(1), "from": batch.column(2),
                "ids": _encoded(vocabulary.encoder(), batch.column(3).to_pylist())}

    # the chunks that a piece touches, cut to the piece and put together
    touched = (cuts.alias("c").join(begins.alias("b"), same("c", "b")).select(
        "c.*", F.posexplode(F.col("b.begins")).alias("nr", "begin"), F.col("b.begins").alias("begins"))
        .withColumn("to", F.get(F.col("begins"), F.col("nr") + 1)["from"])
        .withColumn("last", F.get(F.col("begins"), F.col("nr") + 1)["chunk"])
        .filter((F.col("chunk") >= F.col("begin.chunk"))
                & (F.col("last").isNull() | (F.col("chunk") < F.col("last")))))
    low = F.when(F.col("chunk") == F.col("begin.chunk"), F.col("begin.from")).otherwise(F.col("start") + F.lit(overlap))
    high = F.when(F.col("chunk") == F.col("last") - 1, F.col("to")).otherwise(F.col("end"))
    slices = touched.select("id", "text_key", F.col("begin.from").alias("from"), "chunk", F.substring(
        "text", (low - F.col("start") + 1).cast("int"), (high - low).cast("int")).alias("text"))
    pieces = (slices.groupBy("id", "text_key", "from")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "text"))),
                                            lambda x: x["text"]), "").alias("text")))
    coded = map_batches(pieces, wholes, f"id {kind}, text_key string, from long, ids array<int>")
    joined = (coded.groupBy("id", "text_key").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("from", "ids"))), lambda x: x["ids"])).alias("ids")))
    return (joined.alias("j").join(times.alias("t"), same("j", "t"))
            .select("j.id", "j.ids", F.explode(F.sequence(F.lit(1), F.col("t.times"))).alias("nr")).drop("nr"))


def decode(coded: DataFrame, vocabulary: Vocabulary, ids: str, into: str = "bytes") -> DataFrame:
    """Add the concatenated bytes of each row's ids as `into`; null ids are no ids. An id outside the vocabulary is an error."""
    rest = [c for c in coded.columns if c != into]
    rows = coded.select(*[F.col(f"`{c}`") for c in rest])
    at = rest.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.words()
        for batch in batches:
            lists = batch.column(at)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            out = [b"".join([words[i] for i in flat[a:b].tolist()])
                   for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*rest, into])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, `{into}` binary")
