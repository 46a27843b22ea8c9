"""Token sequences packed into rows of one length.

Sequences longer than a row are cut, without loss, into pieces of a row and a rest. Every task packs the pieces it has, a
pool of at most `POOL` tokens at a time: longest first, each into the row with the least room that still holds it
(best fit). A segment tree over the possible amounts of room finds that row in log(length) steps.

A row holds `input_ids` (little-endian numbers, padded to the full length: the rows of a file stacked are the id matrix),
`cu_seqlens` (where segments start and end, from 0 to the number of tokens in use) and `position_ids` (0, 1, 2, ... from
each segment's start; 0 in the padding), and for each segment its `keys` and `starts` (place in its sequence), from which
the sequences can be put together again.

Cases: null and empty sequences give no segment. A null key stays null. Repeated rows are packed one by one. Further columns are
ignored. Rows depend on how the input is partitioned; what they hold together does not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 2048
POOL = 4_000_000
_SCHEMA = ("pack_id long, n_tokens int, input_ids binary, cu_seqlens array<int>, position_ids binary, "
           "keys array<{kind}>, starts array<long>")


class Rooms:
    """Open rows by the room they have left, from 0 to `length`; finds the least room of at least a size."""

    def __init__(self, length: int) -> None:
        self.leaves = 1 << length.bit_length()
        self.filled = [0] * (2 * self.leaves)      # rows below each node
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        self._count(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """A row with the least sufficient room, and that room."""
        node = size + self.leaves
        if not self.filled[node]:
            # up to the first node that has a filled neighbour on its right, then down to that one's first leaf
            while node > 1 and (node & 1 or not self.filled[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                node += not self.filled[node]
        room = node - self.leaves
        self._count(room, -1)
        return self.rows[room].pop(), room

    def _count(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.filled[node] += by
            node >>= 1


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of indices into `sizes` (each between 1 and `length`), longest pieces first."""
    rooms, out = Rooms(length), []
    for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = rooms.take(sizes[at])
        if found is None:
            found = len(out), length
            out.append([])
        out[found[0]].append(at)
        rooms.put(found[0], found[1] - sizes[at])
    return out


def pack(coded: DataFrame, key: str, ids: str, length: int = LENGTH, pad: int = 0, vocabulary: int = 1 << 16,
         pool: int = POOL) -> DataFrame:
    """Pack the sequences of `ids`. Numbers take two bytes if the vocabulary and the length fit, else four."""
    kind = coded.schema[key].dataType.simpleString()
    number = np.dtype("<u2" if max(vocabulary, length, pad + 1) <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens, at, base = [], 0, 0, TaskContext.get().partitionId() << 32
        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type
            lists = batch.column(1)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for name, start, end in zip(batch.column(0).to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                for cut in range(start, end, length):
                    held.append((name, cut - start, flat[cut:min(cut + length, end)].astype(number)))
                    tokens += len(held[-1][2])
                    if tokens >= pool:
                        yield _rows(held, length, pad, number, base + at, key_type)
                        at, held, tokens = at + len(held), [], 0
        if held:
            yield _rows(held, length, pad, number, base + at, key_type)

    rows = coded.select(F.col(key).alias("key"), F.coalesce(F.col(ids).cast("array<int>"), F.expr("cast(array() as array<int>)")).alias("ids"))
    return rows.mapInArrow(run, _SCHEMA.format(kind=kind))


def _rows(held: list, length: int, pad: int, number: np.dtype, first: int, key_type: pa.DataType) -> pa.RecordBatch:
    rows = best_fit([len(h[2]) for h in held], length)
    matrix = np.full((len(rows), length), pad, number)
    places = np.zeros((len(rows), length), number)
    count = np.arange(length, dtype=number)
    ends: list[list[int]] = []
    for r, row in enumerate(rows):
        at, own = 0, [0]
        for i in row:
            ids = held[i][2]
            matrix[r, at:at + len(ids)] = ids
            places[r, at:at + len(ids)] = count[:len(ids)]
            at += len(ids)
            own.append(at)
        ends.append(own)
    return pa.RecordBatch.from_arrays([
        pa.array(range(first, first + len(rows)), pa.int64()), pa.array([e[-1] for e in ends], pa.int32()),
        pa.array([m.tobytes() for m in matrix], pa.binary()), pa.array(ends, pa.list_(pa.int32())),
        pa.array([p.tobytes() for p in places], pa.binary()),
        pa.array([[held[i][0] for i in row] for row in rows], pa.list_(key_type)),
        pa.array([[held[i][1] for i in row] for row in rows], pa.list_(pa.int64()))],
        names=["pack_id", "n_tokens", "input_ids", "cu_seqlens", "position_ids", "keys", "starts"])


def write(packs: DataFrame, folder: str) -> None:
    """Write packed rows to `folder`, a Parquet table: each row group is a block of the id matrix with its segment lengths."""
    packs.write.parquet(folder)


def unpack(packs: DataFrame, bytes_each: int = 2) -> DataFrame:
    """`key`, `start` and `ids` of every segment."""
    number = np.dtype("<u2" if bytes_each == 2 else "<u4")
    kind = packs.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, starts, out = [], [], []
            for ids, ends, names, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = np.frombuffer(ids, number)
                keys += names
                starts += places
                out += [row[a:b].astype(np.int32) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(2).type.value_type), pa.array(starts, pa.int64()),
                                              pa.array(out, pa.list_(pa.int32()))], names=["key", "start", "ids"])

    return packs.select("input_ids", "cu_seqlens", "keys", "starts").mapInArrow(run, f"key {kind}, start long, ids array<int>")
