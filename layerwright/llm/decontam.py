"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of all benchmark items. Documents stream through it word by word; it
gives the longest run that ends at each word and also occurs in an item. Where that run is at least as long as a window
(13 words, or a whole item that is shorter), the words of the window are hit. Words that no item has lead back to the
start, so only stretches of known words at least as long as the shortest window are walked.

A window is 13 consecutive words of an item; an item of fewer words, but not none, is one window. A document is contaminated
if at least one word and at least a twentieth of its words are hit.

An automaton is made for each block of items, of at most `BLOCK_WORDS` words (or one item), on the driver, and sent to the tasks.
A larger benchmark takes several blocks; the rows then pass through one after the other and gather the hits of all.

Cases: null and empty texts have no words and no hits. Items without words are ignored; a null item id is left out of the
list of items but still hits. Repeated items and repeated rows change nothing. Other columns of the input are ignored by
`measure` and kept by `keep_clean`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 13
SHARE = 20              # a document is contaminated if hits * SHARE >= words
BLOCK_WORDS = 100_000   # words of one automaton, which then takes less than 100 MB
# ASCII letters in lower case, digits and all bytes of other characters make words; the rest separates them
_TABLE = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


class Automaton:
    """Suffix automaton of several word sequences, with the windows that end in each state."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.code: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.code.setdefault(w, len(self.code)) for w in ws]) for name, ws in items if ws]
        for _, ids in coded:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self.shortest = min((min(len(ids), window) for _, ids in coded), default=0)
        # by state: the windows that are among its runs, as (length, items that hold them)
        self.ends: list[dict[int, set]] = [{} for _ in self.link]
        for name, ids in coded:
            size = min(len(ids), window)
            for state, length in self._walk(ids):
                if length >= size:
                    self.ends[self._holder(state, size)].setdefault(size, set()).add(name)
        # the nearest state with windows, the state itself included, on the way to shorter and shorter runs
        self.near = [-1] * len(self.link)
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            self.near[state] = state if self.ends[state] else self.near[self.link[state]] if self.link[state] >= 0 else -1

    def _extend(self, last: int, c: int) -> int:
        """Add one word after `last`, and return the state of the longest run that now ends here."""
        known = self.next[last].get(c)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, c, known)
        new = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and c not in self.next[last]:
            self.next[last][c] = new
            last = self.link[last]
        if last >= 0:
            known = self.next[last][c]
            self.link[new] = known if self.length[known] == self.length[last] + 1 else self._clone(last, c, known)
        return new

    def _clone(self, last: int, c: int, known: int) -> int:
        copy = self._state(self.length[last] + 1, dict(self.next[known]), self.link[known])
        self.link[known] = copy
        while last >= 0 and self.next[last].get(c) == known:
            self.next[last][c] = copy
            last = self.link[last]
        return copy

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _holder(self, state: int, size: int) -> int:
        """The state whose runs include the last `size` words of a longer run."""
        while self.link[state] >= 0 and self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _walk(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest run that ends at each word."""
        state = length = 0
        for c in ids:
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            following = self.next[state].get(c)
            if following is None:
                state = length = 0
            else:
                state, length = following, length + 1
            yield state, length

    def hits(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans of words (start, end) that windows cover, joined where they touch, and the items of those windows."""
        if not self.shortest or len(text_words) < self.shortest:
            return [], set()
        get = self.code.get
        ids = np.array([get(w, -1) for w in text_words], np.int64)
        edges = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        found: list[tuple[int, int]] = []
        items: set = set()
        for start, end in edges.reshape(-1, 2).tolist():
            if end - start < self.shortest:
                continue
            for at, (state, length) in enumerate(self._walk(ids[start:end].tolist()), start + 1):
                holder = self.near[state] if length >= self.shortest else -1
                while holder >= 0:
                    for size, names in self.ends[holder].items():
                        if size <= length:
                            found.append((at - size, at))
                            items |= names
                    holder = self.near[self.link[holder]]
        return _joined(found), items


def _joined(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def blocks(items: DataFrame, item: str, text: str, window: int = WINDOW) -> Iterator[Automaton]:
    """Automata over all items, at most `BLOCK_WORDS` words in each (or one item). The driver holds one block at a time."""
    rows = items.select(F.col(item).cast("string").alias("id"), F.col(text).cast("string").alias("text")).filter(F.length("text") > 0)
    held: list[tuple[object, list[bytes]]] = []
    size = 0
    for row in rows.toLocalIterator():
        own = words(row.text)
        if held and size + len(own) > BLOCK_WORDS:
            yield Automaton(held, window)
            held, size = [], 0
        held.append((row.id, own))
        size += len(own)
    yield Automaton(held, window)


def measure(docs: DataFrame, items: DataFrame, key: str, text: str, item: str, item_text: str, window: int = WINDOW) -> DataFrame:
    """Key, `n_words`, `spans` (start and end of the word runs that are hit) and `items` (sorted ids) of every row."""
    rows = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("text"))
    hit = _hit(rows, 1, items, item, item_text, window)
    return hit.select(F.col("c0").alias(key), "n_words", "spans", "items")


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RESULT = "n_words long, spans array<struct<start:bigint,end:bigint>>, items array<string>"


def _hit(docs: DataFrame, at: int, items: DataFrame, item: str, item_text: str, window: int) -> DataFrame:
    """`docs` with columns c0, c1, ... and n_words, spans and items added; each block of items passes over the rows once."""
    columns = [f"c{i}" for i in range(len(docs.columns))]
    kinds = ", ".join(f"{c} {f.dataType.simpleString()}" for c, f in zip(columns, docs.schema.fields, strict=True))
    out = docs.toDF(*columns).select("*", F.expr("0L AS n_words"), F.expr(
        "cast(array() as array<struct<start:bigint,end:bigint>>) AS spans"), F.expr("cast(array() as array<string>) AS items"))
    for automaton in blocks(items, item, item_text, window):
        out = out.mapInArrow(_pass(docs.sparkSession.sparkContext.broadcast(automaton), at), f"{kinds}, {_RESULT}")
    return out


def _pass(shared: Broadcast, at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans, names = [], [], []
            for value, before, others in zip(*(batch.column(i).to_pylist() for i in (at, -2, -1)), strict=True):
                own = words(value)
                found, held = shared.value.hits(own)
                counts.append(len(own))
                spans.append(_spans(_joined([*((s["start"], s["end"]) for s in before), *found])))
                names.append(sorted({*others, *(n for n in held if n is not None)}))
            added = [pa.array(counts, pa.int64()), pa.array(spans, _SPAN), pa.array(names, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *added], names=batch.schema.names)

    return run


def _spans(found: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"start": s, "end": e} for s, e in found]


def n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


def over_limit(share: int = SHARE) -> Column:
    """TRUE for a contaminated document."""
    return (n_hit() > 0) & (n_hit() * share >= F.col("n_words"))


def without(text: str, found: list[tuple[int, int]]) -> str:
    """The text without the given runs of words; what stands between two removed words goes as well."""
    data = text.encode("utf-8", "replace")
    flat = np.frombuffer(data.translate(_TABLE), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flat, [False])).astype(np.int8))).reshape(-1, 2)
    out, at = [], 0
    for start, end in found:
        out.append(data[at:edges[start][0]])
        at = int(edges[end - 1][1])
    return b"".join([*out, data[at:]]).decode("utf-8")


def decontaminate(docs: DataFrame, items: DataFrame, text: str, item: str, item_text: str, window: int = WINDOW,
                  share: int = SHARE, cut: bool = True) -> DataFrame:
    """`docs` without the documents whose hits exceed the limit of coverage. With `cut`, spans of at least a window are also
    taken out of the documents that stay; else those stay as they are. All columns are kept."""
    at = docs.columns.index(text)
    hit = _hit(docs, at, items, item, item_text, window)
    kept = hit.filter(~over_limit(share)).drop("n_words", "items")
    if not cut:
        return kept.drop("spans").toDF(*docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [without(t, [(s["start"], s["end"]) for s in found]) if found else t
                     for t, found in zip(batch.column(at).to_pylist(), batch.column(-1).to_pylist(), strict=True)]
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    bare = kept.drop("spans")
    return kept.mapInArrow(run, bare.schema).toDF(*docs.columns)
