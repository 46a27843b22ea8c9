"""Verbatim CSV, split over many tasks although quoted fields may hold line breaks.

Spark cuts a file into byte ranges and reads lines; whether a line begins a record depends on all quotes before it. Two passes
settle that. The first notes for each range where it leads from either state (between records, inside a quoted field), how many
records end in it in either case, and a key of its content. Combined in file order, one row a range, this gives each range the
state it begins in and the number of its first record. The second pass parses the ranges on their own; a record that lies across
ranges is put together from its pieces afterwards, and only files that hold such a record are read once more for it.

Records follow the usual reader: a quote opens a field only at its start, two quotes inside stand for one, what follows a closing
quote belongs to the field; lines end at \\n, \\r or \\r\\n; blank lines are no records. Nothing is trimmed. A byte order mark at
the start goes, bytes that are no UTF-8 become U+FFFD. A quote that is never closed ends with the file, at its last line break.

A file may also come in parts, as many tasks write it: a list of paths in their order, each of which ends with a line (not
necessarily with a record). It is read like the one file that its parts make, under the name of the first.
"""

from __future__ import annotations

import csv
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BETWEEN, QUOTED = 0, 1
# a line that ends inside a quoted field it began, read from between records
_OPEN = re.compile(r'(?:(?:[^,"][^,]*+)?+,|"(?:[^"]++|"")*+"[^,]*+,)*+"(?:[^"]++|"")*+\Z', re.S)
_LINES = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+")
_RETURN = re.compile(r"[^\r]*\r|[^\r]+")
# the content key of a range: digests of its lines as digits of a number in this base, so that ranges of any cut combine
_PRIME, _BASE = 2**127 - 1, 0x1F3D5B79A3C5E7091B2D4F6183A5C7E9 % (2**127 - 1)
# the place of a range: number of the part times this, and where it starts in the part
_PART = 2**44
_RANGE = "path string, start long, lines long, key binary, states array<int>, ended array<long>, head array<string>"
_ROW = "path string, row_no long, fields array<string>, surplus string"
_RECORD = f"{_ROW}, start long, piece string"


@dataclass
class File:
    """What the first pass knows of a file: its header, number of records, content key, and where each range begins."""
    path: str
    header: list[str] = field(default_factory=list)
    rows: int = 0
    key: str = ""
    starts: dict[int, tuple[int, int]] = field(default_factory=dict)  # range -> (state, records before it)
    across: bool = False  # a record lies across ranges, or is never closed
    parts: list[str] = field(default_factory=list)


def plain(path: str) -> str:
    """One spelling for a path and for what Spark calls the same file."""
    return re.sub(r"^file:/+", "/", unquote(path) if "%" in path and ":" in path else path)


def pieces_of(path: str | list[str]) -> list[str]:
    """The parts of a file; a file in one piece is its only part."""
    return [path] if isinstance(path, str) else list(path)


def lines(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Lines of files with their file and byte range, in order within a range. Both passes must cut alike."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))


def _ranges(batches: Iterator[pa.RecordBatch], parts: dict[str, tuple[str, int]]) -> Iterator[tuple[str, int, list[bytes], bool]]:
    """(path of the file, place, lines, whether the range begins with them), in pieces."""
    last = None
    for batch in batches:
        paths, starts, held = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        at = 0
        for i in range(1, len(held) + 1):
            if i == len(held) or (paths[i], starts[i]) != (paths[at], starts[at]):
                here = (paths[at], starts[at])
                name, number = parts[plain(here[0])]
                yield name, number * _PART + here[1], held[at:i], here != last
                last, at = here, i


def _texts(held: list[bytes], first: bool) -> Iterator[str]:
    """Lines as text, with their ends; a return inside a line ends one too."""
    for raw in held:
        line = raw.decode("utf-8", "replace")
        if first:
            line, first = line.removeprefix("﻿"), False
        if "\r" in line[:-1]:
            parts = _RETURN.findall(line)
            yield from parts[:-1]
            line = parts[-1]
        yield line + "\n"


def _after(line: str, state: int) -> int:
    if '"' not in line:
        return state
    return QUOTED if _OPEN.match('"' + line if state == QUOTED else line) else BETWEEN


def _blank(line: str) -> bool:
    return not line.rstrip("\r\n")


def _parse(texts: Iterable[str]) -> list[list[str]]:
    csv.field_size_limit(2**31 - 1)
    return [r for r in csv.reader(texts) if r]


def _scan(batches: Iterator[pa.RecordBatch], parts: dict[str, tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    """First pass: one row for each range."""
    out: list[dict] = []
    head: list[str] | None = None
    for path, start, held, begins in _ranges(batches, parts):
        if begins:
            out.append({"path": path, "start": start, "lines": 0, "key": 0, "states": [BETWEEN, QUOTED], "ended": [0, 0], "head": None})
            head = [] if start == 0 else None
        own = out[-1]
        for line in _texts(held, begins and start == 0):
            blank = _blank(line)
            for entry in (BETWEEN, QUOTED):
                was = own["states"][entry]
                now = own["states"][entry] = _after(line, was)
                own["ended"][entry] += now == BETWEEN and not (blank and was == BETWEEN)
            if head is not None and not (blank and not head):
                head.append(line)
                if own["states"][BETWEEN] == BETWEEN:
                    own["head"], head = _parse(head)[0], None
        for raw in held:
            own["key"] = (own["key"] * _BASE + int.from_bytes(hashlib.blake2b(raw, digest_size=16).digest())) % _PRIME
        own["lines"] += len(held)
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("lines", pa.int64()), ("key", pa.binary()), ("states", pa.list_(pa.int32())),
                        ("ended", pa.list_(pa.int64())), ("head", pa.list_(pa.string()))])
    if out:
        yield pa.RecordBatch.from_pylist([r | {"key": r["key"].to_bytes(16)} for r in out], schema)


def _part_numbers(spark: SparkSession, files: Iterable[File]) -> Broadcast:
    """One entry for each part: the file and the number of the part."""
    return spark.sparkContext.broadcast({plain(p): (plain(f.path), i) for f in files for i, p in enumerate(f.parts)})


def survey(spark: SparkSession, paths: list[str | list[str]]) -> dict[str, File]:
    """First pass over all files in one job. One row for each byte range comes to the driver, which plans a task for each."""
    files = {plain(own[0]): File(own[0], parts=own) for own in map(pieces_of, paths)}
    numbers = _part_numbers(spark, files.values())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _scan(batches, numbers.value)

    found = lines(spark, [p for f in files.values() for p in f.parts]).mapInArrow(scan, _RANGE).collect() if paths else []
    by: dict[str, list] = {name: [] for name in files}
    for row in found:
        by[row["path"]].append(row)
    for name, own in by.items():
        f, state, before, count, number = files[name], BETWEEN, 0, 0, 0
        for row in sorted(own, key=lambda r: r["start"]):
            f.starts[row["start"]] = (state, before)
            f.across |= state == QUOTED
            before += row["ended"][state]
            state = row["states"][state]
            number = (number * pow(_BASE, row["lines"], _PRIME) + int.from_bytes(row["key"])) % _PRIME
            count += row["lines"]
            f.header = row["head"] or f.header
        f.across |= state == QUOTED
        records = before + (state == QUOTED)
        if records and not f.header:
            f.header = _long_header(spark, f)
        f.rows = max(records - 1, 0)
        f.key = hashlib.sha256(f"{count}:{number:x}".encode()).hexdigest()
    return files


def _long_header(spark: SparkSession, file: File) -> list[str]:
    """A header that does not end in the first range: read the file from its start until it does."""
    held, state = [], BETWEEN
    for i, row in enumerate(row for part in file.parts for row in lines(spark, [part]).toLocalIterator()):
        for line in _texts([bytes(row["line"])], i == 0):
            if held or not _blank(line):
                state = _after(line, state)
                held.append(line)
                if state == BETWEEN:
                    return _parse(held)[0]
    return _parse(held)[0]


def records(spark: SparkSession, files: dict[str, File]) -> DataFrame:
    """Second pass: path, row_no (1 is the first row after the header), fields, and a JSON list of those the header has no name for."""
    # one entry for each range
    places = spark.sparkContext.broadcast({name: (len(f.header), f.starts) for name, f in files.items()})
    numbers = _part_numbers(spark, files.values())

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _records(batches, places.value, numbers.value)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, number, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield _batch(path, number, _parse(_LINES.findall(text))[:1], places.value[path][0]).select(["path", "row_no", "fields", "surplus"])

    def scan(some: list[File]) -> DataFrame:
        return lines(spark, [p for f in some for p in f.parts]).mapInArrow(parse, _RECORD)

    if not files:
        return spark.createDataFrame([], _ROW)
    rows = scan(list(files.values())).filter(F.col("piece").isNull()).select("path", "row_no", "fields", "surplus")
    if across := [f for f in files.values() if f.across]:
        pieces = scan(across).filter(F.col("piece").isNotNull()).groupBy("path", "row_no").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "piece"))), lambda p: p["piece"]), "").alias("piece"))
        rows = rows.unionByName(pieces.mapInArrow(whole, _ROW))
    return rows.filter("row_no > 0")


def _batch(path: str, number: int, rows: list[list[str]], width: int, start: int = 0, piece: str | None = None) -> pa.RecordBatch:
    """Records from this number on; or, without any, a piece of one."""
    n = len(rows) or 1
    surplus = [json.dumps(r[width:]) if len(r) > width else None for r in rows] or [None]
    return pa.RecordBatch.from_arrays([
        pa.array([path] * n), pa.array(range(number, number + n), pa.int64()), pa.array(rows or [None], pa.list_(pa.string())),
        pa.array(surplus, pa.string()), pa.array([start] * n, pa.int64()), pa.array([piece] * n, pa.string())],
        names=["path", "row_no", "fields", "surplus", "start", "piece"])


def _records(batches: Iterator[pa.RecordBatch], places: dict[str, tuple[int, dict[int, tuple[int, int]]]],
             parts: dict[str, tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    path, start, state, number, width, waiting, whole = "", 0, BETWEEN, 0, 0, [], True
    for name, at, held, begins in _ranges(batches, parts):
        if begins:
            if waiting:
                yield _batch(path, number, [], width, start, "".join(waiting))
            width, starts = places[name]
            if at not in starts:
                raise RuntimeError(f"{name} was cut differently by the two passes: keep the read settings of the session as they are")
            path, start, (state, number), waiting = name, at, starts[at], []
            whole = state == BETWEEN
        ready: list[str] = []
        for line in _texts(held, begins and at == 0):
            state = _after(line, state)
            waiting.append(line)
            if state == BETWEEN:
                if whole:
                    ready += waiting
                else:  # the end of a record that began in an earlier range
                    yield _batch(path, number, [], width, start, "".join(waiting))
                    number, whole = number + 1, True
                waiting = []
        if rows := _parse(ready):
            yield _batch(path, number, rows, width, start)
            number += len(rows)
    if waiting:
        yield _batch(path, number, [], width, start, "".join(waiting))


def payload(header: Column, fields: Column, surplus: Column, extra: str) -> Column:
    """Fields by name: missing ones are NULL, surplus ones stand under `extra`; of equal names the last counts."""
    names = F.array_distinct(header)
    named = F.map_from_arrays(names, F.transform(names, lambda n: F.get(fields, F.size(header) - F.array_position(F.reverse(header), n).cast("int"))))
    return F.when(surplus.isNull(), named).otherwise(F.map_concat(named, F.create_map(F.lit(extra), surplus)))
