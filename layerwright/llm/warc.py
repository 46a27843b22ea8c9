"""WARC archives with an index that comes first.

`write` deals the pages to tasks; each task appends gzip members to an archive of its own in a shared folder and returns an
index row for every record: file, offset, length, URL, digest. `read` takes any rows of that index, sorts them by
place, joins neighbouring byte ranges into one read and returns what the records hold.

Of records with equal payloads of at least `smallest` bytes, that with the largest key is a response, the others are revisits
that carry no payload; smaller payloads are always responses.

Cases: null html is an empty payload, a null URL gives a record without target. Rows that repeat the winning key with the
same payload are responses too. A null key never wins; where all keys of a payload are null, all are responses.
Payloads are equal if their SHA-256 and length are. Further columns of the input are ignored. A digest that does not fit
its payload at reading is an error. An archive name is used by one task attempt only, so a repeated task leaves an
archive behind that no index row names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.common import map_batches

SMALLEST = 1000             # bytes; smaller payloads are never revisits
ARCHIVE_BYTES = 1 << 30     # a task begins another archive beyond this
GAP, READ_BYTES = 64 << 10, 8 << 20  # join ranges up to this gap, into reads of up to this size
TASK_BYTES = 64 << 20       # of the archives that one task reads
LEVEL = 4
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def place(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as URI or as path."""
    uri = folder if "://" in folder else "file://" + folder.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def record(key: int | None, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None, date: str) -> bytes:
    """One record, not compressed."""
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
            "WARC-Date": date, "WARC-Payload-Digest": "sha1:" + base64.b32encode(sha1).decode(),
            "X-Payload-Length": str(len(payload)), "Content-Type": "application/http; msgtype=response"}
    if url is not None:
        head["WARC-Target-URI"] = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    if key is not None:
        head["X-Key"] = str(key)
    if refers_to is not None:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["X-Refers-To-Key"] = str(refers_to)
    block = b"" if refers_to is not None else _HTTP % len(payload) + payload
    head["Content-Length"] = str(len(block))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict[str, object]:
    """Fields of one record and its payload (None for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    whole = fields["WARC-Type"] == "response"
    payload = block.partition(b"\r\n\r\n")[2] if whole else None
    sha1 = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    if whole and hashlib.sha1(payload).digest() != sha1:
        raise ValueError(f"payload does not fit its digest: {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"key": number("X-Key"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "payload": payload,
            "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": sha1.hex(), "refers_to": number("X-Refers-To-Key")}


def packed(data: bytes) -> bytes:
    """One gzip member."""
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def marked(pages: DataFrame, key: str, url: str, html: str, smallest: int = SMALLEST) -> DataFrame:
    """key, url, payload and `refers_to`. Only keys and digests are grouped; payloads move once, by their key."""
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha", F.sha2("payload", 256))
    narrow = rows.filter(F.octet_length("payload") >= smallest).select("key", "sha")
    winners = (narrow.groupBy("sha").agg(F.max("key").alias("refers_to"), F.count(F.lit(1)).alias("n"))
               .filter((F.col("n") > 1) & F.col("refers_to").isNotNull()).select("sha", "refers_to"))
    losers = (narrow.join(winners, "sha").filter(~F.col("key").eqNullSafe(F.col("refers_to"))).distinct())
    return (rows.alias("r").join(losers.alias("l"), F.col("r.key").eqNullSafe(F.col("l.key")) & (F.col("r.sha") == F.col("l.sha")),
                                 "left").select("r.key", "r.url", "r.payload", "l.refers_to"))


def write(pages: DataFrame, folder: str, key: str, url: str, html: str, smallest: int = SMALLEST,
          date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write archives to `folder`, which all executors share, and return the index: file, offset, length, url,
    payload_digest, key. Evaluate it once and keep it, as every evaluation writes archives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = place(folder)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                found: dict[str, list] = {n: [] for n in ("file", "offset", "length", "url", "payload_digest", "key")}
                for key_, url_, payload, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        else:
                            store.create_dir(path, recursive=True)
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{path}/{name}", compression=None)
                    sha1 = hashlib.sha1(payload).digest()
                    data = packed(record(key_, url_, payload, sha1, refers, date))
                    out.write(data)
                    for n, v in zip(found, (name, at, len(data), url_, sha1.hex(), key_), strict=True):
                        found[n].append(v)
                    at += len(data)
                yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in _INDEX], schema=_INDEX)
        finally:
            if out is not None:
                out.close()

    return marked(pages, key, url, html, smallest).mapInArrow(
        run, "file string, offset long, length long, url string, payload_digest string, key long")


_INDEX = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
                    ("payload_digest", pa.string()), ("key", pa.int64())])
_RECORD = "key long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"
_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def ranges(rows: list[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Group sorted (file, offset, length) so that each group is one read."""
    group: list[tuple[str, int, int]] = []
    for row in rows:
        if group and (row[0] != group[0][0] or row[1] - sum(group[-1][1:]) > GAP or sum(row[1:]) - group[0][1] > READ_BYTES):
            yield group
            group = []
        group.append(row)
    if group:
        yield group


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records that the rows of `index` point to; any filter on the index selects records.

    An index row is small whatever the record it points to, so the number of tasks follows the bytes that are to be read.
    """
    names = [part.split() for part in _RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = place(folder)
        for batch in batches:
            for group in ranges(list(zip(*(c.to_pylist() for c in batch.columns), strict=True))):
                start, end = group[0][1], max(o + n for _, o, n in group)
                with store.open_input_file(f"{path}/{group[0][0]}") as f:
                    data = f.read_at(end - start, start)
                found = [parse(zlib.decompress(data[o - start:o - start + n], 31)) for _, o, n in group]
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], _TYPES[k]) for n, k in names],
                                                 names=[n for n, _ in names])

    places = index.select("file", "offset", "length")
    wanted = places.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, wanted // TASK_BYTES + 1)
    return places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, _RECORD)
