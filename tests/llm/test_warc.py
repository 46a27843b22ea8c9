"""Archives against the payloads they were made of."""

import gzip
import hashlib
import os

import pytest

from layerwright import session
from layerwright.llm import warc


def _pages():
    big, same = "ä<p>" * 400, "<b>" * 500
    return [(1, "http://a/1", big), (5, "http://a/5", big), (3, None, big), (5, "http://b/5", big), (7, "u", None), (8, "u", ""), (9, "u v\r\nX: 1", "small"),
            (10, "u", "small"), (None, "n", same), (None, "m", same), (None, "q", big), (11, "u", "x" * 999), (12, "u", "x" * 999),
            (13, "u", "a\r\n\r\nb" * 300), (2**40, "u", "y" * 1000), (14, "u", "y" * 1000)]


def _kept(spark, pages):
    folder = session.fresh_folder(spark, "test-warc")
    return folder, session.staged(warc.write(pages, folder, "page_id", "url", "html"), "test-index")


def test_records_come_back(spark):
    rows = _pages()
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    folder, index = _kept(spark, pages)
    got = warc.read(index, folder).collect()
    assert len(got) == len(rows) == index.count()
    data = lambda html: (html or "").encode()
    best = {}
    for k, _, html in rows:
        if k is not None and len(data(html)) >= 1000:
            best[html] = max(k, best.get(html, k))
    want = []
    for k, _, html in rows:
        to = best.get(html) if best.get(html) != k else None
        want.append((str(k), len(data(html)), hashlib.sha1(data(html)).hexdigest(), "response" if to is None else "revisit", str(to)))
    assert sorted((str(r.key), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == sorted(want)
    for r in got:
        if r.record_type == "response":
            assert len(r.payload) == r.payload_bytes and hashlib.sha1(r.payload).hexdigest() == r.payload_digest


def test_any_record_is_readable_on_its_own_and_files_are_plain_gzip(spark):
    folder, index = _kept(spark, spark.createDataFrame(_pages(), "page_id long, url string, html string"))
    some = warc.read(index.filter("key = 13"), folder).collect()
    assert [bytes(r.payload) for r in some] == [b"a\r\n\r\nb" * 300]
    whole = b"".join(gzip.open(os.path.join(folder, n)).read() for n in os.listdir(folder))
    assert whole.count(b"WARC/1.1\r\n") == len(_pages()) and b"\r\nX: 1" not in whole.split(b"WARC-Target-URI: u%20v%0D%0AX:%201")[0][-20:]


def test_ranges_join_neighbours(monkeypatch):
    monkeypatch.setattr(warc, "GAP", 10)
    monkeypatch.setattr(warc, "READ_BYTES", 100)
    rows = [("a", 0, 20), ("a", 20, 20), ("a", 55, 5), ("a", 62, 30), ("a", 95, 50), ("b", 100, 200), ("b", 300, 1)]
    assert [[r[1] for r in g] for g in warc.ranges(rows)] == [[0, 20], [55, 62, 95], [100], [300]]


def test_damaged_payload_is_an_error():
    data = warc.record(1, "u", b"payload", hashlib.sha1(b"other").digest(), None, "1970-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="digest"):
        warc.parse(data)


def test_empty_table(spark):
    folder, index = _kept(spark, spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read(index, folder).count() == 0
