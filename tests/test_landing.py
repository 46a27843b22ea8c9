"""The splittable reader against the plain one, and batches against one file after the other."""

import csv
import hashlib
import io
import json
import random

import pytest

from layerwright.sources import delimited, landing

CUTS = {"spark.sql.files.maxPartitionBytes": "40b", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def cuts(spark):
    """Byte ranges of some 40 bytes, several in a task."""
    old = {k: spark.conf.get(k) for k in CUTS}
    for k, v in CUTS.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def plain(data: bytes):
    """Header and rows as the csv module reads them."""
    reader = csv.DictReader(io.StringIO(data.decode("utf-8-sig", "replace"), newline=""), restkey=landing.EXTRA)
    rows = [{k: json.dumps(v) if isinstance(v, list) else v for k, v in r.items()} for r in reader]
    return list(reader.fieldnames or []), rows


def text(rng: random.Random) -> bytes:
    """A file with line breaks, quotes and delimiters in all places."""
    out = io.StringIO(newline="")
    end = rng.choice(["\n", "\r\n", "\r"])
    writer = csv.writer(out, lineterminator=end, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    writer.writerow(["id", "na\nme", "note"])
    for i in range(rng.randrange(60)):
        cell = lambda: "".join(rng.choice(["a", "ö", " ", '"', "\n", "\r\n", ",", "long text without any break ", ""]) for _ in range(rng.randrange(12)))
        writer.writerow([i, cell(), cell(), *[cell() for _ in range(rng.randrange(2))]][:rng.choice([1, 2, 3, 4, 4])])
        if rng.random() < 0.1:
            out.write(end)  # a blank line
        if rng.random() < 0.1:
            out.write(f'{i},st"ray "quote"s,"closed"and more' + end)
    return (b"\xef\xbb\xbf" if rng.random() < 0.3 else b"") + out.getvalue().encode()


def test_ranges_read_like_one_file(spark, tmp_path, cuts):
    rng, paths, want = random.Random(4), [], {}
    for i in range(12):
        path = tmp_path / f"f {i}%[x].csv"
        path.write_bytes(text(rng))
        paths.append(str(path))
        want[str(path)] = plain(path.read_bytes())
    (tmp_path / "open.csv").write_bytes(b'id,"a"\n1,x\n2,"never\nclosed, "" and on\n' * 1)
    (tmp_path / "none.csv").write_bytes(b"")
    (tmp_path / "head.csv").write_bytes(b'\n\n"a header\nthat is longer than one range of bytes, and goes on",b\n1,2')
    want |= {str(tmp_path / n): plain((tmp_path / n).read_bytes().lstrip(b"\n")) for n in ("open.csv", "none.csv", "head.csv")}
    files = delimited.survey(spark, list(want))
    assert max(len(f.starts) for f in files.values()) > 20 and any(f.across for f in files.values())
    got = {path: [] for path in want}
    for r in delimited.records(spark, files).collect():
        got[r.path].append((r.row_no, r.fields, r.surplus))
    for path, (header, rows) in want.items():
        assert files[path].header == header and files[path].rows == len(rows), path
        own = sorted(got[path])
        assert [n for n, *_ in own] == list(range(1, len(rows) + 1))
        made = [{**{h: f[i] if i < len(f) else None for i, h in enumerate(header)}, **({landing.EXTRA: s} if s else {})} for _, f, s in own]
        assert made == rows, path


def test_key_does_not_depend_on_the_cut(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes(text(random.Random(9)))
    (tmp_path / "b.csv").write_bytes(path.read_bytes())
    lines = path.read_bytes().split(b"\n")
    (tmp_path / "c.csv").write_bytes(b"\n".join([lines[0], *lines[1:][::-1]]))
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv", "c.csv")]
    whole = delimited.survey(spark, paths)
    old = {k: spark.conf.get(k) for k in CUTS}
    try:
        for k, v in CUTS.items():
            spark.conf.set(k, v)
        cut = delimited.survey(spark, paths)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(cut[paths[0]].starts) > len(whole[paths[0]].starts) == 1
    assert [cut[p].key for p in paths] == [whole[p].key for p in paths] and whole[paths[0]].key == whole[paths[1]].key != whole[paths[2]].key


def test_parts_read_like_the_file_they_make(spark, tmp_path, cuts):
    rng = random.Random(6)
    for i in range(4):
        data = text(rng) if i else b'id,"a\nb",c\n1,"x\ny",z\n2,"never\nclosed'
        (tmp_path / f"{i}.csv").write_bytes(data)
        cut, parts = sorted(rng.sample(range(len(data)), 5)), []
        places = [0, *sorted({data.find(b"\n", c) + 1 for c in cut} - {0}), len(data)]
        for k, (a, b) in enumerate(zip(places, places[1:], strict=False)):
            # the names say nothing about the order
            parts.append(tmp_path / f"{i}-{-k % 7}-{k}.csv")
            parts[-1].write_bytes(data[a:b])
        parts, whole = [str(p) for p in parts], str(tmp_path / f"{i}.csv")
        one, several = delimited.survey(spark, [whole]), delimited.survey(spark, [parts])
        f, g = one[whole], several[parts[0]]
        assert (f.header, f.rows, f.key) == (g.header, g.rows, g.key) and len(g.parts) == len(parts) > 1
        rows = [sorted((r.row_no, r.fields, r.surplus) for r in delimited.records(spark, x).collect()) for x in (one, several)]
        assert rows[0] == rows[1] and len(rows[0]) == f.rows
        root = str(tmp_path / f"lake-{i}")
        done = [landing.land_files(spark, [f], "s", root, "r")[0] for f in (parts, whole)]
        assert [d.skipped for d in done] == [False, True] and done[0].rows_in == f.rows


def test_documents_land_from_parts(spark, tmp_path, monkeypatch):
    import query_registry
    sf, asked = str(tmp_path), []
    texts = ["plain", 'a "quote", and\na line', "", "\n\n", 'ends with "', None]
    rows = [(i * 7 % 60, texts[i % 6], "en" if i % 4 else None) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{sf}/documents.parquet")
    survey = delimited.survey
    monkeypatch.setattr(delimited, "survey", lambda s, paths: asked.extend(paths) or survey(s, paths))
    with monkeypatch.context() as m:
        m.setattr(query_registry, "_KEPT", {})
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
        try:
            got = query_registry.landed_text_rows(spark, sf).orderBy("row_no").collect()
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert all(isinstance(p, list) and len(p) > 3 for p in asked)  # no task wrote all rows
    assert [(r.doc_id, r.row_no, r.number_in_file) for r in got] == [(i, i + 1, i + 1) for i in range(60)]
    want = {i: (hashlib.md5((t or "").encode()).hexdigest(), lang or "") for i, t, lang in rows}
    assert {r.doc_id: (r.text_md5, r.lang) for r in got} == want and all(r.named and r.row_count == 60 for r in got)


def _files(folder, n, rng):
    """CSV files, some of them copies of earlier ones, with rows that come back and headers that change."""
    paths, contents = [], []
    for i in range(n):
        header = rng.choice(["id,a", "id,a", "id,b,a", "a,id"])
        data = header + "\n" + "".join(f"{rng.randrange(30)},{'x' * header.count(',')}{',y' * (header.count(',') - 1)}\n" for _ in range(rng.randrange(6)))
        if contents and rng.random() < 0.2:
            data = rng.choice(contents)
        contents.append(data)
        path = folder / f"{i:04d}.csv"
        path.write_text(data)
        paths.append(str(path))
    return paths, contents


def test_batch_equals_one_after_the_other(spark, tmp_path):
    paths, contents = _files(tmp_path, 14, random.Random(3))
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    single = [landing.land(spark, p, "s", one, "r") for p in paths]
    batch = landing.land_files(spark, paths[:5], "s", many, "r") + landing.land_files(spark, paths[5:], "s", many, "r")
    assert single == batch and any(f.skipped for f in batch) and any(f.repeated for f in batch) and any(f.drift for f in batch)
    # and both equal a plain replay
    seen, landed, header, expected = {}, set(), None, []
    for data in contents:
        names, rows = plain(data.encode())
        hashes = [json.dumps(sorted(r.items())) for r in rows]
        expected.append((len(rows), 0 if data in landed else len(rows), data in landed, 0 if data in landed else sum(h in seen for h in hashes),
                         None if data in landed or header in (None, names) else ([c for c in names if c not in header], [c for c in header if c not in names])))
        if data not in landed:
            landed.add(data)
            header, seen = names, seen | dict.fromkeys(hashes)
    assert [(f.rows_in, f.rows_out, f.skipped, f.repeated, f.drift and (f.drift["added"], f.drift["removed"])) for f in batch] == expected
    rows = lambda root: sorted(map(str, spark.read.schema(landing.BRONZE).parquet(f"{root}/bronze").drop("ingested_at").collect()))
    entries = lambda root: sorted(map(str, spark.read.schema(landing.MANIFEST).parquet(f"{root}/manifest").drop("ingested_at").collect()))
    assert rows(one) == rows(many) and entries(one) == entries(many)
    # content of another source counts as landed before, and a source has numbers of its own
    other = landing.land_files(spark, paths[:2], "t", many, "r")
    assert [f.repeated for f in other] == [f.rows_out for f in other] and not other[0].skipped


def test_broken_attempt_is_replaced(spark, tmp_path, monkeypatch):
    paths, _ = _files(tmp_path, 4, random.Random(8))
    root = str(tmp_path / "lake")
    monkeypatch.setattr(landing, "_repeated", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        landing.land_files(spark, paths, "s", root, "r1")
    monkeypatch.undo()
    done = landing.land_files(spark, paths, "s", root, "r2")
    bronze = spark.read.schema(landing.BRONZE).parquet(f"{root}/bronze")
    assert bronze.count() == sum(f.rows_out for f in done) == bronze.select("bronze_id").distinct().count()
    assert {r.run_id for r in bronze.select("run_id").distinct().collect()} == {"r2"}


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    def jobs(n, name):
        folder = tmp_path / name
        folder.mkdir()
        paths, _ = _files(folder, n, random.Random(1))
        spark.sparkContext.setJobGroup(name, name)
        landing.land_files(spark, paths, "s", str(folder / "lake"), "r")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    # beyond some dozens of paths Spark lists them in jobs of its own, still a fixed number
    few, many = jobs(40, "few"), jobs(120, "many")
    assert many <= few + 4 and many < 25


def test_names(spark):
    row = spark.createDataFrame([(["a", "b", "a"], ["1", "2", "3", "4"], '["4"]'), (["a", "b"], ["1"], None)], "h array<string>, f array<string>, s string")
    got = [r[0] for r in row.select(delimited.payload(row["h"], row["f"], row["s"], "x")).collect()]
    assert got == [{"a": "3", "b": "2", "x": '["4"]'}, {"a": "1", "b": None}]
