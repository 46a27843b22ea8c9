"""The pipeline's stages beside plain versions of what they decide."""

import hashlib

import corpus_pipeline
import duckdb
import pytest

from layerwright import session
from layerwright.llm import decontam, pii
from layerwright.llm.common import table
from layerwright.llm.queries import vocabulary

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    out, docs = [], table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = session.staged(stage(spark, docs, SF), f"test-{name.replace(' ', '-')}")
        out.append(docs)
    return [table(spark, SF, "documents"), *out]


def _texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_keep_columns_and_clean_documents(steps):
    assert all(s.columns == steps[0].columns for s in steps[1:5])
    texts = [_texts(s) for s in steps[:5]]
    assert set(texts[1]) == {k for k, t in texts[0].items() if t and any(c.isalpha() for c in t)}
    for before, after in zip(texts[:3], texts[1:4], strict=True):
        assert all(before[k] == t for k, t in after.items())
    assert set(texts[4]) == set(texts[3])
    for k, t in texts[4].items():
        if t != texts[3][k]:
            assert pii.spans(texts[3][k])
        assert not pii.spans(t), t


def test_one_of_each_group_stays(steps):
    texts = _texts(steps[1])
    sets = {k: {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} for k, t in texts.items() if (w := t.lower().split())}
    up = {k: k for k in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= 85 * max(len(x), len(y)) and 100 * len(x & y) >= 85 * len(x | y):
                lo, hi = sorted((root(a), root(b)))
                up[hi] = lo
    assert set(_texts(steps[2])) == {k for k in texts if root(k) == k}


def test_contaminated_documents_go(steps):
    con = duckdb.connect()
    items = [t for t, in con.execute(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    windows = {tuple(w[i:i + min(13, len(w))]) for t in items if (w := decontam.words(t)) for i in range(len(w) - min(13, len(w)) + 1)}
    sizes = {len(w) for w in windows}

    def over(text):
        own = decontam.words(text)
        hit = {i for n in sizes for at in range(len(own) - n + 1) if tuple(own[at:at + n]) in windows for i in range(at, at + n)}
        return len(hit) > 0 and 20 * len(hit) >= len(own)

    before = _texts(steps[2])
    gone = {k for k, t in before.items() if over(t)}
    assert gone and set(_texts(steps[3])) == set(before) - gone


def test_tokens_decode_to_the_texts(spark, steps):
    texts = _texts(steps[4])
    rows = steps[5].collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
    assert vocabulary(spark).size == 50_256


def test_unusual_rows_pass_all_stages(spark):
    rows = [(1, None, "en", "id"), (None, "some words here to read", None, None), (2, "", None, "x"), (3, "12 !", "en", "x"), (4, "same words in this text", "de", "x"),
            (4, "same words in this text", "de", "x"), (5, "Same words in this text", "de", "x"), (None, None, None, None),
            (6, "write to a.b@c.example today", "en", "x"), (7, "w " * 30_000, "en", "x")]
    docs = spark.createDataFrame([(*r, 0, "c") for r in rows], "doc_id long, text string, lang string, id string, text_key int, base string")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        docs = session.staged(stage(spark, docs, SF), f"odd-{n}")
        assert n == 4 or docs.columns == columns
    got = docs.collect()
    assert sorted(str(r.doc_id) for r in got) == ["4", "6", "7", "None"]
    empty = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_tokens_are_kept_before_they_are_decoded(spark):
    docs = spark.createDataFrame([(1, "one text"), (2, None)], "doc_id long, text string")
    coded = corpus_pipeline.tokens(spark, docs, SF)
    assert coded._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id: r.n_tokens for r in coded.collect()}[2] == 0
