"""The word models against plain counts, and that what they gather grows with the texts."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from layerwright.llm import wordlm
from layerwright.llm.common import table
from layerwright.llm.queries import op3_cross_entropy_difference


def _tokens(text):
    return re.findall(r"[^\W_぀-鿿]+|[^\s]", (text or "").lower()) + [""]


def _model(texts, different):
    words, pairs = Counter(), Counter()
    for t in texts:
        own = _tokens(t)
        words.update(own)
        pairs.update(zip(["", *own], own))
    total, w = sum(words.values()), wordlm.WEIGHT
    return lambda b, c: (pairs[b, c] + w * (words[c] + w / different) / (total + w)) / (words[b] + w)


@pytest.mark.parametrize(("chunk", "bucket"), [(1 << 20, 1 << 20), (4, 3)])
def test_against_plain_counts(spark, monkeypatch, chunk, bucket):
    monkeypatch.setattr(wordlm, "CHUNK", chunk)
    monkeypatch.setattr(wordlm, "BUCKET", bucket)
    rows = [(1, "the cat sat, on the mat; the cat", True), (1, "the hat", True), (2, "Ça & ## 日本語 ça", False), (3, None, None), (4, "", True),
            (None, "### 12", None), (2, "the hat", False), (1, "the hat", True)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "k long, t string, good boolean, score int").repartition(3)
    got = wordlm.score(docs, "k", "t", F.col("good")).collect()
    different = len({w for _, t, _ in rows for w in _tokens(t)})
    target, background = _model([t for _, t, g in rows if g], different), _model([t for _, t, _ in rows], different)
    want = []
    for k, t, _ in rows:
        own = _tokens(t)
        want.append((str(k), len(own), sum(math.log(target(*p) / background(*p)) for p in zip(["", *own], own)) / len(own)))
    assert len(got) == len(want)
    for a, b in zip(sorted((str(r.k), r.n_tokens, r.score) for r in got), sorted(want), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9


def test_empty_table_and_no_target(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, None)], "k long, t string")
    assert wordlm.score(docs.limit(0), "k", "t", F.lit(True)).count() == 0
    assert wordlm.score(docs, "k", "t", F.lit(False)).count() == 2


def test_query_reads_words(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r.n_tokens for r in op3_cross_entropy_difference(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    assert {k: len(wordlm.words(t)) for k, t in texts.items()} == got
