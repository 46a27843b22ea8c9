"""The similarity join against all pairs."""

import random

import numpy as np
import pytest

from layerwright.llm import jaccard
from layerwright.llm.components import components


def _set(text):
    words = (text or "").lower().replace("\x0b", " ").split() if text and text.isascii() else (text or "").split()
    return {tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def _brute(rows):
    sets = [(k, _set(t)) for k, t in rows]
    up = {k: k for k, _ in rows if k is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 85 * len(s | t):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return sorted((str(k), len(s), str(root(k) if k is not None else None)) for k, s in sets)


def _rows(seed, n=160):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        if out and rnd.random() < 0.75:
            words = (rnd.choice(out)[1] or "x y z").split()
            for _ in range(rnd.randrange(0, 1 + len(words) // 25 + 1)):
                at = rnd.randrange(len(words) + 1)
                words[at:at + rnd.randrange(2)] = rnd.choices(vocabulary, k=rnd.randrange(2))
            text = rnd.choice([" ", "  ", "\n", "\t"]).join(words)
            text = text.upper() if rnd.random() < 0.2 else text
        else:
            text = " ".join(rnd.choices(vocabulary, k=int(2 ** rnd.uniform(0, 9))))
        out.append((i * 3 % n, text))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, seed):
    rows = [*_rows(seed), (500, None), (501, ""), (502, " \n"), (503, None), (None, "one two three four"), (504, "One  two three four"),
            (505, "one two three FOUR"), (506, "a"), (507, "A"), (508, "a b"), (None, None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_shingles int")
    got = jaccard.join(docs, "doc_id", "text").collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == _brute(rows)


def test_signatures_lose_no_link():
    rnd = np.random.default_rng(4)
    linked = 0
    for _ in range(3000):
        n = int(2 ** rnd.uniform(0, 10))
        a = rnd.integers(0, 2**63, n).astype(np.uint64)
        out, more = rnd.integers(0, n // 6 + 1), rnd.integers(0, n // 6 + 1)
        b = np.concatenate((a[out:], rnd.integers(0, 2**63, more).astype(np.uint64)))
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            linked += 1
            assert len(np.intersect1d(jaccard.signatures(a), jaccard.signatures(b))), (len(a), len(b), both)
    assert linked > 1000


def test_sparse_sets_lose_no_link():
    rnd = np.random.default_rng(5)
    for scheme in (s for size in range(1, 400) for s in jaccard.schemes(size) if s.sparse_above is not None):
        # features of two partitions only: nearly all others are empty
        pool = rnd.integers(0, 2**63, 40 * scheme.p).astype(np.uint64)
        part = (jaccard.mix(pool ^ scheme.salt) >> np.uint64(33)).astype(np.int64) % scheme.p
        a = np.unique(pool[part < 2])[:scheme.low]
        if len(a) < scheme.low:
            continue
        b = a[:-1] if scheme.low * 85 <= (scheme.low - 1) * 100 else a
        assert len(np.intersect1d(np.concatenate(scheme.sign(a)), np.concatenate(scheme.sign(b))))


def test_a_large_group_of_near_copies_stays_linear(spark):
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(600):
        words = list(base)
        words[i % 120] = f"x{i}"
        rows.append((i, " ".join(words)))
    got = jaccard.join(spark.createDataFrame(rows, "k long, t string"), "k", "t").collect()
    assert sorted((str(r.k), r.n_shingles, str(r.component_id)) for r in got) == _brute(rows)


def _changed(rnd, base, share):
    out = int(rnd.uniform(0, share) * len(base))
    more = rnd.integers(0, 2**63, int(rnd.uniform(0, share) * len(base))).astype(np.uint64)
    return np.unique(np.concatenate((rnd.permutation(base)[out:], more)))


def test_difference_keys_and_sketches_lose_no_link():
    rnd = np.random.default_rng(6)
    linked = 0
    for _ in range(3000):
        pivot = np.unique(rnd.integers(0, 2**63, int(2 ** rnd.uniform(0, 9))).astype(np.uint64))
        a = _changed(rnd, pivot, rnd.choice([0.05, 0.3, 1.0]))
        b = _changed(rnd, a if rnd.random() < 0.7 else pivot, 0.1)
        both = len(np.intersect1d(a, b))
        apart = int(np.bitwise_count((jaccard.sketch(a) ^ jaccard.sketch(b)).view(np.uint64)).sum())
        assert apart <= len(a) + len(b) - 2 * both
        if len(a) and len(b) and 100 * both >= 85 * (len(a) + len(b) - both):
            linked += 1
            assert len(np.intersect1d(jaccard.difference_keys(a, pivot, -5), jaccard.difference_keys(b, pivot, -5)))
            assert apart * 185 <= (len(a) + len(b)) * 15
    assert linked > 1000


@pytest.mark.parametrize("small", [1, 4, 32])
def test_many_near_copies_that_mostly_do_not_link(spark, monkeypatch, small):
    monkeypatch.setattr(jaccard, "SMALL", small)
    rnd = random.Random(8)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 2, 4, 6, 9])):
            words[rnd.randrange(90)] = f"x{rnd.randrange(60)}"
        rows.append((i, " ".join(words)))
    got = jaccard.join(spark.createDataFrame(rows, "k long, t string"), "k", "t").collect()
    assert sorted((str(r.k), r.n_shingles, str(r.component_id)) for r in got) == _brute(rows)


def test_repeated_keys_are_one_document(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(5, a), (5, b), (5, a), (7, a), (6, b), (9, "other words here now")]
    docs = spark.createDataFrame(rows, "k long, t string")
    got = sorted((r.k, r.component_id) for r in jaccard.join(docs, "k", "t").collect())
    assert got == [(5, 5), (5, 5), (5, 5), (6, 5), (7, 5), (9, 9)]
    kept = jaccard.keep_one(docs.withColumn("_rows", docs.k), "k", "t")
    assert sorted(r.k for r in kept.collect()) == [5, 9] and kept.columns == ["k", "t", "_rows"]


def test_empty_table_and_components(spark):
    docs = spark.createDataFrame([], "k long, t string")
    assert jaccard.join(docs, "k", "t").count() == 0 and jaccard.keep_one(docs, "k", "t").count() == 0
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (7, 7)], "a long, b long")
    found = {r.node: r.component for r in components(chain).collect()}
    assert found == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


def test_texts_are_hashed_once_for_sizes_and_signatures(spark, monkeypatch):
    """The texts are read by one pass over all of them and one over those that share a signature."""
    seen, plain = [], jaccard.map_batches
    monkeypatch.setattr(jaccard, "map_batches", lambda df, fn, schema: seen.append(schema) or plain(df, fn, schema))
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs, "doc_id", "text").collect()}
    assert found == {1: (2, 1), 2: (2, 1), 3: (0, 3)}
    assert sum("sigs" in s or "sketch" in s for s in seen) == 1
