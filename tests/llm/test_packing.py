"""Packing against a search through all rows, and back again."""

import random

import numpy as np
import pytest

from layerwright.llm import packing


def _plain(sizes, length):
    rows, room = [], []
    for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fit = [r for r in room if r >= sizes[at]]
        if not fit:
            rows.append([at])
            room.append(length - sizes[at])
            continue
        r = max(i for i, x in enumerate(room) if x == min(fit))
        rows[r].append(at)
        room[r] -= sizes[at]
    return sorted(room)


@pytest.mark.parametrize("length", [1, 2, 7, 8, 63, 64, 100])
def test_best_fit_leaves_the_same_room_as_a_full_search(length):
    rnd = random.Random(length)
    for _ in range(60):
        sizes = [rnd.randrange(1, length + 1) for _ in range(rnd.randrange(0, 80))]
        rows = packing.best_fit(sizes, length)
        assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
        assert sorted(length - sum(sizes[i] for i in r) for r in rows) == _plain(sizes, length)


@pytest.mark.parametrize(("pool", "vocabulary", "each"), [(10**6, 50_000, 2), (40, 1 << 20, 4)])
def test_round_trip(spark, pool, vocabulary, each):
    rnd = random.Random(2)
    rows = [(i % 30, [rnd.randrange(vocabulary) for _ in range(rnd.choice([0, 1, 5, 15, 16, 17, 32, 100]))], "x") for i in range(80)]
    rows += [(None, [1, 2, 3], "x"), (90, None, "x"), (91, [], "x"), (None, [1, 2, 3], "x")]
    coded = spark.createDataFrame(rows, "k long, ids array<int>, keys string").repartition(3)
    packs = packing.pack(coded, "k", "ids", 16, pad=9, vocabulary=vocabulary, pool=pool).cache()
    out = packs.collect()
    assert len({r.pack_id for r in out}) == len(out)
    for r in out:
        ids, at = (np.frombuffer(x, f"<u{each}") for x in (r.input_ids, r.position_ids))
        assert len(ids) == len(at) == 16 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 16
        assert (ids[r.n_tokens:] == 9).all() and (at[r.n_tokens:] == 0).all()
        assert list(at[:r.n_tokens]) == [i for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:], strict=False) for i in range(b - a)]
    segments = packing.unpack(packs, each).collect()
    assert sum(len(s.ids) for s in segments) == sum(len(r[1] or []) for r in rows)
    want = sorted((str(k), s, ids[s:s + 16]) for k, ids, _ in rows for s in range(0, len(ids or []), 16))
    assert sorted((str(s.key), s.start, s.ids) for s in segments) == want
    packs.unpersist()


def test_rows_are_full(spark):
    rnd = random.Random(3)
    rows = [(i, [1] * rnd.randrange(1, 200)) for i in range(3000)]
    packs = packing.pack(spark.createDataFrame(rows, "k long, ids array<int>"), "k", "ids", 256)
    used = packs.agg({"n_tokens": "avg"}).first()[0]
    assert used > 0.98 * 256


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "k long, ids array<int>"), "k", "ids").count() == 0
