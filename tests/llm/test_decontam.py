"""Decontamination against a search for every window, and against SQL."""

import random

import pytest

from layerwright.llm import decontam


def _brute(text, items, window):
    own = decontam.words(text)
    hit, held = set(), set()
    for name, item in items:
        ws = decontam.words(item)
        size = min(len(ws), window)
        for i in range(len(ws) - size + 1 if ws else 0):
            for at in range(len(own) - size + 1):
                if own[at:at + size] == ws[i:i + size]:
                    hit.update(range(at, at + size))
                    held.add(name)
    return len(own), hit, sorted(str(h) for h in held if h is not None)


def _case(seed):
    rnd = random.Random(seed)
    letters = ["a", "B", "c", "dé", "e1"][:rnd.randrange(2, 6)]
    run = lambda n: rnd.choice([" ", ", ", "\n"]).join(rnd.choices(letters, k=n))
    items = [(i, run(rnd.randrange(0, 9))) for i in range(rnd.randrange(0, 7))] + [(7, None), (8, ""), (None, run(4)), (1, run(5))]
    docs = [run(rnd.randrange(0, 30)) for _ in range(12)] + [None, "", "zz zz", "; ; ;"]
    return items, docs


@pytest.mark.parametrize("block", [1, 6, 100_000])
def test_against_every_window(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block)
    for seed in range(3 if block < 100 else 12):
        items, texts = _case(seed)
        docs = spark.createDataFrame([(i // 2, t, "x") for i, t in enumerate(texts)], "k long, t string, spans string")
        table = spark.createDataFrame(items, "item_id long, text string")
        got = decontam.measure(docs.coalesce(1), table, "k", "t", "item_id", "text", 4).select(
            "k", "n_words", "spans", "items", decontam.over_limit().alias("over")).collect()
        for row, text in zip(got, texts, strict=True):
            n, hit, held = _brute(text, items, 4)
            found = [i for s in row.spans for i in range(s.start, s.end)]
            assert (row.n_words, found, row["items"]) == (n, sorted(hit), held), (seed, text, items)
            assert row.over == bool(hit and 20 * len(hit) >= n)


def test_automaton_alone():
    rnd = random.Random(3)
    for _ in range(300):
        items = [(i, [bytes([97 + rnd.randrange(3)]) for _ in range(rnd.randrange(0, 12))]) for i in range(5)]
        text = [bytes([97 + rnd.randrange(4)]) for _ in range(60)]
        found, held = decontam.Automaton(items, 5).hits(text)
        n, hit, names = _brute(b" ".join(text).decode(), [(i, b" ".join(w).decode()) for i, w in items], 5)
        assert sorted(hit) == [i for s, e in found for i in range(s, e)] and sorted(map(str, held)) == names


def test_spans_are_cut_and_full_documents_go(spark):
    item = "one two three four five"
    rest = " ".join(f"w{i}" for i in range(200))
    rows = [(1, f"{rest} One, two; THREE four five! end", "s"), (2, item, "s"), (3, rest, "s"), (4, None, "s"), (3, rest, "s")]
    docs = spark.createDataFrame(rows, "k long, text string, spans string")
    items = spark.createDataFrame([(1, item)], "i long, text string")
    out = decontam.decontaminate(docs, items, "text", "i", "text", 4)
    assert out.schema == docs.schema
    assert sorted((r.k, str(r.text)) for r in out.collect()) == [(1, f"{rest} ! end"), (3, rest), (3, rest), (4, "None")]
    kept = decontam.decontaminate(docs, items, "text", "i", "text", 4, cut=False)
    assert kept.filter("k = 1").first().text == rows[0][1] and kept.count() == 4
    assert decontam.decontaminate(docs.limit(0), items.limit(0), "text", "i", "text").count() == 0
