"""Byte-level BPE against the library over whole texts."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken

from layerwright.llm import bpe
from layerwright.llm.queries import vocabulary


def _library() -> tiktoken.Encoding:
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts() -> list[str | None]:
    rnd = random.Random(5)
    parts = ["we'll", "I'd", " ", "  ", "\n\n\n", "\t", "naïve", "12345", "…", "!!", "日本語", "'", "re", "🙂", "\r\n", "a" * 40, "x'r"]
    mixed = ["".join(rnd.choices(parts, k=rnd.randrange(1, 400))) for _ in range(40)]
    return [None, "", " ", "it's", "<|endoftext|>", "é" * 900, "q" * 700 + " end " * 30, " " * 500 + "x", "\n" * 300, *mixed]


def test_chunks_cover_the_text_and_overlap():
    spans = bpe.chunks("x" * 100, 30, 10)
    assert spans[0] == (0, 30) and spans[-1][1] == 100
    assert all(b[0] == a[1] - 10 for a, b in zip(spans, spans[1:], strict=False))
    assert bpe.chunks("", 30, 10) == [(0, 0)]


@pytest.mark.parametrize(("size", "overlap"), [(64, 16), (200, 40), (32_768, 512)])
def test_ids_equal_the_library_and_decode_to_the_text(spark, size, overlap):
    texts = _texts()
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    words = vocabulary(spark)
    coded = bpe.encode(docs, words, "doc_id", "text", size, overlap)
    found = {r.doc_id: r for r in bpe.decode(coded, words, "ids").collect()}
    library = _library()
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        assert found[i].ids == library.encode_ordinary(text or ""), (i, text)
        assert bytes(found[i].bytes) == (text or "").encode()


def test_repeated_rows_and_null_keys_are_answered_one_by_one(spark):
    long, other = "word " * 60, "text " * 60
    docs = spark.createDataFrame([(1, long), (1, long), (1, other), (None, long), (None, None), (2, "a")], "k long, t string")
    rows = bpe.encode(docs, vocabulary(spark), "k", "t", 64, 16).collect()
    library = _library()
    want = sorted((str(k), library.encode_ordinary(t or "")) for k, t in
                  [(1, long), (1, long), (1, other), (None, long), (None, None), (2, "a")])
    assert sorted((str(r.k), r.ids) for r in rows) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "k long, t string")
    words = vocabulary(spark)
    assert bpe.decode(bpe.encode(docs, words, "k", "t"), words, "ids").count() == 0


@pytest.mark.parametrize("run", [" ", "\n", " \n", "　\t"])
def test_long_white_space(spark, run):
    words = bpe.Vocabulary(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = [run * (1_200_000 // len(run)), "a" + run * 600_000 + "b", run * 4096 + "'s", "x" * 70_000 + run * 4100 + " y"]
    got = bpe.decode(bpe.encode(spark.createDataFrame(list(enumerate(texts)), "k long, t string"), words, "k", "t"), words, "ids").collect()
    assert {r.k: bytes(r.bytes).decode() for r in got} == dict(enumerate(texts))
    encoder = words.encoder()
    for r in got:
        if len(texts[r.k]) < 100_000:
            assert r.ids == encoder.encode(texts[r.k], disallowed_special=())


def test_encoding_and_decoding_are_not_stages_of_one_task(spark):
    from layerwright.llm import queries
    plan = queries.op9_chunked_bpe(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # each one is a Python process beside the others of its task
