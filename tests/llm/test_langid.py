"""Rank-order profiles against a plain reading of the method, and on held-out documents."""

import unicodedata
from collections import Counter

from pyspark.sql import functions as F

from layerwright.llm import langid
from layerwright.llm.common import table
from layerwright.llm.queries import op8_rank_order_profiles

DIR = "/root/testdata/sf0.01"


def _counted(text: str) -> Counter:
    words = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text.lower()).split()
    line, out = "_" + "".join(w + "_" for w in words), Counter()
    for n in (1, 2, 3):
        out.update(g for g in (line[i:i + n] for i in range(len(line) - n + 1)) if g != "_")
    return out if words else Counter()


def _number(gram: str) -> int:
    out = 0
    for c in gram:
        out = out << 21 | (1 if c == "_" else ord(c))
    return out


def _list(counts: Counter) -> list[int]:
    return [g for g, _ in sorted(((_number(g), n) for g, n in counts.items()), key=lambda x: (-x[1], x[0]))][:langid.PROFILE]


def test_against_plain_counts(spark):
    taught = [("aa", "the cat, the hat"), ("aa", "that THE"), ("bb", "der Hut über 9 die"), ("bb", "die, der"), (None, "zz"), ("aa", None)]
    asked = ["the", "Über", "", None, "12 !", "zzz", "the der"]
    learned = langid.profiles(spark.createDataFrame(taught, "lang string, text string"), "text", "lang")
    want = {}
    for name in ("aa", "bb"):
        want[name] = _list(sum((_counted(t) for n, t in taught if n == name and t), Counter()))
    assert {k: list(v) for k, v in learned.items()} == want
    docs = spark.createDataFrame(list(enumerate(asked)), "id long, text string").withColumn("score", F.lit("clash"))
    got = {r.id: (r.lang_pred, r.score) for r in langid.detect(docs, langid.Profiles(learned), "id", "text").collect()}
    for i, text in enumerate(asked):
        own = _list(_counted(text or ""))
        if not own:
            assert got[i] == ("und", 0.0)
            continue
        away = {n: sum(abs(w.index(g) - r) if g in w else langid.PROFILE for r, g in enumerate(own)) for n, w in want.items()}
        best = min(sorted(away), key=away.get)
        assert got[i][0] == best and abs(got[i][1] - (1 - away[best] / (langid.PROFILE * len(own)))) < 1e-12


def test_nothing_learned_and_empty_table(spark):
    none = langid.profiles(spark.createDataFrame([], "lang string, text string"), "text", "lang")
    docs = spark.createDataFrame([(1, "words"), (1, "words"), (None, None)], "id long, text string")
    rows = langid.detect(docs, langid.Profiles(none), "id", "text").collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)] * 3
    assert langid.detect(docs.limit(0), langid.Profiles(none), "id", "text").count() == 0


def test_held_out_documents(spark):
    found = op8_rank_order_profiles(spark, DIR).join(table(spark, DIR, "documents").select("doc_id", "lang"), "doc_id")
    out = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.count("*").alias("n")).first()
    assert found.count() == 1000 and out.n > 200 and out.right > 0.97
