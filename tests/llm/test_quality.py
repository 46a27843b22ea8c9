"""The compression classifier on held-out labels and on unusual rows."""

from pyspark.sql import functions as F

from layerwright.llm import quality
from layerwright.llm.common import held_out, learnable, table
from layerwright.llm.queries import op2_compression_quality

DIR = "/root/testdata/sf0.1"


def test_held_out_labels(spark):
    found = op2_compression_quality(spark, DIR).join(table(spark, DIR, "labels"), "doc_id").filter("held_out")
    out = found.agg(F.count("*").alias("n"), F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right"),
                    F.avg(F.when(F.col("quality") == 0, 1 - F.col("predicted"))).alias("bad")).first()
    assert out.n > 800 and out.right > 0.95 and out.bad > 0.9
    # calibrated: the mean score is near the share of good labels
    means = found.agg(F.avg("score").alias("s"), F.avg("quality").alias("q")).first()
    assert abs(means.s - means.q) < 0.06


def test_nothing_is_learned_from_held_out_rows(spark):
    docs, labels = table(spark, DIR, "documents").limit(800), table(spark, DIR, "labels")
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    fits = [quality.fit(docs, rows, "doc_id", "text", "quality", learnable(F.col("doc_id"))) for rows in (labels, turned)]
    assert fits[0] == fits[1]


def test_unusual_rows(spark):
    docs = spark.createDataFrame([(1, None, 9.0), (1, None, 9.0), (2, "", 1.0), (None, "x" * 300_000, 2.0)], "k long, t string, score double")
    none = spark.createDataFrame([(1, 1), (1, 0), (2, None)], "k long, q int")
    model = quality.fit(docs, none, "k", "t", "q", F.lit(True))
    assert model == quality.NOTHING
    assert [(r.score, r.predicted) for r in quality.score(docs, model, "k", "t").collect()] == [(0.5, 0)] * 4
    assert quality.score(docs.limit(0), model, "k", "t").count() == 0


def test_whole_texts_count():
    good, bad = b"plain words of a plain text " * 40, b"##!! $$%% ##!! &&** " * 40
    text = good.decode() * 20
    longer = text + bad.decode() * 200
    assert quality.difference(good, bad, quality.blocks(longer)) < quality.difference(good, bad, quality.blocks(text))
    assert b"".join(quality.blocks("é" * 5000)).decode() == "é" * 5000
