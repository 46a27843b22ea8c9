"""A corpus pipeline in stages; each reads what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright import session
from layerwright.llm import bpe, decontam, jaccard, langid, pii
from layerwright.llm.common import learnable, prepared, table
from layerwright.llm.queries import vocabulary

# Learned profiles and corpus statistics have no SQL; the tests compare the stages with plain versions.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told: those without a letter. All others stay as they are."""
    prepared(spark)
    learned = langid.Profiles(langid.profiles(docs.filter(learnable(F.col("doc_id"))), "text", "lang"))
    return langid.keep_known(docs, learned, "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links connect, keep the one with the smallest doc_id."""
    return jaccard.keep_one(docs, "doc_id", "text")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop contaminated documents. Those below the limit are clean by the same rule and stay as they are."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), "text", "item_id", "text", cut=False)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data, and terms that give it away, in the texts; n_chars follows the text."""
    out = pii.sanitise(docs, "doc_id", "text", everywhere=True)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of the bytes they decode to."""
    words = vocabulary(prepared(spark))
    # kept in between: a task then has one Python process at a time, not one that encodes and one that decodes
    coded = session.staged(bpe.encode(docs, words, "doc_id", "text"), "token-ids")
    decoded = bpe.decode(coded, words, "ids")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                          F.sha2(F.col("bytes"), 256).alias("decoded_sha256"))


STAGES = [("language ID", language), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontamination),
          ("PII", personal_data), ("byte-level BPE", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(prepared(spark), docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = session.staged(docs, name.replace(" ", "-"))
    return docs
