"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright import session
from layerwright.llm import ann, bpe, decontam, jaccard, langid, mainhtml, packing, pii, quality, repair, warc, whiten, wordlm
from layerwright.llm.common import held_out, learnable, table
from layerwright.llm.sql import SQLS

RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_information_theoretic_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the terms that give it away, in every document."""
    found = pii.find(table(spark, sf_dir, "documents"), "doc_id", "text", everywhere=True)
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint,disclosure:double>>)")
    return found.select("doc_id", *[of(k) for k in pii.KINDS], F.sha2(pii.listed(F.col("base"), none), 256).alias("base_sha256"),
                        pii.listed(F.col("base"), F.col("terms")).alias("spans"))


def op2_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, "doc_id", "text", "quality", learnable(F.col("doc_id")))
    return (quality.score(docs, model, "doc_id", "text")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"))


def op3_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much more every document reads like those labelled good than like all documents."""
    docs = table(spark, sf_dir, "documents")
    good = (table(spark, sf_dir, "labels").filter((F.col("quality") == 1) & learnable(F.col("doc_id")))
            .select("doc_id").distinct().withColumn("good", F.lit(True)))
    # one plan for labels of any number: texts and labels meet by a sort, whatever their sizes
    return wordlm.score(docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left"), "doc_id", "text", F.col("good"))


def op4_suffix_automaton_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontam.measure(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")
    return found.select("doc_id", "n_words", decontam.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontam.over_limit().alias("contaminated"))


def op5_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth one."""
    return ann.search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 100 == 0)


def op6_partenum_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of similar shingle sets."""
    return jaccard.join(table(spark, sf_dir, "documents"), "doc_id", "text")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids, packed into rows of 2048."""
    words = vocabulary(spark)
    return packing.pack(bpe.encode(table(spark, sf_dir, "documents"), words, "doc_id", "text"), "doc_id", "ids", vocabulary=words.size)


def op8_rank_order_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    learned = langid.Profiles(langid.profiles(docs.filter(learnable(F.col("doc_id"))), "text", "lang"))
    return (langid.detect(docs, learned, "doc_id", "text")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))


def vocabulary(spark: SparkSession) -> bpe.Vocabulary:
    return bpe.Vocabulary(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op9_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document, and of the bytes they decode to."""
    words = vocabulary(spark)
    # kept in between: a task then has one Python process at a time, not one that encodes and one that decodes
    coded = session.staged(bpe.encode(table(spark, sf_dir, "documents"), words, "doc_id", "text"), "token-ids")
    return bpe.decode(coded, words, "ids").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256"))


def op10_warc_index_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives, then read back by the index."""
    folder = session.fresh_folder(spark, "warc")
    index = session.staged(warc.write(table(spark, sf_dir, "pages"), folder, "page_id", "url", "html"), "warc-index")
    return warc.read(index, folder).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_incremental_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector in the eight strongest components of all, scaled to unit variance."""
    vectors = table(spark, sf_dir, "embeddings")
    return whiten.whiten(vectors, whiten.fit(vectors, "embedding"), "vec_id", "embedding")


def op12_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, and how many blocks that may be main text repeat on its host."""
    found = mainhtml.extract(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")


def op13_survivor_viterbi_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired at least cost."""
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_information_theoretic_pii, op2_compression_quality, op3_cross_entropy_difference, op4_suffix_automaton_decontamination,
        op5_hilbert_neighbours, op6_partenum_jaccard, op7_best_fit_packing, op8_rank_order_profiles, op9_chunked_bpe,
        op10_warc_index_first, op11_incremental_whitening, op12_host_suffix_array,
        op13_survivor_viterbi_repair)}


def sqls() -> dict[str, str]:
    return dict(SQLS)
