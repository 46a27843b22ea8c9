"""Without any learned language the pipeline's first stage keeps every text with a letter."""

import corpus_pipeline


def test_texts_stay_where_no_language_is_learned(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12 !", None), (3, None, None), (4, "日本", None)], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()) == [1, 4]
