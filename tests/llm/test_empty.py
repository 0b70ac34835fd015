"""Empty tables and columns named as a result."""

import public_tokenizers
from pyspark.sql import functions as F

from statuta.llm import chat_format, quality, token_counts, top_k, toxicity

DOCS = "doc_id long, text string"


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert quality.score_quality(docs, labels).count() == toxicity.score_toxicity(docs, labels).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, vector array<long>")
    assert top_k.top_k(vectors, vectors, 5).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.digests(chat_format.format_conversations(turns)).count() == 0


def test_scores_replace_columns_of_their_names(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (1, None), (None, "plain")], DOCS).withColumn("score", F.lit("x")).withColumn("predicted", F.lit("y"))
    labels = spark.createDataFrame([(1, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for scored in (quality.score_quality(docs, labels), toxicity.score_toxicity(docs, labels)):
        rows = scored.collect()
        assert len(rows) == 3 and scored.columns == docs.columns and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
