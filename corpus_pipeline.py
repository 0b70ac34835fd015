"""Corpus pipeline: toxicity, near-duplicates, repeated passages, mixing, byte-level BPE."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.llm import byte_bpe, mixing, near_duplicates, substrings, toxicity
from statuta.llm.common import checkpointed, release
from statuta.llm.registry import RANKS, WEIGHTS, domain
from statuta.sources.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7."""
    release(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.score_toxicity(docs, labels, 0.7).where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates (five words, 0.8)."""
    release(spark)
    return near_duplicates.drop_near_duplicates(docs, 5, 80).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words or more that an earlier document holds."""
    release(spark)
    cut = substrings.dedup_substrings(docs, 50)
    cut = cut.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One epoch of the mixture: 0.9 of the tokens, each document once at most."""
    release(spark)
    return mixing.mix_sources(docs, domain(), WEIGHTS, part=0.9, max_epochs=1).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and the digests of ids and of the decoded bytes."""
    release(spark)
    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, columns=["doc_id"])
    return byte_bpe.digests(encoded, RANKS)


STAGES = [("toxicity", reject_toxic), ("near_dedup", drop_near_duplicates), ("substring_dedup", cut_repeats), ("mixing", mix_sources), ("byte_bpe", encode)]

#: Learned scores, sketches and merges have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
