"""What the operators leave on disk and in the driver: shuffles of steps that are done, text of plans."""

import time

import public_tokenizers
from pyspark.sql import functions as F

from statuta.llm import byte_bpe, common, near_duplicates
from statuta.operators import graph
from tests.llm import brute

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def shuffles(spark):
    """Numbers of the shuffles that have files."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n.split("_")[1] for n in names if n.startswith("shuffle_")}


def test_near_duplicates_lets_go_of_what_its_steps_shuffled(spark):
    rows = [(i, f"a{i // 3} b{i // 3} c d e f g h i j k l m n o p q r s t") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    common.release(spark)
    time.sleep(2)
    before = shuffles(spark)
    found = near_duplicates.near_duplicates(docs, 4, 80)
    until = time.time() + 10
    while len(left := shuffles(spark) - before) > 4 and time.time() < until:
        time.sleep(0.5)
    assert len(left) <= 4
    want = brute.near_duplicates(rows, 4, 80)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {d: want[d][1] for d, _ in rows}


def test_rounds_of_components_collect_no_garbage(spark, monkeypatch):
    """The driver's JVM may answer time spent on full collections by a larger heap (F1)."""
    collected = []
    monkeypatch.setattr(near_duplicates, "release", lambda session: collected.append(session))
    n = 64
    links = spark.createDataFrame([(i * 37 % n, (i + 1) * 37 % n) for i in range(n - 1)], "a long, b long")
    found = near_duplicates.components(links)
    assert not collected
    assert {r["node"]: r["label"] for r in found.collect()} == dict.fromkeys(range(n), 0)


def test_rounds_do_not_multiply_estimated_sizes(spark, monkeypatch):
    """A checkpoint keeps its plan's estimate: joined with itself in each round, its digits would double (F1)."""
    bits = []

    def told(df):
        bits.append(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length())
        return common.checkpointed(df)

    n = 64
    links = spark.createDataFrame([(i, i + 1) for i in range(n - 1)], "a long, b long")
    nodes = spark.createDataFrame([(i, i - 1 if i else None, None if i else "x") for i in range(n)], "node long, parent long, value string")
    monkeypatch.setattr(near_duplicates, "checkpointed", told)
    monkeypatch.setattr(graph, "checkpointed", told)
    assert {r["node"]: r["label"] for r in near_duplicates.components(links).collect()} == dict.fromkeys(range(n), 0)
    assert {r["node"]: r["hops"] for r in graph.nearest_value(nodes).collect()} == {i: i for i in range(n)}
    assert len(bits) > 14 and max(bits) < 300


def test_plans_of_byte_bpe_do_not_hold_its_tables_as_text(spark):
    words = spark.createDataFrame([("hello",), (" wörld",), ("x",), ("",)], "word string").withColumn("word", F.concat("word", F.lit("s")))
    folded = byte_bpe.encode_words(words, RANKS)
    out = byte_bpe.digests(folded, RANKS)
    for df in (folded, out):
        assert len(df._jdf.queryExecution().toString()) < 100_000
    # No row carries a table: it is folded into the expression that reads it.
    assert "array(scalar-subquery" in folded._jdf.queryExecution().optimizedPlan().toString()
    for r in out.collect():
        assert r["ids"] == brute.bpe().encode_ordinary(r["word"]) and r["decoded_sha256"] == brute.sha(r["word"])
