"""Operators on small fixtures: nulls, empty tables, ties, streams."""

from pyspark.sql import functions as F

from statuta.operators import graph, quality, relational, search, temporal
from statuta.streaming import events as feed


def listed(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_fills_only_missing(spark):
    held = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert listed(relational.upsert(held, batch, "k")) == [(1, "a"), (2, "b"), (3, "c")]
    assert {r["k"]: r["v"] for r in relational.upsert(held, batch, "k", fill_nulls=False).collect()} == {1: "a", 2: None, 3: "c"}


def test_replace_and_carry_forward(spark):
    held = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert listed(relational.replace_by_key(held, spark.createDataFrame([(1, "z")], "k int, v string"), ["k"])) == [(1, "z"), (2, "c")]
    new = spark.createDataFrame([(1, "high"), (2, "low")], "k int, severity string")
    prior = spark.createDataFrame([(1, "high", "ok", 1), (1, "high", "bad", 2), (2, "high", "ok", 1)], "k int, severity string, decision string, at int")
    got = relational.carry_forward(new, prior, ["k"], ["severity"], "decision", F.desc("at"))
    assert {r["k"]: r["decision"] for r in got.collect()} == {1: "bad", 2: None}


def test_unknown_cursor_is_an_empty_page(spark):
    rows = spark.createDataFrame([(1, 10), (2, 10), (3, 9)], "k int, t int")
    assert relational.keyset_page(rows, "t", "k", 99, 5).count() == 0
    assert [r["k"] for r in relational.keyset_page(rows, "t", "k", 2, 5).collect()] == [1, 3]


def test_walk_stops_at_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (2, 1)], "src int, dst int")
    assert listed(graph.walk(edges, spark.createDataFrame([(1,)], "node int"), 10)) == [(1, 1, 2), (2, 2, 3)]


def test_nearest_value(spark):
    nodes = spark.createDataFrame([(1, None, "x"), (2, 1, None), (3, 2, None), (4, 3, None), (5, None, None)], "node int, parent int, value string")
    assert listed(graph.nearest_value(nodes, 3)) == [(1, "x", 0), (2, "x", 1), (3, "x", 2), (4, "x", 3)]


def test_state_priorities(spark):
    rows = [("a", "substitution", "2000-01-01", True), ("a", "repeal", "2001-01-01", None), ("b", "commencement", "2030-01-01", True), ("b", "substitution", "2000-01-01", True), ("c", "other", None, True), ("d", "commencement", "2000-01-01", True)]
    effects = spark.createDataFrame(rows, "unit string, action string, date string, applied boolean").withColumn("date", F.to_date("date"))
    assert dict(listed(temporal.state_at(effects, F.lit("2010-01-01").cast("date")))) == {"a": "repealed", "b": "not_yet_in_force", "d": "in_force"}
    assert listed(temporal.holes(effects, F.lit("2010-01-01").cast("date"))) == [(0, 1, 0)]


def test_gaps_and_rates(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 4), ("b", 1), ("b", 9), ("c", None)], "k string, n int")
    got = {r["k"]: r["kind"] for r in quality.number_gaps(rows, ["k"], "n").collect()}
    assert got == {"a": "repeal", "b": "defect"}
    rates = quality.tri_state_rates(spark.createDataFrame([("x", True), ("x", None), ("y", None)], "k string, f boolean"), ["k"], F.col("f"))
    assert {r["k"]: r["rate"] for r in rates.collect()} == {"x": 1.0, "y": None}


def test_search_on_empty_and_null_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "Alpha beta alpha")], "doc_id int, text string")
    asked = spark.createDataFrame([(9, "ALPHA"), (8, None)], "q int, text string")
    assert [(r["q"], r["doc_id"]) for r in search.bm25(docs, asked, "doc_id", "q").collect()] == [(9, 3)]
    found = spark.createDataFrame([(1, 5, 1), (1, 6, 2)], "q int, d int, rank int")
    gold = spark.createDataFrame([(1, 6), (2, 7)], "q int, d int")
    assert listed(search.retrieval_metrics(found, gold, "q", "d", 10)) == [(2, 0.5, 0.25, round(1 / 1.5849625007211562 / 2, 6))]


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.range(200).select((F.col("id") % 7).alias("user_id"), F.timestamp_seconds(F.col("id") * 97).alias("ts"), F.concat(F.lit("t"), F.col("id") % 3).alias("event_type"), F.col("id").cast("double").alias("value"))
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    run = feed.tumbling_counts(stream).writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert listed(spark.table("counts")) == listed(feed.tumbling_counts(rows))
