"""Run states: batch against a plain fold, stream against batch, late and repeated events."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from statuta.streaming import runs

SCHEMA = "run long, ts timestamp, seq long, kind string, amount long"
T0 = datetime.datetime(2024, 1, 1)
KINDS = ["start", "succeed", "fail", "cancel", "reopen", "claim", "seal", "count", "pause", None]


def plain(rows):
    """The transitions by the rules, written out."""
    once = {}
    for run, ts, seq, kind, amount in rows:
        if None not in (run, ts, seq):
            key = (run, ts, seq)
            new = (kind is None, kind or "", amount is not None, amount or 0, kind, amount)
            once[key] = min(once.get(key, new), new, key=lambda e: e[:4])
    out, at = [], {}
    for (run, ts, seq), (*_, kind, amount) in sorted(once.items()):
        status, started, items = at.get(run, ("queued", False, 0))
        before, ok, item, over = status, False, None, status in ("succeeded", "failed", "cancelled")
        if kind == "start" and not over:
            status, started, ok = "running", True, True
        elif kind in ("succeed", "fail", "cancel") and not over:
            status, ok = {"succeed": "succeeded", "fail": "failed", "cancel": "cancelled"}[kind], True
        elif kind == "reopen" and not started and status in ("queued", "failed"):
            status, ok = "queued", True
        elif kind == "claim":
            item, items, ok = items, items + 1, True
        elif kind == "count":
            items, ok = amount or 0, True
        elif kind == "seal":
            ok = True
        at[run] = status, started, items
        out.append((run, ts, seq, kind, before, status, ok, item))
    return sorted(out, key=lambda r: r[:3])


def log(n, seed=1, hot=None):
    draw = random.Random(seed)
    rows = [(hot if hot and i % 3 else draw.randrange(1, 9), T0 + datetime.timedelta(minutes=draw.randrange(600), microseconds=draw.randrange(9)), i, draw.choice(KINDS), draw.choice([None, 0, 5])) for i in range(n)]
    return rows + draw.sample(rows, n // 5) + [(None, T0, 1, "start", None), (1, None, 2, "start", None), (1, T0, None, "start", None)]


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:3])


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_batch(spark, partitions):
    """Runs that reach over many ranges, ties, replays, nulls and a column of another name."""
    rows = log(400, hot=3) + [(3, T0, 900, "start", 1), (3, T0, 900, "cancel", 2), (3, T0, 900, None, 2)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("code", F.lit("x")).withColumn("chunk", F.lit(9))
    assert told(runs.transitions(df, partitions)) == plain(rows)


def test_rules(spark):
    kinds = ["claim", "fail", "succeed", "reopen", "claim", "start", "start", "cancel", "reopen", "seal", "claim", "count", "claim"]
    rows = [(1, T0 + datetime.timedelta(seconds=i), i, k, 7) for i, k in enumerate(kinds)]
    found = runs.transitions(spark.createDataFrame(rows, SCHEMA))
    assert [r["accepted"] for r in found.orderBy("seq").collect()] == [True, True, False, True, True, True, True, True, False, True, True, True, True]
    assert [r["item"] for r in found.where("kind = 'claim'").orderBy("seq").collect()] == [0, 1, 2, 7]
    end = runs.states(found).collect()[0]
    assert (end["status"], end["started_at"], end["completed_at"], end["sealed"], end["refused"]) == ("cancelled", T0 + datetime.timedelta(seconds=5), T0 + datetime.timedelta(seconds=7), True, 2)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert runs.transitions(empty).count() == 0 and runs.states(runs.transitions(empty)).count() == 0


def test_stream(spark, tmp_path):
    """Events out of order within the bound and replays give the batch's transitions; those behind it are dropped."""
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        rows = [r for r in log(120, seed=5) if r[0] is not None and r[1] is not None and r[2] is not None]
        rows.sort(key=lambda r: r[1] + datetime.timedelta(minutes=(r[2] * 7) % 50))
        parts = [rows[:60], rows[60:], [(99, T0 + datetime.timedelta(days=2), 1, "start", None)], [(1, T0, 5000, "cancel", None), (99, T0 + datetime.timedelta(days=2), 2, "start", None)]]
        source = tmp_path / "in"
        for i, part in enumerate(parts):
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(source / f"p={i}"))
            query = runs.transition_stream(spark.readStream.schema(SCHEMA).parquet(str(source / "*"))).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
            query.awaitTermination()
        assert told(spark.read.parquet(str(tmp_path / "out"))) == [r for r in plain(rows) if r[0] != 99]
    finally:
        spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
