"""Event feeds: rate limits, run states and windowed counts, as streams and as batches."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and their value by type and window; with a watermark where `events` is a stream."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    counted = rows.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return counted.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def within_limit(events: DataFrame, seconds: int, most: int, order: str = "event_id") -> DataFrame:
    """Events with `recent`, how many of the actor's allowed events lie in the interval before each, and whether it is allowed.

    A refused event leaves no record, so it doesn't count towards later ones: the events of an actor
    are folded in order, the state being the times of the last `most` allowed ones. An actor's events
    lie sorted in one partition and pass in batches; the fold holds a batch and that state. Null
    actors are one actor.
    """
    width = seconds * 1_000_000
    rows = events.select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), order)
    ordered = rows.repartition("user_id").sortWithinPartitions("user_id", "t", order)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = fold
        kept: deque[int] = deque()
        for batch in batches:
            recent = []
            for user, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if user != now:
                    now, kept = user, deque()
                while kept and kept[0] < t - width:
                    kept.popleft()
                recent.append(len(kept))
                if len(kept) < most:
                    kept.append(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(recent, pa.int64())], names=["user_id", order, "recent"])

    kinds = dict(events.dtypes)
    found = ordered.mapInArrow(fold, f"user_id {kinds['user_id']}, {order} {kinds[order]}, recent long")
    return found.withColumn("allowed", F.col("recent") < most)


def run_states(events: DataFrame, run: str, order: str, kind: str, terminal: list[str]) -> DataFrame:
    """The last terminal event of each run, or its last event."""
    last = F.struct(F.col(kind).isin(*terminal), F.col(order))
    return events.groupBy(run).agg(F.max_by(kind, last).alias("state"), F.count("*").alias("n"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of each user: events with no pause as long as the gap."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    found = rows.groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n"))
    return found.select("user_id", F.col("session_window.start").alias("start"), "n")
