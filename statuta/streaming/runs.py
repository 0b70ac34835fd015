"""Run states by a table of transitions, as a batch and as a stream with keyed state.

A run is queued, running, succeeded, failed or cancelled. Its events (run, ts, seq, kind, amount):

* start: queued or running becomes running; only the first tells when the run started.
* succeed, fail, cancel: end a run that hasn't ended. An end is written once; later ones are refused.
* reopen: a failed run that never started is queued again; a queued one stays so; others refuse.
* claim: hands out the run's next item index; seal: no more items are announced; count: sets the
  number of items to `amount` (null: 0). They are taken in every state.

Both forms return one row for each event, its `transition`: run, ts, seq, kind, before, after,
accepted and item (the index that a claim handed out). Events of other kinds, and of a null kind,
are refused and change nothing. Events without a run, time or sequence number are left out. Events
are taken in the order of (ts, seq); of several with one (run, ts, seq) that of the least kind, then
the least amount, counts, so that replays change nothing. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from statuta.sources.tables import checkpointed

ENDS = {"succeed": "succeeded", "fail": "failed", "cancel": "cancelled"}
#: A code is a status and whether the run has ever started.
CODES = [(s, b) for s in ("queued", "running", *ENDS.values()) for b in (False, True)]
_AT = {c: i for i, c in enumerate(CODES)}
COUNTERS = ("claim", "seal", "count")
SCHEMA = "run {0}, micros long, seq long, kind string, before string, after string, accepted boolean, item long"


def _after(status: str, started: bool, kind: str) -> int | None:
    """The code that an event leads to; None: it is refused."""
    if kind in COUNTERS:
        return _AT[status, started]
    if kind == "reopen":
        return _AT["queued", False] if (status, started) in (("queued", False), ("failed", False)) else None
    if status in ENDS.values():
        return None
    return _AT["running", True] if kind == "start" else _AT[ENDS[kind], started]


#: For each kind the code after each code.
TABLE = {k: [_after(*c, k) for c in CODES] for k in ("start", *ENDS, "reopen", *COUNTERS)}
STAY = list(range(len(CODES)))


def step(code: int, items: int, kind: str | None, amount: int | None) -> tuple[int, int, bool, int | None]:
    """Code and items after an event, whether it was accepted, and the index that it handed out."""
    after = TABLE.get(kind, [None] * len(CODES))[code]
    if after is None:
        return code, items, False, None
    if kind == "claim":
        return after, items + 1, True, items
    return after, (amount or 0) if kind == "count" else items, True, None


def _events(rows: DataFrame) -> DataFrame:
    said = rows.select("run", F.col("ts").cast("timestamp").alias("ts"), F.col("seq").cast("long").alias("seq"), "kind", F.col("amount").cast("long").alias("amount"))
    return said.where("run is not null and ts is not null and seq is not null").withColumn("micros", F.unix_micros("ts"))


def _told(found: DataFrame) -> DataFrame:
    return found.select("run", F.timestamp_micros("micros").alias("ts"), "seq", "kind", "before", "after", "accepted", "item")


def _ints(column: pd.Series) -> list[int | None]:
    return [None if pd.isna(x) else int(x) for x in column]


def transitions(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """The transition of each event of a batch.

    Events are sorted over ranges of (run, ts, seq), so a run of any size is cut into several
    ranges. What a range does to a run is a map from codes to codes and to the number of items;
    the maps before a range compose into the code that the range begins with.
    """
    spark = rows.sparkSession
    kind = dict(rows.dtypes)["run"]
    once = _events(rows).groupBy("run", "micros", "seq").agg(F.min(F.struct(F.col("kind").isNull().alias("none"), "kind", "amount")).alias("e")).select("run", "micros", "seq", "e.kind", "e.amount")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["run", "micros", "seq"]
    dealt = checkpointed(once.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("chunk", F.spark_partition_id()))

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """For each run of a range: its map, and the items it adds to those before or (fixed) to none."""
        run, chunk, codes, fixed, items = None, 0, STAY, False, 0
        out = lambda: pd.DataFrame({"run": [run], "chunk": [chunk], "codes": [codes], "fixed": [fixed], "items": [items]})
        for batch in batches:
            done = []
            for r, c, k, a in zip(batch["run"], batch["chunk"], batch["kind"], _ints(batch["amount"]), strict=True):
                if r != run:
                    if run is not None:
                        done.append(out())
                    run, chunk, codes, fixed, items = r, c, STAY, False, 0
                moves = TABLE.get(k)
                if moves is not None:
                    codes = [x if moves[x] is None else moves[x] for x in codes]
                    fixed, items = fixed or k == "count", step(0, items, k, a)[1] if k in COUNTERS else items
            if done:
                yield pd.concat(done)
        if run is not None:
            yield out()

    # A run has a row for each range that it reaches into: at most as many as there are ranges.
    maps = checkpointed(dealt.mapInPandas(summed, f"run {kind}, chunk int, codes array<int>, fixed boolean, items long"))
    cut = maps.groupBy("run").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("chunk", "codes", "fixed", "items"))).alias("parts")).where("n > 1")
    begin = F.struct(F.lit(0).alias("code"), F.lit(0).cast("long").alias("items"))
    follow = lambda s, p: F.struct(F.element_at(p["codes"], s["code"] + 1).alias("code"), F.when(p["fixed"], p["items"]).otherwise(s["items"] + p["items"]).alias("items"))
    before = F.transform("parts", lambda p, i: F.struct(p["chunk"].alias("chunk"), F.aggregate(F.slice("parts", F.lit(1), i), begin, follow).alias("s")))
    carried = cut.select("run", F.explode(before).alias("b")).select("run", "b.chunk", F.col("b.s.code").alias("code"), F.col("b.s.items").alias("items"))
    # Only the run that a range begins with reaches into it from before: one row for each range.
    into = carried.where("chunk > 0").join(dealt.groupBy("chunk").agg(F.min("run").alias("run")), ["run", "chunk"])
    told = dealt.join(F.broadcast(into), ["run", "chunk"], "left")

    def taken(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, code, items = None, 0, 0
        for batch in batches:
            found = []
            for r, k, a, c, i in zip(batch["run"], batch["kind"], _ints(batch["amount"]), _ints(batch["code"]), _ints(batch["items"]), strict=True):
                if r != run:
                    run, code, items = r, c or 0, i or 0
                was = code
                code, items, accepted, item = step(code, items, k, a)
                found.append((CODES[was][0], CODES[code][0], accepted, item))
            rest = pd.DataFrame(found, columns=["before", "after", "accepted", "item"])
            rest["item"] = rest["item"].astype("Int64")
            yield pd.concat([batch[["run", "micros", "seq", "kind"]].reset_index(drop=True), rest], axis=1)

    return _told(told.mapInPandas(taken, SCHEMA.format(kind)))


class Machine(StatefulProcessor):
    """Holds the events of a run until the watermark has passed them, then takes them in order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", "code int, items long")
        self.pending = handle.getMapState("pending", "ts long, seq long", "kind string, amount long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        for batch in rows:
            for t, s, k, a in zip(batch["micros"], batch["seq"], batch["kind"], _ints(batch["amount"]), strict=True):
                at, new = (int(t), int(s)), (None if pd.isna(k) else k, a)
                if self.pending.containsKey(at):
                    new = min(tuple(self.pending.getValue(at)), new, key=lambda e: (e[0] is None, e[0] or "", e[1] is not None, e[1] or 0))
                self.pending.updateValue(at, new)
                self.handle.registerTimer(at[0] // 1000 + 1)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        until = expiredTimerInfo.getExpiryTimeInMs() * 1000
        due = sorted((tuple(at), tuple(e)) for at, e in self.pending.iterator() if at[0] < until)
        code, items = self.now.get() if self.now.exists() else (0, 0)
        found = []
        for at, (k, a) in due:
            was = code
            code, items, accepted, item = step(code, items, k, a)
            found.append((key[0], at[0], at[1], k, CODES[was][0], CODES[code][0], accepted, item))
            self.pending.removeKey(at)
        self.now.update((code, items))
        out = pd.DataFrame(found, columns=["run", "micros", "seq", "kind", "before", "after", "accepted", "item"])
        out["item"] = out["item"].astype("Int64")
        yield out


def transition_stream(rows: DataFrame, late: str = "2 hours") -> DataFrame:
    """The transitions of a stream of events, each told once the watermark has passed it.

    They are those of the batch as long as no event is later than `late`; what comes after the
    watermark is dropped, a replay of told events with it. State is a code, a number and the events
    that wait. Needs the RocksDB state store (spark.sql.streaming.stateStore.providerClass).
    """
    kind = dict(rows.dtypes)["run"]
    said = _events(rows).withWatermark("ts", late)
    return _told(said.groupBy("run").transformWithStateInPandas(Machine(), SCHEMA.format(kind), "append", "EventTime"))


def states(told: DataFrame) -> DataFrame:
    """run, status, started_at, completed_at, claims, sealed, events and refused of each run, from its transitions."""
    at, yes = F.struct("ts", "seq"), F.col("accepted")
    ended = F.col("after").isin(*ENDS.values()) & F.col("kind").isin(*ENDS)
    last = F.max_by("after", at)
    return told.groupBy("run").agg(
        last.alias("status"),
        F.min(F.when(yes & (F.col("kind") == "start"), F.col("ts"))).alias("started_at"),
        F.when(last.isin(*ENDS.values()), F.max(F.when(yes & ended, F.col("ts")))).alias("completed_at"),
        F.count(F.when(F.col("kind") == "claim", 1)).alias("claims"),
        F.coalesce(F.bool_or(F.col("kind") == "seal"), F.lit(False)).alias("sealed"),
        F.count("*").alias("events"),
        F.count(F.when(~yes, 1)).alias("refused"),
    )
