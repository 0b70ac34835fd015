"""Walks over an edge table, lineage and nearest ancestors, by bounded rounds of equi-joins."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.sources.tables import checkpointed, unsized


def walk(edges: DataFrame, start: DataFrame, depth: int) -> DataFrame:
    """depth, src and dst of the edges reached from the start nodes (column node); a path never returns to a node."""
    depth = min(max(depth, 1), 10)
    at = start.select(F.col("node").alias("src"), F.array("node").alias("visited"))
    out = None
    for i in range(1, depth + 1):
        step = edges.join(at, "src").where(~F.array_contains("visited", F.col("dst"))).select(F.lit(i).alias("depth"), "src", "dst", "visited")
        out = step if out is None else out.unionByName(step)
        at = step.select(F.col("dst").alias("src"), F.concat("visited", F.array("dst")).alias("visited"))
    return out.select("depth", "src", "dst")


def citation_chain(edges: DataFrame, start: DataFrame, inbound: bool = False, depth: int = 3, classes: list[str] | None = None, allowed: DataFrame | None = None) -> DataFrame:
    """Edges on the paths that lead out of the start nodes (column node), or into them: start, edge_id, edge_class, node, depth and truncated.

    `edges`: edge_id, src, dst and edge_class. A path goes on from each node that it reaches unless it
    was there before; an edge without a far node is a leaf. Each path tells its edges, so one edge may
    come several times. `classes` (none given: all; empty: none) and `allowed` (nodes; a missing
    far node passes) hold at every hop. `depth` is kept within 1 and 10; `truncated` tells of a start
    whether some path has that length. Null starts reach nothing; repeated ones count once.
    """
    depth = min(max(depth, 1), 10)
    near, far = ("dst", "src") if inbound else ("src", "dst")
    hops = edges.select(F.col(near).alias("near"), F.col(far).alias("node"), "edge_id", "edge_class").where("near is not null")
    if inbound:
        hops = hops.where("node is not null")
    if classes is not None:
        hops = hops.where(F.col("edge_class").isin(*classes) if classes else F.lit(False))
    if allowed is not None:
        kept = hops.join(allowed.select("node").where("node is not null").distinct(), "node", "left_semi").select(hops.columns)
        hops = kept.unionByName(hops.where("node is null"))
    at = start.where("node is not null").select(F.col("node").alias("start"), F.col("node").alias("near"), F.array().cast(f"array<{dict(start.dtypes)['node']}>").alias("visited")).distinct()
    out = None
    for i in range(1, depth + 1):
        # Each level is written once: the next one starts from its rows, not from all levels before.
        step = checkpointed(at.join(hops, "near").select("start", F.lit(i).alias("depth"), "edge_id", "edge_class", "node", F.concat("visited", F.array("near")).alias("visited")))
        out = step if out is None else out.unionByName(step)
        at = step.where("node is not null and not array_contains(visited, node)").select("start", F.col("node").alias("near"), "visited")
    capped = step.select("start").distinct().withColumn("truncated", F.lit(True))
    return out.drop("visited").join(capped, "start", "left").select("start", "edge_id", "edge_class", "node", "depth", F.coalesce("truncated", F.lit(False)).alias("truncated"))


def nearest_value(nodes: DataFrame, rounds: int | None = None) -> DataFrame:
    """node, value and hops of the nearest node up the parents that has a value (node, parent, value).

    Each round doubles the distance looked at: `rounds` of them see 2**rounds ancestors; none given,
    they go on until no node without a value has an ancestor left to look at. Nodes on a cycle without
    a value, and those below it, have none: the rounds end once the distance exceeds the number of nodes.
    Rows without a node are left out; of a node's several rows one of the least parent counts.
    """
    own = nodes.where("node is not null").groupBy("node").agg(F.min(F.struct("parent", "value")).alias("r")).select("node", "r.parent", "r.value")
    seen = own.select("node", F.when(F.col("value").isNull(), F.col("parent")).alias("up"), "value", F.when(F.col("value").isNull(), F.lit(1)).otherwise(F.lit(0)).alias("hops"))
    most = None
    for i in itertools.count():
        if i == rounds:
            break
        if rounds is None:
            seen = unsized(checkpointed(seen))
            open_ = seen.where("value is null and up is not null").count()
            most = most or seen.count()
            if not open_ or 1 << i > 2 * most:
                break
        above = seen.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("value").alias("value2"), F.col("hops").alias("hops2"))
        found = F.col("value").isNull() & F.col("hops2").isNotNull()
        seen = seen.join(above, "up", "left").select("node", F.when(F.col("value").isNull(), F.col("up2")).alias("up"), F.coalesce("value", "value2").alias("value"), F.when(found, F.col("hops") + F.col("hops2")).otherwise(F.col("hops")).alias("hops"))
    return seen.where("value is not null").select("node", "value", "hops")


def lineage(nodes: DataFrame, start: DataFrame, cap: int = 100) -> DataFrame:
    """start, node and depth of all ancestors of the start nodes (column node), up to `cap` of them (node, parent)."""
    at = start.select(F.col("node").alias("start"), F.col("node"), F.lit(0).alias("depth"))
    out, parents = at, nodes.where("parent is not null and parent <> node").select("node", "parent")
    for _ in range(cap):
        # Each level is written once, and joined by a shuffle: the driver gets no table to broadcast.
        at = checkpointed(at.hint("merge").join(parents, "node").select("start", F.col("parent").alias("node"), (F.col("depth") + 1).alias("depth")))
        if at.isEmpty():
            break
        out = out.unionByName(at)
    return out
