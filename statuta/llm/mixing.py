"""Mixing sources to target weights by hierarchical budgeting.

Weights are handed down a tree of domain, language and source. Each node's budget is shared among
its children in proportion to their weights, but no child gets more than it can supply (its tokens
times `max_epochs`); what it leaves goes to its siblings, and only what they cannot take stays for
the ancestors' other branches. This sharing has a closed form: with the children in order of
supply by weight, one running sum gives the level at which the budget is spent.

A leaf then takes whole epochs and a token-prefix of one more: its documents in the seeded order of
that epoch for as long as their tokens fit. The prefix is one cut-off of the order's hash, found by
descending the hash bits with pre-aggregated sums, so no leaf, however large, is sorted in one task.

Null languages and sources count as "", null text has 0 tokens, a weight of 0 or less supplies
nothing, rows of equal doc_id and hash enter or stay out together, and other columns pass through
unless they are named as a result. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statuta.llm.common import checkpointed, release, words

LEVELS = ["domain", "language", "origin"]
#: Leaves of at most this many bytes are broadcast; more are joined by leaf and salt.
BROADCAST_BYTES = 32 << 20
SALTS = 64


def join_leaves(rows: DataFrame, leaves: DataFrame, keys: list[str]) -> DataFrame:
    """`rows`, which have doc_id, with the columns of their leaf (`keys`: domain, language, origin).

    The size of `leaves` is measured first. Where it is too large to broadcast, each leaf is
    repeated for SALTS salts, so that the rows of a hot leaf go to as many tasks.
    """
    size = leaves.agg(F.sum(sum((F.octet_length(k) for k in keys), F.lit(128)))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(leaves), keys)
    salted = leaves.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("__salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [*keys, "__salt"]).drop("__salt")


def weight_of(keys: list[str], weights: dict) -> Column:
    """Column of the weight in `weights` (by the values of `keys`, or of the last of them); 1 by default."""
    out = None
    for key, weight in weights.items():
        values = key if isinstance(key, tuple) else (key,)
        same = F.lit(True)
        for name, value in zip(keys[-len(values) :], values, strict=True):
            same = same & (F.col(name) == value)
        out = F.when(same, F.lit(float(weight))) if out is None else out.when(same, F.lit(float(weight)))
    return F.lit(1.0) if out is None else out.otherwise(F.lit(1.0))


def share(nodes: DataFrame, parent: list[str], budget: str, weight: str, supply: str, out: str) -> DataFrame:
    """`nodes` with `out`: the part of the parent's budget that each child gets."""
    live = F.greatest(F.col(weight), F.lit(0.0))
    ready = nodes.withColumn("__w", live).withColumn("__s", F.when(live > 0, F.col(supply).cast("double")).otherwise(F.lit(0.0)))
    family = Window.partitionBy(*parent).orderBy(F.when(live > 0, F.col("__s") / live).otherwise(F.lit(0.0)), *LEVELS)
    before = F.coalesce(F.sum("__s").over(family.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("__w").over(family.rowsBetween(0, Window.unboundedFollowing))
    level = ready.withColumn("__level", F.when(rest > 0, (F.col(budget) - before) / rest).otherwise(F.lit(0.0)))
    top = F.max("__level").over(Window.partitionBy(*parent))
    return level.withColumn("__top", top).withColumn(out, F.greatest(F.lit(0.0), F.least(F.col("__s"), F.col("__top") * F.col("__w")))).drop("__w", "__s", "__level", "__top")


def budgets(leaves: DataFrame, total: float, weights: tuple[dict, dict, dict], max_epochs: int) -> DataFrame:
    """Leaves (domain, language, origin, tokens) with the token budget of each."""
    each = leaves.withColumn("supply", F.col("tokens") * F.lit(max_epochs)).withColumn("root", F.lit(0))
    for i, name in enumerate(LEVELS):
        each = each.withColumn(f"w{i}", weight_of(LEVELS[: i + 1], weights[i]))
    supplied = F.when((F.col("w0") > 0) & (F.col("w1") > 0) & (F.col("w2") > 0), F.col("supply")).otherwise(F.lit(0))
    each = each.withColumn("supply", supplied)
    blank = lambda n: [F.lit("").alias(x) for x in LEVELS[n:]]
    top = each.groupBy("root", "domain").agg(F.sum("supply").alias("supply"), F.first("w0").alias("w0")).select("*", *blank(1)).withColumn("b", F.lit(float(total)))
    top = share(top, ["root"], "b", "w0", "supply", "budget0").select("domain", "budget0")
    middle = each.groupBy("domain", "language").agg(F.sum("supply").alias("supply"), F.first("w1").alias("w1")).select("*", *blank(2)).join(top, "domain")
    middle = share(middle, ["domain"], "budget0", "w1", "supply", "budget1").select("domain", "language", "budget1")
    leaf = share(each.join(middle, ["domain", "language"]), ["domain", "language"], "budget1", "w2", "supply", "budget")
    return leaf.select(*LEVELS, "tokens", F.floor(F.col("budget") + 1e-6).cast("long").alias("budget"))


def _crossing(sums: DataFrame, bucket: str, start: Column, rest: str) -> DataFrame:
    """For each leaf the bucket in which the running sum passes `rest`, and the sum before it."""
    run = Window.partitionBy(*LEVELS).orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = sums.withColumn("__to", start + F.sum("tokens").over(run))
    return summed.where((F.col("__to") > F.col(rest)) & (F.col("__to") - F.col("tokens") <= F.col(rest)))


def plan(docs: DataFrame, tokens: Column, domain: Column, seed: int, part: float, weights, max_epochs: int) -> DataFrame:
    """Leaves with budget, epochs (whole ones) and cut: the last hash that the epoch after them keeps.

    Sums and hashes of all documents are made from a narrow table of (leaf, doc_id, tokens).
    """
    narrow = checkpointed(docs.select("doc_id", domain.alias("domain"), F.coalesce("lang", F.lit("")).alias("language"), F.coalesce("source", F.lit("")).alias("origin"), tokens.cast("long").alias("tokens")))
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    total = (leaves.agg(F.sum("tokens").alias("n")).first()["n"] or 0) * part
    planned = budgets(leaves, total, weights, max_epochs)
    planned = planned.withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(0)).cast("int"))
    planned = checkpointed(planned.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")))
    release(docs.sparkSession)
    rows = join_leaves(narrow, planned.select(*LEVELS, "epochs", "rest"), LEVELS).withColumn("h", order_hash(seed))
    rows = rows.withColumn("b1", F.shiftright("h", 40)).withColumn("b2", F.shiftright("h", 32) % 256)
    first = _crossing(rows.groupBy(*LEVELS, "rest", "b1").agg(F.sum("tokens").alias("tokens")), "b1", F.lit(0), "rest")
    first = checkpointed(first.select(*LEVELS, F.col("b1").alias("c1"), (F.col("__to") - F.col("tokens")).alias("s1")))
    inside = join_leaves(rows, first, LEVELS).where("b1 = c1")
    second = _crossing(inside.groupBy(*LEVELS, "rest", "c1", "s1", "b2").agg(F.sum("tokens").alias("tokens")), "b2", F.col("s1"), "rest")
    second = checkpointed(second.select(*LEVELS, "c1", F.col("b2").alias("c2"), (F.col("__to") - F.col("tokens")).alias("s2")))
    last = join_leaves(rows, second, LEVELS).where("b1 = c1 and b2 = c2")
    run = Window.partitionBy(*LEVELS).orderBy("h")
    fits = last.withColumn("__to", F.col("s2") + F.sum("tokens").over(run)).where("__to <= rest").groupBy(*LEVELS).agg(F.max("h").alias("kept"))
    below = second.select(*LEVELS, ((F.col("c1") * 256 + F.col("c2")) * F.lit(1 << 32) - 1).alias("below"))
    cuts = below.join(fits, LEVELS, "left").select(*LEVELS, F.coalesce("kept", "below").alias("cut"))
    # Without a crossing the rest takes the whole leaf (only where it has no tokens).
    return planned.join(cuts, LEVELS, "left").withColumn("cut", F.coalesce("cut", F.lit((1 << 48) - 1)))


def order_hash(seed: int) -> Column:
    """48-bit place of a document in the order of the epoch after the whole ones."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "epochs", "doc_id"), 16)


def mix_sources(docs: DataFrame, domain: Column, weights=({}, {}, {}), part: float = 0.8, max_epochs: int = 2, seed: int = 17, tokens: Column | None = None) -> DataFrame:
    """Documents of the mixture with domain, n_tokens and copies (epochs that hold the document).

    The mixture has at most `part` times the tokens of `docs`. Documents of no epoch are left out.
    """
    tokens = F.size(words(F.col("text"))) if tokens is None else tokens
    leaves = checkpointed(plan(docs, tokens, domain, seed, part, weights, max_epochs).select(F.col("domain").alias("__d"), F.col("language").alias("__l"), F.col("origin").alias("__o"), "epochs", "cut"))
    release(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("domain", "n_tokens", "copies", "epochs", "cut")]
    leaves = leaves.withColumnsRenamed({"epochs": "__epochs", "cut": "__cut"})
    placed = docs.withColumn("__d", domain).withColumn("__l", F.coalesce("lang", F.lit(""))).withColumn("__o", F.coalesce("source", F.lit("")))
    held = join_leaves(placed, leaves, ["__d", "__l", "__o"])
    copies = F.col("__epochs") + (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "__epochs", "doc_id"), 16) <= F.col("__cut")).cast("int")
    out = held.withColumn("__copies", copies).where("__copies > 0")
    return out.select(*names, F.col("__d").alias("domain"), tokens.cast("long").alias("n_tokens"), F.col("__copies").alias("copies"))
