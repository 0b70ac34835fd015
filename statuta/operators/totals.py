"""Corpus totals as a mergeable nested aggregate: by era, section and name a list of counts, and their comparison with a pinned baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["era", "section", "name"]


def totals(rows: DataFrame, width: int = 3) -> DataFrame:
    """era, section, name and counts (array of `width` sums) of rows with nested counters.

    rows: era, counters (map of section to map of name to array of longs). Sums are combined in each
    task first, so a shuffle carries a row for each key and task. Null eras count as one era, missing
    and null counts as 0, longer lists are cut at `width`.
    """
    each = rows.select("era", F.explode("counters").alias("section", "m")).select("era", "section", F.explode("m").alias("name", "c"))
    return merge_totals(each.select(*KEYS, F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.get("c", i).cast("long")).alias("counts")), width=width)


def merge_totals(*parts: DataFrame, width: int = 3) -> DataFrame:
    """Totals of several parts together: associative, in any order."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    sums = [F.coalesce(F.sum(F.get("counts", F.lit(i))), F.lit(0)).alias(f"c{i}") for i in range(width)]
    return every.groupBy(*KEYS).agg(*sums).select(*KEYS, F.array(*(f"c{i}" for i in range(width))).alias("counts"))


def folded(found: DataFrame) -> DataFrame:
    """The totals as nested maps: era, and a map of section to map of name to counts."""
    inner = found.groupBy("era", "section").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "counts")))).alias("m"))
    return inner.groupBy("era").agg(F.map_from_entries(F.collect_list(F.struct("section", "m"))).alias("counters"))


def against(found: DataFrame, pinned: DataFrame) -> DataFrame:
    """Totals beside a pinned baseline: verdict same, new, gone, or changed, and the differences of the counts."""
    a, b = found.alias("a"), pinned.withColumnRenamed("counts", "pinned").alias("b")
    on = F.lit(True)
    for k in KEYS:
        on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    both = a.join(b, on, "full")
    verdict = F.when(F.col("pinned").isNull(), "new").when(F.col("counts").isNull(), "gone").when(F.col("counts") == F.col("pinned"), "same").otherwise("changed")
    change = F.zip_with(F.coalesce("counts", F.array().cast("array<bigint>")), F.coalesce("pinned", F.array().cast("array<bigint>")), lambda x, y: F.coalesce(x, F.lit(0)) - F.coalesce(y, F.lit(0)))
    return both.select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in KEYS], verdict.alias("verdict"), change.alias("change"))
