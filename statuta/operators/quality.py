"""Tri-state rates, numbering gaps, order breaks, grades, legibility and page comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def tri_state_rates(rows: DataFrame, keys: list[str], failed: Column) -> DataFrame:
    """failed, passed, not_run and rate (null where nothing was measured) by key."""
    counted = rows.groupBy(*keys).agg(F.count_if(failed).alias("failed"), F.count_if(~failed).alias("passed"), F.count_if(failed.isNull()).alias("not_run"))
    measured = F.col("failed") + F.col("passed")
    return counted.withColumn("rate", F.when(measured > 0, F.round(F.col("failed") / measured, 6)))


def number_gaps(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Missing numbers between the distinct numbers of a key, and what they suggest."""
    place = Window.partitionBy(*keys).orderBy(number)
    steps = rows.where(F.col(number).isNotNull()).select(*keys, number).distinct().withColumn("__gap", F.col(number) - F.lag(number).over(place) - 1)
    found = steps.groupBy(*keys).agg(F.count("*").alias("numbers"), F.coalesce(F.sum("__gap"), F.lit(0)).alias("missing"), F.coalesce(F.max("__gap"), F.lit(0)).alias("longest"), (F.max(number) - F.min(number) + 1).alias("__span"))
    kind = F.when(F.col("missing") == 0, "none").when((F.col("longest") >= 3) | (F.col("missing") / F.col("__span") > 0.30), "defect").when((F.col("longest") == 1) & (F.col("missing") <= 3), "repeal").otherwise("ambiguous")
    return found.withColumn("kind", kind).drop("__span")


def order_breaks(rows: DataFrame, keys: list[str], position: str, value: str) -> DataFrame:
    """Rows whose value is below that of the row before them in the group."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(position))
    return rows.withColumn("before", before).where(F.col(value) < F.col("before"))


def alignment_summary(verdicts: DataFrame, keys: list[str], verdict: str, label: str, order: str) -> DataFrame:
    """Counts and percentages of the verdicts aligned, partial and gap, the level, and the first eight distinct gap labels in order."""
    counted = verdicts.groupBy(*keys).agg(*[F.count_if(F.col(verdict) == v).alias(v) for v in ("aligned", "partial", "gap")])
    total = F.col("aligned") + F.col("partial") + F.col("gap")
    shares = [F.when(total > 0, F.round(100 * F.col(v) / total, 1)).alias(f"{v}_pct") for v in ("aligned", "partial", "gap")]
    # The first place of each label is aggregated before labels are listed, so a list has each label once.
    firsts = verdicts.where((F.col(verdict) == "gap") & F.col(label).isNotNull()).groupBy(*keys, label).agg(F.min(order).alias("__at"))
    best = Window.partitionBy(*keys).orderBy("__at", label)
    gaps = firsts.withColumn("__rn", F.row_number().over(best)).where("__rn <= 8").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__rn", F.col(label).alias("label")))).alias("__gaps"))
    level = alignment_level(F.col("aligned"), F.col("partial"), F.col("gap")).alias("level")
    return counted.join(gaps, keys, "left").select(*keys, "aligned", "partial", "gap", *shares, level, F.array_join(F.coalesce(F.transform("__gaps", lambda g: g["label"]), F.array().cast("array<string>")), ",").alias("gaps"))


def legibility_verdict(prose: Column, lexicon: Column) -> Column:
    """prose, damaged or not_prose from the two rates; null where a rate that is needed wasn't measured."""
    return F.when(prose >= 80, "prose").when(prose.isNotNull() & (lexicon < 12), "damaged").when(prose.isNotNull() & lexicon.isNotNull(), "not_prose")


def numeral_parity(a: Column, b: Column) -> Column:
    """Multiset overlap of two arrays of numerals over the fuller one; null if neither has any."""
    times = lambda x, v: F.size(F.filter(x, lambda y: y == v))
    both = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, v: s + F.least(times(a, v), times(b, v)))
    most = F.greatest(F.size(a), F.size(b))
    return F.when(most > 0, F.round(both / most, 6))


def grade(findings: DataFrame, keys: list[str], severity: str, order: str, reason: str) -> DataFrame:
    """Grade of the worst severity and the earliest finding of it; info is ignored."""
    rank = F.when(F.col(severity) == "error", 2).when(F.col(severity) == "warning", 1).otherwise(0)
    worst = findings.withColumn("__rank", rank).where("__rank > 0").groupBy(*keys).agg(F.max_by(F.struct("__rank", F.col(reason).alias("reason")), F.struct("__rank", -F.col(order))).alias("w"))
    return worst.select(*keys, F.when(F.col("w.__rank") == 2, "blocking").otherwise("warning").alias("grade"), F.col("w.reason").alias("reason"))


def rate_per_thousand(tokens: Column, listed: list[str], floor: int) -> Column:
    """Listed words per 1,000 tokens; null below `floor` tokens."""
    hits = F.size(F.filter(tokens, lambda t: t.isin(*listed)))
    return F.when(F.size(tokens) >= floor, F.round(hits * 1000 / F.size(tokens), 6))


def band(rate: Column) -> Column:
    return F.when(rate >= 120, "good").when(rate >= 80, "fair").when(rate >= 40, "poor").when(rate.isNotNull(), "illegible")


def divergence(a: Column, b: Column) -> Column:
    """1 - Jaccard of two token arrays; null if either is empty."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    both = F.size(F.array_intersect(x, y))
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.round(1 - both / (F.size(x) + F.size(y) - both), 6))


def repeat_density(tokens: Column, n: int = 6, floor: int = 12) -> Column:
    """Share of n-grams that repeat an earlier one; null below `floor` tokens."""
    grams = F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= floor, F.round(1 - F.size(F.array_distinct(grams)) / F.size(grams), 6))


def alignment_level(aligned: Column, partial: Column, gap: Column) -> Column:
    """Level of a comparison: half credit for partial matches, inconclusive below five."""
    total = aligned + partial + gap
    share = (aligned + 0.5 * partial) / total
    return F.when(total < 5, "inconclusive").when((partial == 0) & (gap == 0), "fully_aligned").when(share >= 0.85, "largely_aligned").when(share >= 0.50, "partially_aligned").otherwise("not_aligned")
