"""Read path: latest rows, paging, facets, roll-ups, semi, anti and full outer joins, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_group(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each group by a full ordering."""
    return rows.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")


def top_n_per_group(rows: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """The first n rows of each group, with their rank."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


def keyset_page(rows: DataFrame, time: str, key: str, cursor, limit: int) -> DataFrame:
    """Page of limit + 1 rows after the row whose key is `cursor`, newest first; unknown cursor: empty."""
    if cursor is not None:
        at = rows.where(F.col(key) == cursor).select(F.col(time).alias("__t"), F.col(key).alias("__k")).limit(1)
        rows = rows.join(F.broadcast(at), (F.col(time) < F.col("__t")) | ((F.col(time) == F.col("__t")) & (F.col(key) < F.col("__k")))).drop("__t", "__k")
    return rows.orderBy(F.desc(time), F.desc(key)).limit(limit + 1)


def pivot_counts(rows: DataFrame, keys: list[str], by: str, values: dict[str, str]) -> DataFrame:
    """Zero-filled counts of each listed value (value to column name) in one aggregation."""
    return rows.groupBy(*keys).agg(*[F.count_if(F.col(by) == value).alias(name) for value, name in values.items()])


def facets(rows: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """facet, value, n: each facet counted under all filters except its own."""
    out = None
    for facet in filters:
        kept = rows
        for other, condition in filters.items():
            if other != facet:
                kept = kept.where(condition)
        counted = kept.groupBy(F.col(facet).alias("value")).count().select(F.lit(facet).alias("facet"), "value", F.col("count").alias("n"))
        out = counted if out is None else out.unionByName(counted)
    return out


def preferred_or_fallback(preferred: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """All preferred rows, and fallback rows of keys that have none."""
    return preferred.unionByName(fallback.join(preferred.select(key).distinct(), key, "left_anti"))


def rate_delta(old: DataFrame, new: DataFrame, keys: list[str], rate: str = "rate") -> DataFrame:
    """Both scans' rates by key with the change and whether a check stopped or started running."""
    a = old.select(*keys, F.col(rate).alias("old_rate"))
    b = new.select(*keys, F.col(rate).alias("new_rate"))
    both = a.join(b, keys, "full_outer")
    return both.select(
        *keys, "old_rate", "new_rate", (F.col("new_rate") - F.col("old_rate")).alias("delta"),
        (F.col("old_rate").isNotNull() & F.col("new_rate").isNull()).alias("stopped"), (F.col("old_rate").isNull() & F.col("new_rate").isNotNull()).alias("started"),
    )


def upsert(held: DataFrame, batch: DataFrame, key: str, fill_nulls: bool = True) -> DataFrame:
    """Next snapshot: batch values win, or with fill_nulls only where the batch has one."""
    values = [c for c in held.columns if c != key]
    new = batch.select(key, *[F.col(c).alias(f"__{c}") for c in values], F.lit(True).alias("__new"))
    pick = lambda c: F.coalesce(F.col(f"__{c}"), F.col(c)) if fill_nulls else F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c))
    return held.join(new, key, "full_outer").select(key, *[pick(c).alias(c) for c in values])


def insert_ignore(held: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Held rows and those of the batch whose key isn't held, once each."""
    return held.unionByName(batch.dropDuplicates(keys).join(held.select(*keys), keys, "left_anti"))


def replace_by_key(held: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Next snapshot in which the batch's keys have only the batch's rows."""
    return held.join(batch.select(*keys).distinct(), keys, "left_anti").unionByName(batch)


def carry_forward(new: DataFrame, prior: DataFrame, keys: list[str], same: list[str], decision: str, *order: Column) -> DataFrame:
    """New rows with the latest prior decision of their key where the `same` columns agree."""
    last = latest_per_group(prior, keys, *order).select(*keys, *[F.col(c).alias(f"__{c}") for c in same], F.col(decision).alias("__decision"))
    agree = F.lit(True)
    for c in same:
        agree = agree & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return new.join(last, keys, "left").withColumn(decision, F.when(agree, F.col("__decision"))).drop("__decision", *[f"__{c}" for c in same])


def keyset_after(rows: DataFrame, order: list[tuple[str, bool]], cursor: dict, limit: int) -> DataFrame:
    """Page of limit + 1 rows after a cursor, by columns (name, ascending), nulls last either way.

    The cursor holds the values of the last row seen; null is a value like any other.
    """
    after, same = F.lit(False), F.lit(True)
    for name, up in order:
        c, at = F.col(name), cursor[name]
        if at is not None:
            beyond = (c > F.lit(at)) if up else (c < F.lit(at))
            after = after | (same & (F.coalesce(beyond, F.lit(False)) | c.isNull()))
        same = same & c.eqNullSafe(F.lit(at))
    sorts = [F.asc_nulls_last(name) if up else F.desc_nulls_last(name) for name, up in order]
    return rows.where(after).orderBy(*sorts).limit(limit + 1)


def latest_in_language(versions: DataFrame, key: str, language: str, *order: Column) -> DataFrame:
    """The version of each key in a language, or else the latest original (parent null)."""
    admitted = versions.where((F.col("language") == language) | F.col("parent").isNull())
    return latest_per_group(admitted, [key], F.desc(F.coalesce(F.col("language") == language, F.lit(False))), *order)


def reranked(rows: DataFrame, score: str, rank: str, key: str, window: int = 200, weight: float = 0.35) -> DataFrame:
    """The best `window` rows by score, in the order of score - rank * weight."""
    best = rows.orderBy(F.desc(score), key).limit(window)
    return best.withColumn("adjusted", F.round(F.col(score) - F.col(rank) * weight, 6)).orderBy(F.desc("adjusted"), key)


def scoped(rows: DataFrame, column: str, scope: list | None) -> DataFrame:
    """Rows of a scope; None is unbounded, an empty scope has no rows."""
    return rows if scope is None else rows.where(F.col(column).isin(*scope)) if scope else rows.where(F.lit(False))


def counts_map(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Per key the number of rows and a map from each value of `by` to its count."""
    each = rows.groupBy(*keys, by).agg(F.count("*").alias("n"))
    return each.groupBy(*keys).agg(F.sum("n").alias("n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(by), F.col("n"))))).alias("classes"))


def set_difference(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """keys and change (gone, new, changed) of two snapshots by key."""
    a, b = (df.select(*keys, F.struct(*values).alias(f"__{i}")) for i, df in enumerate((left, right)))
    both = a.join(b, keys, "full_outer")
    change = F.when(F.col("__1").isNull(), "gone").when(F.col("__0").isNull(), "new").when(~F.col("__0").eqNullSafe(F.col("__1")), "changed")
    return both.select(*keys, change.alias("change")).where("change is not null")
