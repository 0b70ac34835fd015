"""Positions, groups, pages, prefixes and owners of the units of a document.

Null keys match nothing; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def positions(rows: DataFrame, section: list[str], *order: Column) -> DataFrame:
    """`rows` with position: the place in their section, from 0."""
    return rows.withColumn("position", F.row_number().over(Window.partitionBy(*section).orderBy(*order)) - 1)


def chapter_batches(rows: DataFrame, document: list[str], opens: Column, size: int, *order: Column) -> DataFrame:
    """`rows` with chapter (rows that `opens` holds for start one; 0 before the first) and batch of at most `size` rows in it."""
    running = Window.partitionBy(*document).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = rows.withColumn("chapter", F.sum(F.coalesce(opens, F.lit(False)).cast("int")).over(running))
    place = F.row_number().over(Window.partitionBy(*document, "chapter").orderBy(*order))
    return opened.withColumn("batch", F.floor((place - 1) / size).cast("int"))


def page_spans(pages: DataFrame, document: str, page: str, text: str, gap: int = 1) -> DataFrame:
    """document, page and its span [start, end) in the pages' joined texts, `gap` characters between them; null text is empty."""
    size = F.coalesce(F.char_length(text), F.lit(0)).cast("long")
    before = Window.partitionBy(document).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    narrow = pages.select(document, page, size.alias("size"))
    start = F.coalesce(F.sum(F.col("size") + gap).over(before), F.lit(0))
    return narrow.withColumn("start", start).withColumn("end", F.col("start") + F.col("size")).drop("size")


def page_of(offsets: DataFrame, spans: DataFrame, document: str, offset: str) -> DataFrame:
    """`offsets` with the span that holds each; offsets in a gap or beyond the text have none and are left out."""
    return offsets.join(spans, document).where((F.col("start") <= F.col(offset)) & (F.col(offset) < F.col("end")))


def under_works(rows: DataFrame, uri: str, works: DataFrame, work: str) -> DataFrame:
    """`rows` joined with the works whose URI, followed by a slash, begins theirs.

    Each URI is spread to its own ancestors, so that the join is one of equal keys.
    """
    parts = F.split(F.col(uri), "/")
    above = F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")), lambda p: F.col(uri).startswith(F.concat(p, F.lit("/"))))
    return rows.withColumn(work, F.explode(above)).join(works, work)


def code_matches(rows: DataFrame, code: str, asked: DataFrame, wanted: str) -> DataFrame:
    """`rows` with the asked codes (column `wanted`, not empty) that theirs equals or is narrower than, and exact."""
    begins = F.transform(F.sequence(F.lit(1), F.char_length(code)), lambda n: F.substring(F.col(code), F.lit(1), n))
    spread = rows.where(F.char_length(code) > 0).withColumn(wanted, F.explode(begins))
    return spread.join(asked, wanted).withColumn("exact", F.col(wanted) == F.col(code))


def owners(rows: DataFrame, kind: str, ref: str, held: dict[str, DataFrame]) -> DataFrame:
    """`rows` with owner: what the table of their kind (key, owner) says of `ref`; null where it says nothing.

    The tables are joined as one, by kind and key, instead of one after another.
    """
    every = None
    for name, found in held.items():
        one = found.select(F.lit(name).alias(kind), F.col("key").cast("long").alias(ref), F.col("owner").cast("long").alias("owner"))
        every = one if every is None else every.unionByName(one)
    return rows.withColumn(ref, F.col(ref).cast("long")).join(every, [kind, ref], "left")


def placeholder_share(rows: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """keys and share of rows whose flag is true; null if the flag of any row isn't known."""
    known = F.count(flag) == F.count(F.lit(1))
    return rows.groupBy(*keys).agg(F.when(known, F.round(F.avg(F.col(flag).cast("int")), 6)).alias("share"))


def lacking(rows: DataFrame, notes: DataFrame, keys: list[str], of: str) -> DataFrame:
    """The distinct `of` that have any row without a note of the same keys."""
    return rows.join(notes.select(*keys), keys, "left_anti").select(of).distinct()


def grouped_matches(matches: DataFrame, key: str, laws: int, law_order: list[Column], each: int, order: list[Column]) -> DataFrame:
    """The first `laws` groups of the matches, with their match counts, and at most `each` rows of them by rank.

    Groups are counted before any is chosen; only the chosen groups' rows are ranked.
    """
    counted = matches.groupBy(key).agg(F.count("*").alias("matches")).orderBy(*law_order).limit(laws)
    chosen = matches.join(F.broadcast(counted), key)
    ranked = chosen.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("rank") <= each)
