"""Document fingerprints: threshold-scaled sketches, with Spark expressions only.

A sketch keeps every hash of a text's distinct word shingles below a fixed fraction of the hash
range; of a text with at most WHOLE distinct shingles it keeps them all and says so. Sketches merge by
union, the union's sketch being that of both texts' shingles, and two of them tell containment and
resemblance however unequal the texts: exactly where both are whole, else by the hashes of both
below the fraction.

A text of fewer words than a shingle is one shingle; null text, or text without words, has the empty
whole sketch. Two empty sets are alike (1.0), an empty and another one are not (0.0). Empty tables give
no rows; long texts are read whole. Repeated rows have equal fingerprints. Rows of a null doc_id come
after all others. Columns besides those named are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statuta.llm.common import words

SHINGLE = 5
FRACTION = 0.25
#: Sets of so many distinct shingles are kept whole.
WHOLE = 128
#: Ranges of doc_id that the search for the next document is dealt by; also the most rows that its
#: broadcast can have, if doc_id is unique.
RANGES = 1024


def _bound(fraction: float) -> Column:
    top = int((1 << 63) * min(max(fraction, 0.0), 1.0) * 2) - (1 << 63)
    return F.lit(min(top, (1 << 63) - 1))


def _sketch(whole: Column, hashes: Column) -> Column:
    return F.struct(whole.alias("whole"), hashes.alias("kept"))


def _scaled(kept: Column, fraction: float) -> Column:
    return F.filter(kept, lambda h: h < _bound(fraction))


def sketch(text: Column, shingle: int = SHINGLE, fraction: float = FRACTION) -> Column:
    """Struct of whole (all hashes are kept) and the sorted array of the kept hashes of a text."""

    def hashes(found: Column) -> Column:
        n = F.size(found)
        one = F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(F.array_join(found, " "))))
        each = F.transform(F.sequence(F.lit(0), n - shingle), lambda i: F.xxhash64(*[found[i + k] for k in range(shingle)]))
        return F.array_distinct(F.when(n < shingle, one).otherwise(each))

    def kept(h: Column) -> Column:
        return _sketch(F.size(h) <= WHOLE, F.array_sort(F.when(F.size(h) <= WHOLE, h).otherwise(_scaled(h, fraction))))

    return F.transform(F.transform(F.array(words(text)), hashes), kept)[0]


def merge_sketches(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Sketch of two texts' shingles together."""
    both = F.array_sort(F.array_union(a["kept"], b["kept"]))
    whole = a["whole"] & b["whole"] & (F.size(both) <= WHOLE)
    return _sketch(whole, F.when(whole, both).otherwise(_scaled(both, fraction)))


def _alike(a: Column, b: Column, fraction: float) -> tuple[Column, Column]:
    """The hashes of both that can be compared."""
    whole = a["whole"] & b["whole"]
    return tuple(F.when(whole, x["kept"]).otherwise(_scaled(x["kept"], fraction)) for x in (a, b))


def resemblance(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Likeness |A and B| / |A or B|."""
    x, y = _alike(a, b, fraction)
    both = F.size(F.array_intersect(x, y))
    either = F.size(x) + F.size(y) - both
    return F.when(either > 0, both / either).otherwise((a == b).cast("double"))


def containment(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The part |A and B| / |A| of the first text that the second holds."""
    x, y = _alike(a, b, fraction)
    return F.when(F.size(x) > 0, F.size(F.array_intersect(x, y)) / F.size(x)).otherwise((a["whole"] | (a == b)).cast("double"))


def packed(kept: Column) -> Column:
    """A sketch as a string: = before a whole one, ~ before a scaled one."""
    return F.concat(F.when(kept["whole"], "=").otherwise("~"), F.array_join(F.transform(kept["kept"], lambda h: F.hex(h)), ","))


def with_next(docs: DataFrame, values: list[str], key: str = "doc_id") -> DataFrame:
    """`docs` with next_<value>: the values of the next row by descending key, cyclically.

    Rows are dealt to ranges of the key of about equal size, cut at its quantiles; the first row of a
    range is also the row after the last of the range above, so it is sent there too. The table of
    ranges, at most RANGES rows, is what the driver and the broadcast hold. Null keys come last; rows
    of equal keys share a range and are ordered by the first of their values.
    """
    cuts = docs.agg(F.percentile_approx(key, [i / RANGES for i in range(1, RANGES)], 4 * RANGES).alias("cuts")).first()["cuts"]
    cuts = sorted(set(cuts or []))
    listed = F.from_json(F.lit(json.dumps(cuts)), "array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))] or [F.lit(0)])
    # A binary search: how many cuts are at most the key.
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.coalesce(F.get(listed, at + step - 1) <= F.col(key), F.lit(False)), at + step).otherwise(at))
    part = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(found).cast("long")
    dealt = docs.select(key, *values, part.alias("__part"))
    ranges = dealt.groupBy("__part").agg(F.max(key).alias("__first"))
    order = Window.orderBy(F.desc("__part"))
    ends = Window.orderBy("__part")
    seam = ranges.select("__first", F.coalesce(F.lag("__part").over(order), F.first("__part").over(ends)).alias("__above"))
    dealt = dealt.join(F.broadcast(seam), dealt[key].eqNullSafe(seam["__first"]), "left").drop("__first")
    placed = F.when(F.col("__above").isNull(), F.array(F.struct(F.col("__part").alias("at"), F.lit(0).alias("copy")))).otherwise(F.array(F.struct(F.col("__part").alias("at"), F.lit(0).alias("copy")), F.struct(F.col("__above").alias("at"), F.lit(1).alias("copy"))))
    rows = dealt.select(key, *values, F.explode(placed).alias("__to")).select(key, *values, "__to.at", "__to.copy")
    down = Window.partitionBy("at").orderBy("copy", F.desc_nulls_last(key), values[0])
    nexts = [F.lead(v).over(down).alias(f"next_{v}") for v in values]
    return rows.select(key, *values, "copy", *nexts).where("copy = 0").drop("copy")


def edited_text(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the first as many (or all) of the next text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(following, half))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, fraction: float = FRACTION) -> DataFrame:
    """doc_id, n_chars, the edited text, and sketches of the text, the edited text and the next text."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("sketch", sketch(F.col("text"), shingle, fraction))
    pairs = with_next(own, ["text", "sketch"])
    edited = edited_text(F.col("text"), F.col("next_text"))
    pairs = pairs.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    return pairs.withColumn("edited_sketch", sketch(F.col("edited"), shingle, fraction))


def digests(found: DataFrame) -> DataFrame:
    a, b, c = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), packed(a).alias("fingerprint"), packed(b).alias("edited_fingerprint"),
        resemblance(a, b).alias("near_edited"), resemblance(a, c).alias("near_next"), containment(a, b).alias("held_by_edited"), containment(a, c).alias("held_by_next"),
    )
