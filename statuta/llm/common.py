"""Helpers that the training-data operators share."""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.sources.tables import checkpointed, unsized  # noqa: F401  (the other modules take them from here)

#: Words are the maximal runs of characters outside this class.
SPACES = r"[\x20\x09-\x0D]+"
PIECE_BYTES = 2 << 20
FILTER_BITS = 1 << 24
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_CUT = re.compile(r"(?<=\S)[ \n]")
#: Words of more bytes are hashed one by one.
LONG_WORD = 256


def words(text: Column) -> Column:
    """Array of the words of a text; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffles, broadcasts and plans that nothing refers to any more.

    It drops them once the driver has collected its garbage, which by itself happens at any time
    up to half an hour later; between the steps of a long job that keeps disk and memory in use.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hash_piece(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of a piece: eight bytes at a time go through the finaliser, which no algebra undoes."""
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    sizes = ends - starts
    lanes = np.ndarray((len(data) + 1,), "<u8", np.concatenate((data, np.zeros(8, dtype=np.uint8))), 0, (1,))
    h = mix(mix((lanes[starts] & _LOW_BYTES[np.minimum(sizes, 8)]) + _BASE) ^ sizes.astype(np.uint64))
    todo, at = np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD)), 8
    while len(todo):
        left = sizes[todo] - at
        h[todo] = mix((h[todo] + _BASE) ^ mix(lanes[starts[todo] + at] & _LOW_BYTES[np.minimum(left, 8)]))
        todo, at = todo[left > 8], at + 8
    for i in np.flatnonzero(sizes > LONG_WORD):
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def hash_words(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text, in order."""
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE_BYTES)
        if end < len(data):
            cut = max(data.rfind(b" ", at, end), data.rfind(b"\n", at, end))
            if cut < 0:
                found = [x for x in (data.find(b" ", end), data.find(b"\n", end)) if x >= 0]
                cut = min(found, default=len(data) - 1)
            end = cut + 1
        parts.append(_hash_piece(np.frombuffer(data, dtype=np.uint8)[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def hash_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts, one after another, and the offsets of each text's words."""
    out, sizes, group, size = [], [], [], 0

    def flush():
        if group:
            joined = b"\n".join(group)
            space = _SPACE[np.frombuffer(joined, dtype=np.uint8)]
            starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
            bounds = np.cumsum([0, *[len(x) + 1 for x in group]])
            sizes.extend(np.diff(np.searchsorted(starts, bounds)))
            out.append(hash_words(joined))
            group.clear()

    for t in texts:
        if size + len(t) > PIECE_BYTES // 2:
            flush()
            size = 0
        if len(t) > PIECE_BYTES // 2:
            out.append(hash_words(t))
            sizes.append(len(out[-1]))
        else:
            group.append(t)
            size += len(t)
    flush()
    flat = np.concatenate(out) if out else np.empty(0, dtype=np.uint64)
    return flat, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def slices(text: str, size: int = 1 << 20) -> Iterator[str]:
    """Parts of about `size` characters of a text, cut before a blank or line end that follows another character."""
    at = 0
    while len(text) - at > size:
        found = _CUT.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def streamed(rows: DataFrame, keys: list[str], order: list[str], step, schema: str) -> DataFrame:
    """`step` over the batches of partitions that hold the rows of each key together, in `order`; no group is held whole."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(step, schema)


def at_most(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """At most `limit` of `rows`, chosen by a hash of `key`: those below a bound that a histogram of 4,096 bins tells."""
    place = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(4096))
    total, bound = 0, 0
    for row in sorted(rows.groupBy(place.alias("bin")).count().collect(), key=lambda r: r["bin"]):
        total += row["count"]
        if total > limit:
            break
        bound = row["bin"] + 1
    return rows.where(place < bound)


def bitmap(places: DataFrame):
    """Broadcast of one bit for each of FILTER_BITS places, set for those in column h of `places`.

    What the driver and the broadcast hold is a fixed size; with very many places all bits are set
    and nothing is ruled out.
    """
    spread = places.select("h")
    bits = spread.groupBy(F.floor(F.col("h") / 64).cast("int").alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("h") % 64).cast("int"))).alias("b"))
    table = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    rows = bits.toArrow()
    table[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    return places.sparkSession.sparkContext.broadcast(table)


def is_set(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((table[places >> 6] >> (places & 63)) & 1) == 1


def may_hold(ids: DataFrame, column: str):
    """A function from an id column to whether `ids` may hold it (always true for those it holds)."""
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    shared = bitmap(ids.select(at(F.col(column)).alias("h")))

    @F.pandas_udf("boolean")
    def held(h: pd.Series) -> pd.Series:
        return pd.Series(is_set(shared.value, h.to_numpy()))

    return lambda c: held(at(c))
