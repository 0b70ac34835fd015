"""Substring deduplication by recompression.

Each text, as a sequence of word hashes, is parsed in rounds: runs of one symbol and pairs of a
left-class and a right-class symbol get new symbols. A symbol's name is a hash of what it stands
for, so that names agree over the whole corpus without a dictionary, and a symbol carries the
interval of words that its existence depends on. Symbols whose interval lies inside a window of
`window` words are therefore the same in every copy of the window. Each window is assigned the
symbol of the highest round inside it (of least hash, then leftmost); windows in a row with one
symbol form an occurrence, named by the symbol and by the words it spans.

Symbols only propose. What is compared are the words themselves: occurrences of shared symbols carry,
beside the symbol's 64-bit name, half of a 128-bit BLAKE2 digest of the bytes of their words. Spark finds occurrences that a document with a
smaller doc_id has too: all their windows repeat. Symbols that occur within different spans are
verified window by window, by half a digest of the windows' words and a hash of their word hashes, one document for each distinct span.
Documents get back the names of what repeats in them; texts in which nothing repeats aren't shuffled.
Empty tables give no rows; long texts are parsed whole.

Words are runs of characters other than space and \\t\\n\\v\\f\\r. Null text has no words. Windows of
the same document, of rows of the same doc_id, or of texts shorter than a window never repeat; rows
of a null doc_id keep everything and are no source. Other columns pass through; columns named as a
result (n_words, n_removed, kept) are replaced.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statuta.llm.common import FILTER_BITS, bitmap, checkpointed, hash_texts, is_set, may_hold, mix, release, words

WINDOW = 50
ROUNDS = 6
_A, _B = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)
SLICE_BYTES = 1 << 20


class Parse:
    """The rounds of recompression of a batch of texts, and its occurrences."""

    def __init__(self, texts: list[bytes], window: int):
        words, offsets = hash_texts(texts)
        self.texts, self.words, self.offsets, self.window = texts, words, offsets, window
        n, sizes = len(words), np.diff(offsets)
        of = np.repeat(np.arange(len(sizes)), sizes)
        self.of = of
        name, low, high = words, np.arange(n), np.arange(1, n + 1)
        start, end = offsets[:-1] - 1, offsets[1:] + 1
        levels = [(name, low, high)]
        for k in range(1, ROUNDS + 1):
            if len(name) < 2:
                break
            if k % 2:
                name, low, high, of = self._runs(name, low, high, of, start, end)
            name, low, high, of = self._pairs(name, low, high, of, start, end, k)
            levels.append((name, low, high))
        last = np.maximum(sizes - window + 1, 0)
        begins = np.repeat(offsets[:-1], last) + np.arange(last.sum()) - np.repeat(np.cumsum(last) - last, last)
        self._choose(begins, levels)

    @staticmethod
    def _runs(name, low, high, of, start, end):
        """Maximal runs become symbols; what is no run depends on its neighbours too."""
        fresh = np.concatenate(([True], (name[1:] != name[:-1]) | (of[1:] != of[:-1])))
        at = np.flatnonzero(fresh)
        until = np.append(at[1:], len(name))
        length = (until - at).astype(np.uint64)
        out = np.where(length > 1, mix(name[at] * _A + length), name[at])
        before, after = np.maximum(at - 1, 0), np.minimum(until, len(name) - 1)
        doc = of[at]
        lows = np.where((at > 0) & (of[before] == doc), low[before], start[doc])
        highs = np.where((until < len(name)) & (of[after] == doc), high[after], end[doc])
        return out, lows, highs, doc

    @staticmethod
    def _pairs(name, low, high, of, start, end, k):
        """Pairs of a left-class and a right-class symbol become symbols."""
        salt = np.uint64(k * int(_B) % (1 << 64))
        right = (mix(name + salt) & np.uint64(1)).astype(bool)
        near = of[1:] == of[:-1]
        joined = np.concatenate((near & ~right[:-1] & right[1:], [False]))
        second = np.concatenate(([False], joined[:-1]))
        low_before = np.where(np.concatenate(([False], near)), np.concatenate((low[:1], low[:-1])), start[of])
        high_after = np.where(np.concatenate((near, [False])), np.concatenate((high[1:], high[-1:])), end[of])
        lows = np.where(joined | ~right, low, low_before)
        highs = np.where(joined | ~right, high_after, high)
        pair = mix((name[:-1] * _A + name[1:]) ^ salt)
        names = np.where(joined, np.append(pair, np.uint64(0)), name)
        keep = ~second
        return names[keep], lows[keep], highs[keep], of[keep]

    def _choose(self, begins: np.ndarray, levels: list) -> None:
        chosen = np.full(len(begins), -1, dtype=np.int64)
        names = np.zeros(len(begins), dtype=np.uint64)
        todo, shift = np.arange(len(begins)), 0
        for name, low, high in reversed(levels):
            if not len(todo):
                break
            i = begins[todo]
            first = np.searchsorted(low, i)
            last = np.searchsorted(high, i + self.window, "right")
            fit = last > first
            first, last, now = first[fit], last[fit], todo[fit]
            if len(now):
                best = self._least(mix(name ^ _B), first, last)
                chosen[now], names[now] = best + shift, name[best]
            shift += len(name)
            todo = todo[~fit]
        fresh = np.ones(len(begins), dtype=bool)
        if len(begins) > 1:
            fresh[1:] = (chosen[1:] != chosen[:-1]) | (begins[1:] != begins[:-1] + 1)
        at = np.flatnonzero(fresh)
        self.first = begins[at]
        self.last = begins[np.append(at[1:], len(begins)) - 1] if len(at) else self.first
        self.name = names[at]
        self.doc = self.of[self.first] if len(at) else np.empty(0, dtype=np.int64)

    @staticmethod
    def _least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Leftmost place of the least value in each [first, last)."""
        width = last - first
        out = np.empty(len(first), dtype=np.int64)
        places, size = np.arange(len(values)), 1
        while True:
            fit = (width >= size) & (width < 2 * size)
            a, b = places[first[fit]], places[last[fit] - size]
            out[fit] = np.where(values[b] < values[a], b, a)
            if not (width >= 2 * size).any():
                return out
            a, b = places[:-size], places[size:]
            places, size = np.where(values[b] < values[a], b, a), 2 * size

    def digests(self, first: np.ndarray, until: np.ndarray) -> np.ndarray:
        """128-bit digests of the words [first, until) of each span, as pairs of integers; spans by document."""
        out, docs = [], self.of[first]
        edges = [0, *(np.flatnonzero(np.diff(docs)) + 1), len(docs)] if len(docs) else []
        for at, to in itertools.pairwise(edges):
            split = self.texts[docs[at]].split()
            joined, base = b" ".join(split), self.offsets[docs[at]]
            ends = np.concatenate(([0], np.cumsum(np.fromiter(map(len, split), np.int64, len(split)) + 1)))
            spans = zip(ends[first[at:to] - base].tolist(), (ends[until[at:to] - base] - 1).tolist(), strict=True)
            out += [hashlib.blake2b(joined[a:b], digest_size=16).digest() for a, b in spans]
        return np.frombuffer(b"".join(out), dtype="<i8").reshape(-1, 2)

    def mixed(self, begins: np.ndarray) -> np.ndarray:
        """Hashes of the windows of word hashes that start at `begins`: halves of doubling length are mixed in order."""
        if not len(begins):
            return np.empty(0, dtype=np.int64)
        out, part, size, at, n = np.zeros(len(self.words), dtype=np.uint64), self.words, 1, 0, len(self.words)
        while True:
            if self.window & size:
                out[: n - at] = mix(out[: n - at] * _A + part[at:n])
                at += size
            if 2 * size > self.window:
                return out[begins].view(np.int64)
            part, size = np.append(mix((part[:-size] * _B) ^ mix(part[size:] + _A)), np.zeros(size, dtype=np.uint64)), 2 * size

    def keys(self, picked: np.ndarray) -> np.ndarray:
        """Digests of the picked occurrences."""
        return self.digests(self.first[picked], self.last[picked] + self.window)

    def windows(self, picked: np.ndarray) -> np.ndarray:
        """Starts of all windows of the picked occurrences."""
        n = self.last[picked] - self.first[picked] + 1
        return np.repeat(self.first[picked], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _squeezed(text: Column) -> Column:
    """A text's bytes, compressed: what a shuffle of texts writes is then two thirds."""

    @F.arrow_udf("binary")
    def squeezed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield pa.array([None if t.as_py() is None else pack.compress(t.as_py().encode()) for t in batch], pa.binary())

    return squeezed(text)


def _plain(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of texts, squeezed or not."""
    if (pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)):
        return [None if x is None else zstandard.decompress(x) for x in column.to_pylist()]
    return [None if x is None else x.encode() for x in column.to_pylist()]


def _parsed(batch: pa.RecordBatch, text: int, window: int) -> Iterator[tuple[pa.RecordBatch, Parse]]:
    """Slices of a batch and their parse."""
    column = batch.column(text)
    sizes = [x and zstandard.frame_content_size(x) for x in column.to_pylist()] if (pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)) else pa.compute.binary_length(column).to_pylist()
    lengths = np.array([x or 0 for x in sizes], dtype=np.int64)
    group = np.cumsum(lengths) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1), len(lengths)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            part = batch.slice(a, b - a)
            yield part, Parse([t or b"" for t in _plain(part.column(text))], window)


def symbols(docs: DataFrame, window: int) -> DataFrame:
    """name and doc_id of the symbols that name the occurrences of each document, once each."""

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, parse in _parsed(batch, 1, window):
                keep = _once(parse.doc, parse.name)
                ids = part.column(0).to_numpy(zero_copy_only=False)[parse.doc[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(parse.name[keep].view(np.int64)), pa.array(ids.astype(np.int64))], names=["name", "doc_id"])

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(emitted, "name long, doc_id long")


def _once(*columns: np.ndarray) -> np.ndarray:
    """Places of the first of each group of equal rows."""
    order = np.lexsort(columns[::-1])
    if not len(order):
        return order
    fresh = np.zeros(len(order), dtype=bool)
    fresh[0] = True
    for c in columns:
        fresh[1:] |= c[order][1:] != c[order][:-1]
    return np.sort(order[fresh])


def occurrences(docs: DataFrame, window: int, names) -> DataFrame:
    """name, k1 (digest) and doc_id of the occurrences, once in a document, whose names the broadcast bitmap has."""

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, parse in _parsed(batch, 1, window):
                picked = np.flatnonzero(is_set(names.value, (parse.name & np.uint64(FILTER_BITS - 1)).astype(np.int64)))
                key, doc, name = parse.keys(picked)[:, 0], parse.doc[picked], parse.name[picked].view(np.int64)
                keep = _once(doc, name, key)
                ids = part.column(0).to_numpy(zero_copy_only=False)[doc[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(name[keep]), pa.array(key[keep]), pa.array(ids.astype(np.int64))], names=["name", "k1", "doc_id"])

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(emitted, "name long, k1 long, doc_id long")


def _membership(lists: list, values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each (value, document) whether the document's list holds the value; rows by document."""
    out = np.zeros(len(values), dtype=bool)
    bounds = np.searchsorted(of, np.arange(len(lists) + 1))
    for i, wanted in enumerate(lists):
        if wanted:
            a, b = bounds[i], bounds[i + 1]
            out[a:b] = np.isin(values[a:b], np.array(wanted, dtype=np.int64))
    return out


def _listed(parse: Parse, names: list, keys: list) -> np.ndarray:
    """Places of the occurrences whose name and digest their document's lists hold."""
    named = np.flatnonzero(_membership(names, parse.name.view(np.int64), parse.doc))
    return named[_membership(keys, parse.keys(named)[:, 0], parse.doc[named])]


def spans_to_verify(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """w1 (half of a window's digest), w2 (hash of its word hashes) and doc_id of all windows of the wanted (doc_id, names, keys) occurrences."""

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, parse in _parsed(batch, 1, window):
                begins = parse.windows(_listed(parse, part.column(2).to_pylist(), part.column(3).to_pylist()))
                digests = parse.digests(begins, begins + window)
                ids = part.column(0).to_numpy()[parse.of[begins]] if len(begins) else np.empty(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(digests[:, 0]), pa.array(parse.mixed(begins)), pa.array(ids.astype(np.int64))], names=["w1", "w2", "doc_id"])

    near = docs.select("doc_id", "text").where("doc_id is not null").where(may_hold(wanted, "doc_id")(F.col("doc_id")))
    near = near.select("doc_id", _squeezed(F.col("text")).alias("text"))
    return near.join(wanted, "doc_id").select("doc_id", "text", "names", "keys").mapInArrow(emitted, "w1 long, w2 long, doc_id long")


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` with n_words, n_removed and kept: the kept words, joined by one space.

    A word is removed if a window that covers it also starts in a document of smaller doc_id.
    """
    # Most symbols are of one document only; the rest of the work is on those of several.
    shared = checkpointed(symbols(docs, window).groupBy("name").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("name"))
    names = bitmap(shared.select(F.col("name").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("h")))
    release(docs.sparkSession)
    found = checkpointed(occurrences(docs, window, names).join(shared, "name", "left_semi"))
    each = checkpointed(found.groupBy("name", "k1").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")))
    release(docs.sparkSession)
    repeated = found.join(each.where("first < last").select("name", "k1", "first"), ["name", "k1"]).where("doc_id > first").select("doc_id", "name", "k1")
    mixed = checkpointed(each.groupBy("name").agg(F.count("*").alias("n"), F.min("first").alias("a"), F.max("last").alias("b")).where("n > 1 and a < b").select("name"))
    wanted = checkpointed(each.join(mixed, "name").groupBy(F.col("first").alias("doc_id")).agg(F.collect_set("name").alias("names"), F.collect_set("k1").alias("keys")))
    windows = checkpointed(spans_to_verify(docs, wanted, window))
    sources = checkpointed(windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("w1", "w2", "first"))
    release(docs.sparkSession)
    partly = windows.where(may_hold(sources, "w1")(F.col("w1"))).join(sources, ["w1", "w2"]).where("doc_id > first").select("doc_id", "w1", "w2").distinct()
    return removed(docs, repeated, partly, window)


def removed(docs: DataFrame, repeated: DataFrame, partly: DataFrame, window: int) -> DataFrame:
    """Takes out the words of repeated occurrences (doc_id, name, k1) and windows (doc_id, w1, w2).

    A window's word hashes are looked up first; digests are taken of those windows only that they let through.
    """
    none = F.lit(None).cast("long")
    flags = repeated.select("doc_id", "name", "k1", none.alias("w1"), none.alias("w2")).unionByName(partly.select("doc_id", none.alias("name"), none.alias("k1"), "w1", "w2"))
    flags = checkpointed(flags.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set("name").alias("__names"), F.collect_set("k1").alias("__keys"), F.collect_set("w1").alias("__windows"), F.collect_set("w2").alias("__mixed")))
    rest = docs.drop("n_words", "n_removed", "kept")
    names = rest.columns
    text = names.index("text")
    schema = T.StructType([*rest.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, parse in _parsed(batch, text, window):
                symbols, keys, hashes, mixed = (part.column(len(names) + i).to_pylist() for i in range(4))
                change = np.zeros(len(parse.words) + 1, dtype=np.int64)
                picked = _listed(parse, symbols, keys)
                np.add.at(change, parse.first[picked], 1)
                np.add.at(change, parse.last[picked] + window, -1)
                listed = np.array([bool(h) for h in hashes], dtype=bool)
                if listed.any():
                    begins = parse.windows(np.flatnonzero(listed[parse.doc]))
                    begins = begins[_membership(mixed, parse.mixed(begins), parse.of[begins])]
                    hit = begins[_membership(hashes, parse.digests(begins, begins + window)[:, 0], parse.of[begins])]
                    np.add.at(change, hit, 1)
                    np.add.at(change, hit + window, -1)
                gone = np.cumsum(change)[:-1] > 0
                kept, taken = [], []
                for t, a, b in zip(parse.texts, parse.offsets[:-1], parse.offsets[1:], strict=True):
                    here, split = gone[a:b], t.split()
                    taken.append(int(here.sum()))
                    kept.append(b" ".join([w for w, g in zip(split, here.tolist(), strict=True) if not g] if taken[-1] else split).decode())
                whole = pa.array([None if x is None else x.decode() for x in _plain(part.column(text))], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:text], whole, *part.columns[text + 1 : len(names)], pa.array(np.diff(parse.offsets)), pa.array(taken, pa.int64()), pa.array(kept, pa.string())],
                    names=[*names, "n_words", "n_removed", "kept"],
                )

    listed = F.coalesce(may_hold(flags, "__id")(F.coalesce("doc_id", F.lit(0))) & F.col("doc_id").isNotNull(), F.lit(False))
    marked = rest.withColumn("__listed", listed)
    # The text goes through the shuffle squeezed, in its own place among the columns.
    joined = marked.where("__listed").withColumn("text", _squeezed(F.col("text"))).join(flags, F.col("doc_id") == F.col("__id"), "left").select(*names, "__names", "__keys", "__windows", "__mixed")
    found = words(F.col("text"))
    whole = marked.where("not __listed").select(*names, F.size(found).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.array_join(found, " ").alias("kept"))
    return joined.mapInArrow(cut, schema).unionByName(whole)
