"""Byte-level BPE encoding and decoding.

The bytes of a word are an array of symbols, and a fold with Spark's higher-order functions joins,
step by step, the leftmost adjacent pair of the lowest rank. Ranks are looked up in one value, an array of
small maps from pairs of ids, so that one look-up reads a few entries. It is a scalar subquery, as are
the pieces that decode: as literals their text would stand in every plan that the driver describes. The vocabulary must
be one that was trained by merging, where every token encodes to itself; other rank files are refused.

The fold encodes the words that most rows hold, a dictionary of a stated size; folding all distinct
words costs more than this operator's limits (README). Tasks map words to ids with the dictionary
and merge the distinct words outside it in numpy, all words of a batch taking each merging step
together, with the same ranks: ids don't depend on what is in the dictionary. Decoding concatenates the binary pieces of ids.

Null text counts as empty (no ids); repeated rows, empty tables and long texts need no special case;
other columns pass through, a column named `ids` is replaced.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statuta.llm.common import checkpointed, release

#: White space as the rank files' pattern means it (Unicode White_Space), for Java's engine.
WHITE = r"\t\n\x0B\f\r \x85\xA0  -     　"
BUCKETS = 1 << 14
DICTIONARY_WORDS, DICTIONARY_BYTES = 60_000, 32
#: Words outside the dictionary are merged in blocks of at most BLOCK words, by size up to these widths; longer ones one by one.
WIDTHS, BLOCK = (8, 16, 32), 5_000
NONE, NO_TOKEN = 1 << 62, (1 << 31) - 1


@functools.lru_cache(maxsize=2)
def newer(category: str) -> str:
    """Ranges of the library's characters of a category, to be asked for those that Java doesn't know.

    The library itself tells them: it splits a text of all characters, block by block, into those that match.
    """
    import tiktoken

    plain = tiktoken.Encoding("bytes", pat_str=rf"\p{{{category}}}+", mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    found: list[int] = []
    for at in range(0, 0x110000, 0x800):
        if at != 0xD800:
            found += map(ord, plain.decode(plain.encode_ordinary("".join(map(chr, range(at, at + 0x800))))))
    starts = [c for a, c in zip([-2, *found], found, strict=False) if c != a + 1]
    ends = [c for c, b in zip(found, [*found[1:], -2], strict=True) if b != c + 1]
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in zip(starts, ends, strict=True) if a > 0xFF)


def java_pattern(pattern: str, newest: bool = True) -> str:
    r"""The pattern with \s and \S spelled out for Java, and, if `newest`, \p{L} and \p{N} as new as the library's."""
    for category in ("L", "N") if newest else ():
        known, more = rf"\p{{{category}}}", rf"[\p{{Cn}}&&[{newer(category)}]]"
        parts, inside = [], False
        for part in pattern.replace(known, f"\0{known}\0").split("\0"):
            parts.append(part if part != known else known + more if inside else f"[{known}{more}]")
            inside = inside if part == known else (part.rfind("[") > part.rfind("]")) or (inside and "]" not in part)
        pattern = "".join(parts)
    return pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]")


@functools.lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def pieces(text: Column, pattern: str) -> Column:
    """The matches of the pattern in a text, in order.

    Only texts with characters that Java doesn't know need the longer classes, which are slow to test.
    """
    whole = F.coalesce(text, F.lit(""))
    by = lambda newest: F.regexp_extract_all(whole, F.lit(java_pattern(pattern, newest)), F.lit(0))
    return F.when(whole.rlike(r"\p{Cn}"), by(True)).otherwise(by(False))


def _let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.transform(F.array(value), body)[0]


def _splits(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """Pairs of ids that make a token, and its id; ValueError where a token doesn't encode to itself."""
    pairs = {}
    for token, i in ranks.items():
        for k in range(1, len(token)):
            a, b = ranks.get(token[:k]), ranks.get(token[k:])
            if a is not None and b is not None:
                pairs[a, b] = i
    for token, i in ranks.items():
        ids = [ranks[token[k : k + 1]] for k in range(len(token))]
        while len(ids) > 1 and (low := min(pairs.get(p, NONE) for p in itertools.pairwise(ids))) < NONE:
            at = next(k for k, p in enumerate(itertools.pairwise(ids)) if pairs.get(p) == low)
            ids[at : at + 2] = [low]
        if ids != [i]:
            raise ValueError(f"not a vocabulary of merges: {token!r} doesn't encode to itself")
    return pairs


def _one_row(values: list, kind: pa.DataType) -> pa.Table:
    return pa.table({"value": pa.array([values], pa.list_(kind))})


def _value(row: pa.Table) -> Column:
    """The value of a table of one row and column, as a scalar subquery."""
    return SparkSession.active().createDataFrame(row).scalar()


@functools.lru_cache(maxsize=2)
def _tables(path: str) -> tuple[pa.Table, list[int], int, np.ndarray, np.ndarray]:
    """The rank table as one row, the symbols of the bytes, the factor of a pair's first symbol, and the sorted numbers of pairs with their tokens; symbols are ids + 1."""
    ranks = read_ranks(path)
    factor = max(ranks.values(), default=0) + 2
    pairs = sorted(((a + 1) * factor + b + 1, i + 1) for (a, b), i in _splits(ranks).items())
    table = [[NONE] for _ in range(BUCKETS)]
    for key, symbol in pairs:
        table[key % BUCKETS] += [key, symbol]
    keys, symbols = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
    return _one_row(table, pa.list_(pa.int64())), [ranks[bytes([i])] + 1 for i in range(256)], factor, keys.copy(), symbols.astype(np.int32)


def rank_table(path: str) -> Column:
    """The one value: small maps from pairs of ids to ranks, by the pairs' number modulo BUCKETS.

    A map is an array of NONE, then each key with its rank behind it: what is behind the place of a
    key (0 if it isn't there) is its rank, or NONE.
    """
    return _value(_tables(path)[0])


def fold_ids(word: Column, path: str, table: Column) -> Column:
    """Ids of one word by folding ranked merges over its bytes (Spark expressions only); table: the column of the rank table."""
    _, of_byte, size, _, _ = _tables(path)
    symbols = F.array(*[F.lit(i).cast("long") for i in of_byte])

    def folded(table: Column) -> Column:
        def rank(a: Column, b: Column) -> Column:
            key = a * size + b
            entry = F.get(table, key.bitwiseAND(F.lit(BUCKETS - 1)))
            return F.get(entry, F.array_position(entry, key))

        def step(ids: Column, _: Column) -> Column:
            def joined(found: Column) -> Column:
                low = F.array_min(found)
                at = F.array_position(found, low).cast("int")
                merged = F.concat(F.slice(ids, F.lit(1), at - 1), F.array(low), F.slice(ids, at + 2, F.size(ids)))
                return F.when(low < NONE, merged).otherwise(F.concat(ids, F.array(F.lit(-1).cast("long"))))

            ranks = F.zip_with(F.slice(ids, F.lit(1), F.size(ids) - 1), F.slice(ids, F.lit(2), F.size(ids)), rank)
            # A last -1 says that nothing is left to join.
            return F.when((F.size(ids) > 1) & (F.element_at(ids, -1) > 0), _let(ranks, joined)).otherwise(ids)

        single = F.transform(F.split(F.decode(word.cast("binary"), "ISO-8859-1"), ""), lambda c: F.get(symbols, F.ascii(c)))
        return F.aggregate(F.sequence(F.lit(2), F.octet_length(word)), single, step, lambda ids: F.transform(F.array_remove(ids, -1), lambda i: i - 1))

    whole = F.get(symbols, F.ascii(F.decode(word.cast("binary"), "ISO-8859-1")))
    ids = F.when(F.octet_length(word) > 1, _let(table, folded)).when(F.octet_length(word) == 1, F.array(whole - 1)).otherwise(F.array().cast("array<bigint>"))
    return ids.cast("array<int>")


def encode_words(words: DataFrame, path: str, word: str = "word") -> DataFrame:
    """`words`, dealt anew, with the ids of each word.

    Behind a shuffle `word` is a plain column, so that Spark takes the rank table into the fold and makes it no column of the rows.
    """
    dealt = words.repartition(words.sparkSession.sparkContext.defaultParallelism)
    return dealt.withColumn("__ranks", rank_table(path)).withColumn("ids", fold_ids(F.col(word), path, F.col("__ranks"))).drop("__ranks")


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word of any length, in time n log n."""
    n = len(word)
    ends, before, alive = [*range(1, n + 1)], [*range(-1, n - 1)], [True] * n

    def pair(i: int) -> tuple[int, int, int] | None:
        j = ends[i]
        rank = ranks.get(word[i : ends[j]]) if j < n else None
        return None if rank is None else (rank, i, ends[j])

    heap = [x for x in map(pair, range(n)) if x]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or ends[i] >= n or ends[ends[i]] != end:
            continue
        alive[ends[i]] = False
        ends[i] = end
        if end < n:
            before[end] = i
        for x in (i, before[i]):
            if x >= 0 and (found := pair(x)):
                heapq.heappush(heap, found)
    return [ranks[word[i : ends[i]]] for i in range(n) if alive[i]]


def pair_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Numbers of the pairs that make a token, the tokens' symbols, the symbols of the bytes, and the factor of a pair's first symbol."""
    _, of_byte, factor, keys, symbols = _tables(path)
    return keys, symbols, np.array(of_byte, dtype=np.int32), factor


def _merge_block(symbols: np.ndarray, table) -> np.ndarray:
    """Rows of symbols (0 behind a word's end) after all merges; all words take a step at a time."""
    keys, tokens, _, factor = table

    def ranks_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a.astype(np.int64) * factor + b
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        return np.where(keys[at] == pair, tokens[at], np.int32(NO_TOKEN))

    columns = np.arange(symbols.shape[1])
    out, rows = symbols.copy(), np.arange(len(symbols))
    ranks = ranks_of(symbols[:, :-1], symbols[:, 1:])
    while len(rows):
        at = ranks.argmin(axis=1)
        each = np.arange(len(rows))
        low = ranks[each, at]
        going = low < NO_TOKEN
        if not going.all():
            out[rows[~going]] = symbols[~going]
            rows, symbols, ranks, at, low = rows[going], symbols[going], ranks[going], at[going], low[going]
            each = each[: len(rows)]
        # What is behind the merged pair moves one place to the left.
        source = np.minimum(columns + (columns > at[:, None]), len(columns) - 1)
        symbols = np.take_along_axis(symbols, source, 1)
        symbols[:, -1] = 0
        symbols[each, at] = low
        ranks = np.take_along_axis(ranks, np.minimum(source[:, :-1], len(columns) - 2), 1)
        ranks[:, -1] = NO_TOKEN
        for place in (np.maximum(at - 1, 0), at):
            ranks[each, place] = ranks_of(symbols[each, place], symbols[each, place + 1])
    return out


def merge_words(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, table, ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of many words (spans of `data`): all ids, and where each word's begin and how many they are."""
    begins, counts, parts, total = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64), [], 0
    least = 0
    for width in WIDTHS:
        group = np.flatnonzero((sizes > least) & (sizes <= width))
        least = width
        for k in range(0, len(group), BLOCK):
            own = group[k : k + BLOCK]
            places = starts[own, None] + np.arange(width)
            inside = np.arange(width) < sizes[own, None]
            done = _merge_block(np.where(inside, table[2][data[np.where(inside, places, 0)]], np.int32(0)), table)
            held = done > 0
            counts[own] = held.sum(axis=1)
            begins[own] = total + np.cumsum(counts[own]) - counts[own]
            parts.append(done[held] - 1)
            total += len(parts[-1])
    for i in np.flatnonzero(sizes > least):
        parts.append(np.array(merge_long(data[starts[i] : starts[i] + sizes[i]].tobytes(), ranks), dtype=np.int32))
        begins[i], counts[i] = total, len(parts[-1])
        total += len(parts[-1])
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int32), begins, counts


def frequent_words(found: DataFrame, limit: int = DICTIONARY_WORDS) -> DataFrame:
    """The short words that most rows of `found` (array column `words`) hold: as many as `limit` allows.

    A histogram of the counts, of some hundred bins, tells the least count that gives so few words.
    """
    each = found.select(F.explode(F.array_distinct("words")).alias("word")).where(F.octet_length("word") <= DICTIONARY_BYTES)
    counted = checkpointed(each.groupBy("word").count().where("count > 1").withColumn("bin", F.floor(F.log2("count") * 8).cast("int")))
    total, least = 0, None
    for row in sorted(counted.groupBy("bin").count().collect(), key=lambda r: -r["bin"]):
        total += row["count"]
        if total > limit:
            break
        least = row["bin"]
    return counted.where(F.col("bin") >= (F.lit(None) if least is None else F.lit(least))).select("word")


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", columns: list[str] | None = None, dictionary_words: int = DICTIONARY_WORDS) -> DataFrame:
    """`docs` (its `columns`, or all) with `ids`: the ids of the whole text.

    The dictionary is collected and broadcast; it has at most `dictionary_words` words of at most
    DICTIONARY_BYTES bytes each.
    """
    spark = docs.sparkSession
    found = docs.select(pieces(F.col(text), pattern).alias("words"))
    known = encode_words(frequent_words(found, dictionary_words), ranks_path).toArrow()
    release(spark)
    shared = spark.sparkContext.broadcast((known, pair_table(ranks_path)))
    names = [c for c in (docs.columns if columns is None else columns) if c != "ids"]
    kept = [f"c{i}" for i in range(len(names))]
    rest = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(names, kept, strict=True)], pieces(F.col(text), pattern).alias("words"))
    schema = T.StructType([*rest.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType(), False), True)])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = shared.value
        ranks = read_ranks(ranks_path)
        known_words = known.column("word").combine_chunks().cast(pa.large_string())
        known_lists = known.column("ids").combine_chunks()
        known_ids, known_ends = known_lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32), known_lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
        known_begins = np.concatenate(([0], known_ends)).astype(np.int64)

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                lists = part.column(part.num_columns - 1)
                first = lists.offsets[0].as_py()
                flat = lists.values.slice(first, lists.offsets[-1].as_py() - first).dictionary_encode()
                distinct = flat.dictionary.cast(pa.large_string())
                place = pc.fill_null(pc.index_in(distinct, value_set=known_words), -1).to_numpy(zero_copy_only=False)
                begins, n = known_begins[place], np.diff(known_begins)[place] if len(known_words) else np.zeros(len(place), dtype=np.int64)
                joined = known_ids
                others = np.flatnonzero(place < 0)
                if len(others):
                    edges = np.frombuffer(distinct.buffers()[1], dtype=np.int64)[distinct.offset :][: len(distinct) + 1]
                    data = np.frombuffer(distinct.buffers()[2], dtype=np.uint8)
                    more, more_begins, n[others] = merge_words(data, edges[others], np.diff(edges)[others], table, ranks)
                    begins[others] = len(joined) + more_begins
                    joined = np.concatenate((joined, more))
                words = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = n[words]
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
                out = joined[np.repeat(begins[words] - ends[:-1], sizes) + np.arange(ends[-1])]
                bounds = ends[lists.offsets.to_numpy() - first]
                arrays = [*part.columns[:-1], pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(out, pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "ids"])

    return rest.mapInArrow(encoded, schema).toDF(*names, "ids")


def piece_table(path: str) -> Column:
    """The one value: the pieces of all ids, in hexadecimal."""
    ranks = read_ranks(path)
    by_id = [""] * (max(ranks.values(), default=-1) + 1)
    for piece, i in ranks.items():
        by_id[i] = piece.hex()
    return _value(_one_row(by_id, pa.string()))


def decoded(ids: Column, table: Column) -> Column:
    """Binary column: the concatenated pieces of an array of ids; table: the column of the pieces."""
    return F.unhex(F.array_join(F.transform(ids, lambda i: table[i]), ""))


def digests(encoded_docs: DataFrame, ranks_path: str) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of rows that have ids."""
    decimal = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    out = encoded_docs.withColumn("n_tokens", F.size("ids").cast("long")).withColumn("ids_sha256", F.sha2(decimal.cast("binary"), 256)).withColumn("__pieces", piece_table(ranks_path))
    return out.withColumn("decoded_sha256", F.sha2(decoded(F.col("ids"), F.col("__pieces")), 256)).drop("__pieces")
