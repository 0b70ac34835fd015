"""Packing of token sequences by best-fit decreasing.

Texts are encoded where they lie; a document that is longer than a window is first cut into full
windows, each a sequence of its own, and a remainder. Remainders are dealt into shards of bounded
size by a hash. In a shard they are taken longest first, and each goes to the open window with the
least room that still holds it: a segment tree over the remaining capacities (leaf c counts the open
windows with room for c more tokens) finds that window in log(window) steps. Windows that a shard
leaves loose are opened again and packed together with those of other shards, until one shard holds
all of them or a round no longer makes them fewer.

Null and empty texts have the closing id only; repeated rows are documents of their own; a null
doc_id is kept. Equal lengths are taken in order of doc_id and start. Other columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import checkpointed, slices

#: Remainders of a shard (on average) and share of a window that may stay empty without another round.
SHARD = 8_192
LOOSE = 1 / 64
#: Chunks of text that a worker remembers and encodes at once, characters of a batch of texts.
MEMO = 500_000
LEARNT = 20_000
#: Words and marks that are merged at once without a normalizer.
PLAIN = 500
BATCH = 4_000_000
#: Windows of a shard are numbered below this.
WINDOWS = 1 << 20
#: Where the tokenizer parts an ASCII text in lower case (its own pattern), and final marks that follow a letter
#: (but for the dotted capital I, of which the lower case ends with a mark itself).
_APART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")
_TAIL = re.compile(r"(.*[^\W\d_İ])([.,;:!?]+)", re.S)
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _settled(piece: str) -> bool:
    """Whether the tokenizer keeps a piece, in lower case already, whole and unchanged."""
    return piece.isascii() and piece.isprintable() and "<|" not in piece


class Encoder:
    """Ids of texts, as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space and no token reaches across it, so what stands between blanks
    or line ends is encoded once and remembered; so are the words and marks in it. Those that its
    normalizer and pattern leave as they are need neither: `plain` only merges.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer, self.plain.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        self.memo: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _parts(self, chunk: str) -> list[str]:
        """Pieces of a chunk that the tokenizer encodes apart from each other."""
        if chunk.isascii():
            return _APART.findall(chunk.lower()) if "<|" not in chunk else [chunk]
        found = _TAIL.fullmatch(chunk) if "<|" not in chunk else None
        return list(found.groups()) if found else [chunk]

    def _learn(self, chunks: list[str]) -> None:
        """Encodes the new pieces of new chunks together, with blanks between, and tells by its offset in which piece an id starts."""
        split = [self._parts(c) for c in chunks]
        new, plain = [], []
        for p in dict.fromkeys(itertools.chain.from_iterable(split)):
            if p not in self.pieces:
                (plain if _settled(p) else new).append(p)
        for at in range(0, len(plain), PLAIN):
            some = plain[at : at + PLAIN]
            found = self.plain.encode(" ".join(some), add_special_tokens=False)
            cuts = np.searchsorted(np.array(found.word_ids, dtype=np.int64), np.arange(len(some) + 1)) * 4
            data = np.array(found.ids, dtype="<u4").tobytes()
            self.pieces.update(zip(some, [data[x:y] for x, y in itertools.pairwise(cuts.tolist())], strict=True))
        for at in range(0, len(new), LEARNT):
            some = new[at : at + LEARNT]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            begins = np.cumsum([0, *map(len, some[:-1])]) + np.arange(len(some))
            starts = np.fromiter((x for x, _ in found.offsets), np.int64, len(found))
            cuts = np.append(np.searchsorted(starts, begins), len(found)) * 4
            data = np.array(found.ids, dtype="<u4").tobytes()
            self.pieces.update(zip(some, [data[x:y] for x, y in itertools.pairwise(cuts.tolist())], strict=True))
        held = self.pieces
        self.memo.update(zip(chunks, [held[p[0]] if len(p) == 1 else b"".join([held[x] for x in p]) for p in split], strict=True))

    def ids(self, parts: list[str]) -> list[bytes]:
        """Ids of each of the parts, which start or end at a blank, a line end or an end of their text."""
        split = [p.replace("\n", " ").split(" ") for p in parts]
        if len(self.memo) > MEMO:
            self.memo.clear()
            self.pieces.clear()
        self._learn([c for c in dict.fromkeys(itertools.chain.from_iterable(split)) if c not in self.memo])
        return [b"".join(map(self.memo.__getitem__, chunks)) for chunks in split]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(docs: DataFrame, path: str, window: int, close: int, text: str = "text") -> DataFrame:
    """Pieces of at most `window` ids of each document: doc_id, start, length, ids_crc32, doc_tokens."""
    end, step = np.array([close], dtype="<u4").tobytes(), 4 * window

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, names = encoder(path), [c.split()[0] for c in PIECES.split(", ")]

        def encoded(docs: list, parts: list[tuple[int, str]]) -> pa.RecordBatch:
            held = defaultdict(list)
            for (i, _), ids in zip(parts, memo.ids([p for _, p in parts]), strict=True):
                held[i].append(ids)
            rows = []
            for i, doc in enumerate(docs):
                ids = b"".join([*held[i], end])
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    rows.append((doc, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
            return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

        docs, parts, size = [], [], 0
        for batch in batches:
            for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for part in slices(whole.as_py() or ""):
                    parts.append((len(docs), part))
                    size += len(part) + 100
                docs.append(doc)
                if size > BATCH:
                    yield encoded(docs, parts)
                    docs, parts, size = [], [], 0
        if docs:
            yield encoded(docs, parts)

    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string")).mapInArrow(pieces, PIECES)


class Rooms:
    """Open windows by remaining capacity; the inner nodes count the open windows below them."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.held: list[list[int]] = [[] for _ in range(self.leaves)]

    def _add(self, room: int, n: int) -> None:
        node = self.leaves + room
        while node:
            self.counts[node] += n
            node >>= 1

    def put(self, room: int, number: int) -> None:
        self.held[room].append(number)
        self._add(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """Room and number of the tightest open window that holds `length`, which is then no longer open."""
        node, counts = self.leaves + length, self.counts
        if not counts[node]:
            while node > 1 and (node & 1 or not counts[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not counts[node]:
                    node += 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.held[room].pop()


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window and offset of each of the lengths, which descend, and the room left in each window."""
    rooms, numbers, offsets, left = Rooms(window), np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    for i, length in enumerate(lengths.tolist()):
        found = rooms.take(length)
        room, number = found or (window, len(left))
        if found is None:
            left.append(window)
        numbers[i], offsets[i] = number, window - room
        left[number] = room - length
        if room > length:
            rooms.put(room - length, number)
    return numbers, offsets, np.array(left, dtype=np.int64)


def _packed(rest: DataFrame, shards: int, window: int) -> DataFrame:
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        numbers, offsets, left = best_fit(group.column("length").to_numpy(), window)
        for name, values in (("number", numbers), ("offset", offsets), ("room", left[numbers])):
            group = group.append_column(name, pa.array(values, pa.int64()))
        return group

    dealt = rest.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(pack, PIECES + ", shard long, number long, offset long, room long")


def pack_documents(docs: DataFrame, path: str, window: int = 4096, close: int = 2, text: str = "text") -> DataFrame:
    """Pieces of all documents with sequence_id and offset: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = checkpointed(cut(docs, path, window, close, text))
    names = pieces.columns
    done = pieces.where(F.col("length") == window).select(*names, (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest, before = pieces.where(F.col("length") < window), None
    for nth in range(1, 64):
        n = rest.count()
        shards = max(1, -(-n // SHARD))
        packed = _packed(rest, shards, window)
        number = (F.lit(nth << 52) + F.col("shard") * WINDOWS + F.col("number")) * 2 + 1
        last = shards == 1 or before is not None and n > before // 2
        if not last:
            packed = checkpointed(packed)
        tight = packed if last else packed.where(F.col("room") <= window * LOOSE)
        done = done.unionByName(tight.select(*names, number.alias("sequence_id"), "offset"))
        if last:
            break
        rest, before = packed.where(F.col("room") > window * LOOSE).select(*names), n
    return done
