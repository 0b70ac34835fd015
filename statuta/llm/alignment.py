"""Alignment of two tokenizers by corpus-wide counts of overlapping token pairs.

Documents are read in blocks. Neither tokenizer has a token across a blank or line end that follows
another character, so a text is a sequence of units between such places; a unit's tokens, groups and
links are found once and remembered. A block keeps for each document its units, and for each pair of
ids linked in it the number of links: pairs are added up before anything is shuffled.

Count matrices are dense and striped by the B id: the pairs of all blocks are dealt by stripe (and by
a salt of the block, so that no task reads all blocks), and each task adds them up with np.add.at in
the matrix of one stripe at a time, whatever the number of blocks. Salted matrices are merged in the
same way, and the maximum of a B id's row is its best count. Then the blocks' pairs meet the stripe's
counts, the answers return to the blocks' documents (one exchange, rows of a key streamed in order)
and the units' scores are summed for each document.

Texts that are null, empty or not restored by both tokenizers have no tokens: zeros and ''. Repeated
rows are documents of their own; a null doc_id is kept. Other columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import checkpointed, slices, streamed

MARK = "▁"
#: Characters of a block's texts and of those split at once, units that a worker remembers and finds at once, B ids of a stripe, blocks of a salt.
BLOCK = 8_000_000
PART = 2_000_000
MEMO = 500_000
LEARNT = 20_000
STRIPE = 64
SALT_BLOCKS = 256
A_IDS = 1 << 16
_UNIT = re.compile(r"[ \n](?:[^ \n]+|(?<=\s)[ \n])*")
_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long"
BLOCKS = "block long, docs binary, shas array<string>, links binary"
PAIRS = "block long, stripe int, codes binary, counts binary"


def _byte_level() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable ones stand for themselves, others for 256 upwards."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Units of text by number: their tokens, groups and linked pairs, found once."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a_tokens = Tokenizer.from_file(a_path)
        self.a_tokens.encode_special_tokens = True
        self.b_tokens = sentencepiece.SentencePieceProcessor(model_file=b_path)
        level, sp = _byte_level(), self.b_tokens
        vocabulary = self.a_tokens.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes([level.get(c, 0) for c in token])
        self.b_bytes = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode() for i in range(sp.get_piece_size()) for p in [sp.id_to_piece(i)]]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in table]) for table in (self.a_bytes, self.b_bytes))
        # An id as text: within a group, then at the end of the group's side; first A, then B.
        self.texts = [f"{i}{end}" for table, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for end in ends for i in range(len(table))]
        self.clear()

    def clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.groups: list[str] = [""]
        self.held: list[np.ndarray] = []

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of A tokens, B tokens, groups and links of each unit, and the codes of all units' links."""
        rows, codes = [np.zeros((1, 4), np.int64)], [np.empty(0, np.uint32)]
        for sizes, found in self.held:
            rows.append(sizes)
            codes.append(found)
        self.held = [(np.concatenate(rows)[1:], np.concatenate(codes))]
        return np.concatenate(rows), self.held[0][1]

    def _learn(self, units: list[str]) -> None:
        """Finds the tokens of new units, all of which end with a character that isn't blank, together."""
        joined = "".join(units)
        data = joined.encode("utf-8", "replace")
        a = np.array(self.a_tokens.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=np.int64)
        # The library puts a blank before a text; here a letter follows it, whose token is left out.
        b = np.array(self.b_tokens.encode("x" + joined, num_threads=1)[1:], dtype=np.int64)
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != data or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != data:
            if len(units) == 1:
                self.memo[units[0]] = 0
            else:
                for half in (units[: len(units) // 2], units[len(units) // 2 :]):
                    self._learn(half)
            return
        ends = np.cumsum([len(u.encode("utf-8", "replace")) for u in units]) if len(data) > len(joined) else np.cumsum([len(u) for u in units])
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        both, either = np.intersect1d(a_ends, b_ends, assume_unique=True), np.union1d(a_ends, b_ends)
        codes = (b[np.searchsorted(b_ends, either)] << 16 | a[np.searchsorted(a_ends, either)]).astype(np.uint32)
        sizes = np.stack([np.diff(np.searchsorted(x, ends, "right"), prepend=0) for x in (a_ends, b_ends, both, either)], axis=1)
        # The ids as text in order of the groups, A before B.
        group = [np.searchsorted(both, x) for x in (a_ends, b_ends)]
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        n, m = len(self.a_bytes), len(self.b_bytes)
        last = [np.isin(x, both, assume_unique=True) for x in (a_ends, b_ends)]
        texts = np.concatenate([a + n * last[0], b + 2 * n + m * last[1]])[order].tolist()
        parts = [self.texts[i] for i in texts]
        cuts = np.cumsum(sizes[:, 0] + sizes[:, 1]).tolist()
        first = len(self.groups)
        self.groups += ["".join(parts[x:y])[:-1] for x, y in itertools.pairwise([0, *cuts])]
        self.memo.update(zip(units, range(first, len(self.groups)), strict=True))
        self.held.append((sizes, codes))

    def numbers(self, found: list[list[str]]) -> list[np.ndarray]:
        """Numbers of the units; 0 is a unit that a tokenizer doesn't restore."""
        new = [u for u in dict.fromkeys(itertools.chain.from_iterable(found)) if u not in self.memo]
        alone = [u for u in new if u[-1].isspace() or MARK in u]
        together = [u for u in new if not (u[-1].isspace() or MARK in u)]
        for at in range(0, len(together), LEARNT):
            self._learn(together[at : at + LEARNT])
        for unit in alone:
            self._learn([unit])
        return [np.fromiter(map(self.memo.__getitem__, units), np.int64, len(units)) for units in found]


@functools.lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _packed(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *[x for a in arrays for x in (len(a), a.itemsize)]], dtype="<i8")
    return zstandard.compress(head.tobytes() + b"".join(a.tobytes() for a in arrays), 1)


def _unpacked(data: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head, at, out = np.frombuffer(raw, "<i8", 2 * n, 8).tolist(), 8 + 16 * n, []
    for size, width in zip(head[::2], head[1::2], strict=True):
        out.append(np.frombuffer(raw, f"<u{width}" if width < 8 else "<i8", size, at))
        at += size * width
    return out


class Block:
    """Documents of a block and the units in them."""

    def __init__(self, tokens: Aligner):
        self.tokens, self.docs, self.shas, self.units, self.wrong = tokens, [], [], [], set()
        self.parts, self.waiting, self.size = [], 0, 0

    def add(self, doc: int | None, text: str | None) -> None:
        self.docs.append(doc)
        self.shas.append(hashlib.sha256())
        self.units.append([])
        self.size += len(text or "") + 200
        for part in slices(" " + text) if text else ():
            self.parts.append((len(self.docs) - 1, part))
            self.waiting += len(part)
            if self.waiting > PART:
                self._read()

    def _read(self) -> None:
        texts = self.tokens.groups
        for (doc, _), numbers in zip(self.parts, self.tokens.numbers([_UNIT.findall(p) for _, p in self.parts]), strict=True):
            if not numbers.all():
                self.wrong.add(doc)
            self.shas[doc].update((";" * bool(self.units[doc]) + ";".join([texts[i] for i in numbers.tolist()])).encode())
            self.units[doc].append(numbers)
        self.parts, self.waiting = [], 0

    def row(self, number: int) -> pa.RecordBatch:
        self._read()
        units = [np.concatenate(u) if u and i not in self.wrong else np.empty(0, np.int64) for i, u in enumerate(self.units)]
        sizes, codes = self.tokens.counts()
        lengths, flat = np.array([len(u) for u in units]), np.concatenate(units)
        sums = np.zeros((len(units), 4), np.int64)
        np.add.at(sums, np.repeat(np.arange(len(units)), lengths), sizes[flat])
        own, places = np.unique(flat, return_inverse=True)
        links = sizes[own, 3]
        begins = np.cumsum(sizes[:, 3])[own] - links
        joined = codes[np.repeat(begins - np.cumsum(links) + links, links) + np.arange(links.sum())]
        pairs, at = np.unique(joined, return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, at, np.repeat(np.bincount(places, minlength=len(own)), links))
        blob = _packed(lengths.astype("<u4"), places.astype("<u2" if len(own) < 1 << 16 else "<u4"), links.astype("<u4"), at.astype("<u4"), pairs, counts)
        none = np.array([d is None for d in self.docs], dtype=np.uint8)
        docs = _packed(none, np.array([d or 0 for d in self.docs], dtype=np.int64), *(np.ascontiguousarray(x) for x in sums.T))
        shas = [sha.hexdigest() if n else "" for sha, n in zip(self.shas, lengths.tolist(), strict=True)]
        values = [pa.array([number]), pa.array([docs], pa.binary()), pa.array([shas], pa.list_(pa.string())), pa.array([blob], pa.binary())]
        return pa.record_batch(values, names=["block", "docs", "shas", "links"])


def blocks(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, nth = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        block = Block(tokens)
        for batch in batches:
            for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block.add(doc, whole.as_py())
                if block.size >= BLOCK:
                    yield block.row(nth)
                    if len(tokens.memo) > MEMO:
                        tokens.clear()
                    block, nth = Block(tokens), nth + 1
        if block.docs:
            yield block.row(nth)
        if len(tokens.memo) > MEMO:
            tokens.clear()

    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string")).mapInArrow(read, BLOCKS)


def _stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of each block, a row for each stripe."""
    for batch in batches:
        for number, links in zip(batch.column("block").to_pylist(), batch.column("links"), strict=True):
            *_, codes, counts = _unpacked(links.as_py())
            stripes = (codes >> 16) // STRIPE
            own, starts = np.unique(stripes, return_index=True)
            ends = [*starts[1:], len(codes)][: len(own)]
            values = [pa.array([number] * len(own), pa.int64()), pa.array(own, pa.int32())]
            values += [pa.array([_packed(x[s:e]) for s, e in zip(starts, ends, strict=True)], pa.binary()) for x in (codes, counts)]
            yield pa.record_batch(values, names=["block", "stripe", "codes", "counts"])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (salt, stripe, codes, counts), those of a salt and stripe together, to one row for each of these."""
    matrix, now = np.zeros((STRIPE, A_IDS), dtype=np.int64), None

    def cells() -> pa.RecordBatch:
        b, a = np.nonzero(matrix)
        codes = ((b + now[1] * STRIPE).astype(np.uint32) << 16) | a.astype(np.uint32)
        out = pa.record_batch([pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int32()), pa.array([_packed(codes)], pa.binary()), pa.array([_packed(matrix[b, a])], pa.binary())], names=["salt", "stripe", "codes", "counts"])
        matrix[b, a] = 0
        return out

    for batch in batches:
        for salt, stripe, codes, counts in zip(*(batch.column(c).to_pylist() for c in ("salt", "stripe", "codes", "counts")), strict=True):
            if now not in (None, (salt, stripe)):
                yield cells()
            now = salt, stripe
            (codes,), (counts,) = _unpacked(codes), _unpacked(counts)
            np.add.at(matrix, ((codes >> 16) - stripe * STRIPE, codes & 0xFFFF), counts)
    if now is not None:
        yield cells()


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block's pairs of a stripe, which follow the stripe's matrix: the counts and whether these are the B id's highest."""
    known = counts = best = None
    for batch in batches:
        rows = [[], [], [], []]
        for block, stripe, codes, held in zip(*(batch.column(c).to_pylist() for c in ("block", "stripe", "codes", "counts")), strict=True):
            (codes,) = _unpacked(codes)
            if block is None:
                known, (counts,) = codes, _unpacked(held)
                best = np.zeros(STRIPE, np.int64)
                np.maximum.at(best, (known >> 16) - stripe * STRIPE, counts)
                continue
            found = counts[np.searchsorted(known, codes)]
            top = found == best[(codes >> 16) - stripe * STRIPE]
            for column, value in zip(rows, (block, stripe, _packed(found), _packed(top.astype(np.uint8))), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
        yield pa.record_batch([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["block", "stripe", "found", "top"])


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's row, then the answers by stripe, to a row for each document."""
    now, parts = None, []

    def documents() -> pa.RecordBatch:
        none, *numbers = _unpacked(now[0])
        lengths, places, sizes, at, pairs, _ = _unpacked(now[2])
        found, top = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in range(2))
        unit_of = np.repeat(np.arange(len(sizes)), sizes)
        doc_of = np.repeat(np.arange(len(lengths)), lengths)
        sums = np.zeros((2, len(lengths)), np.int64)
        for row, values in zip(sums, (top.astype(np.int64), found), strict=True):
            units = np.zeros(len(sizes), np.int64)
            np.add.at(units, unit_of, values[at])
            np.add.at(row, doc_of, units[places])
        ids = pa.array(numbers[0], mask=none.astype(bool))
        return pa.record_batch([ids, *(pa.array(x) for x in (*numbers[1:], *sums)), pa.array(now[1], pa.string())], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    for batch in batches:
        for docs, shas, links, found, top in zip(*(batch.column(c).to_pylist() for c in ("docs", "shas", "links", "found", "top")), strict=True):
            if docs is not None:
                if now is not None:
                    yield documents()
                now, parts = (docs, shas, links), []
            else:
                parts.append((_unpacked(found)[0], _unpacked(top)[0]))
    if now is not None:
        yield documents()


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """Numbers of tokens, groups and links of each document, its links' counts and the digest of its groups."""
    held = checkpointed(blocks(docs, a_path, b_path, text))
    salts = max(1, -(-held.count() // SALT_BLOCKS))
    pairs = held.select("block", "links").mapInArrow(_stripes, PAIRS)
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)))
    summed = "salt long, stripe int, codes binary, counts binary"
    counts = streamed(salted.select("salt", "stripe", "codes", "counts"), ["salt", "stripe"], [], _add_up, summed)
    if salts > 1:
        counts = streamed(counts.withColumn("salt", F.lit(0).cast("long")), ["stripe"], ["salt"], _add_up, summed)
    spread = counts.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"), "stripe", F.lit(None).cast("long").alias("block"), "codes", "counts")
    asked = salted.select("salt", "stripe", "block", "codes", F.lit(None).cast("binary").alias("counts"))
    answers = streamed(spread.unionByName(asked), ["salt", "stripe"], ["block"], _answer, "block long, stripe int, found binary, top binary")
    rows = held.withColumn("stripe", F.lit(-1)).unionByName(answers, allowMissingColumns=True)
    return streamed(rows, ["block"], ["stripe"], _scored, _DOC + ", n_best long, count_sum long, groups_sha256 string")
