"""Near-duplicates by HyperMinHash: banded compressed registers, corrected estimates, exact links.

Each document's set of distinct word shingles (ASCII letters lower-cased) is hashed into buckets;
a bucket's register keeps the leading-zero count and some mantissa bits of its least hash.
Documents of equal sets are taken together first. Bands of registers then deal the others into
buckets. A first round compares each member of a bucket with the bucket's hubs (a few members, the
same for all) and with its neighbours in the order of the sketches, which is linear in the bucket,
and links it to its nearest partner. A second round compares, in buckets that still hold several
classes, the pairs of different classes: small sets exactly, others by finest sketches, whose error
is stated for each pair. Members of a bucket's largest class are never compared with each other.
Candidates are confirmed on the full sets. Large buckets are dealt to pairs of blocks, so no group
is held by one task.

Links are the pairs with 100 * |A and B| >= percent * |A or B|, on 64-bit hashes of words and
shingles. Texts of fewer words than a shingle have their whole word sequence as the only shingle;
null texts and texts without words have no shingles and no links. Rows of one doc_id are one
document whose least text counts; a null doc_id is never linked. Empty tables give no rows, long
texts are read whole. Extra columns are left alone by `drop_near_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import checkpointed, hash_texts, mix, release, unsized

_STEP = np.uint64(0x9FB21C651E98DF25)
COARSE, FINE, FINEST = 7, 8, 10
#: Mantissa bits of the registers that are banded, and of those that are compressed to bytes.
MANTISSA, SHORT = 26, 10
EMPTY = 0xFFFFFFFF
BAND_REGISTERS = 4
BLOCK = 1024
#: How far below the threshold an estimate may lie for the pair to be confirmed exactly: over five
#: standard errors of the fine sketch.
MARGIN = 0.13
#: Pairs of so few shingles in all are never ruled out by an estimate: two register collisions can hide their link.
TINY = 64
#: Sets of at most so many shingles are compared exactly in their buckets; larger ones by their finest sketch.
SMALL = 128
#: Members of a bucket that all others are compared with in the first round, and neighbours on either side.
HUBS, NEIGHBOURS, FEW = 4, 4, 32
#: Standard errors that a pair's finest sketches may lie below the threshold.
ERRORS = 5.5


def shingle_sets(texts: list, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text."""
    flat, offsets = hash_texts([b"" if t is None else t.encode().lower() for t in texts])
    n = len(flat)
    joined = flat.copy()
    for i in range(1, min(width, n)):
        joined[: n - i] = joined[: n - i] * _STEP + flat[i:]
    joined = mix(joined)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(joined[a : b - width + 1]))
        elif b > a:
            whole = np.array([b - a], dtype=np.uint64)
            for w in flat[a:b]:
                whole = whole * _STEP + w
            out.append(mix(whole ^ _STEP))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def registers(found: np.ndarray, bits: int, mantissa: int = MANTISSA) -> np.ndarray:
    """HyperMinHash registers (leading zeros, then mantissa) of a sorted set, by its top `bits` bits."""
    out = np.full(1 << bits, EMPTY, dtype=np.uint32)
    if len(found):
        low_bits = 64 - bits
        bucket = (found >> np.uint64(low_bits)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        low = found[first] & np.uint64((1 << low_bits) - 1)
        length = np.zeros(len(low), dtype=np.int64)
        rest = low.copy()
        for step in (32, 16, 8, 4, 2, 1):
            more = rest >> np.uint64(step) > 0
            length[more] += step
            rest[more] >>= np.uint64(step)
        shift = length - mantissa
        part = np.where(shift >= 0, low >> np.maximum(shift, 0).astype(np.uint64), low << np.maximum(-shift, 0).astype(np.uint64)) & np.uint64((1 << mantissa) - 1)
        out[bucket[first]] = ((low_bits - 1 - length) << mantissa) | part.astype(np.int64)
    return out


def band_keys(found: np.ndarray) -> np.ndarray:
    """Keys of the bands of a sorted set that have a register."""
    bands = registers(found, COARSE).reshape(-1, BAND_REGISTERS)
    parts = bands.view(np.uint64)
    keys = mix(mix(parts[:, 0] + (np.arange(len(bands), dtype=np.uint64) + np.uint64(1)) * _STEP) ^ parts[:, 1])
    return keys[(bands != EMPTY).any(axis=1)].view(np.int64)


def compressed(found: np.ndarray, bits: int) -> bytes:
    """Sketch of a sorted set: a byte for each register, 0 for an empty one."""
    r = registers(found, bits, SHORT)
    return np.where(r == EMPTY, 0, 1 + (r.astype(np.uint32) * np.uint32(40503) >> np.uint32(5)) % 255).astype(np.uint8).tobytes()


def finest(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """rep, finest (sketch) and small (the set itself) of the rows (doc_id, text).

    A set has the one or the other, by its size; near the border it has both, so that any two sets
    that may be linked have one in common.
    """

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = shingle_sets(part.column(1).to_pylist(), width)
                sketches = [compressed(x, FINEST) if 100 * len(x) >= percent * SMALL else b"" for x in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sketches, pa.binary()), pa.array([x.tobytes() if len(x) <= SMALL else b"" for x in sets], pa.binary())], names=["rep", "finest", "small"])

    return texts.select("doc_id", "text").mapInArrow(signed, "rep long, finest binary, small binary")


def allowance(n: np.ndarray, percent: int) -> np.ndarray:
    """How far below the threshold the estimate from finest sketches may lie, by the sets' total size."""
    share, size = percent / 100, 1 << FINEST
    union = np.maximum(n / (1 + share), 1)
    held = size * -np.expm1(-union / size)
    error = share * (1 - share) / held * np.maximum(1 - held / union, 0) + (1 - share) / 255 / held
    return ERRORS * np.sqrt(error)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, s1 and s2 (hash of the set), bands (keys) and sketch (binary) of documents."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = shingle_sets(part.column(1).to_pylist(), width)
                sums = [(int(x.sum().astype(np.int64)), int(mix(x ^ _STEP).sum().astype(np.int64))) for x in sets]
                bands = [band_keys(x) for x in sets]
                fine = [compressed(x, FINE) for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array([a for a, _ in sums], pa.int64()), pa.array([b for _, b in sums], pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(fine, pa.binary())],
                    names=["doc_id", "n_shingles", "s1", "s2", "bands", "sketch"],
                )

    return docs.select("doc_id", "text").mapInArrow(signed, "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>, sketch binary")


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of fine sketches, with the expected chance matches taken out."""
    either = ((a | b) != 0).sum(axis=-1)
    same = ((a == b) & (a != 0)).sum(axis=-1)
    chance = 1 / 255
    return np.clip((same / np.maximum(either, 1) - chance) / (1 - chance), 0, 1)


def _pairs_of_groups(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs i < j within small groups."""
    left, right = [], []
    for size in np.unique(ends - starts):
        i, j = np.triu_indices(size, 1)
        at = starts[ends - starts == size][:, None]
        left.append((at + i).ravel())
        right.append((at + j).ravel())
    return np.concatenate(left), np.concatenate(right)


def _groups(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the groups of equal (key, ci, cj) in sorted rows."""
    group = rows[["key", "ci", "cj"]].to_numpy()
    edge = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]).any(axis=1), [True])))
    return edge[:-1], edge[1:]


def _estimated(of: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.concatenate([estimates(of[i[at : at + 8192]], of[j[at : at + 8192]]) for at in range(0, len(i), 8192)] or [np.empty(0)])


def _sketches(column: pd.Series) -> np.ndarray:
    """A matrix of the sketches; rows without one are zero."""
    size = max(map(len, column), default=0)
    return np.frombuffer(b"".join(x or bytes(size) for x in column), dtype=np.uint8).reshape(len(column), -1)


def _nearest(rows: pd.DataFrame, least: float, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row its nearest partner among hubs and neighbours of its groups (all pairs of small groups)."""
    ids, n, hub, sketch = rows["rep"].to_numpy(), rows["n"].to_numpy(), rows["hub"].to_numpy(), _sketches(rows["sketch"])
    starts, ends = _groups(rows)
    few = (ends - starts > 1) & (ends - starts <= FEW)
    pairs = [_pairs_of_groups(starts[few], ends[few])] if few.any() else []
    for a, b in zip(starts[ends - starts > FEW], ends[ends - starts > FEW], strict=True):
        hubs = a + np.flatnonzero(hub[a:b])
        pairs.append((np.tile(np.arange(a, b), len(hubs)), np.repeat(hubs, b - a)))
        order = a + np.lexsort(sketch[a:b, :16].T)
        pairs += [(order[:-step], order[step:]) for step in range(1, NEIGHBOURS + 1)]
    if not pairs:
        return ids[:0], ids[:0]
    i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
    fit = (ids[i] != ids[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
    i, j = i[fit], j[fit]
    e = _estimated(sketch, i, j)
    fit = e >= least
    one, two, near = np.concatenate((i[fit], j[fit])), np.concatenate((j[fit], i[fit])), np.concatenate((e[fit], e[fit]))
    order = np.lexsort((ids[two], -near, one))
    first = order[np.concatenate(([True], one[order][1:] != one[order][:-1]))] if len(order) else order
    a, b = ids[one[first]], ids[two[first]]
    return np.minimum(a, b), np.maximum(a, b)


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Size of the intersection of each pair of small sorted sets."""
    sizes = np.array([len(x) for x in sets])
    out = np.zeros(len(i), dtype=np.int64)
    order = np.argsort(np.maximum(sizes[i], sizes[j]), kind="stable")
    for at in range(0, len(order), 4096):
        some = order[at : at + 4096]
        width = max(1, int(np.maximum(sizes[i[some]], sizes[j[some]]).max()))
        used, place = np.unique(np.concatenate((i[some], j[some])), return_inverse=True)
        table = np.zeros((len(used), width), dtype=np.uint64)
        held = np.zeros((len(used), width), dtype=bool)
        for r, x in enumerate(used):
            table[r, : sizes[x]], held[r, : sizes[x]] = sets[x], True
        a, b = place[: len(some)], place[len(some) :]
        both = np.concatenate((table[a], table[b]), axis=1)
        real = np.concatenate((held[a], held[b]), axis=1)
        # Equal neighbours after sorting are common members: a set has none twice. Padding sorts last.
        by = np.where(real, both, np.uint64((1 << 64) - 1))
        by.sort(axis=1)
        equal = by[:, 1:] == by[:, :-1]
        spare = 2 * width - real.sum(axis=1)
        out[some] = equal.sum(axis=1) - np.maximum(spare - 1, 0)
    return out


def _apart(rows: pd.DataFrame, least: float, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ids of different labels in whole groups of `rows` (sorted by group) that no measure rules out."""
    ids, n, label = rows["rep"].to_numpy(), rows["n"].to_numpy(), rows["label"].to_numpy()
    block, apart = rows["block"].to_numpy(), rows["apart"].to_numpy()
    sketch, more = _sketches(rows["sketch"]), _sketches(rows["finest"])
    small = [np.frombuffer(x, dtype=np.uint64) for x in rows["small"]]
    bands, keys = rows["bands"].to_numpy(), rows["key"].to_numpy()
    starts, ends = _groups(rows)

    def compared(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fit = (label[i] != label[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        fit &= ~apart[i] | (block[i] != block[j])
        i, j = i[fit], j[fit]
        fit = (n[i] + n[j] <= TINY) | (_estimated(sketch, i, j) >= least)
        i, j = i[fit], j[fit]
        exact = (n[i] <= SMALL) & (n[j] <= SMALL)
        fit = np.zeros(len(i), dtype=bool)
        both = _common(small, i[exact], j[exact])
        fit[exact] = 100 * both >= percent * (n[i[exact]] + n[j[exact]] - both)
        rest = ~exact
        fit[rest] = _estimated(more, i[rest], j[rest]) >= percent / 100 - allowance(n[i[rest]] + n[j[rest]], percent)
        i, j = i[fit], j[fit]
        # A pair is told once, in the least bucket that both are in.
        own = np.fromiter((np.intersect1d(bands[x], bands[y]).min() == keys[x] for x, y in zip(i, j, strict=True)), dtype=bool, count=len(i))
        a, b = ids[i[own]], ids[j[own]]
        return np.minimum(a, b), np.maximum(a, b)

    few = (ends - starts > 1) & (ends - starts <= FEW)
    if few.any():
        yield compared(*_pairs_of_groups(starts[few], ends[few]))
    for a, b in zip(starts[ends - starts > FEW], ends[ends - starts > FEW], strict=True):
        # A few rows against all later ones at a time.
        step = max(1, (1 << 18) // int(b - a))
        for at in range(a, b - 1, step):
            i, j = np.meshgrid(np.arange(at, min(at + step, b)), np.arange(at, b), indexing="ij")
            later = j > i
            yield compared(i[later], j[later])


def _compared(dealt: DataFrame, pairs_of) -> DataFrame:
    """Distinct pairs (a, b) that pairs_of finds in the groups (key, ci, cj) of `dealt`."""

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def found(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            for a, b in pairs_of(rows):
                if len(a):
                    yield pd.DataFrame({"a": a, "b": b}).drop_duplicates()

        for batch in batches:
            rows = pd.concat([*held, batch]) if held else batch
            last = rows[["key", "ci", "cj"]].iloc[-1]
            open_group = ((rows["key"] == last["key"]) & (rows["ci"] == last["ci"]) & (rows["cj"] == last["cj"])).to_numpy()
            held = [rows[open_group]]
            if not open_group.all():
                yield from found(rows[~open_group])
        if held:
            yield from found(held[0])

    sorted_rows = dealt.repartition("key", "ci", "cj").sortWithinPartitions("key", "ci", "cj", "rep")
    return sorted_rows.mapInPandas(compared, "a long, b long").distinct()


def _dealt(blocks) -> Column:
    """The block, of so many, that a member belongs to."""
    return F.pmod(F.xxhash64("rep"), blocks).cast("int")


def _every(blocks) -> Column:
    return F.sequence(F.lit(0), blocks - 1)


def nearest_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Each member (key, size, hubs, rep, n, sketch) with its nearest partner by the sketches, hubs and neighbours being asked."""
    least = percent / 100 - MARGIN
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK).cast("int"), F.lit(1))
    hub = F.array_contains("hubs", F.col("rep"))
    cells = F.when(hub, _every(blocks)).otherwise(F.array(_dealt(blocks)))
    dealt = members.select("key", F.explode(cells).alias("ci"), F.lit(0).alias("cj"), "rep", "n", hub.alias("hub"), "sketch")
    return _compared(dealt, lambda rows: [_nearest(rows, least, percent)])


def pairs_apart(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of different labels that may be links.

    Members have key, size, main (the label that most of the bucket have), of_main (how many), rep,
    n, label, sketch, finest, small and bands. Blocks of the main label meet blocks of the others,
    and these each other; blocks of the main label never meet.
    """
    least = percent / 100 - MARGIN
    alone = F.col("size") <= BLOCK
    mains = F.when(alone, F.lit(0)).otherwise(F.ceil(F.col("of_main") / BLOCK).cast("int"))
    others = F.when(alone, F.lit(1)).otherwise(F.ceil((F.col("size") - F.col("of_main")) / BLOCK).cast("int"))
    main = ~alone & (F.col("label") == F.col("main"))
    own = F.when(main, -1 - _dealt(F.greatest(mains, F.lit(1)))).otherwise(_dealt(F.greatest(others, F.lit(1))))
    dealt = members.withColumn("block", own)
    cell = lambda i, j: F.struct(i.cast("int").alias("ci"), j.cast("int").alias("cj"))
    with_others = F.transform(_every(others), lambda o: cell(F.least(F.col("block"), o), F.greatest(F.col("block"), o)))
    with_main = F.when(mains > 0, F.transform(_every(F.greatest(mains, F.lit(1))), lambda m: cell(-1 - m, F.col("block")))).otherwise(F.array().cast("array<struct<ci:int,cj:int>>"))
    cells = F.when(main, with_others).otherwise(F.concat(with_others, with_main))
    dealt = dealt.withColumn("cell", F.explode(cells))
    # In the cell of two different blocks only pairs across them count.
    dealt = dealt.select("key", "cell.ci", "cell.cj", "rep", "n", "label", "sketch", "finest", "small", "bands", "block", (F.col("cell.ci") != F.col("cell.cj")).alias("apart"))
    return _compared(dealt, lambda rows: _apart(rows, least, percent))


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are linked; texts: doc_id, text."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                one, two = (shingle_sets(part.column(i).to_pylist(), width) for i in (2, 3))
                linked = []
                for x, y in zip(one, two, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("one"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("two"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
    return both.mapInArrow(exact, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node and label (least node reachable) of the undirected links (a, b).

    Each round hangs every node below its least neighbour, follows those pointers to their roots and
    contracts the links to links between roots. At most half of the nodes are roots that still have
    links, so there are few rounds, and each handles only what the one before left. Rounds shuffle
    ids only; what they leave is the caller's to let go, once: the JVM may answer time spent on
    full collections of the driver's garbage by growing its heap. No round builds on the estimated
    sizes of the one before.
    """
    edges = unsized(checkpointed(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()))
    labels = None
    while True:
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).union(edges.select("b", "a"))
        roots = _roots(checkpointed(ends.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("label"))))
        if labels is None:
            labels = roots
        else:
            over = roots.select(F.col("node").alias("label"), F.col("label").alias("above"))
            labels = unsized(checkpointed(labels.join(over, "label", "left").select("node", F.coalesce("above", "label").alias("label"))))
        for end in ("a", "b"):
            edges = edges.join(roots.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("label", end)
        edges = unsized(checkpointed(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()))
        if not edges.count():
            return labels


def _roots(parents: DataFrame) -> DataFrame:
    """Follows the pointers (node, label), which lead to lesser nodes, to their ends, doubling each time."""
    while True:
        above = parents.select(F.col("node").alias("label"), F.col("label").alias("above")).where("label <> above")
        moved = unsized(checkpointed(parents.join(above, "label", "left").select("node", F.coalesce("above", "label").alias("label"), F.col("above").isNotNull().alias("moved"))))
        parents = moved.drop("moved")
        if not moved.where("moved").count():
            return parents


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row for each document that has a doc_id: doc_id, n_shingles and component_id.

    What a step has shuffled is let go before the next one, else all steps' files are on disk together.
    """
    spark = docs.sparkSession
    repeats = _repeats(docs)
    signed = checkpointed(signatures(docs.where("doc_id is not null").groupBy("doc_id").agg(F.min("text").alias("text")) if repeats else docs, width))
    sets = signed.where("n_shingles > 0").groupBy("s1", "s2", "n_shingles").agg(F.min(F.struct("doc_id", "bands", "sketch")).alias("first"))
    reps = checkpointed(sets.select("s1", "s2", F.col("n_shingles").alias("n"), F.col("first.doc_id").alias("rep"), "first.bands", "first.sketch"))
    release(spark)
    bands = reps.select(F.explode("bands").alias("key"), "rep")
    hubs = [F.min_by("rep", F.xxhash64("rep", F.lit(i))) for i in range(HUBS)]
    shared = bands.groupBy("key").agg(F.count("*").alias("size"), F.array(*hubs).alias("hubs")).where("size > 1")
    members = checkpointed(bands.join(shared, "key"))
    release(spark)
    first = checkpointed(nearest_pairs(members.join(reps.select("rep", "n", "sketch"), "rep"), percent))
    release(spark)
    links = checkpointed(confirmed(first, _texts(docs, _ends(first), repeats), width, percent))
    release(spark)
    labels = components(links)
    release(spark)
    # The second round: only buckets that hold members of different classes. A large set whose buckets
    # are all small was compared with all of their members: without a partner it has no link.
    known = labels.withColumnRenamed("node", "rep")
    paired = first.select(F.col("a").alias("rep")).union(first.select("b")).distinct()
    more = members.groupBy("rep").agg(F.max("size").alias("most")).join(reps.select("rep", "n"), "rep").where((F.col("most") > FEW) | (F.col("n") <= TINY))
    still = paired.union(more.select("rep")).distinct()
    named = checkpointed(members.select("key", "rep").join(still, "rep").join(known, "rep", "left").select("key", "rep", F.coalesce("label", "rep").alias("label")))
    of_label = named.groupBy("key", "label").agg(F.count("*").alias("n"))
    apart = of_label.groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("labels")).where("labels > 1")
    ready = named.join(apart.select("key", "size", F.col("top.label").alias("main"), F.col("top.n").alias("of_main")), "key")
    release(spark)
    measured = checkpointed(finest(_texts(docs, ready.select(F.col("rep").alias("doc_id")).distinct(), repeats), width, percent))
    ready = ready.join(reps.select("rep", "n", "sketch", "bands"), "rep").join(measured, "rep")
    release(spark)
    second = checkpointed(pairs_apart(ready, percent))
    release(spark)
    more = checkpointed(confirmed(second, _texts(docs, _ends(second), repeats), width, percent))
    release(spark)
    if more.count():
        labels = components(links.union(more))
        release(spark)
    classes = reps.select("s1", "s2", F.col("n").alias("n_shingles"), "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    classes = classes.select("s1", "s2", "n_shingles", F.coalesce("label", "rep").alias("label"))
    out = signed.select("doc_id", "n_shingles", "s1", "s2").join(classes, ["s1", "s2", "n_shingles"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))


def near_duplicates_and_unnamed(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """near_duplicates, and a row for each document of a null doc_id: its set's size and a null component, as it has no name to be linked by."""
    found, unnamed = near_duplicates(docs, width, percent), docs.where("doc_id is null").select("doc_id", "text")
    if not unnamed.limit(1).count():
        return found
    return found.unionByName(signatures(unnamed, width).select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id")))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()


def _texts(docs: DataFrame, wanted: DataFrame, repeats: bool) -> DataFrame:
    """doc_id and text (the least of several) of the wanted documents."""
    found = docs.select("doc_id", "text").join(wanted, "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text")) if repeats else found


def _repeats(docs: DataFrame) -> bool:
    """Whether some doc_id is null or on several rows."""
    return bool(docs.where("doc_id is null").limit(1).count() or docs.groupBy("doc_id").count().where("count > 1").limit(1).count())


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """`docs` without the rows whose document is not the first of its class."""
    classes = near_duplicates(docs, width, percent).where("doc_id <> component_id").select(F.col("doc_id").alias("__copy")).distinct()
    return docs.join(classes, docs["doc_id"] == classes["__copy"], "left_anti")
