"""Packing, centroid clustering and tokenizer alignment against plain forms, and their edges."""

import math
import random
import struct
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from statuta.llm import alignment, centroids, fingerprints, near_duplicates, packing, registry, top_k
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
ODD = [
    "", None, " ", "a", "  two  blanks ", "line\n\nends \n and\ttabs\r\n", "<|endoftext|> <|startoftext|>x", "▁mark", "é é İ Σς ΑΣ", "\x1c \x1f\x85 　x",
    "word " * 3000, "x" * 9000, "日本語 テキスト\n漢字", "don't we'll I'm", "\n", "\n\n \nfoo  bar", "<0x0A> <s> </s> <unk>", "tab\there \n\n\n x", "emoji \U0001f600\U0001f600 ok", "a b c   d",
]


@cache
def words():
    return Tokenizer.from_file(registry.WORDS)


@cache
def byte_level():
    found = Tokenizer.from_file(registry.BYTES)
    found.encode_special_tokens = True
    return found


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def texts_of(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}


def test_settled_words_are_only_merged():
    rng = random.Random(8)
    some = [*"aeiouxyz'!?,.-<|>0123", *"éßıſσςяёجوאẞİŉǆ\u0301\u0345\u00ad\u0640\u02bc\x01\x7f\x85", "ing", "tion", "'s", "'ll", "Æ", "A"]
    chunks = ["".join(rng.choices(some, k=rng.randint(1, 6))) for _ in range(20_000)]
    chunks += ["".join(chr(c) for c in range(at, at + 3) if not chr(c).isspace()) for at in range(0x21, 0x900)]
    encoder = packing.Encoder(registry.WORDS)
    got = encoder.ids(chunks)
    want = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in words().encode_batch(chunks, add_special_tokens=False)]
    assert got == want
    assert packing._settled("word") and not packing._settled("größe") and not packing._settled("a\x7f")


def check_packed(rows, texts, window=4096):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = [*words().encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part)), text
            at += r["length"]
        assert at == len(ids)
    used = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= window
        used += at if at & (at - 1) == 0 else window
    return used / sum(r["length"] for r in rows)


def test_packing(spark):
    assert check_packed(registry.op11_packing(spark, FOLDER).collect(), texts_of(spark)) < 1.06
    check_packed(packing.pack_documents(docs_of(spark, ODD).withColumn("length", F.lit("x")), registry.WORDS).collect(), dict(enumerate(ODD)))


def test_packing_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 16)
    assert check_packed(registry.op11_packing(spark, FOLDER).collect(), texts_of(spark)) < 1.1


def test_packing_edges(spark):
    assert packing.pack_documents(docs_of(spark, []), registry.WORDS).count() == 0
    rows = packing.pack_documents(spark.createDataFrame([(None, "a"), (None, "a"), (1 << 60, None)], "doc_id long, text string"), registry.WORDS).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 2), (0, 2), (1 << 60, 1)]
    assert len({r["sequence_id"] for r in rows}) == 1 and sorted(r["offset"] for r in rows) in ([0, 2, 4],)


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(1, 65, 400))[::-1]
    numbers, offsets, left = packing.best_fit(lengths, 64)
    rooms = []
    for length, number, offset in zip(lengths, numbers, offsets, strict=True):
        fits = [r for r in rooms if r >= length]
        want = min(fits) if fits else 64
        if not fits:
            rooms.append(64)
            assert number == len(rooms) - 1
        assert rooms[number] == want and offset == 64 - want
        rooms[number] -= length
    assert rooms == left.tolist()


def lloyd(rows, k=40, rounds=5):
    start = sorted(rows, key=lambda r: brute.sha(f"2:{r[0]}"))[:k]
    cents = [[math.floor(256 * x) for x in v] for _, v in start]
    vecs = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in vecs:
            groups[near(v)[1]].append(v)
        for n, own in groups.items():
            cents[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, *near(v)[::-1]) for i, v in vecs]
    inertia = Counter()
    for _, n, d in found:
        inertia[n] += d
    return sorted((i, n, d, inertia[n], sum(inertia.values()), brute.sha(",".join(map(str, cents[n])))) for i, n, d in found)


@pytest.mark.parametrize("keys_collide", [False, True])
def test_centroids_with_copies(spark, monkeypatch, keys_collide):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 64)).astype(np.float32)
    rows = [(i, base[i % 60 if i % 3 else 0].tolist()) for i in range(240)] + [(7, base[5].tolist()), (900, [1e9] + [0.0] * 63)]
    rows = [(i, [min(x, 2.0**27 / 256) for x in v]) for i, v in rows]
    dirty = [(1000, None), (1001, [1.0] * 63), (1002, [None] + [1.0] * 63), (1003, [float("nan")] * 64), (1004, [float("inf")] * 64), (1005, [])]
    df = spark.createDataFrame(rows + dirty, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("x"))
    if keys_collide:
        monkeypatch.setattr(F, "xxhash64", lambda *a: F.lit(1).cast("long"))
    assert sorted(map(tuple, centroids.cluster(df).collect())) == lloyd(rows)


def test_centroids_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert centroids.cluster(empty).count() == 0
    few = spark.createDataFrame([(None, [1.0] * 64), (3, [2.0] * 64)], "vec_id long, embedding array<float>")
    assert sorted((r["vec_id"] or -1, r["cluster"]) for r in centroids.cluster(few).collect()) == [(-1, 0), (3, 0)]


def aligned(texts):
    """doc_id to the row, by whole texts and plain counts."""
    level, a_tokens, sp = alignment._byte_level(), byte_level(), brute.sentences()
    links, out = {}, {}
    for doc, text in texts.items():
        a = a_tokens.encode(" " + (text or ""), add_special_tokens=False)
        b = sp.encode(text or "")
        a_bytes = [bytes(level[c] for c in t) for t in a.tokens]
        b_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            links[doc], out[doc] = [], (0, 0, 0, "")
            continue
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        own, j = [], 0
        for i, end in enumerate(a_ends):
            begin = end - len(a_bytes[i])
            while b_ends[j] <= begin:
                j += 1
            k = j
            while k < len(b) and b_ends[k] - len(b_bytes[k]) < end:
                own.append((a.ids[i], b[k]))
                k += 1
        both = [0, *sorted(set(a_ends) & set(b_ends))]
        groups = defaultdict(lambda: ([], []))
        for side, tokens, ends in ((0, a.ids, a_ends), (1, b, b_ends)):
            for x, e in zip(tokens, ends, strict=True):
                groups[bisect_left(both, e)][side].append(str(x))
        groups = [f"{','.join(x)}|{','.join(y)}" for _, (x, y) in sorted(groups.items())]
        links[doc] = own
        out[doc] = len(a.ids), len(b), len(both) - 1, brute.sha(";".join(groups))
    counts = Counter(p for own in links.values() for p in own)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return {d: (d, *out[d][:3], len(own), sum(counts[p] == best[p[1]] for p in own), sum(counts[p] for p in own), out[d][3]) for d, own in links.items()}


def check_aligned(rows, texts):
    want = aligned(texts)
    assert len(rows) == len(want)
    for r in rows:
        own = want[r["doc_id"]]
        assert tuple(r) == own, texts[r["doc_id"]]


def test_alignment(spark):
    check_aligned(registry.op13_alignment(spark, FOLDER).collect(), texts_of(spark))


def test_alignment_of_odd_texts_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 1000)
    monkeypatch.setattr(alignment, "SALT_BLOCKS", 2)
    docs = docs_of(spark, ODD * 2).repartition(3).withColumn("n_a", F.lit("x"))
    check_aligned(alignment.align(docs, registry.BYTES, registry.PIECES).collect(), dict(enumerate(ODD * 2)))


def test_alignment_edges(spark):
    assert alignment.align(docs_of(spark, []), registry.BYTES, registry.PIECES).count() == 0
    rows = alignment.align(spark.createDataFrame([(None, "a"), (None, "a"), (1 << 60, None)], "doc_id long, text string"), registry.BYTES, registry.PIECES).collect()
    assert sorted((r["doc_id"] or 0, r["n_links"], r["count_sum"]) for r in rows) == [(0, 1, 2), (0, 1, 2), (1 << 60, 0, 0)]


def test_likeness_of_fingerprints(spark):
    """Exact where both sets are whole, near it elsewhere; nothing shared is 0 however short the texts."""
    rows = spark.createDataFrame([("gamma delta eps", "alpha beta"), ("", None), ("", "a"), ("a b c d e f", "a b c d e g")], "a string, b string")
    a, b = fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))
    got = [r[0] for r in rows.select(fingerprints.resemblance(a, b)).collect()]
    assert got == [0.0, 1.0, 0.0, 1 / 3]
    texts, edits = texts_of(spark), brute.edited(list(texts_of(spark).items()))
    down = sorted(texts, reverse=True)
    after = {d: down[(i + 1) % len(down)] for i, d in enumerate(down)}
    far = []
    for r in registry.op1_fingerprints(spark, FOLDER).collect():
        x, y, z = (brute.shingles(t, 5) for t in (texts[r["doc_id"]], edits[r["doc_id"]], texts[after[r["doc_id"]]]))
        for found, p, q in ((r["near_edited"], x, y), (r["near_next"], x, z)):
            want = len(p & q) / len(p | q) if p | q else 1.0
            assert max(len(p), len(q)) > fingerprints.WHOLE or abs(found - want) < 1e-9
            far.append(abs(found - want))
    assert max(far) < 0.25 and sum(far) / len(far) < 0.03


def test_empty_vectors_and_unnamed_documents(spark):
    vectors = spark.createDataFrame([(20, []), (1, []), (2, [])], "vec_id long, vector array<long>")
    assert [tuple(r) for r in top_k.top_k(vectors, vectors.where("vec_id = 20"), 20).orderBy("rank").collect()] == [(20, 1, 1, 0), (20, 2, 2, 0)]
    docs = spark.createDataFrame([(None, "a b c d e"), (None, None), (3, "a b c d e"), (4, "a b c d e"), (4, "a b c d e")], "doc_id long, text string")
    got = sorted(((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in near_duplicates.near_duplicates_and_unnamed(docs, 4, 80).collect()), key=str)
    assert got == [(-1, 0, None), (-1, 2, None), (3, 2, 3), (4, 2, 3)]
