"""Training-data operators against brute force: nulls, empty and odd texts, ties, repeated rows, clashing names."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from statuta.llm import byte_bpe, chat_format, common, fingerprints, mixing, near_duplicates, quality, registry, substrings, token_counts, top_k, toxicity
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    out = []
    for i in range(40):
        body = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 160))]
        if i % 3 == 0:
            body[10:10] = passage[rng.randrange(0, 15) :]
        if i % 7 == 1 and out:
            body = out[-1][1].split()
            body[len(body) // 2] = "Changed"
        out.append((i, " ".join(body)))
    odd = [None, "", " \t\n", "one", "two words", "a" * 5000, "x " * 400, "Ünïcode ▁ <s>   zero\x00", "same text here now", "same text here now", " ".join(passage), "\n".join(passage)]
    return out + [(100 + i, t) for i, t in enumerate(odd)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(texts(), DOCS).withColumn("label", F.lit(1)).withColumn("n_tokens", F.lit("x")).cache()


def test_fingerprints(spark, docs):
    got = {r["doc_id"]: r for r in fingerprints.digests(fingerprints.fingerprints(docs)).collect()}
    want = brute.edited(texts())
    for d, text in texts():
        assert got[d]["edited_sha256"] == brute.sha(want[d]) and got[d]["n_chars"] == len(text or "")
        assert 0 <= got[d]["near_edited"] <= 1
    assert got[108]["fingerprint"] == got[109]["fingerprint"] and got[108]["near_next"] is not None
    assert fingerprints.digests(fingerprints.fingerprints(docs.limit(0))).count() == 0


def test_sketches_estimate_containment(spark):
    rng = random.Random(1)
    long = [f"v{rng.randrange(5000)}" for _ in range(4000)]
    row = spark.createDataFrame([(" ".join(long), " ".join(long[:1000]))], "a string, b string")
    a, b = fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))
    got = row.select(a.alias("a"), b.alias("b")).select(fingerprints.containment(F.col("b"), F.col("a")), fingerprints.resemblance(F.col("a"), F.col("b")), fingerprints.merge_sketches(F.col("a"), F.col("b")) == F.col("a")).first()
    assert got[0] == 1.0 and abs(got[1] - 0.25) < 0.08 and got[2]


def test_next_rows_of_clustered_ids(spark):
    rows = [(i, f"text {i}") for i in range(500)] + [(2**63 - 1, "top"), (-(2**63), "bottom"), (None, "null")]
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(spark.createDataFrame(rows, DOCS), ["text"]).collect()}
    down = sorted((d for d, _ in rows if d is not None), reverse=True) + [None]
    held = dict(rows)
    assert got == {d: held[down[(i + 1) % len(down)]] for i, d in enumerate(down)}


def test_mixing_with_clashing_columns(spark):
    docs = spark.createDataFrame([(i, "a b c", "en", "s", 1, 2) for i in range(50)], "doc_id long, text string, lang string, source string, epochs int, cut int")
    assert mixing.mix_sources(docs, F.lit("web"), part=0.5, max_epochs=1).count() > 15


def test_token_counts(docs):
    sp = brute.sentences()
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert got == {d: (len((t or "").encode()), len(sp.encode(t or ""))) for d, t in texts()}


def test_chunk_maps_compose():
    machine = token_counts.transducer(public_tokenizers.path("piece_bpe_32k.model"))
    text = (token_counts.MARK + "The quick brown\nfox  jumps über 日本".replace(" ", token_counts.MARK)) * 3
    whole = machine.count(text)
    for i in range(0, len(text), 3):
        for j in range(i, len(text), 11):
            maps = [machine.chunk_map(x) for x in (text[:i], text[i:j], text[j:])]
            assert machine.total(machine.compose(machine.compose(maps[0], maps[1]), maps[2])) == whole
            assert machine.total(machine.compose(maps[0], machine.compose(maps[1], maps[2]))) == whole


def test_token_counts_of_texts_of_many_chunks(spark):
    rng = random.Random(3)
    parts = ["the ", "cat", " über", "日本", "\n", "  ", "x" * 50, "\U0001f600", "1", ". ", "\u2581"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(1500 * i))) for i in range(6)]
    rows += [(90, "a" * 9000), (91, "x" * 3 * token_counts.CHUNK + " y" * 3), (92, " " * 9000), (93, "\n" * (token_counts.CHUNK + 1)), (94, "a" * (token_counts.CHUNK - 2) + " " + "b" * token_counts.CHUNK)]
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(spark.createDataFrame(rows, DOCS), public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert got == {d: len(brute.sentences().encode(t)) for d, t in rows}


def test_byte_bpe(docs):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    assert "label" in encoded.columns
    got = {r["doc_id"]: (r["ids"], r["decoded_sha256"]) for r in byte_bpe.digests(encoded, ranks).collect()}
    assert got == {d: (brute.bpe().encode_ordinary(t or ""), brute.sha(t or "")) for d, t in texts()}


def test_byte_bpe_of_letters_newer_than_java_and_long_words(spark):
    rng = random.Random(8)
    parts = [" ", "a", "B", "'s", "1", "\n", "é", "\U0001e030", "\U00031350", "\ua7d0", "ⅷ", "_", "--", "\u0300", "日本", "aaaaa", "ing "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 60)))) for i in range(400)] + [(900, "a" * 1500), (901, "".join(rng.choice("abcdef") for _ in range(600)))]
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    frame = spark.createDataFrame(rows, DOCS).withColumn("__words", F.lit(1)).withColumn("ids", F.lit("x"))
    got = {r["doc_id"]: r["ids"] for r in byte_bpe.encode(frame, ranks, public_tokenizers.PATTERN).collect()}
    assert got == {d: brute.bpe().encode_ordinary(t) for d, t in rows}
    assert byte_bpe.encode(frame.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def thue_morse(swap):
    word = "ab"
    for _ in range(9):
        word += word.translate(str.maketrans("ab", "ba"))
    return word.translate(str.maketrans("ab", "ba")) if swap else word


def test_words_that_polynomials_cannot_tell_apart(spark):
    same = " ".join(f"s{i}" for i in range(49))
    rows = [(i, f"{thue_morse(i)} {same}") for i in (0, 1)] + [(10 + i, thue_morse(i)) for i in (0, 1)]
    frame = spark.createDataFrame(rows, DOCS)
    assert {r["doc_id"]: r["n_removed"] for r in substrings.dedup_substrings(frame).collect()} == {0: 0, 1: 0, 10: 0, 11: 0}
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(frame.where("doc_id > 9")).collect()} == {10: 10, 11: 11}


def test_hot_bucket_of_near_copies(spark):
    rng = random.Random(4)
    body = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(1500):
        own = list(body)
        for k in range(i % 7):
            own[rng.randrange(120)] = f"x{i}_{k}"
        rows.append((i, " ".join(own)))
    rows += [(5000 + i, " ".join(body[:60] + [f"y{i}_{k}" for k in range(60)])) for i in range(40)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, DOCS), 4, 80).collect()}
    assert got == brute.near_duplicates(rows)


def test_repeated_and_null_ids(spark):
    long = " ".join(f"v{i}" for i in range(80))
    rows = [(1, long), (1, "other words"), (None, long), (2, long), (2, long)]
    frame = spark.createDataFrame(rows, DOCS)
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in substrings.dedup_substrings(frame).collect())
    assert got == [("1", 2, 0), ("1", 80, 0), ("2", 80, 80), ("2", 80, 80), ("None", 80, 0)]
    assert sorted((r["doc_id"], r["component_id"]) for r in near_duplicates.near_duplicates(frame).collect()) == [(1, 1), (2, 1 if long < "other words" else 2)]
    assert substrings.dedup_substrings(frame.limit(0)).count() == near_duplicates.near_duplicates(frame.limit(0)).count() == 0


def test_hashes_of_windows_tell_them_apart():
    rng = random.Random(3)
    texts = [" ".join(rng.choices("abc", k=rng.choice([0, 1, 5, 49, 50, 200]))).encode() for _ in range(60)]
    for window in (1, 2, 5, 50):
        parse = substrings.Parse(texts, window)
        begins = parse.windows(np.arange(len(parse.first)))
        mixed, whole = parse.mixed(begins).tolist(), [b" ".join(texts[d].split()[i : i + window]) for d, i in zip(parse.of[begins], begins - parse.offsets[parse.of[begins]], strict=True)]
        assert len(set(zip(mixed, whole, strict=True))) == len(set(mixed)) == len(set(whole)) > 0
    assert len(substrings.Parse([b"a b"], 50).mixed(np.arange(0))) == 0


def test_substrings(docs):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substrings.dedup_substrings(docs).collect()}
    want = {d: (a, b, " ".join(c)) for d, (a, b, c) in brute.substrings(texts()).items()}
    assert got == want and sum(x[1] for x in want.values()) > 500


def test_near_duplicates(docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.near_duplicates(docs, 4, 80).collect()}
    assert got == brute.near_duplicates(texts())
    kept = near_duplicates.drop_near_duplicates(docs, 4, 80)
    assert set(kept.columns) == set(docs.columns)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = dict(tuple(r) for r in near_duplicates.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 130)}


def test_top_k(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(-9, 9)) for _ in range(6)]) for i in range(300)] + [(300, None), (301, [None] * 6), (302, [float("nan")] * 6), (303, [1.0] * 6), (304, [1.0] * 6)]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<double>").where(top_k.usable(F.col("v"))).select("vec_id", top_k.scaled(F.col("v"), 1).alias("vector"))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in top_k.top_k(vectors, vectors.where("vec_id % 20 = 0"), 7).collect()}
    held = [(i, v) for i, v in rows if v and None not in v and v == v and i != 302]
    want = {}
    for q, a in held:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in held if i != q)[:7]
            want |= {(q, n + 1): (i, int(-s)) for n, (s, i) in enumerate(scored)}
    assert got == want


def test_chat_format_reads_back(spark):
    said = [(1, 0, "user", "a<|im_end|>\\<\\|"), (1, 1, "user", None), (1, 2, "assistant", registry.CONTROL), (1, 3, "assistant", "<|im_next|>"), (None, 0, None, "x"), (2, 0, "assistant", "")]
    rows = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat_format.digests(chat_format.format_conversations(rows)).collect()}
    turns = "".join(f"{r}\n{t or ''}\n" for c, _, r, t in said if c == 1)
    assert got[1]["turns_sha256"] == brute.sha(turns) and got[1]["loss_sha256"] == brute.sha(registry.CONTROL + "<|im_next|>")
    assert got[2]["n_turns"] == 1 and got[None]["n_turns"] == 1 and got[2]["loss_chars"] == 0


def test_mixing_budgets(spark):
    rows = [(i, "t " * (1 + i % 5), lang, source) for i, (lang, source) in enumerate([("en", "a"), ("en", "b"), ("de", "a"), (None, None)] * 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    domain = F.when(F.col("source") == "a", "web").otherwise("books")
    got = mixing.mix_sources(docs, domain, ({"web": 3.0, "books": 1.0}, {}, {}), part=0.5, max_epochs=1)
    total = sum(1 + i % 5 for i in range(len(rows)))
    spent = {r["domain"]: r["n"] for r in got.groupBy("domain").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("n")).collect()}
    assert 0.47 * total <= sum(spent.values()) <= 0.5 * total
    assert abs(spent["web"] / sum(spent.values()) - 0.75) < 0.05
    assert mixing.mix_sources(docs.limit(0), domain).count() == 0


def test_mixing_salts_leaves_too_many_to_broadcast(spark, monkeypatch):
    rows = [(i, "t " * (1 + i % 5), lang, source) for i, (lang, source) in enumerate([("en", "a"), ("en", "b"), ("de", "a"), (None, None)] * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    made = []
    for limit in (mixing.BROADCAST_BYTES, -1):
        monkeypatch.setattr(mixing, "BROADCAST_BYTES", limit)
        made.append(sorted(map(tuple, mixing.mix_sources(docs, F.coalesce("source", F.lit("none"))).collect()), key=str))
    assert made[0] and made[0] == made[1]


def test_classifiers_learn_and_score_odd_texts(spark, docs):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60)) + (" you vile grumbler ### $$$" if i % 4 == 0 else ".")) for i in range(400)]
    train = spark.createDataFrame(rows, DOCS)
    labels = train.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"), (F.col("doc_id") % 4 != 0).cast("int").alias("quality"))
    for scored, sign in ((toxicity.score_toxicity(train.union(docs.select("doc_id", "text")), labels.where("doc_id % 3 = 1")), 1), (quality.score_quality(train.union(docs.select("doc_id", "text")), labels.where("doc_id % 3 = 1")), 0)):
        found = [(r["doc_id"], r["score"]) for r in scored.collect()]
        assert all(0 <= s <= 1 for _, s in found)
        assert brute.auc([s for d, s in found[:400]], [int((d % 4 == 0) == bool(sign)) for d, _ in found[:400]]) > 0.95
    assert toxicity.score_toxicity(docs, labels.limit(0)).where("score is null").count() == 0


def test_filter_keeps_what_it_holds(spark):
    ids = spark.range(0, 5000, 7)
    assert spark.range(5000).where(common.may_hold(ids, "id")(F.col("id"))).join(ids, "id").count() == ids.count()
