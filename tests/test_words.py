"""Whole-word tokens and the queries that use them, against plain Python."""

import math
import unicodedata
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from statuta.operators import quality, search
from statuta.plans import registry

FOLDER = "/root/testdata/sf0.001"
TEXTS = [
    ("La adopción n.º 12", None, ["la", "adopción", "n", "o", "12"]),
    ("adópcion STRASSE Straße ΣΟΦΟΣ σοφός", None, ["adópcion", "strasse", "strasse", "σοφοσ", "σοφόσ"]),
    ("कानून १२ 日本 ＡＢＣ ﬁn", "hi", ["कानून", "12", "日本", "abc", "fin"]),
    ("İHALE ihale x_y", "tr", ["ihale", "ihale", "x", "y"]),
    ("وللنقيب للنقيب المادة ٣", "ar", ["نقيب", "نقيب", "ماد", "3"]),
    ("שָׁלוֹם", "he", ["שלום"]),
    (None, "en", []),
    ("", None, []),
]


def split(text):
    """Runs of letters, numbers and marks, told by Unicode category."""
    out, held = [], ""
    for c in unicodedata.normalize("NFKC", text or "") + " ":
        if unicodedata.category(c)[0] in "LNM":
            held += c
        elif held:
            out, held = [*out, held.casefold()], ""
    return out


def documents(columns="doc_id, text"):
    return duckdb.sql(f"select {columns} from '{FOLDER}/documents.parquet'").fetchall()


def test_tokens(spark):
    rows = spark.createDataFrame([(i, t, x) for i, (t, x, _) in enumerate(TEXTS)], "k int, text string, lang string")
    got = {r["k"]: r["w"] for r in rows.select("k", search.tokens(F.col("text"), F.col("lang")).alias("w")).collect()}
    assert got == {i: want for i, (*_, want) in enumerate(TEXTS)}


def test_operators_keep_whole_words(spark):
    docs = spark.createDataFrame([(1, "adopción 1999"), (2, "adopci n"), (3, "12 日本")], "doc_id int, text string")
    assert {tuple(r) for r in search.lexicon(docs, "doc_id", "text").collect()} == {(w, 1) for w in ("adopción", "1999", "adopci", "n", "12", "日本")}
    asked = spark.createDataFrame([(7, "ADOPCIÓN"), (8, "日本")], "q int, text string")
    assert sorted((r["q"], r["doc_id"]) for r in search.bm25(docs, asked, "doc_id", "q").collect()) == [(7, 1), (8, 3)]
    pair = spark.createDataFrame([("year 1999", "year 2000")], "a string, b string")
    assert pair.select(quality.divergence(search.tokens(F.col("a")), search.tokens(F.col("b")))).first()[0] == round(2 / 3, 6)


def test_lexicon_and_divergence(spark):
    words = {d: split(t) for d, t in documents()}
    got = {r["term"]: r["ndoc"] for r in registry.lexicon_words(spark, FOLDER).collect()}
    assert got == Counter(w for x in words.values() for w in set(x) if len(w.encode()) <= 128)
    got = {r["doc_id"]: r["divergence"] for r in registry.divergence_words(spark, FOLDER).collect()}
    sets = {d: set(x) for d, x in words.items()}
    want = {d: 1 - len(sets[d] & sets[d + 1]) / len(sets[d] | sets[d + 1]) if sets[d] and sets[d + 1] else None for d in sets if d + 1 in sets}
    assert got.keys() == want.keys() and all((got[d] is None) == (x is None) and (x is None or abs(got[d] - x) < 1e-5) for d, x in want.items())


def test_bm25_and_legibility(spark):
    docs = {d: Counter(split(t)) for d, t in documents()}
    df, n = Counter(w for x in docs.values() for w in x), len(docs)
    mean = sum(x.total() for x in docs.values()) / n
    want = {}
    for item, text in duckdb.sql(f"select item_id, text from '{FOLDER}/benchmark.parquet'").fetchall():
        asked = {w for w in split(text) if len(w.encode()) <= 128}
        scores = {d: round(sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * x[w] * 2.2 / (x[w] + 1.2 * (0.25 + 0.75 * x.total() / mean)) for w in asked if x[w]), 6) for d, x in docs.items() if asked & x.keys()}
        want |= {(item, k + 1): s for k, (_, s) in enumerate(sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:10])}
    got = {(r["item_id"], r["rank"]): r["score"] for r in registry.bm25_topk_words(spark, FOLDER).collect()}
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-5 for x in want)
    rates = {r["doc_id"]: r["rate"] for r in registry.legibility_words(spark, FOLDER).collect()}
    for d, x in docs.items():
        assert (rates[d] is None) == (x.total() < 200) and (rates[d] is None or abs(rates[d] - 1000 * sum(x[w] for w in registry.COMMON) / x.total()) < 1e-5)
