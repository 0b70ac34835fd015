"""Hybrid search within scopes against a plain form, and its edge cases."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from statuta.operators import retrieval, search

UNITS = "unit long, version string, text string, lang string, kind string, normative boolean, excluded boolean"
VECTORS = "unit long, model string, vector array<float>"
ASKED = "query long, scope string, text string, vector array<float>"
ROWS = [
    (1, "a", "tax on land", "en", "article", True, False),
    (2, "a", "tax on boats and land", "en", "article", True, None),
    (3, "a", "tax tax tax", "en", "annex", True, False),
    (4, "b", "boats", "en", "article", True, False),
    (5, "b", "land tax", "en", "article", False, False),
    (6, "b", "land tax", "en", "article", None, False),
    (7, "b", "land tax", "en", "article", True, True),
    (8, None, "land tax", "en", "article", True, False),
    (9, "b", None, "en", "article", True, False),
    (10, "b", "land of boats", "en", None, True, False),
]
OWN = [(1, "new", [1.0, 0.0]), (1, "old", [0.0, 1.0]), (2, "old", [0.0, 2.0]), (4, "new", [3.0, 4.0]), (9, "new", [0.0, 0.0]), (3, "new", None), (10, "new", [1.0, None]), (10, "old", [1.0, 0.0]), (7, "new", [1.0, 0.0])]
SCOPES = [("all", "a"), ("all", "b"), ("all", "b"), ("b", "b"), ("none", "z"), (None, "a"), ("b", None)]
QUERIES = [(1, "all", "tax land", [1.0, 0.0]), (2, "b", "boats", [0.0, 1.0]), (3, "all", "...", [0.0, 5.0]), (4, "none", "tax", [1.0, 0.0]), (5, None, "tax", [1.0, 0.0]), (6, "all", "boats", None), (7, "all", None, [1.0, 0.0, 0.0]), (8, "unknown", "land", [1.0, 0.0]), (8, "unknown", "land", [1.0, 0.0])]


def plain(rows, own, asked, scopes, k, pool, kind=None, non_normative=False):
    """query, unit, score and rank by nested loops."""
    words = {r[0]: (r[2] or "").split() for r in rows}
    mean, out = sum(map(len, words.values())) / len(words), []
    vectors = {u: v for u, m, v in own if m == "old"} | {u: v for u, m, v in own if m == "new"}

    def length(v):
        return math.sqrt(sum(x * x for x in v)) if v and None not in v else 0

    for query, scope, text, vector in dict.fromkeys((q, s, t, tuple(v) if v else None) for q, s, t, v in asked):
        held = {v for s, v in scopes if s == scope and s is not None and v is not None}
        inside = [r[0] for r in rows if r[1] in held and (r[5] or non_normative) and not r[6] and kind in (None, r[4])]
        terms = {w for w in (text or "").split() if w.isalpha()}
        lexical = {}
        for u in inside:
            score = 0.0
            for t in terms & set(words[u]):
                n = sum(t in w for w in words.values())
                tf = Counter(words[u])[t]
                score += math.log(1 + (len(words) - n + 0.5) / (n + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words[u]) / mean))
            if terms & set(words[u]):
                lexical[u] = round(score, 6)
        dense = {}
        for u in inside:
            v = vectors.get(u)
            if vector and length(v) and length(vector) and len(v) == len(vector):
                dense[u] = round(sum(x * y for x, y in zip(v, vector, strict=True)) / length(v) / length(vector), 6)
        arms = [sorted(x, key=lambda u, x=x: (-x[u], u))[:pool] for x in (lexical, dense)]
        if not terms:
            out += [(query, u, 0.0, i + 1) for i, u in enumerate(arms[1][:k])]
            continue
        fused = Counter()
        for arm in arms:
            for i, u in enumerate(arm):
                fused[u] += 1 / (61 + i)
        best = sorted(fused, key=lambda u: (-round(fused[u], 8), u))[:k]
        out += [(query, u, round(fused[u], 8), i + 1) for i, u in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"kind": "article"}, {"non_normative": True}])
@pytest.mark.parametrize("k,pool", [(10, 10), (2, 3)])
def test_equals_plain_form(spark, options, k, pool):
    frames = [spark.createDataFrame(*x) for x in ((ROWS, UNITS), (OWN, VECTORS), (QUERIES, ASKED), (SCOPES, "scope string, version string"))]
    frames[0] = frames[0].union(frames[0].where("unit = 2"))
    found = retrieval.hybrid(*frames, k, pool, "new", "old", tokenise=search.ascii_tokens, **options)
    got = sorted((r["query"], r["unit"], round(r["score"], 8), r["rank"]) for r in found.collect())
    assert got == plain(ROWS, OWN, QUERIES, SCOPES, k, pool, **options)
    assert {q for q, *_ in got} == {1, 2, 3, 6}


def test_fallback_only_without_a_preferred_vector(spark):
    vectors = spark.createDataFrame(OWN, VECTORS)
    assert sorted(r["unit"] for r in retrieval.usable_vectors(vectors, "new").collect()) == [1, 3, 4, 7, 9, 10]
    both = {r["unit"]: r["vector"] for r in retrieval.usable_vectors(vectors, "new", "old").collect()}
    assert both[1] == [1.0, 0.0] and both[2] == [0.0, 2.0] and both[10] == [1.0, None]


def test_terms_of_every_language_of_the_scope_and_variants(spark):
    asked = spark.createDataFrame([(1, "s", "taxes land"), (2, "t", "taxes")], "query long, scope string, text string")
    languages = spark.createDataFrame([("s", "en"), ("s", "de"), ("s", "de")], "scope string, lang string")
    variants = spark.createDataFrame([("land", "lande"), ("land", "lande"), ("sea", "see")], "term string, variant string")
    by_lang = lambda text: F.when(F.col("lang") == "en", F.split(F.replace(text, F.lit("taxes"), F.lit("tax")), " ")).otherwise(F.split(text, " "))
    got = sorted((r["query"], r["term"]) for r in retrieval.query_terms(asked, languages, by_lang, variants).collect())
    assert got == [(1, "land"), (1, "lande"), (1, "tax"), (1, "taxes"), (2, "taxes")]


def test_empty_tables(spark):
    frames = [spark.createDataFrame(*x) for x in ((ROWS, UNITS), (OWN, VECTORS), (QUERIES, ASKED), (SCOPES, "scope string, version string"))]
    for i in range(4):
        some = [f.limit(0) if j == i else f for j, f in enumerate(frames)]
        found = retrieval.hybrid(*some, 5, 5, "new", "old", tokenise=search.ascii_tokens)
        assert (found.count() == 0) == (i != 1)


def test_enriched(spark):
    found = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "query long, unit long")
    units = spark.createDataFrame([(10, "a"), (11, "b")], "unit long, version string")
    laws = spark.createDataFrame([("a", "law")], "version string, title string")
    assert [tuple(r) for r in retrieval.enriched(found, units, [(laws, "version")]).select("query", "unit", "title").collect()] == [(1, 10, "law")]


def test_best_of_parts_is_bm25_of_the_scope(spark, monkeypatch):
    monkeypatch.setattr(search, "PART_BLOCK", 7)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", (F.col("doc_id") % 3).alias("scope"))
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", (F.col("item_id") % 3).alias("scope"), F.explode(F.array_distinct(search.ascii_tokens(F.col("text")))).alias("term"))
    placed = docs.select("scope", "doc_id").union(docs.where("doc_id % 5 = 0").select((F.col("scope") + 1) % 3, "doc_id"))
    found = search.best_of_parts(search.term_parts(docs, items, "doc_id", tokenise=search.ascii_tokens), items, placed, 9, "doc_id", "item_id", "scope")
    assert "FlatMapCoGroups" in found._jdf.queryExecution().executedPlan().toString()
    scored = search.bm25_of_terms(docs, items.select("item_id", "term"), "doc_id", "item_id", tokenise=search.ascii_tokens)
    want = search.ranked(scored.join(items.select("item_id", "scope").distinct(), "item_id").join(placed, ["scope", "doc_id"], "left_semi").drop("scope"), ["item_id"], "doc_id", 9)
    tell = lambda df: {tuple(r) for r in df.select("item_id", "doc_id", "score", "rank").collect()}
    assert tell(found) == tell(want) != set()
