"""Tokens, lexicon, BM25, exact cosine, rank fusion and retrieval metrics."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statuta.functions.tokeniser import ALL_STEMMERS, tokens
from statuta.sources.tables import checkpointed

K1, B, RRF = 1.2, 0.75, 60
QUERY_BLOCK, VECTOR_BLOCK, VECTOR_BLOCKS, PART_BLOCK = 4096, 32768, 12, 8192
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_tokens(text: Column) -> Column:
    """ASCII-folded letter runs of a text, in order: the form that SQL has; splits words at other letters, drops digits."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit("[a-z]+"), F.lit(0))


def stored_form(text: Column, lang: Column | None = None) -> Column:
    """The stems of a text joined by blanks, as an index stores them; a placeholder's form is empty, so that no query finds it."""
    return F.when(F.coalesce(exclusion_reason(text) == "placeholder", F.lit(False)), "").otherwise(F.array_join(tokens(text, lang, ALL_STEMMERS), " "))


def postings(docs: DataFrame, key: str, text: str, tokenise: Callable[[Column], Column] = tokens) -> DataFrame:
    """term, key and tf."""
    return _counted(docs.select(key, tokenise(F.col(text)).alias("words")), key)


def _counted(worded: DataFrame, key: str) -> DataFrame:
    each = worded.select(key, F.explode("words").alias("term"))
    return each.groupBy("term", key).agg(F.count("*").alias("tf"))


def _worded(docs: DataFrame, key: str, text: str, tokenise: Callable[[Column], Column]) -> DataFrame:
    """key and words of `docs`, split once: the words are written to the checkpoint folder, joined, as arrays take thrice the room."""
    joined = checkpointed(docs.select(key, F.array_join(tokenise(F.col(text)), "\x1f").alias("words")))
    return joined.select(key, F.array_remove(F.split("words", "\x1f"), "").alias("words"))


def lexicon(docs: DataFrame, key: str, text: str, tokenise: Callable[[Column], Column] = tokens) -> DataFrame:
    """term and the number of documents that hold it; stored terms have at most 128 bytes."""
    each = docs.select(key, F.explode(F.array_distinct(tokenise(F.col(text)))).alias("term")).where(F.octet_length("term") <= 128)
    # Pairs of term and document are shuffled only if some document is on several rows.
    if docs.groupBy(key).count().where("count > 1").limit(1).count():
        each = each.distinct()
    return each.groupBy("term").agg(F.count("*").alias("ndoc"))


def dead_terms(held: DataFrame, live: DataFrame) -> DataFrame:
    return held.join(live.select("term"), "term", "left_anti")


def bm25(docs: DataFrame, queries: DataFrame, key: str, query: str, text: str = "text", tokenise: Callable[[Column], Column] = tokens) -> DataFrame:
    """query, key and score of every document that holds a term of the query.

    Statistics are of all of `docs`. The queries' terms are joined to the postings by term, so only
    terms that are asked for are aggregated again.
    """
    asked = queries.select(query, F.explode(F.array_distinct(tokenise(F.col(text)))).alias("term"))
    return bm25_of_terms(docs, asked, key, query, text, tokenise)


def bm25_of_terms(docs: DataFrame, asked: DataFrame, key: str, query: str, text: str = "text", tokenise: Callable[[Column], Column] = tokens) -> DataFrame:
    """bm25 for terms at hand: `asked` has query and term, each pair once."""
    parts = term_parts(docs, asked, key, text, tokenise)
    return parts.join(asked, "term").groupBy(query, key).agg(F.round(F.sum("part"), 6).alias("score"))


def term_parts(docs: DataFrame, asked: DataFrame, key: str, text: str = "text", tokenise: Callable[[Column], Column] = tokens) -> DataFrame:
    """term, key and part: what each term of `asked` adds to the BM25 score of each document that holds it."""
    worded = _worded(docs, key, text, tokenise)
    sized = worded.select(key, F.size("words").alias("dl"))
    stats = sized.agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))
    wanted = _counted(worded, key).join(asked.select("term").distinct(), "term", "left_semi")
    df = wanted.groupBy("term").agg(F.count("*").alias("df"))
    scored = wanted.join(df, "term").join(sized, key).crossJoin(F.broadcast(stats))
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    return scored.select("term", key, part.alias("part"))


def best_of_parts(parts: DataFrame, asked: DataFrame, placed: DataFrame, k: int, key: str, query: str, within: str) -> DataFrame:
    """query, key, score and rank of the k best documents for each query among those placed in its own `within`.

    `parts`: term, key and part; `asked`: query, within and term; `placed`: within and key. Each block
    of documents meets each block of queries of its place once, and a pair of blocks tells k rows a
    query at most: pairs of a query and a document aren't shuffled.
    """
    # Rows by the document's block: its parts, of the terms that are asked for.
    many = lambda df, name, size, alias: df.groupBy(within).agg(F.ceil(F.count_distinct(name) / size).cast("int").alias(alias))
    sized = checkpointed(many(asked, query, QUERY_BLOCK, "__q").join(many(placed, key, PART_BLOCK, "__b"), within))
    at = lambda name, blocks: F.pmod(F.xxhash64(name, F.lit(3)), F.col(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    queries = asked.join(sized, within).select(within, query, "term", at(query, "__q").alias("q"), every("__b").alias("b"))
    held = parts.join(placed.join(sized, within), key).select(within, key, "term", "part", every("__q").alias("q"), at(key, "__b").alias("b"))

    def best(some: pa.Table, rows: pa.Table) -> pa.Table:
        names, at = np.unique(rows.column(key).to_numpy(), return_inverse=True)
        terms = rows.column("term").combine_chunks().dictionary_encode()
        order = np.argsort(terms.indices.to_numpy(), kind="stable")
        bounds = np.searchsorted(terms.indices.to_numpy()[order], np.arange(len(terms.dictionary) + 1))
        places = {t: (bounds[i], bounds[i + 1]) for i, t in enumerate(terms.dictionary.to_pylist())}
        at, part = at[order], rows.column("part").to_numpy()[order]
        wanted: dict = {}
        for q, t in zip(some.column(query).to_pylist(), some.column("term").to_pylist(), strict=True):
            wanted.setdefault(q, []).extend([places[t]] if t in places else [])
        out = {query: [], key: [], "score": []}
        for q, slices in wanted.items():
            score = np.zeros(len(names))
            for a, b in slices:
                score[at[a:b]] += part[a:b]
            found = np.flatnonzero(score)
            score = np.round(score[found], 6)
            # By falling score, ties by key.
            first = np.argsort(-score, kind="stable")[:k]
            out[query] += [q] * len(first)
            out[key] += names[found[first]].tolist()
            out["score"] += score[first].tolist()
        return pa.table({query: pa.array(out[query], some.column(query).type), key: pa.array(out[key], rows.column(key).type), "score": pa.array(out["score"], pa.float64())})

    kinds = dict(asked.dtypes)[query], dict(placed.dtypes)[key]
    cells = [df.groupBy(within, "q", "b") for df in (queries, held)]
    found = cells[0].cogroup(cells[1]).applyInArrow(best, f"`{query}` {kinds[0]}, `{key}` {kinds[1]}, score double")
    return ranked(found, [query], key, k)


def ranked(scored: DataFrame, by: list[str], key: str, k: int) -> DataFrame:
    best = Window.partitionBy(*by).orderBy(F.desc("score"), key)
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", query: str = "query_id", within: str | None = None) -> DataFrame:
    """query, key, score (dot product) and rank of the k best vectors for every row of `queries` (query, vector).

    With `within`, a column of both sides, a query sees only the vectors of its own value there; null sees none.
    Each block of vectors meets each block of queries once, and a pair of blocks tells k rows a query
    at most. Vectors that have no product with the query's (null, NaN, other lengths) come last, with null.
    """
    if within is None:
        blocks = [F.lit(max(1, -(-queries.count() // QUERY_BLOCK))), F.lit(max(VECTOR_BLOCKS, -(-vectors.count() // VECTOR_BLOCK)))]
    else:
        sizes = [df.groupBy(within).agg(F.ceil(F.count("*") / size).alias(name)) for df, size, name in ((queries, QUERY_BLOCK, "__q"), (vectors, VECTOR_BLOCK, "__b"))]
        sized = checkpointed(sizes[0].join(sizes[1], within))
        queries, vectors = queries.join(sized, within), vectors.join(sized, within)
        blocks = [F.col("__q"), F.col("__b")]
    inside = [] if within is None else [within]

    def dealt(df: DataFrame, name: str, own: int, other: int) -> DataFrame:
        at = F.pmod(F.xxhash64(name, F.lit(1)), blocks[own]).cast("int")
        every = F.explode(F.sequence(F.lit(0), (blocks[other] - 1).cast("int"))).alias("other")
        rows = df.select(*inside, F.col(name).alias("id"), F.col(vector).cast("array<double>").alias("v"), at.alias("own"), every)
        return rows.select(*inside, "id", "v", *[F.col("own" if i == own else "other").alias(c) for i, c in enumerate(("q", "b"))])

    def best(asked: pa.Table, held: pa.Table) -> pa.Table:
        ids = held.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, rows = ids[order], held.column("v").take(pa.array(order)).to_pylist()
        usable = [r is not None and None not in r for r in rows]
        width = np.array([len(r) if ok else -1 for r, ok in zip(rows, usable, strict=True)])
        whole = {w: (at := np.flatnonzero(width == w), np.array([rows[i] for i in at], dtype=float).reshape(len(at), w)) for w in np.unique(width[width >= 0])}
        out = {query: [], key: [], "score": []}
        for q, v in zip(asked.column("id").to_pylist(), asked.column("v").to_pylist(), strict=True):
            score = np.full(len(ids), np.nan)
            if v is not None and None not in v and len(v) in whole:
                at, matrix = whole[len(v)]
                score[at] = np.round(matrix @ np.array(v, dtype=float), 6)
            # By falling score, ties by id; what has no score is last.
            first = np.argsort(-score, kind="stable")[:k]
            out[query] += [q] * len(first)
            out[key] += ids[first].tolist()
            out["score"] += [None if np.isnan(x) else x for x in score[first].tolist()]
        return pa.table({query: pa.array(out[query], asked.column("id").type), key: pa.array(out[key], held.column("id").type), "score": pa.array(out["score"], pa.float64())})

    kinds = dict(queries.dtypes)[query], dict(vectors.dtypes)[key]
    cells = [df.groupBy(*inside, "q", "b") for df in (dealt(queries, query, 0, 1), dealt(vectors, key, 1, 0))]
    found = cells[0].cogroup(cells[1]).applyInArrow(best, f"`{query}` {kinds[0]}, `{key}` {kinds[1]}, score double")
    return ranked(found, [query], key, k)


def fuse(arms: list[DataFrame], key: str, k: int, constant: int = RRF, by: list[str] | None = None) -> DataFrame:
    """Reciprocal rank fusion of arms (by, key, rank): by, key, score and rank of the k best of each `by`."""
    by = by or []
    every = arms[0].select(*by, key, "rank")
    for arm in arms[1:]:
        every = every.unionByName(arm.select(*by, key, "rank"))
    fused = every.groupBy(*by, key).agg(F.round(F.sum(1 / (F.lit(constant) + F.col("rank"))), 8).alias("score"))
    return ranked(fused, by, key, k) if by else fused.orderBy(F.desc("score"), key).limit(k)


def retrieval_metrics(found: DataFrame, gold: DataFrame, query: str, key: str, k: int) -> DataFrame:
    """recall, mrr and ndcg at k, averaged over the queries of `gold` (query, key)."""
    hits = found.where(F.col("rank") <= k).join(gold, [query, key]).groupBy(query).agg(F.count("*").alias("hits"), F.min("rank").alias("best"), F.sum(1 / F.log2(F.col("rank") + 1)).alias("gain"))
    size = gold.groupBy(query).agg(F.count("*").alias("n"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int")), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + 1))
    each = size.join(hits, query, "left").select((F.coalesce("hits", F.lit(0)) / F.col("n")).alias("recall"), F.coalesce(1 / F.col("best"), F.lit(0.0)).alias("rr"), F.coalesce(F.col("gain") / ideal, F.lit(0.0)).alias("ndcg"))
    return each.agg(F.count("*").alias("queries"), F.round(F.avg("recall"), 6).alias("recall"), F.round(F.avg("rr"), 6).alias("mrr"), F.round(F.avg("ndcg"), 6).alias("ndcg"))


def exclusion_reason(text: Column) -> Column:
    """Why a unit stays out of the retrieval pool: placeholder, table or digits; null: it stays in."""
    whole = F.trim(F.coalesce(text, F.lit("")))
    few = F.size(F.split(whole, r"[ \t\n]+")) < 25
    digits, letters = F.length(F.regexp_replace(whole, "[^0-9]", "")), F.length(F.regexp_replace(whole, "[^0-9A-Za-z]", ""))
    return F.when(whole == "", None).when(whole.rlike(r"^\[[a-z ]+\]$"), "placeholder").when(few & whole.rlike(r"\|.*\||\.{4,}|_{4,}"), "table").when(few & (letters > 0) & (digits / letters > 0.3), "digits")
