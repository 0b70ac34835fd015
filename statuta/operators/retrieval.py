"""Hybrid search within scopes: pool, preferred and fallback vectors, two arms, fusion and enrichment.

Every function serves a whole table of queries. A scope is a set of versions; each query names one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.tokeniser import tokens
from statuta.operators.search import RRF, best_of_parts, fuse, nearest, term_parts
from statuta.sources.tables import checkpointed


def in_pool(kind: str | None = None, non_normative: bool = False) -> Column:
    """Whether a unit (kind, normative, excluded) may be found.

    It has to be normative, unless the rest is asked for too, where null isn't; it may not be excluded,
    where null isn't either; and it has to be of the kind, if one is given.
    """
    wanted = ~F.coalesce(F.col("excluded"), F.lit(False))
    if not non_normative:
        wanted &= F.coalesce(F.col("normative"), F.lit(False))
    if kind is not None:
        wanted &= F.coalesce(F.col("kind") == kind, F.lit(False))
    return wanted


def usable_vectors(vectors: DataFrame, model: str, fallback: str | None = None) -> DataFrame:
    """unit and vector of each unit's vectors (unit, model, vector) of `model`; of `fallback` for units that have none of `model`."""
    preferred = vectors.where(F.col("model") == model).select("unit", "vector")
    if fallback is None or fallback == model:
        return preferred
    spare = vectors.where(F.col("model") == fallback).select("unit", "vector")
    return preferred.unionByName(spare.join(preferred.select("unit").distinct(), "unit", "left_anti"))


def unit_length(vector: Column) -> Column:
    """The vector divided by its length, as doubles; null for one of no length, or that holds null or a non-finite component."""
    v = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.when((norm > 0) & (norm < float("inf")), F.transform(v, lambda x: x / norm))


def query_terms(asked: DataFrame, languages: DataFrame, tokenise: Callable[[Column], Column] = tokens, variants: DataFrame | None = None) -> DataFrame:
    """query and term, each pair once: the text tokenised by every language of the query's scope, and the terms' `variants`.

    `asked`: query, scope and text; `languages`: scope and lang; `variants`: term and variant.
    `tokenise` may read the column lang. A scope without a language takes lang null.
    """
    worded = asked.select("query", "scope", "text").join(languages.select("scope", "lang").distinct(), "scope", "left")
    terms = worded.select("query", F.explode(tokenise(F.col("text"))).alias("term")).distinct()
    if variants is None:
        return terms
    return terms.union(terms.join(variants.select("term", "variant"), "term").select("query", "variant")).distinct()


def hybrid(
    units: DataFrame, vectors: DataFrame, asked: DataFrame, scopes: DataFrame, k: int, pool: int, model: str, fallback: str | None = None,
    kind: str | None = None, non_normative: bool = False, tokenise: Callable[[Column], Column] = tokens, variants: DataFrame | None = None, constant: int = RRF,
) -> DataFrame:
    """query, unit, score and rank of the k best units of each query's scope.

    `units`: unit, version, text, lang, kind, normative, excluded; `vectors`: unit, model, vector;
    `asked`: query, scope, text, vector; `scopes`: scope and version. Both arms rank the pool of the
    scope alone, by BM25 and by cosine, ties by the unit, and give `pool` units to the fusion; the
    statistics of BM25 are of all units. A query without a term, by whatever language of its scope, is
    answered by the vectors alone, with score 0. Queries of an unknown, empty or null scope find
    nothing; nor does a null or unusable vector find or get found by the dense arm. Of several rows of
    a unit, a query, or a unit's usable vectors, one counts, whichever; null keys never match.
    """
    asked = asked.select("query", "scope", "text", "vector").where("query is not null and scope is not null").dropDuplicates(["query"])
    units = units.where("unit is not null")
    # Texts are shuffled only if some unit is on several rows.
    if units.groupBy("unit").count().where("count > 1").limit(1).count():
        units = units.dropDuplicates(["unit"])
    inside = scopes.select("scope", "version").where("scope is not null").distinct()
    placed = checkpointed(units.where(in_pool(kind, non_normative)).select("unit", "version").join(inside, "version").select("scope", "unit"))
    languages = units.select("version", "lang").distinct().join(inside, "version").select("scope", "lang").distinct()
    terms = checkpointed(query_terms(asked, languages, tokenise, variants))
    parts = term_parts(units, terms, "unit", "text", tokenise)
    lexical = best_of_parts(parts, terms.join(asked.select("query", "scope"), "query"), placed, pool, "unit", "query", "scope")
    held = usable_vectors(vectors, model, fallback).select("unit", unit_length(F.col("vector")).alias("v")).where("v is not null").dropDuplicates(["unit"])
    wanted = asked.select("query", "scope", unit_length(F.col("vector")).alias("v")).where("v is not null")
    # A vector of another length than the query's has no product with it.
    dense = checkpointed(nearest(held.join(placed, "unit"), wanted, pool, "unit", "v", "query", within="scope").where("score is not null"))
    worded = terms.select("query").distinct()
    fused = fuse([lexical, dense.join(worded, "query", "left_semi")], "unit", k, constant, ["query"])
    alone = dense.join(worded, "query", "left_anti").where(F.col("rank") <= k).withColumn("score", F.lit(0.0))
    return fused.unionByName(alone)


def enriched(found: DataFrame, units: DataFrame, dimensions: list[tuple[DataFrame, str]]) -> DataFrame:
    """`found` (unit, ...) with the columns of its unit and then, in order, of each dimension, joined by its key; what lacks one goes."""
    out = found.join(units, "unit")
    for rows, key in dimensions:
        out = out.join(rows, key)
    return out
