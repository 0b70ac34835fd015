"""Lexicon expansion: terms of the corpus that a query's token looks like a part of, by trigrams."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEAST, MOST_VARIANTS, LEAST_LENGTH = 0.5, 6, 3
TOKEN_BLOCK, TERM_BLOCK = 4096, 32768
#: Pairs of a token and a term that are counted at once; places whose bits a sum of doubles keeps apart.
CELLS, PLACES = 1 << 18, 50


def trigrams(term: Column) -> Column:
    """The trigrams of a word in order, with two blanks before it and one after."""
    padded = F.concat(F.lit("  "), term, F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.char_length(term) + 1), lambda i: F.substring(padded, i, F.lit(3)))


@lru_cache(maxsize=100_000)
def _grams(word: str) -> tuple[str, ...]:
    padded = f"  {word} "
    return tuple(padded[i : i + 3] for i in range(len(word) + 1))


def extent_score(asked: str, term: str, least: float = 0.0) -> float:
    """How much of the distinct trigrams of `asked` some continuous extent of the trigrams of `term` holds.

    The greatest, over all extents, of shared / (asked + extent's - shared), distinct trigrams counted;
    extents that begin and end with a shared trigram are enough. Not symmetric. 0 where nothing is
    shared, or too little to reach `least`.
    """
    wanted, ordered = frozenset(_grams(asked)), _grams(term)
    hits = [i for i, g in enumerate(ordered) if g in wanted]
    n, best = len(wanted), 0.0
    if not hits or len(set(map(ordered.__getitem__, hits))) < least * n:
        return 0.0
    for begin in hits:
        held, shared = set(), 0
        for g in ordered[begin : hits[-1] + 1]:
            if g not in held:
                held.add(g)
                shared += g in wanted
            if g in wanted:
                best = max(best, shared / (n + len(held) - shared))
    return best


def rounded(score: float) -> float:
    """A score with six digits, halves up, as Spark's round gives it."""
    return float(Decimal(repr(score)).quantize(Decimal("0.000001"), ROUND_HALF_UP))


def _coded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of words as numbers, one word after another, and where each word's begin; no word is empty."""
    points = np.frombuffer("".join([f"  {w} " for w in words]).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    ends = np.cumsum([len(w) + 3 for w in words])
    codes = points[:-2] << 42 | points[1:-1] << 21 | points[2:]
    inside = np.ones(len(codes), dtype=bool)
    # The two places at a word's end would reach into the next word.
    inside[(ends[:-1, None] - [1, 2]).ravel()] = False
    return codes[inside], np.cumsum([0, *[len(w) + 1 for w in words]])


def _pattern_score(n: int, bits: int) -> float:
    """extent_score of a token of `n` trigrams and a term of trigrams that all differ, those at `bits` the token's."""
    hits = [i for i in range(bits.bit_length()) if bits >> i & 1]
    return max((y - x + 1) / (n + hits[y] - hits[x] - y + x) for x in range(len(hits)) for y in range(x, len(hits)))


def likenesses(tokens: list[str], terms: list[str], least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of tokens and terms, and their rounded extent scores, of the pairs that reach `least`, some terms at a time.

    Shared trigrams are counted for all pairs; a score is taken once for each number of trigrams and
    each pattern of shared places. Terms that repeat a trigram or are long are scored pair by pair.
    """
    codes, begins = _coded(tokens)
    owner = np.repeat(np.arange(len(tokens)), np.diff(begins))
    held = np.unique(np.stack([codes, owner]), axis=1)
    sizes = np.bincount(held[1], minlength=len(tokens))
    need = np.maximum(np.ceil(sizes * least), 1)
    known, first, many = np.unique(held[0], return_index=True, return_counts=True)
    told: dict[tuple[int, int], float] = {}
    step = max(1, CELLS // len(tokens))
    for at in range(0, len(terms), step):
        some = terms[at : at + step]
        codes, begins = _coded(some)
        owner = np.repeat(np.arange(len(some)), np.diff(begins))
        place = np.arange(len(codes)) - begins[owner]
        repeated = np.lexsort((place, codes, owner))
        again = repeated[1:][(np.diff(codes[repeated]) == 0) & (np.diff(owner[repeated]) == 0)]
        plain = np.diff(begins) <= PLACES
        plain[owner[again]] = False
        found = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        hit = known[found] == codes
        hit[again] = False
        found, owner, place = found[hit], owner[hit], place[hit]
        times = many[found]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        pair = np.repeat(owner, times) * len(tokens) + held[1][np.repeat(first[found], times) + nth]
        enough = (np.bincount(pair, minlength=len(some) * len(tokens)).reshape(-1, len(tokens)) >= need).ravel()
        kept = np.flatnonzero(enough)
        if not len(kept):
            continue
        i, j = np.divmod(kept, len(tokens))
        held_on = np.flatnonzero(enough[pair])
        bits = np.bincount(np.searchsorted(kept, pair[held_on]), np.repeat(2.0 ** np.minimum(place, PLACES), times)[held_on], len(kept)).astype(np.int64)
        score, easy = np.zeros(len(i)), plain[i]
        cases, back = np.unique(np.stack([sizes[j[easy]], bits[easy]]), axis=1, return_inverse=True)
        for case in map(tuple, cases.T.tolist()):
            if case not in told:
                told[case] = rounded(_pattern_score(*case))
        score[easy] = np.array([told[c] for c in map(tuple, cases.T.tolist())])[back.ravel()] if len(cases.T) else []
        for x in np.flatnonzero(~easy):
            score[x] = rounded(extent_score(tokens[j[x]], some[i[x]], least))
        good = score >= least
        yield j[good], i[good] + at, score[good]


def variants(asked: DataFrame, lexicon: DataFrame, least: float = LEAST, most: int = MOST_VARIANTS) -> DataFrame:
    """token, term, similarity, ndoc and rank of the best variants of each token (asked: token; lexicon: term, ndoc).

    At `least`, a term shares at least that part of the token's trigrams. Each block of tokens meets
    each block of terms once, and a pair of blocks tells `most` terms a token at most: pairs aren't
    shuffled. Tokens shorter than three characters, null tokens and terms have no variants; repeated
    rows count once, of a term's rows that of the greatest ndoc. Ranks: similarity falling, ndoc
    falling, term.
    """
    tokens = asked.select("token").where(F.char_length("token") >= LEAST_LENGTH).distinct()
    terms = lexicon.where(F.char_length("term") > 0).groupBy("term").agg(F.max("ndoc").alias("ndoc"))
    parts = int(lexicon.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = [max(1, -(-tokens.count() // TOKEN_BLOCK)), max(parts, -(-lexicon.count() // TERM_BLOCK))]

    def dealt(df: DataFrame, name: str, own: int) -> DataFrame:
        at, every = F.pmod(F.xxhash64(name, F.lit(2)), F.lit(blocks[own])), F.explode(F.sequence(F.lit(0), F.lit(blocks[1 - own] - 1)))
        return df.select("*", at.cast("int").alias("qb"[own]), every.alias("bq"[own])).groupBy("q", "b")

    def best(some: pa.Table, held: pa.Table) -> pa.Table:
        names, words, ndoc = some.column("token").to_pylist(), held.column("term").to_pylist(), np.array(held.column("ndoc").to_pylist(), dtype=object)
        kept: dict[int, list] = {}
        if names and words:
            for at, place, score in likenesses(names, words, least):
                order = np.argsort(at, kind="stable")
                cuts = np.flatnonzero(np.diff(at[order])) + 1
                for group in np.split(order, cuts) if len(order) else []:
                    token = names[at[group[0]]]
                    told = [(-s, n is None, -(n or 0), words[p]) for s, n, p in zip(score[group].tolist(), ndoc[place[group]].tolist(), place[group].tolist(), strict=True) if words[p] != token]
                    kept[at[group[0]]] = heapq.nsmallest(most, kept.get(at[group[0]], []) + told)
        rows = [(names[i], w, -s, None if none else -n) for i, found in kept.items() for s, none, n, w in found]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.float64(), held.column("ndoc").type), strict=True)], names=["token", "term", "similarity", "ndoc"])

    found = dealt(tokens, "token", 0).cogroup(dealt(terms, "term", 1)).applyInArrow(best, f"token string, term string, similarity double, ndoc {dict(terms.dtypes)['ndoc']}")
    rank = Window.partitionBy("token").orderBy(F.desc("similarity"), F.desc("ndoc"), "term")
    return found.select("*", F.row_number().over(rank).alias("rank")).where(F.col("rank") <= most)


def expanded(queries: DataFrame, found: DataFrame, query: str) -> DataFrame:
    """query and words: its tokens (words, in order) without repeats, then the variants of each that are no token, in order of the tokens and ranks."""
    own = queries.select(query, F.posexplode(F.array_distinct("words")).alias("at", "token"))
    added = own.join(found.select("token", "term", "rank"), "token").select(query, F.lit(1).alias("arm"), "at", "rank", F.col("term").alias("word"))
    every = own.select(query, F.lit(0).alias("arm"), "at", F.lit(0).alias("rank"), F.col("token").alias("word")).unionByName(added)
    held = every.groupBy(query).agg(F.array_sort(F.collect_list(F.struct("arm", "at", "rank", "word"))).alias("w"))
    return held.select(query, F.array_distinct(F.transform("w", lambda x: x["word"])).alias("words"))
