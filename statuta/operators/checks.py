"""Predicates, checks and verdicts on units, texts and audits.

Verdicts and grades are column expressions; measures that are null abstain. Null keys match nothing;
empty tables give no rows.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scoped(rows: DataFrame, column: str, scope: list | None) -> DataFrame:
    """Rows whose column is in `scope`; None means all rows, an empty list none."""
    if scope is None:
        return rows
    return rows.where(F.col(column).isin(scope)) if scope else rows.limit(0)


def holds(params: Column, wanted: dict[str, str]) -> Column:
    """Whether a JSON object has every wanted key with that value."""
    return functools.reduce(operator.and_, (F.get_json_object(params, f"$.{k}").eqNullSafe(v) for k, v in wanted.items()), F.lit(True))


def from_year(year: Column, first: int) -> Column:
    """Whether a year is `first` or later, or unknown."""
    return year.isNull() | (year >= first)


def stale(version: Column, current: Column) -> Column:
    """Whether what was derived at `version` isn't of the `current` one; null is a version that differs from all others."""
    return ~version.eqNullSafe(current)


def title_or_citation(tokens: Column, words: list[str], number: Column, year: Column, cited: tuple[str, int] | None) -> Column:
    """Whether a title has any of the words, or number (leading zeros aside) and year are those cited."""
    named = F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in words])) if words else F.lit(False)
    if cited is None:
        return named
    same = (F.ltrim(number, F.lit("0")) == cited[0].lstrip("0")) & (year == cited[1])
    return named | F.coalesce(same, F.lit(False))


def units_found(asked: DataFrame, units: DataFrame, document: str, wanted: str, path: str) -> DataFrame:
    """`asked` (document, wanted) with path: the unit of exactly that path, else the only one that ends in it; else null.

    Each unit is spread to the ends of its path, so that the join is one of equal keys.
    """
    parts = F.split(F.col(path), "__")
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "__"))
    spread = units.select(document, path).distinct().withColumn(wanted, F.explode(ends))
    found = asked.select(document, wanted).distinct().join(spread, [document, wanted])
    exact = F.max(F.when(F.col(path) == F.col(wanted), F.col(path)))
    one = found.groupBy(document, wanted).agg(F.coalesce(exact, F.when(F.count("*") == 1, F.min(path))).alias(path))
    return asked.join(one, [document, wanted], "left")


def kinds(units: DataFrame, document: str, path: str) -> DataFrame:
    """document, kind, n (units of the kind) and numbers: their distinct numbers, in order, joined by commas."""
    last = F.substring_index(path, "__", -1)
    numbered = units.select(document, F.regexp_extract(last, "^([a-z]+)_", 1).alias("kind"), F.regexp_extract(last, "_([0-9]+)$", 1).try_cast("int").alias("number"))
    numbers = F.array_join(F.transform(F.array_sort(F.collect_set("number")), lambda n: n.cast("string")), ",")
    return numbered.groupBy(document, "kind").agg(F.count("*").alias("n"), numbers.alias("numbers"))


def duplicate_paths(units: DataFrame, document: str, path: str) -> DataFrame:
    """document, path and n of the paths that more than one unit of a document has."""
    return units.groupBy(document, path).agg(F.count("*").alias("n")).where((F.col("n") > 1) & F.col(path).isNotNull())


def multiset_deltas(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """keys, missing and extra: how often the source holds what the target lacks, and the other way round; nulls are equal here."""
    both = source.select(*keys, F.lit(1).alias("side")).unionByName(target.select(*keys, F.lit(-1).alias("side")))
    left = both.groupBy(*keys).agg(F.sum("side").alias("left")).where("left <> 0")
    return left.select(*keys, F.greatest("left", F.lit(0)).cast("long").alias("missing"), F.greatest(-F.col("left"), F.lit(0)).cast("long").alias("extra"))


def within(rows: DataFrame, intervals: DataFrame, key: str, day: str) -> DataFrame:
    """`rows` with inside: whether any interval (key, since, until; null until is open) of their key holds their day, both ends included.

    Intervals of a key that overlap don't repeat rows: they are gathered as one array of each key.
    """
    gathered = intervals.groupBy(key).agg(F.collect_list(F.struct("since", "until")).alias("spans"))
    holding = F.exists("spans", lambda s: (s["since"] <= F.col(day)) & (s["until"].isNull() | (F.col(day) <= s["until"])))
    return rows.join(gathered, key, "left").withColumn("inside", F.coalesce(holding, F.lit(False))).drop("spans")


def latest_severities(laws: DataFrame, runs: DataFrame, findings: DataFrame, law: str, run: str, at: str, severities: list[str]) -> DataFrame:
    """law, run and counts by severity of the law's latest of `runs`; 0 where it found nothing, null for a law without a run."""
    latest = runs.groupBy(law).agg(F.max_by(run, F.struct(at, run)).alias(run))
    counted = findings.join(latest.select(run), run, "left_semi").groupBy(run).agg(*[F.count_if(F.col("severity") == s).alias(s) for s in severities])
    filled = laws.select(law).join(latest, law, "left").join(counted, run, "left")
    return filled.select(law, run, *[F.when(F.col(run).isNotNull(), F.coalesce(F.col(s), F.lit(0))).alias(s) for s in severities])


def _any(*conditions: Column) -> Column:
    return functools.reduce(operator.or_, (F.coalesce(c, F.lit(False)) for c in conditions))


def page_verdict(chars_per_ink: Column, repeats: Column, forms: Column, purity: Column, divergence: Column, parity: Column) -> Column:
    """escalate, reread or accept, from what was measured of a page's text; a page of which nothing was measured is reread."""
    measured = F.coalesce(*[c.cast("double") for c in (chars_per_ink, repeats, forms, purity, divergence, parity)]).isNotNull()
    bad = _any(chars_per_ink < 5000, repeats > 0.5, forms > 0.3, purity < 0.85)
    return F.when(bad, "escalate").when(_any(divergence > 0.7, parity < 0.8) | ~measured, "reread").otherwise("accept")


def clause_gap(source: Column, target: Column) -> Column:
    """Whether a translation has at least two clauses, and over a fifth of them, less than its source."""
    return F.coalesce((source - target >= 2) & (target < 0.8 * source), F.lit(False))


def cover_level(cover: Column, body: Column) -> Column:
    """clean, warning or error, by how far the counts of a cover and of its body are apart; null if either is unknown."""
    apart = F.abs(cover - body)
    return F.when(apart <= 1, "clean").when(apart == 2, "warning").when(apart > 2, "error")


def translation_grade(audit: dict[str, Column]) -> Column:
    """A, B, C or ungraded from the measures of an audit; measures that it lacks raise no objection.

    Without the recall of numbers, the state of the notes or the number of units it is ungraded.
    """
    of = lambda name: audit.get(name, F.lit(None))
    flag = lambda name: of(name).cast("boolean")
    unknown = functools.reduce(operator.or_, (of(k).isNull() for k in ("numeric_slot_recall", "notes_status", "units_total")))
    severe = [of("fallback_ratio") > 0.05, of("notes_status") == "failed", *[flag(k) for k in ("alien_body", "alien_heading", "stray_sentinels", "money_missing", "money_duplicated")]]
    severe += [of("numeric_slot_recall") < 0.99, of("judge") == "fail", of("judge_failure_ratio") > 1 / 3]
    slight = [flag("register_drift"), of("notes_status") == "partial", flag("clause_gap"), flag("header_bleed"), of("judge") == "warn"]
    return F.when(unknown, "ungraded").when(_any(*severe), "C").when(_any(*slight), "B").otherwise("A")
