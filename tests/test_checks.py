"""Nulls, empty tables and repeated rows of the checks."""

from pyspark.sql import functions as F

from statuta.operators import checks


def test_scope_and_staleness(spark):
    rows = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "id int, v int")
    assert checks.scoped(rows, "v", None).count() == 3
    assert checks.scoped(rows, "v", []).count() == 0
    assert [r["id"] for r in checks.scoped(rows, "v", [6]).collect()] == [3]
    assert [r["id"] for r in rows.where(checks.stale(F.col("v"), F.lit(5))).orderBy("id").collect()] == [1, 3]
    assert [r["id"] for r in rows.where(checks.from_year(F.col("v"), 6)).orderBy("id").collect()] == [1, 3]


def test_containment(spark):
    rows = spark.createDataFrame([(1, '{"a": 1, "b": "x"}'), (2, '{"a": 1}'), (3, None), (4, "no json")], "id int, p string")
    assert [r["id"] for r in rows.where(checks.holds(F.col("p"), {"a": "1", "b": "x"})).collect()] == [1]
    assert rows.where(checks.holds(F.col("p"), {})).count() == 4


def test_units_found(spark):
    units = spark.createDataFrame([("d", "art_1__para_1"), ("d", "art_2__para_1"), ("d", "art_2__para_2"), ("d", "para_2"), ("d", None), (None, "art_9"), ("d", "art_2__para_2")], "doc string, path string")
    asked = spark.createDataFrame([("d", "para_1"), ("d", "para_2"), ("d", "art_1"), ("d", "art_2__para_2"), ("d", None), (None, "art_9"), ("d", "para_2")], "doc string, wanted string")
    got = {(r["doc"], r["wanted"], r["path"]) for r in checks.units_found(asked, units, "doc", "wanted", "path").collect()}
    assert got == {("d", "para_1", None), ("d", "para_2", "para_2"), ("d", "art_1", None), ("d", "art_2__para_2", "art_2__para_2"), ("d", None, None), (None, "art_9", None)}
    assert checks.units_found(asked, units.limit(0), "doc", "wanted", "path").where("path is not null").count() == 0


def test_counts_and_intervals(spark):
    units = spark.createDataFrame([("d", "art_2"), ("d", "art_10"), ("d", "art_2"), ("d", None), ("d", "preamble")], "doc string, path string")
    assert [tuple(r) for r in checks.duplicate_paths(units, "doc", "path").collect()] == [("d", "art_2", 2)]
    assert {r["kind"]: (r["n"], r["numbers"]) for r in checks.kinds(units.dropna(), "doc", "path").collect()} == {"art": (3, "2,10"), "": (1, "")}
    deltas = checks.multiset_deltas(units.limit(3), units.where("path = 'art_2'").limit(1), ["doc", "path"])
    assert {tuple(r) for r in deltas.collect()} == {("d", "art_2", 1, 0), ("d", "art_10", 1, 0)}
    rows = spark.createDataFrame([("a", 5), ("a", 20), ("b", 5), (None, 5), ("a", None)], "k string, day int")
    spans = spark.createDataFrame([("a", 1, 9), ("a", 2, 7), ("b", 6, None), ("a", 15, None)], "k string, since int, until int")
    assert sorted(map(str, (tuple(r) for r in checks.within(rows, spans, "k", "day").collect()))) == ["('a', 20, True)", "('a', 5, True)", "('a', None, False)", "('b', 5, False)", "(None, 5, False)"]


def test_verdicts_abstain(spark):
    none, one = F.lit(None).cast("double"), spark.range(1)
    verdict = lambda *m: one.select(checks.page_verdict(*m)).first()[0]
    assert verdict(*[none] * 6) == "reread"
    assert verdict(none, none, none, none, F.lit(0.1), none) == "accept"
    assert verdict(F.lit(4999.0), none, none, none, F.lit(0.9), none) == "escalate"
    assert one.select(checks.clause_gap(none, F.lit(1))).first()[0] is False
    grade = lambda **a: one.select(checks.translation_grade({k: F.lit(v) for k, v in a.items()})).first()[0]
    full = {"numeric_slot_recall": 1.0, "notes_status": "ok", "units_total": 3}
    assert [grade(), grade(**full), grade(**full, judge="warn"), grade(**full, judge="fail"), grade(**full | {"numeric_slot_recall": 0.98})] == ["ungraded", "A", "B", "C", "C"]
