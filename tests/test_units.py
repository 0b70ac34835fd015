"""Positions, batches, spans, prefixes and owners: nulls, ties and empty tables."""

from pyspark.sql import functions as F

from statuta.operators import units


def test_spans_and_pages(spark):
    rows = spark.createDataFrame([(1, 1, "abc"), (1, 2, None), (1, 3, "de")], "doc long, page long, text string")
    spans = units.page_spans(rows, "doc", "page", "text")
    assert [tuple(r) for r in spans.orderBy("page").collect()] == [(1, 1, 0, 3), (1, 2, 4, 4), (1, 3, 5, 7)]
    asked = spark.createDataFrame([(1, 0), (1, 3), (1, 6), (1, 7), (None, 0)], "doc long, at long")
    assert sorted((r["at"], r["page"]) for r in units.page_of(asked, spans, "doc", "at").collect()) == [(0, 1), (6, 3)]
    assert units.page_spans(rows.limit(0), "doc", "page", "text").count() == 0


def test_batches_before_the_first_chapter(spark):
    rows = spark.createDataFrame([(1, i, opens) for i, opens in enumerate([None, False, True, False, False, True])], "doc long, place long, opens boolean")
    got = units.chapter_batches(rows, ["doc"], F.col("opens"), 2, F.asc("place"))
    assert [(r["chapter"], r["batch"]) for r in got.orderBy("place").collect()] == [(0, 0), (0, 0), (1, 0), (1, 0), (1, 1), (2, 0)]


def test_prefixes_are_whole_segments(spark):
    rows = spark.createDataFrame([("/a/1/x",), ("/a/11/x",), ("/a/1",), ("",), (None,)], "uri string")
    works = spark.createDataFrame([("/a/1",), ("/a",), (None,)], "work string")
    assert sorted(map(tuple, units.under_works(rows, "uri", works, "work").select("uri", "work").collect())) == [("/a/1", "/a"), ("/a/1/x", "/a"), ("/a/1/x", "/a/1"), ("/a/11/x", "/a")]
    codes = spark.createDataFrame([("0101",), ("01",), ("",), (None,)], "code string")
    asked = spark.createDataFrame([("01",), ("0101",)], "asked string")
    got = units.code_matches(codes, "code", asked, "asked").select("code", "asked", "exact").collect()
    assert sorted(map(tuple, got)) == [("01", "01", True), ("0101", "01", False), ("0101", "0101", True)]


def test_owners_and_shares(spark):
    rows = spark.createDataFrame([("law", 1), ("version", 1), ("other", 1), (None, None)], "kind string, ref long")
    held = {"law": spark.createDataFrame([(1, 7)], "key long, owner long"), "version": spark.createDataFrame([(1, 8)], "key long, owner long")}
    assert sorted((str(r["kind"]), r["owner"]) for r in units.owners(rows, "kind", "ref", held).collect()) == [("None", None), ("law", 7), ("other", None), ("version", 8)]
    flags = spark.createDataFrame([(1, True), (1, False), (2, None), (2, True)], "v long, flag boolean")
    assert dict(map(tuple, units.placeholder_share(flags, ["v"], "flag").collect())) == {1: 0.5, 2: None}
