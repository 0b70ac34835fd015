"""Steps that must not grow with the tables: what is gathered, broadcast or done twice, by their plans and on cases."""

import random
import unicodedata
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from statuta.functions import tokeniser
from statuta.operators import graph, grids, search, spans, structure
from statuta.plans import registry, structural
from statuta.streaming import events as feed

FOLDER = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_lineage_broadcasts_nothing(spark):
    nodes = spark.createDataFrame([(i, i // 2 or None) for i in range(1, 40)] + [(50, 51), (51, 50), (60, 60)], "node long, parent long")
    found = graph.lineage(nodes, nodes.where("node in (37, 50, 60)"), 4)
    assert "Broadcast" not in plan(found) and "Join" not in plan(found)
    want = {(37, 37, 0), (37, 18, 1), (37, 9, 2), (37, 4, 3), (37, 2, 4), *((50, 50 + i % 2, i) for i in range(5)), (60, 60, 0)}
    assert {tuple(r) for r in found.collect()} == want


def test_rate_limit_holds_no_actor_whole(spark):
    rows = [(i, None if i % 3 == 0 else i % 2, datetime(2024, 1, 1) + timedelta(seconds=i * 701 % 90_000)) for i in range(25_000)]
    found = feed.within_limit(spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp"), 3600, 2)
    assert "collect_list" not in plan(found)
    got, want, kept = {r["event_id"]: (r["recent"], r["allowed"]) for r in found.collect()}, {}, {}
    for i, user, at in sorted(rows, key=lambda r: (r[2], r[0])):
        own = kept[user] = [t for t in kept.get(user, []) if t >= at - timedelta(seconds=3600)]
        want[i] = len(own), len(own) < 2
        own += [at] if len(own) < 2 else []
    assert got == want


def test_numeric_tokens_are_found_once(spark):
    # One pass that finds them, one that puts them back.
    assert plan(structural.numeric_tokens(spark, FOLDER)).count("ArrowEvalPython") == 2


def test_spared_patterns_find_nothing():
    rng = random.Random(5)
    words = ["Article", "ARTıCLE", "Artİcle", "ſection", "section", "Paragraph", "of", "Law", "aCt", "No.", "Euros", "dollar", "1/2/2024", "3.4.1999", "12", "7", "/", "(3)", "٣", "x", "1,5", "-", "Order 3 of 2001"]
    for _ in range(3000):
        text = " ".join(rng.choices(words, k=rng.randint(1, 8)))
        taken, own = [], spans.claimed(text)
        for kind, pattern in spans._COMPILED:
            taken += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if all(m.end() <= a or m.start() >= b for a, b, _ in taken)]
        assert own == sorted(taken)


def test_slices_keep_every_row(spark):
    n = structure.SLICE * 2 + 3
    rows = spark.range(n, numPartitions=1).select("id", F.when(F.col("id") % 5 > 0, F.array(F.lit("4"), F.lit("5"), F.lit("1"), F.col("id").cast("string"))).alias("n"))
    got = {r["id"]: r["r"] for r in rows.select("id", structure.repair_numbers(F.col("n")).alias("r")).collect()}
    assert all((got[i] is None) if i % 5 == 0 else [tuple(x) for x in got[i]] == structure.repaired_numbers(["4", "5", "1", str(i)]) for i in range(n))
    texts = spark.range(spans.SLICE * 2 + 3, numPartitions=1).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("Article "), F.col("id"))).alias("t"))
    for r in texts.select("id", "t", spans.numeric_tokens(F.col("t")).alias("e")).collect():
        assert r["e"] is None if r["t"] is None else [t["surface"] for t in r["e"]["tokens"]] == [r["t"]]
    cells = spark.range(grids.SLICE * 2 + 3, numPartitions=1).select(F.col("id").alias("tab"), F.lit(0).alias("row"), F.lit(0).alias("cell"), F.col("id").cast("string").alias("text"), F.lit(1).alias("colspan"), F.lit(1).alias("rowspan"), F.lit(False).alias("is_header"))
    assert {(r["tab"], r["cells"][0]) for r in grids.table_rows(cells).collect()} == {(i, str(i)) for i in range(grids.SLICE * 2 + 3)}


def test_lineage_of_parts(spark):
    found = registry.version_lineage(spark, FOLDER).collect()
    want = {(s, s >> d, d) for s in (r["start"] for r in found) for d in range(max(1, s.bit_length()))}
    assert {tuple(r) for r in found} == want


def test_lexicon_shuffles_pairs_only_for_repeated_documents(spark):
    docs = [(1, "b a a"), (2, "a b " + "x" * 129), (None, "a c")]
    whole = search.lexicon(spark.createDataFrame(docs, "k long, t string"), "k", "t")
    assert plan(whole).count("Exchange ") == 1
    twice = search.lexicon(spark.createDataFrame([*docs, (1, "a d"), (None, "a")], "k long, t string"), "k", "t")
    read = lambda df: {r["term"]: r["ndoc"] for r in df.collect()}
    assert read(whole) == {"a": 3, "b": 2, "c": 1} and read(twice) == {"a": 3, "b": 2, "c": 1, "d": 1}


def test_words_of_whole_texts_are_those_of_their_words():
    def plainly(text, lang):
        code = tokeniser.folded(lang)
        plain = unicodedata.normalize("NFKC", text).translate(tokeniser._DIGITS)
        plain = tokeniser._WITHOUT[code].sub("", plain) if code in tokeniser._WITHOUT else plain
        return [w.casefold().replace("i̇", "i") for w in tokeniser._WORD.findall(plain.translate(tokeniser._ALIKE.get(code, {})))]

    for c in [*range(0x250), *range(0x300, 0x400), *range(0x590, 0x700), *range(0x1E00, 0x2200), *range(0x2460, 0x2500), *range(0xFB00, 0xFF00, 3)]:
        for lang in (None, "he", "ar"):
            text = f"aB1{chr(c)}Xi {chr(c)}̇I"
            assert tokeniser.tokenise(text, lang, {}) == plainly(text, lang)


def test_tables_are_read_from_sorted_cells(spark):
    n = grids.SLICE // 2
    cells = spark.range(n * 6, numPartitions=3).select((F.col("id") % 2).alias("tab"), (F.col("id") / 6).cast("int").alias("row"), (F.col("id") / 2 % 3).cast("int").alias("cell"), F.concat(F.repeat(F.lit("- "), (F.col("id") % 3).cast("int")), "id").alias("text"), F.when(F.col("id") % 5 > 0, 1).alias("colspan"), (F.col("id") % 4).cast("int").alias("rowspan"), F.lit(False).alias("is_header"))
    found = grids.table_rows(cells)
    assert "collect_list" not in plan(found) and plan(found).count("Exchange ") == 1 and "Generate" not in plan(found)
    held = {}
    for c in sorted(cells.collect(), key=lambda c: (c["tab"], c["row"], c["cell"])):
        held.setdefault(c["tab"], {}).setdefault(c["row"], []).append(c.asDict())
    want = {(t, y): (r["cells"], r["lineage"], r["mechanisms"]) for t, rows in held.items() for y, r in zip(sorted(rows), grids.resolved([rows[y] for y in sorted(rows)]), strict=True)}
    assert {(r["tab"], r["row"]): (r["cells"], r["lineage"], r["mechanisms"]) for r in found.collect()} == want and len(want) == 2 * n
