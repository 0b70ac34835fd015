"""Numeric tokens, own terms, tables, references and totals, against plain forms and on cases."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from statuta.operators import grids, resolution, spans, totals
from statuta.plans import structural

FOLDER = "/root/testdata/sf0.001"
TEXTS = [
    "Article (5) and Paragraph (3) of Article (20), Article (4/9).", "Law No. 7 of 1999 on 3/2/2000: 1,000 Dinars, 1.5 dollars", "٣ و ١٢", "⟨N000⟩ 5 ‹N001› 6 ", "", "no numbers", "1 1", "Article 5/6/2000", "x" * 50 + " 7" * 400,
]


def claims(text):
    """Tokens with a mark for each character that is taken."""
    taken, out = [False] * len(text), []
    for kind, pattern in spans.PATTERNS:
        for m in re.finditer(pattern, text):
            if not any(taken[m.start() : m.end()]):
                taken[m.start() : m.end()] = [True] * (m.end() - m.start())
                out.append((m.start(), m.end(), kind))
    return sorted(out)


@pytest.mark.parametrize("text", TEXTS)
def test_tokens_come_back(text):
    encoded, a, b, tokens = spans.encode(text)
    assert tokens == claims(text) and not re.search(r"[0-9]", re.sub(f"{a}N[0-9]+{b}|[⟨‹]N[0-9]+[⟩›]", "", encoded))
    assert spans.decode(encoded, a, b, [text[s:e] for s, e, _ in tokens]) == (text, [])


def test_token_kinds_and_lost_sentinels():
    kinds = lambda t: [k for *_, k in spans.claimed(t)]
    assert kinds(TEXTS[0]) == ["article_ref", "para_of_article_ref", "article_para_ref"]
    assert kinds(TEXTS[1]) == ["statute_ref", "date", "money", "money"]
    assert [spans.target_surface(*x) for x in (("Law No. 8 of 2014", "statute_ref"), ("1,000 Dinars", "money"), ("٣/٢/٢٠٠٠", "date"), ("Article (4/9)", "article_para_ref"))] == ["8/2014", "1,000", "3/2/2000", "4/9"]
    assert spans.decode("a ⟨N001⟩ ⟨N007⟩", "⟨", "⟩", ["x", "y"]) == ("a y ⟨N007⟩", [0])


def test_numeric_tokens_query(spark):
    texts = {r["doc_id"]: r["text"] for r in structural.acts(spark, FOLDER).collect()}
    got = {r["doc_id"]: r for r in structural.numeric_tokens(spark, FOLDER).collect()}
    assert set(got) == {d for d, t in texts.items() if t is not None} and all(r["restored"] for r in got.values())
    assert {d: r["n_tokens"] for d, r in got.items()} == {d: len(claims(t)) for d, t in texts.items() if t is not None}


def naive(text, terms):
    low, out, at = text.lower() if len(text.lower()) == len(text) else text, [], 0
    keys = sorted({t.lower(): t for t in sorted(terms, reverse=True)}.items(), key=lambda k: -len(k[0]))
    word = lambda i: 0 <= i < len(low) and (low[i].isalnum() or low[i] == "_")
    while at < len(low):
        hit = next(((k, t) for k, t in keys if low.startswith(k, at) and not (word(at - 1) and word(at)) and not (word(at + len(k)) and word(at + len(k) - 1))), None)
        if hit:
            out.append((at, at + len(hit[0]), hit[1]))
        at += len(hit[0]) if hit else 1
    return out


def test_own_terms(spark):
    rows = [(1, "The Personal Data of personal DATA subjects; data.", ["Data", "personal data", "Data subjects"]), (2, None, ["a"]), (3, "a", None), (4, "abab ab", ["ab", None, ""]), (5, "İx data", ["data"])]
    got = sorted(tuple(r) for r in spans.term_occurrences(spark.createDataFrame(rows, "k int, t string, x array<string>"), "k", "t", "x").collect())
    assert got == [(1, 4, 17, "personal data"), (1, 21, 34, "personal data"), (1, 45, 49, "Data"), (4, 5, 7, "ab"), (5, 3, 7, "data")]
    docs = structural.termed(spark, FOLDER).collect()
    want = {(r["doc_id"], *o) for r in docs if len(r["text"] or "") < 3000 for o in naive(r["text"] or "", r["terms"] or [])}
    small = {r["doc_id"] for r in docs if len(r["text"] or "") < 3000}
    assert {tuple(r) for r in structural.own_terms(spark, FOLDER).collect() if r["doc_id"] in small} == want and len(want) > 100


def cells(*rows):
    """Rows of cells: text, or (text, colspan, rowspan); a header row is a tuple."""
    made = []
    for row in rows:
        made.append([{"text": c[0], "colspan": c[1], "rowspan": c[2], "is_header": isinstance(row, tuple)} if isinstance(c, tuple) else {"text": c, "colspan": 1, "rowspan": 1, "is_header": isinstance(row, tuple)} for c in row])
    return made


def test_spans_fill_the_grid():
    assert grids.occupancy(cells([("a", 1, 2), "b"], ["c", ("d", 1, 2)], ["e"])) == [["a", "b"], ["a", "c", "d"], ["e", "", "d"]]
    assert grids.occupancy(cells([("a", 2, 9), "b"], ["c"])) == [["a", "a", "b"], ["a", "a", "c"]]
    assert grids.occupancy([]) == []


def test_lineage_by_codes_bands_and_dashes():
    rows = grids.resolved(cells(("Code", "Goods", "Duty"), ["01", "Animals:", ""], ["0101", "Horses", "5"], [("Meat", 3, 1)], ["02", "Beef", "7"], ["0201", "Fresh", "8"]))
    assert [(r["lineage"], r["mechanisms"]) for r in rows] == [([], ["header"]), (["Animals"], ["header", "prefix"]), (["Meat"], ["group", "header"]), (["Meat", "Beef"], ["group", "header", "prefix"])]
    assert rows[1]["labels"] == ["Code", "Goods", "Duty"]
    ladder = grids.resolved(cells(["Live animals", "1"], ["- Horses:", ""], ["- - for breeding", "2"], ["- Asses", "3"]))
    assert [r["lineage"] for r in ladder] == [[], ["Live animals"], ["Live animals", "Horses"], ["Live animals"]]
    depths = grids.resolved(cells(("Level", "Name"), ["1", "aa"], ["2", "bb"], ["1", "cc"]))
    assert [r["lineage"] for r in depths] == [[], ["aa"], []]
    assert grids.resolved(cells(["x"], [("y", 1, 1)])) and grids.resolved([]) == [] and grids.resolved(cells([])) != 0


def test_tables_query(spark):
    held = {}
    for c in structural.tariff_cells(spark, FOLDER).collect():
        held.setdefault(c["tab"], {}).setdefault(c["row"], []).append(c)
    want = {}
    for tab, rows in held.items():
        places = sorted(rows)
        for r in grids.resolved([sorted((c.asDict() for c in rows[y]), key=lambda c: (c["cell"], c["text"], c["colspan"], c["rowspan"], c["is_header"])) for y in places]):
            want[tab, places[r["row"]]] = (r["labels"], r["cells"], r["lineage"], r["mechanisms"])
    got = {(r["tab"], r["row"]): (r["labels"], r["cells"], r["lineage"], r["mechanisms"]) for r in structural.table_lineage(spark, FOLDER).collect()}
    assert got == want and {m for *_, how in want.values() for m in how} == {"header", "group", "prefix", "indent"}
    assert grids.table_rows(structural.tariff_cells(spark, FOLDER).limit(0)).count() == 0


def test_references(spark):
    units = spark.createDataFrame([("7", "chp_1__art_2", "w1", False), ("7", "chp_2__art_2", None, None), ("7", "chp_1__art_3__para_1", "w1", False), ("7", "art_9", None, True), (None, None, None, None)], "doc string, path string, alias string, excluded boolean")
    asked = [("#chp_1__art_2", "resolved_exact"), ("#w1", "resolved_alias"), ("#art_2", "ambiguous"), ("#art_3", "resolved_partial"), ("#art", "missing_same_doc"), ("#art_9", "missing_same_doc"), ("/7", "resolved_document"), ("/7#x", "document_only"), ("/8#x", "unknown_document"), ("", "unparsed"), (None, "unparsed"), ("#", "unparsed")]
    refs = spark.createDataFrame([(i, "7", t, None, None) for i, (t, _) in enumerate(asked)] + [(90, "7", "#art_2", 1, True), (91, "7", "#art_2", 1, False), (91, "7", "#art_2", 1, False)], "ref_id int, doc string, target string, resolver_version int, resolved boolean").withColumn("path", F.lit("x"))
    found = resolution.resolve(refs, units)
    assert {r["ref_id"]: r["outcome"] for r in found.collect()} == {i: o for i, (_, o) in enumerate(asked)} | {91: "ambiguous"}
    assert {r["outcome"]: r["n"] for r in resolution.counters(found).collect()} == Counter(o for _, o in asked) + Counter(["ambiguous"]) + Counter(examined=len(asked) + 1)
    assert {r["outcome"]: r["n"] for r in resolution.counters(found.limit(0)).collect()} == {"examined": 0}


def test_totals_are_a_plain_fold_and_merge(spark):
    rows = structural.walk_counters(spark, FOLDER)
    want = {}
    for r in rows.collect():
        for section, names in r["counters"].items():
            for name, c in names.items():
                old = want.get((r["era"], section, name), [0, 0])
                want[r["era"], section, name] = [old[0] + c[0], old[1] + c[1]]
    read = lambda df: {(r["era"], r["section"], r["name"]): r["counts"] for r in df.collect()}
    whole = structural.corpus_totals(spark, FOLDER)
    assert read(whole) == want and len(want) > 10
    halves = [totals.totals(rows.where(f"hash(era) % 2 = {i} or era = 'era1'"), 2) for i in (0, 1, -1)]
    assert read(totals.merge_totals(totals.totals(rows, 2), totals.totals(rows.limit(0), 2), width=2)) == want and len(halves) == 3
    nested = {r["era"]: r["counters"] for r in totals.folded(whole).collect()}
    assert {(e, s, n): c for e, x in nested.items() for s, y in x.items() for n, c in y.items()} == want
    a = spark.createDataFrame([("x", "s", "a", [1, 2]), (None, "s", "b", [1, 2]), ("x", "s", "c", [0, 0])], "era string, section string, name string, counts array<long>")
    b = spark.createDataFrame([("x", "s", "a", [1, 1]), (None, "s", "b", [1, 2]), ("x", "s", "d", [3, 0])], "era string, section string, name string, counts array<long>")
    assert {r["name"]: (r["verdict"], r["change"]) for r in totals.against(a, b).collect()} == {"a": ("changed", [0, 1]), "b": ("same", [0, 0]), "c": ("new", [0, 0]), "d": ("gone", [-3, 0])}
