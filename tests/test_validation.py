"""Findings on units: single cases, and whole tables against a plain form."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from statuta.operators import validation
from statuta.plans import structural

SCHEMA = "doc_id long, path string, line int, body string"
PARENTS = {"para": ["art", "chp"], "item": ["point", "art"], "point": ["art", "para"]}
ARGS = (["art", "para", "point"], PARENTS, "art", ["chp"])


def plain(units, references, numbered=ARGS[0], parents=PARENTS, article="art", containers=("chp",)):
    """doc_id, check, severity, path and detail, document by document."""
    docs, out = defaultdict(list), []
    for doc, path, line, body in units:
        docs[doc].append((path, line, body or ""))
    for doc, rows in docs.items():
        found = [(p, n, b, p.split("__")) for p, n, b in rows if p is not None]
        counts = Counter(p for p, *_ in found)

        def name(segment):
            got = re.match("([a-z]+)_([0-9a-z]+)?", segment)
            return (got[1], got[2] or "") if got else ("", "")

        out += [(doc, "eid_uniqueness", "error", p, str(n)) for p, n in counts.items() if n > 1]
        bad = sorted((n, p, len(s)) for p, n, _, s in found if len(s) > 12 or len(p) > 255)
        out += [(doc, "eid_unusable", "error", p, "too deep" if depth > 12 else "too long") for _, p, depth in bad[:1]]
        for p, _, _, s in found:
            above = name(s[-2])[0] if len(s) > 1 else ""
            if name(s[-1])[0] in parents and above not in parents[name(s[-1])[0]]:
                out.append((doc, "hierarchy_coherence", "warning", p, "in " + (above or "root")))
        arts = [(n, s) for _, n, _, s in found if name(s[-1])[0] == article]
        rooted, first = [n for n, s in arts if len(s) == 1], [n for _, n, _, s in found if len(s) == 1 and name(s[0])[0] in containers]
        if rooted and first:
            good = max(rooted) < min(first) and len(rooted) <= 0.2 * len(arts)
            out.append((doc, "orphan_articles", "warning" if good else "error", None, f"{len(rooted)} of {len(arts)}"))
        chars = sum(len(b.strip(" ")) for _, _, b in rows)
        if not found and chars <= 200:
            out.append((doc, "empty_body", "error", None, str(chars)))
        if len(found) <= 1 and chars > (10_000 if found else 200):
            out.append((doc, "structureless_body", "warning", None, str(chars)))
        texts = Counter()
        for _, _, b, s in found:
            for i in range(1, len(s) + 1):
                texts["__".join(s[:i])] += len(b.partition("\n")[2].strip(" "))
        out += [(doc, "empty_article", "warning", p, "no text") for p in {p for p, _, _, s in found if name(s[-1])[0] == article} if not texts[p]]
        scopes = defaultdict(list)
        for p, n, _, s in found:
            kind, number = name(s[-1])
            if kind in numbered and number:
                scopes[kind, "__".join(s[:-1])].append((n, p, number))
        for (kind, _), each in scopes.items():
            same = defaultdict(set)
            for _, p, number in each:
                same[number].add(p)
            out += [(doc, "duplicate_number", "warning", min(p), f"{kind} {number} {len(p)}") for number, p in same.items() if len(p) > 1]
            other = min((n for n, _, number in each if not number.isdigit()), default=float("inf"))
            hosts = {}
            for n, p, number in sorted(each):
                if number.isdigit() and n < other:
                    hosts.setdefault(int(number), p)
            values = sorted(hosts)
            gaps = [(a, b - a - 1) for a, b in zip(values, values[1:], strict=False) if b - a > 1]
            if gaps:
                missing, longest = sum(g for _, g in gaps), max(g for _, g in gaps)
                likely = "defect" if longest >= 3 or missing / (values[-1] - values[0] + 1) > 0.3 else "repeal" if longest == 1 and missing <= 3 else "ambiguous"
                out += [(doc, "number_gap", "warning" if likely == "defect" else "info", hosts[a], f"{kind} {a + 1}-{a + g} {likely}") for a, g in gaps]
        out += [(doc, "ref_resolution", "warning", h[1:], "no such unit") for d, h in references if d == doc and h and h[0] == "#" and len(h) > 1 and h[1:] not in counts]
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


CASES = [
    (1, "art_1", 0, "Article 1\ntext"), (1, "art_2", 1, "Article 2"), (1, "art_2__point_1", 2, "Point 1\nfirst"), (1, "art_5", 3, "Article 5\n"), (1, "art_5__item_1", 4, "Item 1"),
    (1, "chp_1", 5, "Chapter 1"), (1, "chp_1__art_9", 6, None), (1, "chp_1__art_9_2", 7, "Article 9\nx"), (1, "chp_1__art_9_2", 8, "Article 9\nx"), (1, "item_3", 9, "Item\ny"),
    (2, None, 0, "short"), (3, None, 0, "long " * 100), (4, "art_1", 0, "Article 1\n" + "y" * 10_001), (5, None, 0, None),
    (6, "__".join(f"sub_{i}" for i in range(13)), 4, "x\ny"), (6, "a" * 256, 5, "x\ny"), (None, "art_1", 0, "Article 1\nz"), (None, "art_3", 1, "Article 3\nz"),
    *[(7, f"art_{n}", i, "Article\nz") for i, n in enumerate((1, 2, 3, 4, 5, 7, 8, 9, 10, 12, "12a", 40))],
    *[(8, "art_1" if i == 0 else f"chp_1__art_{i}", i if i == 0 else i + 1, "Article\nz") for i in range(6)], (8, "chp_1", 1, "Chapter"),
]
REFERENCES = [(1, "#art_1"), (1, "#art_3"), (1, "http://x"), (1, "#"), (1, None), (2, "#art_1"), (None, "#art_1")]


def test_cases(spark):
    units, references = spark.createDataFrame(CASES, SCHEMA), spark.createDataFrame(REFERENCES, "doc_id long, href string")
    got = found(validation.findings(units, *ARGS, references))
    assert got == plain(CASES, REFERENCES)
    checks = {(d, c) for d, c, *_ in got}
    assert {(1, "eid_uniqueness"), (1, "orphan_articles"), (1, "duplicate_number"), (1, "ref_resolution"), (2, "empty_body"), (3, "structureless_body"), (4, "structureless_body"), (5, "empty_body"), (6, "eid_unusable"), (None, "number_gap")} <= checks
    assert [(p, s) for d, c, s, p, _ in got if c == "number_gap" and d == 7] == [("art_10", "info"), ("art_5", "info")]
    assert [s for d, c, s, *_ in got if c == "orphan_articles" and d == 8] == ["warning"]
    assert [p for d, c, _, p, _ in got if c == "empty_article" and d == 1] == ["art_5", "chp_1__art_9"]
    grades = {r["doc_id"]: r["grade"] for r in validation.graded(units, validation.findings(units, *ARGS)).collect()}
    assert grades[1] == "blocking" and grades[3] == "warning" and grades[7] == "clean" and len(grades) == 9


def test_empty(spark):
    units = spark.createDataFrame([], SCHEMA)
    assert validation.findings(units, *ARGS).count() == 0 and validation.graded(units, validation.findings(units, *ARGS)).count() == 0


@pytest.fixture(scope="module")
def folder():
    return "/root/testdata/sf0.001"


def test_whole_tables(spark, folder):
    cut, told = structural._findings(spark, folder)
    units = [tuple(r) for r in cut.select("doc_id", "path", "line", "body").collect()]
    references = [(d, "#art_" + n) for d, _, _, body in units for n in re.findall("title ([0-9]+)", (body or "").lower())]
    want = plain(units, references)
    assert found(told) == want and len({c for _, c, *_ in want}) >= 6


def test_references_of_each_unit_and_one_shuffle(spark):
    units = spark.createDataFrame([(*c, [h for d, h in REFERENCES if d == c[0]] if c[2] == 0 else None) for c in CASES], SCHEMA + ", hrefs array<string>")
    told = validation.findings(units, *ARGS, F.col("hrefs"))
    assert told._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert found(told) == plain(CASES, REFERENCES)


def test_grades_write_acts_once_and_sort_seldom(spark, folder):
    graded, told = structural.validator_grades(spark, folder), structural.validator_findings(spark, folder)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(graded).count("collect_list(") == plan(told).count("collect_list(")
    assert len(re.findall(r"\bSort \[", plan(told))) <= 4 and "SortAggregate" not in plan(told) and plan(told).count("ArrowEvalPython") == 1
    docs = {r["doc_id"] for r in structural.structure.documents(structural.acts(spark, folder)).select("doc_id").collect()}
    assert {r["doc_id"] for r in graded.collect()} == docs and None not in docs
