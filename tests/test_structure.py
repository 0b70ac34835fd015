"""From text to structure, document order and expansion, against plain forms on whole small tables and on cases."""

import functools
import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from statuta.functions import paths
from statuta.operators import expansion, structure
from statuta.plans import structural

FOLDER = "/root/testdata/sf0.001"


def mask(text):
    """Whether each offset lies inside a matched quoted span of its paragraph, by stacks."""
    out, at = [False] * (len(text) + 1), 0
    for part in re.split(r"(?<=\n)(?=[^\S\n]*\n)", text):
        for opener, closers in structure.PAIRS:
            stack = []
            for i, c in enumerate(part):
                if c == opener:
                    stack.append(i)
                elif c in closers and stack:
                    begin = stack.pop()
                    out[at + begin + 1 : at + i + 1] = [True] * (i - begin)
        for sign in structure.TURNS:
            places = [i for i, c in enumerate(part) if c == sign]
            for begin, end in zip(places[::2], places[1::2], strict=False):
                out[at + begin + 1 : at + end + 1] = [True] * (end - begin)
        at += len(part)
    return out


def walked(text):
    """Markers of a text as (line, kind, number, reason)."""
    words = {w: m.kind for m in structural.CONFIG for w in m.words}
    shape = re.compile(rf"[ \t]*({'|'.join(words)})(?:[ \t]+([0-9]+(?:[ \t]?bis|[a-z])?|[IVXLCDM]+))?(?![0-9A-Za-z])(.*)", re.S)
    inside, out, at = mask(text), [], 0
    for i, line in enumerate(text.split("\n")):
        if m := shape.match(line):
            rest, reason = m[3], None
            run = re.match(r"[ \t]*(?:,|-|[ \t](?:and|to))[ \t]*[0-9]", rest)
            first = rest.lstrip(" \t")[:1]
            if m[2] and re.match(r"\.[0-9]", rest):
                reason = "partial_decimal_number"
            elif inside[at]:
                reason = "inside_quoted_text"
            elif not run and (first in {",", ";", ")"} or first.islower() and rest[:1] in " \t"):
                reason = "read_as_prose_reference"
            elif run:
                reason = "read_as_citation_run"
            out.append((i, words[m[1]], m[2], reason))
        at += len(line) + 1
    return out


def placed(anchors):
    """(line, kind, number) to (line, parent, path, event), each anchor looking back for where it stands."""
    about = {m.kind: m for m in structural.CONFIG}
    out, kept, lost = [], [], []
    for line, kind, number in anchors:
        m = about[kind]
        if lost and m.outline and m.rank > lost[-1]:
            out.append((line, None, None, "restarted_list"))
            continue
        lost = []
        parent = next((p for r, p in reversed(kept) if r < m.rank and all(r2 > r for r2, _ in kept[[x[1] for x in kept].index(p) + 1 :])), None)
        own = re.sub("[^0-9a-z]+", "", (number or "").lower())
        own = f"{m.short}_{(own.lstrip('0') or '0') if own else '0'}"
        twins = sum(1 for o in out if o[1] == parent and o[4:] == (own,))
        if twins and m.outline:
            out.append((line, parent, None, "restarted_list"))
            lost = [m.rank]
            continue
        name = f"{own}_{twins + 1}" if twins else own
        path = f"{parent}__{name}" if parent else name
        out.append((line, parent, path, "duplicate_number" if twins else None, own))
        kept.append((m.rank, path))
    return [o[:4] for o in out]


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in structural.acts(spark, FOLDER).collect()}


def test_marker_walk(spark, texts):
    got = sorted(((r["doc_id"], r["line"], r["kind"], r["number"], r["reason"]) for r in structural.marker_walk(spark, FOLDER).collect()), key=str)
    want = sorted(((d, *w) for d, t in texts.items() if t is not None for w in walked(t)), key=str)
    assert got == want and len({w[4] for w in want}) == 5


def test_paths_units_and_coverage(spark, texts):
    want = {}
    for d, t in texts.items():
        if t is not None:
            want[d] = placed([w[:3] for w in walked(t) if w[3] is None])
    got = sorted(((r["doc_id"], r["line"], r["parent"], r["path"], r["event"]) for r in structural.unit_paths(spark, FOLDER).collect()), key=str)
    assert got == sorted(((d, *w) for d, own in want.items() for w in own), key=str)
    assert {w[3] for own in want.values() for w in own} == {None, "duplicate_number", "restarted_list"}
    bodies = {}
    for d, t in texts.items():
        if t is None:
            continue
        rows, starts = t.split("\n"), [w for w in want[d] if w[2]]
        cuts = [(0, None), *((w[0], w[2]) for w in starts)]
        cuts = cuts[1:] if starts and starts[0][0] == 0 else cuts
        for (a, path), (b, _) in itertools.pairwise([*cuts, (len(rows), None)]):
            body = "\n".join(rows[a:b])
            bodies[d, a] = path, len(body), hashlib.sha256(body.encode()).hexdigest()
    got = {(r["doc_id"], r["line"]): (r["path"], r["n_chars"], r["body_sha256"]) for r in structural.verbatim_units(spark, FOLDER).collect()}
    assert got == bodies
    for r in structural.structure_coverage(spark, FOLDER).collect():
        own = [x for (d, _), x in bodies.items() if d == r["doc_id"]]
        total, inside = sum(x[1] for x in own), sum(x[1] for x in own if x[0])
        share = round(inside / total, 6) if total else 0.0
        assert r["lossless"] and abs(r["share"] - share) < 2e-6
        assert r["gate"] == ("no_anchors" if not any(x[0] for x in own) else "below_floor" if share < 0.5 else "passed")


def test_structure_edges(spark):
    assert structure.lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, "Article 1\nx"), (1, "Article 1\nx"), (1, "Article 2"), (None, "Article 3\r\n\n"), (2, None), (3, "")], "doc_id long, text string").withColumn("kind", F.lit("x"))
    rows = structure.lines(docs)
    found = structure.markers(structure.quoted(rows), structural.CONFIG)
    # A null id has no key to join its lines by: its document has no units.
    assert sorted((r["doc_id"], r["number"]) for r in found.collect()) == [(1, "1"), (1, "2")]
    cut = structure.units(rows, structure.assign_paths(found, structural.CONFIG))
    assert sorted((r["doc_id"] or 0, r["body"]) for r in cut.collect()) == [(0, "Article 3\r\n\n"), (1, "Article 1\nx"), (1, "Article 2"), (3, "")]
    assert all(r["lossless"] for r in structure.coverage(cut).collect())


RUNS = [
    ("4 5 1 7 8", "4 5 6 7 8"), ("60 61 12 63", "60 61 62 63"), ("4 0 6", "4 5 6"), ("8 8 10", "8 9 10"), ("2 2 4", "2 3 4"), ("10 16 12", None), ("17 13 19", None), ("17 15 19", None), ("17 19 19", None),
    ("1 2 3 4 5", None), ("5 7 8", None), ("5 IV 7", None), ("4 5A 6", None), ("10 16 18", None), ("7 68 9", None), ("٥ ١ ٧", "٥ ٦ ٧"),
    ("58 59 60 11 12 13 14 15 16 17 18 19 70", " ".join(map(str, range(58, 71)))), ("٥٩ ٦٠ ١١ ١٢ ١٣ ٧٠", "٥٩ ٦٠ ٦١ ٦٢ ٦٣ ٧٠"), ("58 59 60 11 12", "58 59 60 61 62"), (" ".join(map(str, range(1, 40))), None),
]


@pytest.mark.parametrize(("given", "want"), RUNS)
def test_number_repair(given, want):
    found = structure.repaired_numbers(given.split())
    assert [n for n, _ in found] == (want or given).split()
    assert [r is not None for _, r in found] == [a != b for a, b in zip(given.split(), (want or given).split(), strict=True)]


def test_number_repair_column(spark):
    rows = spark.createDataFrame([(1, ["4", "5", "1", "7"]), (2, None), (3, []), (4, [None, "", "x", "2", None, "2", "4"])], "k int, n array<string>")
    got = {r["k"]: r["r"] and [x["number"] for x in r["r"]] for r in rows.select("k", structure.repair_numbers(F.col("n")).alias("r")).collect()}
    assert got == {1: ["4", "5", "6", "7"], 2: None, 3: [], 4: [None, "", "x", "2", None, "3", "4"]}
    every = {r["doc"]: r["numbers"] for r in structural.number_runs(spark, FOLDER).collect()}
    want = {(d, i, n[i], x, why) for d, n in every.items() for i, (x, why) in enumerate(structure.repaired_numbers(n)) if why}
    assert {tuple(r) for r in structural.digit_repairs(spark, FOLDER).collect()} == want and len(want) > 10


def compare(a, b):
    """Document order of two paths, segment by segment."""
    kinds = {**{k: k for k in paths.KINDS}, **paths.PREFIXES}
    cut = lambda s: (m[1].lower(), m[2] or "") if (m := re.fullmatch(r"([a-zA-Z]+)(?:_(.*))?", s)) else (s.lower(), "")
    xs, ys = ([cut(s) for s in p.split("__")] if p else [] for p in (a, b))
    for (p, n), (q, m) in zip(xs, ys, strict=False):
        if p != q:
            i, j = (paths.KINDS.index(kinds[x]) if x in kinds else 999 for x in (p, q))
            return -1 if (i, p) < (j, q) else 1
        for u, v in itertools.zip_longest(re.split("[._]", n), re.split("[._]", m), fillvalue=""):
            if u.isdigit() and v.isdigit():
                if int(u) != int(v):
                    return -1 if int(u) < int(v) else 1
            elif u != v:
                return -1 if u < v else 1
    return (len(xs) > len(ys)) - (len(xs) < len(ys))


def test_order_key(spark):
    rng = random.Random(4)
    number = lambda: rng.choice(["", "_1", "_2", "_10", "_5_a", "_5_b", "_05", "_5", "_5.2", "_5.10", "_100_b"])
    made = {"__".join(rng.choice(["book", "tit", "chp", "art", "para", "pt", "annex", "anne", "x-1"]) + number() for _ in range(rng.randint(1, 4))) for _ in range(600)}
    made |= {"", "chp_1__art_2", "chp_1__art_10", "chp_1", "chp_2__art_1", "tit_2"}
    rows = spark.createDataFrame([(p,) for p in sorted(made)], "p string").select("p", paths.order_key(F.col("p")).alias("k")).collect()
    got = [r["p"] for r in sorted(rows, key=lambda r: r["k"])]
    want = sorted(made, key=functools.cmp_to_key(compare))
    assert [compare(a, b) for a, b in zip(got, want, strict=True)] == [0] * len(got)
    assert spark.range(1).select(paths.order_key(F.lit(None).cast("string"))).first()[0] is None


def grams(w):
    w = f"  {w} "
    return [w[i : i + 3] for i in range(len(w) - 2)]


def similarity(token, term):
    asked, ordered = set(grams(token)), grams(term)
    best = 0
    for i in range(len(ordered)):
        for j in range(i, len(ordered)):
            part = set(ordered[i : j + 1])
            best = max(best, len(part & asked) / (len(asked) + len(part) - len(part & asked)))
    return best


def test_variants(spark):
    words = ["وزير", "الوزير", "banana", "bananas", "anan", "ban", "word", "words", "wordy", "sword", "swordfish", "wor", "ab", "abc", "xyz", "WORD"]
    lexicon = spark.createDataFrame([(w, i % 4) for i, w in enumerate(words)] + [("word", 9), (None, 5), ("", 7)], "term string, ndoc int")
    asked = spark.createDataFrame([(w,) for w in [*words, "word", None, "", "zzz"]], "token string")
    ndoc = {w: i % 4 for i, w in enumerate(words)} | {"word": 9}
    want = set()
    for token in {w for w in words if len(w) >= 3} | {"zzz"}:
        scored = sorted((-similarity(token, t), -ndoc[t], t) for t in ndoc if t != token and similarity(token, t) >= 0.5)
        want |= {(token, t, round(-s, 6), -n, i + 1) for i, (s, n, t) in enumerate(scored[:6])}
    assert {tuple(r) for r in expansion.variants(asked, lexicon).collect()} == want and ("وزير", "الوزير", 0.6) in {w[:3] for w in want}
    assert expansion.variants(asked.limit(0), lexicon).count() == expansion.variants(asked, lexicon.limit(0)).count() == 0


def test_variants_shuffle_no_pairs(spark):
    rng = random.Random(6)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(1, 12))) for _ in range(900)} | {"a" * 70, "ab" * 40, "".join(map(chr, range(0x4E00, 0x4E3C))) + "abcab"})
    lexicon = spark.createDataFrame([(w, len(w)) for w in words], "term string, ndoc long")
    found = expansion.variants(lexicon.where("length(term) < 9").select(F.col("term").alias("token")), lexicon)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" in plan and "Join" not in plan
    want = set()
    for token in [w for w in words if 3 <= len(w) < 9]:
        scored = sorted((-round(similarity(token, t), 6), -len(t), t) for t in words if t != token and expansion.extent_score(token, t, 0.5) >= 0.5)
        want |= {(token, t, -s, -n, i + 1) for i, (s, n, t) in enumerate(scored[:6])}
    assert {tuple(r) for r in found.collect()} == want


def test_expanded_queries_lead_with_their_own_words(spark):
    found = {r["item_id"]: r["words"] for r in structural.expanded_queries(spark, FOLDER).collect()}
    own = {r["item_id"]: re.findall(r"[a-z]+", r["text"].lower()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect() if r["text"].isascii()}
    for item, words in own.items():
        first = list(dict.fromkeys(words))
        assert found[item][: len(first)] == first and len(set(found[item])) == len(found[item]) <= 7 * len(first)


EDGES = [
    (1, "Article 1\nx « open\nArticle 2 closed »\nArticle 3\n \t\nArticle 4 of it\nPoint 1, 2\nPoint 1.5\nPoint 1\nItem 2\nPoint 01\nItem 3"), (1, "Chapter IV — On\r\nCHAPTER\n\tArticle 2 bis - Title \n«««\nArticle 2\n»»\nArticle 3\n\"\nArticle 4\n\"\n\"\nArticle 5"),
    (None, "Article 1"), (2, ""), (3, "\n"), (4, "Articles\nArticle 5é\nArticle 1\nArticle 1  to 3\nParagraph 1 and 2\nParagraph XIVx\nArticle 7 Ёж\nArticle 7 ёж\nArticle 00"), (5, None),
]


def test_whole_documents_are_walked_as_their_lines_are(spark):
    docs = structure.documents(spark.createDataFrame([*EDGES, EDGES[0]], "doc_id long, text string")).cache()
    rows = structure.lines(docs)
    found = structure.markers(structure.quoted(rows), structural.CONFIG)
    paths = structure.assign_paths(found.where("reason is null"), structural.CONFIG)
    told = lambda df, tell=None: sorted(map(str, (df if tell is None else structure.walked(df, structural.CONFIG, tell).select(*structure.KEYS, F.inline(tell))).collect()))
    assert told(docs, "marks") == told(found) and len({r["reason"] for r in found.collect()}) == 5
    assert told(docs, "anchors") == told(paths)
    units = structure.units(rows, paths)
    assert told(docs, "units") == told(units)
    assert told(structure.coverage_of(structure.walked(docs, structural.CONFIG, "units"))) == told(structure.coverage(units))


@pytest.mark.parametrize("query", [structural.marker_walk, structural.unit_paths, structural.verbatim_units, structural.structure_coverage])
def test_texts_are_shuffled_once(spark, query):
    plan = query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan
