"""Queries from text to structure, and those on document order and lexicon expansion.

Acts are derived from lineitem: the lines of an order make up an act with chapters, articles and
points, quoted spans and references that aren't units. The texts of `documents` are walked beside
them (doc_id below 0), whole, so that prose without units is met too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statuta.functions import paths
from statuta.operators import expansion, grids, resolution, search, spans, structure, totals, validation
from statuta.plans.registry import query, unmatched
from statuta.sources.tables import checkpointed, table

CONFIG = [
    structure.Marker("chapter", ("Chapter", "CHAPTER"), 3, "chp"),
    structure.Marker("article", ("Article", "ARTICLE"), 5, "art"),
    structure.Marker("paragraph", ("Paragraph",), 6, "para"),
    structure.Marker("point", ("Point",), 8, "point", outline=True),
    structure.Marker("item", ("Item",), 9, "item", outline=True),
]


def acts(spark: SparkSession, d: str) -> DataFrame:
    """doc_id and text: an act for each order, and the documents."""
    part, supp, n = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    said = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y.cast("string") for y in x])
    after = F.when(F.col("l_quantity") > 45, ".5 of that schedule").when(part % 7 == 0, " of the other act").when(part % 13 == 0, ", 8 and 9").when(part % 11 == 0, "").otherwise(said(". Title ", part % 100))
    pieces = [
        F.when(F.col("l_returnflag") == "R", said("Chapter ", n, " — ", F.col("l_linestatus"))),
        F.when(supp % 7 == 0, F.lit("„The words that follow")),
        said("Article ", part % 9 + 1, after),
        F.when(part % 3 == 0, said("Point ", supp % 3, ". first")),
        F.when(part % 3 == 0, said("Item ", n % 2, ". of it")),
        F.when(part % 3 == 0, said("Point ", part % 2, ". second")),
        said("body ", F.date_format("l_shipdate", "yyyy-MM-dd"), F.when(supp % 5 == 0, " « opened").when(supp % 5 == 1, " closed »").when(supp % 5 == 2, ' a "turn').when(supp % 5 == 3, " ended”").otherwise("")),
        F.when(F.col("l_quantity") < 5, F.lit("")),
    ]
    about = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"]
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.lit(True).alias("act"), *about)
    prose = table(spark, d, "documents").select((-1 - F.col("doc_id")).alias("doc_id"), F.lit(False).alias("act"), "text")
    # One shuffle, of the lines before they are texts; all that goes by document stays in its partition.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.unionByName(prose, allowMissingColumns=True).repartition(parts, "doc_id")
    part = F.when(F.col("act"), F.struct("l_linenumber", F.array_join(F.array_compact(F.array(*pieces)), "\n").alias("part")))
    held = dealt.select("doc_id", "act", "text", part.alias("part")).groupBy("doc_id", "act", "text").agg(F.collect_list("part").alias("parts"), F.count("*").alias("n"))
    joined = F.array_join(F.transform(F.sort_array("parts"), lambda x: x["part"]), "\n")
    times = F.when(F.col("act"), 1).otherwise(F.col("n").cast("int"))
    return held.select("doc_id", F.when(F.col("act"), joined).otherwise(F.col("text")).alias("text"), F.explode(F.sequence(F.lit(1), times)).alias("nth")).drop("nth")


def _walked(spark: SparkSession, d: str, tell: str) -> DataFrame:
    return structure.walked(structure.documents(acts(spark, d)), CONFIG, tell)


@unmatched
def marker_walk(spark: SparkSession, d: str) -> DataFrame:
    return _walked(spark, d, "marks").select("doc_id", F.inline("marks"))


@unmatched
def unit_paths(spark: SparkSession, d: str) -> DataFrame:
    return _walked(spark, d, "anchors").select("doc_id", F.inline("anchors"))


@unmatched
def verbatim_units(spark: SparkSession, d: str) -> DataFrame:
    units = _walked(spark, d, "units").select("doc_id", F.inline("units"))
    return units.select("doc_id", "unit", "path", "line", F.char_length("body").alias("n_chars"), F.sha2(F.col("body").cast("binary"), 256).alias("body_sha256"))


@unmatched
def structure_coverage(spark: SparkSession, d: str) -> DataFrame:
    return structure.coverage_of(_walked(spark, d, "units")).drop("version")


def _findings(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    cut = _walked(spark, d, "units").select("doc_id", F.inline("units")).select("doc_id", "path", "line", "body")
    hrefs = F.transform(F.regexp_extract_all(F.lower("body"), F.lit("title ([0-9]+)"), F.lit(1)), lambda n: F.concat(F.lit("#art_"), n))
    parents = {"para": ["art", "chp"], "item": ["point", "art"], "point": ["art", "para"]}
    return cut, validation.findings(cut, ["art", "para", "point"], parents, "art", ["chp"], hrefs)


@unmatched
def validator_findings(spark: SparkSession, d: str) -> DataFrame:
    return _findings(spark, d)[1]


@unmatched
def validator_grades(spark: SparkSession, d: str) -> DataFrame:
    # Every document has a unit: that of its whole text, if no other. Acts needn't be written for their ids.
    prose = table(spark, d, "documents").where("text is not null").select((-1 - F.col("doc_id")).alias("doc_id"))
    ids = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id")).unionByName(prose)
    return validation.graded(ids, _findings(spark, d)[1])


def number_runs(spark: SparkSession, d: str) -> DataFrame:
    """doc (user and block of 500 events) and its numbers in order: event numbers with digits misread here and there."""
    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    rows = table(spark, d, "events").select("user_id", "event_id", nth.alias("n"))
    number, at = F.col("n").cast("string"), F.col("event_id") % 23
    wrong = F.when(at == 0, F.translate(number, "6", "1")).when(at == 1, F.translate(number, "5", "0")).when(at == 2, F.regexp_replace(number, "8$", "9")).when(at == 3, F.lit("IV")).otherwise(number)
    wrong = F.when((F.col("user_id") % 3 == 0) & F.col("n").between(60, 69), F.regexp_replace(number, "^6", "1")).otherwise(wrong)
    blocks = rows.select(F.concat_ws("-", "user_id", F.floor(F.col("n") / 500)).alias("doc"), "n", wrong.alias("number"))
    return blocks.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "number"))), lambda x: x["number"]).alias("numbers"))


@unmatched
def digit_repairs(spark: SparkSession, d: str) -> DataFrame:
    mended = number_runs(spark, d).select("doc", "numbers", F.posexplode(structure.repair_numbers(F.col("numbers"))).alias("at", "r"))
    return mended.where("r.reason is not null").select("doc", "at", F.get("numbers", F.col("at")).alias("was"), "r.number", "r.reason")


GRAMS = "list_transform(range(1, len({0}) + 2), lambda i: substr('  ' || {0} || ' ', i, 3))"
WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z]+')"


@query(f"""with lex as (select term, count(*)::bigint as ndoc from (select distinct doc_id, unnest({WORDS}) as term from documents) where strlen(term) <= 128 group by 1), tok as (select token, list_distinct({GRAMS.format("token")}) as g from (select distinct unnest({WORDS}) as token from benchmark) where len(token) >= 3),
t as (select term, ndoc, {GRAMS.format("term")} as o from lex), p as (select term, unnest(list_distinct(o)) as gram from t), q as (select token, unnest(g) as gram from tok),
c as (select token, term from q join p using (gram) where term <> token group by 1, 2 having 2 * count(*) >= (select len(g) from tok k where k.token = q.token)),
e as (select token, term, ndoc, g, list_distinct(o[i : j]) as part from c join t using (term) join tok using (token), range(1, 140) a(i), range(1, 140) b(j) where i <= len(o) and j between i and len(o) and list_contains(g, o[i]) and list_contains(g, o[j])),
s as (select token, term, ndoc, round(max(len(list_intersect(part, g)) / (len(g) + len(part) - len(list_intersect(part, g)))), 6) as similarity from e group by 1, 2, 3)
select token, term, similarity, ndoc, rank from (select *, row_number() over (partition by token order by similarity desc, ndoc desc, term)::int as rank from s where similarity >= 0.5) where rank <= 6""")
def term_variants(spark: SparkSession, d: str) -> DataFrame:
    lexicon = checkpointed(search.lexicon(table(spark, d, "documents"), "doc_id", "text", search.ascii_tokens))
    asked = table(spark, d, "benchmark").select(F.explode(search.ascii_tokens(F.col("text"))).alias("token"))
    return expansion.variants(asked, lexicon)


@unmatched
def expanded_queries(spark: SparkSession, d: str) -> DataFrame:
    """Each benchmark item's whole words with their variants in the documents' lexicon."""
    lexicon = checkpointed(search.lexicon(table(spark, d, "documents"), "doc_id", "text"))
    asked = table(spark, d, "benchmark").select("item_id", search.tokens(F.col("text")).alias("words"))
    found = expansion.variants(asked.select(F.explode("words").alias("token")), lexicon)
    return expansion.expanded(asked, found, "item_id")


RANKS = "{" + ", ".join(f"'{k}': {paths.KINDS.index(v)}" for k, v in {**{k: k for k in paths.KINDS}, **paths.PREFIXES}.items()) + "}"
EIDS = """u as (select distinct l_orderkey % 50 as doc, case when l_linenumber = 7 then 'annex' else case l_returnflag when 'R' then 'chp_' when 'A' then 'tit_' else 'sec_' end || l_linenumber end || case when l_partkey % 4 > 0 then '__art_' || (l_partkey % 12) || case l_suppkey % 3 when 0 then '_a' when 1 then '.' || (l_suppkey % 11) else '' end else '' end || case when l_partkey % 8 > 4 then '__para_' || (l_suppkey % 10) else '' end as path from lineitem)"""


def _eids(spark: SparkSession, d: str) -> DataFrame:
    part, supp, n = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    said = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y.cast("string") for y in x])
    outer = F.when(n == 7, "annex").otherwise(said(F.when(F.col("l_returnflag") == "R", "chp_").when(F.col("l_returnflag") == "A", "tit_").otherwise("sec_"), n))
    article = F.when(part % 4 > 0, said("__art_", part % 12, F.when(supp % 3 == 0, "_a").when(supp % 3 == 1, said(".", supp % 11)).otherwise(""))).otherwise("")
    inner = F.when(part % 8 > 4, said("__para_", supp % 10)).otherwise("")
    return table(spark, d, "lineitem").select((F.col("l_orderkey") % 50).alias("doc"), F.concat(outer, article, inner).alias("path")).distinct()


@query(f"""with {EIDS}, k as (select doc, path, list_transform(string_split(path, '__'), lambda s: struct_pack(kind := coalesce(map {RANKS}[regexp_extract(s, '^[a-z]+')], 999), prefix := regexp_extract(s, '^[a-z]+'),
number := list_transform(string_split_regex(regexp_extract(s, '^[a-z]+_(.*)$', 1), '[._]'), lambda x: struct_pack(t := case when x = '' then 0 when regexp_full_match(x, '[0-9]+') then 1 else 2 end, n := coalesce(try_cast(x as bigint), 0), s := x)))) as key from u)
select doc, path, row_number() over (partition by doc order by key)::int as place from k""")
def document_order(spark: SparkSession, d: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("doc").orderBy(paths.order_key(F.col("path"))))
    return _eids(spark, d).select("doc", "path", place.alias("place"))


@unmatched
def numeric_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Of each text: its numeric tokens by kind, the text with sentinels, and whether it comes back from it."""
    # Null texts go before: a condition on the tokens would find them twice.
    found = acts(spark, d).where("text is not null").select("doc_id", "text", spans.numeric_tokens(F.col("text")).alias("e"))
    surfaces = F.transform("e.tokens", lambda t: t["surface"])
    back = spans.numbers_restored(F.col("e.encoded"), F.col("e.opener"), F.col("e.closer"), surfaces)
    digest = F.array_join(F.transform("e.tokens", lambda t: F.concat_ws(":", t["start"], t["end"], t["kind"], t["target"])), ";")
    return found.select("doc_id", F.size("e.tokens").cast("long").alias("n_tokens"), F.sha2("e.encoded", 256).alias("encoded_sha256"), F.sha2(digest, 256).alias("tokens_sha256"), ((back["text"] == F.col("text")) & (F.size(back["missing"]) == 0)).alias("restored"))


def termed(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the words of five letters or more that they write with a capital."""
    names = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?<![\p{L}\p{N}_])(\p{Lu}\p{Ll}{4,})(?![\p{L}\p{N}_])"), F.lit(1)))
    return table(spark, d, "documents").select("doc_id", "text", names.alias("terms"))


@unmatched
def own_terms(spark: SparkSession, d: str) -> DataFrame:
    return spans.term_occurrences(termed(spark, d), "doc_id", "text", "terms")


def tariff_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of a table for each order: a header, a band where a row is returned, nested codes, dashes, spans."""
    n, part = F.col("l_linenumber"), F.col("l_partkey")
    lit = lambda x: F.lit(x) if isinstance(x, (str, int)) else x

    def cell(at: int, text, wide: int = 1, deep=1, head: bool = False):
        return F.struct(F.lit(at).alias("cell"), lit(text).cast("string").alias("text"), lit(wide).alias("colspan"), lit(deep).alias("rowspan"), F.lit(head).alias("is_header"))

    said = F.concat(F.repeat(F.lit("- "), (part % 3).cast("int")), F.lit("goods of "), F.date_format("l_shipdate", "MMMM yyyy"))
    code = F.concat(F.lit("12"), F.substring(F.lit("345678"), F.lit(1), n - 1))
    deep = F.when(n % 3 == 1, 2).otherwise(1)
    own = F.when(n % 3 == 2, F.array(cell(0, code), cell(1, said))).otherwise(F.array(cell(0, code), cell(1, said), cell(2, F.col("l_quantity").cast("int"), 1, deep)))
    rows = F.array_compact(F.array(F.when(n == 1, F.array(cell(0, "Code", 1, 1, True), cell(1, "Description", 1, 1, True), cell(2, "Duty", 1, 1, True))), F.when(F.col("l_returnflag") == "R", F.array(cell(0, F.concat(F.lit("Section "), n), 3, 1, True))), own))
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("tab"), "l_linenumber", F.posexplode(rows).alias("nth", "cells"))
    return lines.select("tab", (F.col("l_linenumber") * 4 + F.col("nth")).alias("row"), F.inline("cells"))


@unmatched
def table_lineage(spark: SparkSession, d: str) -> DataFrame:
    return grids.table_rows(tariff_cells(spark, d))


REFS = """held as (select doc, path, case when path like '%para%' then 'alias_' || substr(path, 1, 5) end as alias, path like '%\\_3' escape '\\' as excluded from u),
refs as (select o_orderkey as ref_id, o_orderkey % 50 as doc, case o_orderkey % 8 when 0 then '#chp_' || (o_custkey % 7 + 1) || '__art_' || (o_custkey % 12) when 1 then '#art_' || (o_custkey % 12) || '_a' when 2 then '#alias_chp_' || (o_custkey % 7 + 1)
when 3 then '/' || (o_custkey % 60) || '#sec_' || (o_custkey % 9) when 4 then '/' || (o_custkey % 60) when 5 then '/a/b' when 7 then '#para_' || (o_custkey % 10) end as target, case when o_orderkey % 5 = 0 then 1 end as resolver_version, o_orderstatus = 'F' as resolved from orders)"""
RESOLVED = f"""with {EIDS}, {REFS}, o as (select ref_id, doc as own, coalesce(target, '') as t from refs where not (coalesce(resolver_version, -1) >= 1 and coalesce(resolved, false))),
a as (select ref_id, starts_with(t, '#') as same, case when starts_with(t, '#') then own::varchar else nullif(regexp_extract(t, '^/([^/#]+)(#(.+))?$', 1), '') end as target_doc, nullif(case when starts_with(t, '#') then substr(t, 2) else regexp_extract(t, '^/([^/#]+)(#(.+))?$', 3) end, '') as wanted from o),
m as (select ref_id, min(path) filter (path = wanted) as e, min(path) filter (alias = wanted) as w, count(distinct path) filter (path <> wanted and contains('__' || path || '__', '__' || wanted || '__')) as n, min(path) filter (path <> wanted and contains('__' || path || '__', '__' || wanted || '__')) as p
from a join held on held.doc::varchar = target_doc where not excluded group by 1),
r as (select ref_id, target_doc, case when target_doc is null then 'unparsed' when e is not null then 'resolved_exact' when w is not null then 'resolved_alias' when n > 1 then 'ambiguous' when n = 1 then 'resolved_partial' when same then 'missing_same_doc'
when target_doc not in (select doc::varchar from held) then 'unknown_document' when wanted is null then 'resolved_document' else 'document_only' end as outcome, coalesce(e, w, p) as unit from a left join m using (ref_id))"""


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    held = _eids(spark, d).select("doc", "path", F.when(F.col("path").contains("para"), F.concat(F.lit("alias_"), F.substring("path", 1, 5))).alias("alias"), F.col("path").endswith("_3").alias("excluded"))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    said = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y.cast("string") for y in x])
    forms = [said("#chp_", cust % 7 + 1, "__art_", cust % 12), said("#art_", cust % 12, "_a"), said("#alias_chp_", cust % 7 + 1), said("/", cust % 60, "#sec_", cust % 9), said("/", cust % 60), F.lit("/a/b"), F.lit(None).cast("string"), said("#para_", cust % 10)]
    target = F.get(F.array(*forms), (key % 8).cast("int"))
    refs = table(spark, d, "orders").select(key.alias("ref_id"), (key % 50).alias("doc"), target.alias("target"), F.when(key % 5 == 0, 1).alias("resolver_version"), (F.col("o_orderstatus") == "F").alias("resolved"))
    return resolution.resolve(refs, held)


@query(RESOLVED + " select ref_id, outcome, case when starts_with(outcome, 'resolved') then unit end as unit, case when starts_with(outcome, 'resolved') or outcome = 'document_only' then target_doc end as target_doc, case when starts_with(outcome, 'resolved') then 1 end as resolver_version from r")
def reference_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return _resolved(spark, d)


@query(RESOLVED + ", c as (select outcome, count(*)::bigint as n from r group by 1) select * from c union all select 'examined', sum(n)::bigint from c")
def reference_counters(spark: SparkSession, d: str) -> DataFrame:
    return resolution.counters(_resolved(spark, d))


def walk_counters(spark: SparkSession, d: str) -> DataFrame:
    """era and counters of each act: by kind the markers and those accepted, by reason the markers rejected."""
    era = F.when(F.col("doc_id") < 0, "prose").otherwise(F.concat(F.lit("era"), (F.col("doc_id") % 3).cast("string")))
    marks = marker_walk(spark, d)
    ok, kinds = F.col("reason").isNull(), [c.kind for c in CONFIG]
    counted = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds] + [F.count_if((F.col("kind") == k) & ok).alias(f"ok_{k}") for k in kinds] + [F.count_if(F.col("reason") == r).alias(r) for r in structure.REASONS]
    held = marks.groupBy("doc_id").agg(*counted)
    forms = [F.struct(F.lit(k).alias("key"), F.array(f"n_{k}", f"ok_{k}").alias("value")) for k in kinds]
    passes = [F.struct(F.lit(r).alias("key"), F.array(F.col(r), F.lit(1).cast("long")).alias("value")) for r in structure.REASONS]
    known = lambda entries: F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"][0] > 0))
    sections = F.filter(F.array(F.struct(F.lit("forms").alias("key"), known(forms).alias("value")), F.struct(F.lit("passes").alias("key"), known(passes).alias("value"))), lambda e: F.size(e["value"]) > 0)
    return held.select(era.alias("era"), F.map_from_entries(sections).alias("counters"))


@unmatched
def corpus_totals(spark: SparkSession, d: str) -> DataFrame:
    return totals.totals(walk_counters(spark, d), 2)
