"""Checks of a document's units as one long table of findings.

Units have doc_id, path (null: text before the first unit), line and body, whose first line is the
unit's own marker; a path's last segment tells kind and number. Every check gives doc_id, check,
severity, path (null: the document), and detail. `findings` makes one row of each path of a document,
with what its units, the units below it and the references to it add up to, and every check reads
these rows by windows within the document; no document is gathered as one row. Units of a null doc_id count as one document. Empty tables give
no rows; repeated rows are duplicates of a path.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Ceilings of a path, lengths of a body, share of leading articles.
MAX_DEPTH, MAX_LENGTH = 12, 255
EMPTY_CHARS, STRUCTURELESS_CHARS = 200, 10_000
LEADING_SHARE = 0.2


def parsed(units: DataFrame) -> DataFrame:
    """The rows with kind, number, parent (empty at the root) and depth from their paths; null without a path."""
    segment = F.substring_index("path", "__", -1)
    length = F.char_length("path") - F.char_length(segment) - 2
    return units.withColumns({
        "kind": F.regexp_extract(segment, "^([a-z]+)_", 1),
        "number": F.regexp_extract(segment, "^[a-z]+_([0-9a-z]+)", 1),
        "parent": F.substring(F.col("path"), F.lit(1), F.greatest(length, F.lit(0))),
        "depth": F.size(F.split("path", "__")),
    }).withColumn("depth", F.when(F.col("path").isNotNull(), F.col("depth")))


#: What a row adds to a path: one of its units, the text of a unit at or below it, or a reference to it.
_FACT = "struct<path: string, n: int, line: int, chars: int, text: int, asked: int>"


def _fact(path: Column, **known: Column) -> Column:
    columns = {"n": F.lit(0), "line": F.lit(None), "chars": F.lit(0), "text": F.lit(0), "asked": F.lit(0)} | known
    return F.struct(path.alias("path"), *[c.alias(n) for n, c in columns.items()]).cast(_FACT)


def _asked(hrefs: Column) -> Column:
    """References within the document (`#path`) as facts; others are elsewhere."""
    here = F.filter(F.coalesce(hrefs, F.array().cast("array<string>")), lambda h: F.startswith(h, F.lit("#")) & (F.char_length(h) > 1))
    return F.transform(here, lambda h: _fact(F.substr(h, F.lit(2)), asked=F.lit(1)))


def by_path(units: DataFrame, references: DataFrame | Column | None = None) -> DataFrame:
    """A row for each doc_id and path: n (units that have it), line and last (their first and last lines), chars
    (characters of their bodies), text (of all texts at or below it but the units' own first lines) and asked (references to it).

    `references`: a table of doc_id and href, or each unit's array of hrefs.
    """
    body = F.coalesce("body", F.lit(""))
    own = F.char_length(F.trim(F.regexp_replace(body, r"^[^\n]*\n?", "")))
    hrefs = references if isinstance(references, Column) else F.lit(None).cast("array<string>")
    # One shuffle, of units without their bodies: all that follows stays within a document.
    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = units.select("doc_id", "path", "line", F.char_length(F.trim(body)).alias("chars"), own.alias("text"), hrefs.alias("hrefs")).repartition(parts, "doc_id")
    segments = F.split("path", "__")
    above = F.when(F.size(segments) > 1, F.transform(F.sequence(F.lit(1), F.size(segments) - 1), lambda i: F.array_join(F.slice(segments, 1, i), "__"))).otherwise(F.array().cast("array<string>"))
    unit = _fact(F.col("path"), n=F.lit(1), line=F.col("line"), chars=F.col("chars"), text=F.col("text"))
    facts = F.concat(F.array(unit), F.transform(above, lambda p: _fact(p, text=F.col("text"))), _asked(F.col("hrefs")))
    every = narrow.select("doc_id", F.inline(facts))
    if isinstance(references, DataFrame):
        every = every.unionByName(references.select("doc_id", F.inline(_asked(F.array("href")))))
    return every.groupBy("doc_id", "path").agg(*[F.sum(c).alias(c) for c in ("n", "chars", "text", "asked")], F.min("line").alias("line"), F.max("line").alias("last"))


def findings(units: DataFrame, numbered: list[str], parents: dict[str, list[str]], article: str, containers: list[str], references: DataFrame | Column | None = None) -> DataFrame:
    """The findings of all checks on the units; `references` as for `by_path`, none given: not looked at.

    * eid_uniqueness: a path that several units have.
    * eid_unusable: the first path of a document that is too deep or too long to be cited.
    * hierarchy_coherence: a unit whose parent is of none of the kinds that its own may stand in (empty: the root).
    * orphan_articles: units of kind `article` at the root of a document that has containers there too. A warning where
      all stand before the first container and are at most a fifth of their kind; else an error.
    * empty_body and structureless_body: a document of no units and hardly a text, or of one unit at most and a long text.
    * empty_article: a unit of kind `article` that has no text but its marker, nor has any unit below it.
    * duplicate_number: a number that several paths of a kind below one parent have.
    * number_gap: a run of missing numbers between two of a kind below one parent, told at the unit before it: a warning
      where the gaps of these units look like a defect (a run of three, or over 30 % missing), else info. Gaps look at
      the units before the first whose number isn't a plain one.
    * ref_resolution: references to `#path` that no unit of the document has.
    """
    known = parsed(by_path(units, references))
    doc, place = Window.partitionBy("doc_id"), ["doc_id", "held", "kind", "parent"]
    col, unit = F.col, F.col("n") > 0
    pathed = unit & col("path").isNotNull()
    root, own = pathed & (col("parent") == ""), pathed & (col("kind") == article)
    bad = pathed & ((col("depth") > MAX_DEPTH) | (F.char_length("path") > MAX_LENGTH))
    # Windows come finest first: those of a prefix of its order follow without sorting again.
    known = known.withColumn("teller", F.row_number().over(doc.orderBy("path")) == 1)
    known = known.withColumns({
        "unusable": F.min(F.when(bad, F.struct("line", "path"))).over(doc),
        "units": F.sum(F.when(pathed, col("n")).otherwise(0)).over(doc), "rows": F.sum("n").over(doc), "all_chars": F.sum("chars").over(doc),
        "rooted": F.sum(F.when(root & own, col("n")).otherwise(0)).over(doc), "articles": F.sum(F.when(own, col("n")).otherwise(0)).over(doc),
        "last_rooted": F.max(F.when(root & own, col("last"))).over(doc), "first_container": F.min(F.when(root & col("kind").isin(*containers), col("line"))).over(doc),
    })
    # Numbers of a kind below one parent. Rows that are none of it lie apart.
    value = F.when(col("number").rlike("^[0-9]+$"), col("number").try_cast("long"))
    known = known.withColumn("held", pathed & col("kind").isin(*numbered) & (col("number") != "")).withColumn("value", value)
    known = known.withColumn("held", F.coalesce("held", F.lit(False)))
    beside, same = Window.partitionBy(*place), Window.partitionBy(*place, "number")
    known = known.withColumns({"twins": F.when(col("held"), F.count("*").over(same)), "twin": F.min("path").over(same)})
    known = known.withColumn("other", F.min(F.when(col("value").isNull(), col("line"))).over(beside))
    known = known.withColumn("head", F.coalesce(col("held") & col("value").isNotNull() & (col("other").isNull() | (col("line") < col("other"))), F.lit(False)))
    known = known.withColumn("host", col("head") & (F.row_number().over(Window.partitionBy(*place, "head", "value").orderBy("line", "path")) == 1))
    hosts = Window.partitionBy(*place, "host")
    known = known.withColumn("gap", F.lead("value").over(hosts.orderBy("value")) - col("value") - 1)
    known = known.withColumns({"missing": F.sum("gap").over(hosts), "longest": F.max("gap").over(hosts), "span": F.max("value").over(hosts) - F.min("value").over(hosts) + 1})

    def told(when: Column, check: str, severity: Column | str, detail: Column, path: Column | None = None, times: Column | None = None) -> Column:
        severity = F.lit(severity) if isinstance(severity, str) else severity
        path = col("path") if path is None else path
        row = F.struct(F.lit(check).alias("check"), severity.alias("severity"), path.cast("string").alias("path"), detail.cast("string").alias("detail"))
        none = F.array().cast("array<struct<check: string, severity: string, path: string, detail: string>>")
        return F.when(when, F.array(row) if times is None else F.array_repeat(row, times.cast("int"))).otherwise(none)

    above = F.regexp_extract(F.substring_index("parent", "__", -1), "^([a-z]+)_", 1)
    wrong = functools.reduce(lambda a, b: a | b, [(col("kind") == k) & ~above.isin(*p) for k, p in parents.items()], F.lit(False))
    leading = (col("last_rooted") < col("first_container")) & (col("rooted") / col("articles") <= LEADING_SHARE)
    teller, nowhere = col("teller") & (col("rows") > 0), F.lit(None)
    floor = F.when(col("units") == 0, EMPTY_CHARS).otherwise(STRUCTURELESS_CHARS)
    likely = F.when((col("longest") >= 3) | (col("missing") / col("span") > 0.3), "defect").when((col("longest") == 1) & (col("missing") <= 3), "repeal").otherwise("ambiguous")
    found = [
        told(pathed & (col("n") > 1), "eid_uniqueness", "error", col("n")),
        told(bad & (col("path") == col("unusable.path")), "eid_unusable", "error", F.when(col("depth") > MAX_DEPTH, "too deep").otherwise("too long")),
        told(pathed & wrong, "hierarchy_coherence", "warning", F.concat(F.lit("in "), F.when(above == "", "root").otherwise(above)), times=col("n")),
        told(teller & (col("rooted") > 0) & col("first_container").isNotNull(), "orphan_articles", F.when(leading, "warning").otherwise("error"), F.concat_ws(" of ", "rooted", "articles"), nowhere),
        told(teller & (col("units") == 0) & (col("all_chars") <= EMPTY_CHARS), "empty_body", "error", col("all_chars"), nowhere),
        told(teller & (col("units") <= 1) & (col("all_chars") > floor), "structureless_body", "warning", col("all_chars"), nowhere),
        told(own & (col("text") == 0), "empty_article", "warning", F.lit("no text")),
        told((col("twins") > 1) & (col("path") == col("twin")), "duplicate_number", "warning", F.concat_ws(" ", "kind", "number", "twins")),
        told(col("host") & (col("gap") > 0), "number_gap", F.when(likely == "defect", "warning").otherwise("info"), F.concat_ws(" ", col("kind"), F.concat_ws("-", col("value") + 1, col("value") + col("gap")), likely)),
        told((col("n") == 0) & (col("asked") > 0), "ref_resolution", "warning", F.lit("no such unit"), times=col("asked")),
    ]
    return known.select("doc_id", F.inline(F.concat(*found)))


def graded(units: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, errors, warnings and grade (blocking, warning or clean) of every document of the units."""
    counted = units.select("doc_id", F.lit(None).cast("string").alias("severity")).distinct().unionByName(found.select("doc_id", "severity"))
    each = counted.groupBy("doc_id").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    return each.withColumn("grade", F.when(F.col("errors") > 0, "blocking").when(F.col("warnings") > 0, "warning").otherwise("clean"))
