"""Resolution of references by a ladder of rungs: all candidates from one join, the first rung that answers counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLICY = 1
RUNGS = {1: "resolved_exact", 2: "resolved_alias", 3: "resolved_partial"}


def parts(path: Column) -> Column:
    """The proper runs of segments of a path: what is above, below or amid the whole."""
    segments = F.split(path, "__")
    n = F.size(segments)
    runs = F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(i, n), lambda j: F.array_join(F.slice(segments, i, j - i + 1), "__")))
    return F.array_distinct(F.array_except(F.flatten(runs), F.array(path)))


def resolve(refs: DataFrame, units: DataFrame, policy: int = POLICY) -> DataFrame:
    """ref_id, outcome, unit, target_doc and resolver_version of every reference that is open.

    refs: ref_id, doc (where it stands), target, resolver_version, resolved. Settled are those that an
    equal or later policy resolved; all others are examined anew, unresolved ones whatever their version.
    units: doc, path, alias, excluded; excluded units answer nothing. A target is `#path` in the same
    document, or `/doc` or `/doc#path`.

    Outcomes exclude each other: resolved_exact (path), resolved_alias (alias), resolved_partial (the one
    unit of which the path is a run of segments), ambiguous (several such), missing_same_doc, resolved_document
    (no path given), document_only (held, without the unit), unknown_document, unparsed. Of several
    units of one path the answer is the least; repeated refs are one.
    """
    settled = (F.coalesce(F.col("resolver_version"), F.lit(-1)) >= policy) & F.coalesce(F.col("resolved"), F.lit(False))
    open_ = refs.where(~settled).select("ref_id", F.col("doc").cast("string").alias("own"), F.coalesce("target", F.lit("")).alias("target")).distinct()
    same = F.col("target").startswith("#") & (F.length("target") > 1)
    other = F.regexp_extract("target", "^/([^/#]+)(?:#(.+))?$", 1)
    asked = open_.select("ref_id", same.alias("same"), F.when(same, F.col("own")).when(other != "", other).alias("target_doc"), F.when(same, F.substring("target", 2, 1 << 30)).otherwise(F.nullif(F.regexp_extract("target", "^/([^/#]+)(?:#(.+))?$", 2), F.lit(""))).alias("wanted"))
    held = units.where("not coalesce(excluded, false) and path is not null").select(F.col("doc").cast("string").alias("target_doc"), "path", "alias").distinct()
    key = lambda rung, column: F.struct(F.lit(rung).alias("rung"), column.alias("key"))
    keys = F.array_compact(F.concat(F.array(key(1, F.col("path")), F.when(F.col("alias").isNotNull(), key(2, F.col("alias")))), F.transform(parts(F.col("path")), lambda p: key(3, p))))
    index = held.select("target_doc", "path", F.explode(keys).alias("k")).select("target_doc", "path", "k.rung", F.col("k.key").alias("wanted"))
    answers = index.groupBy("target_doc", "wanted", "rung").agg(F.countDistinct("path").alias("n"), F.min("path").alias("unit"))
    # One row a wanted path: what each rung says, so that the references meet the index once.
    ladder = answers.groupBy("target_doc", "wanted").agg(F.min(F.struct("rung", "n", "unit")).alias("first"))
    documents = units.select(F.col("doc").cast("string").alias("target_doc")).distinct().withColumn("known", F.lit(True))
    met = asked.join(ladder, ["target_doc", "wanted"], "left").join(documents, "target_doc", "left")
    named = F.create_map(*[F.lit(x) for pair in RUNGS.items() for x in pair])
    outcome = (
        F.when(F.col("target_doc").isNull(), "unparsed").when((F.col("first.rung") == 3) & (F.col("first.n") > 1), "ambiguous").when(F.col("first").isNotNull(), named[F.col("first.rung")])
        .when(F.col("same"), "missing_same_doc").when(F.col("known").isNull(), "unknown_document").when(F.col("wanted").isNull(), "resolved_document").otherwise("document_only")
    )
    found = met.select("ref_id", outcome.alias("outcome"), F.col("first.unit").alias("unit"), "target_doc")
    done = F.col("outcome").startswith("resolved")
    return found.select("ref_id", "outcome", F.when(done, F.col("unit")).alias("unit"), F.when(done | (F.col("outcome") == "document_only"), F.col("target_doc")).alias("target_doc"), F.when(done, F.lit(policy)).alias("resolver_version"))


def counters(found: DataFrame) -> DataFrame:
    """outcome and n, and the row examined, which is their sum."""
    each = found.groupBy("outcome").agg(F.count("*").alias("n"))
    return each.unionByName(each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("examined").alias("outcome"), "n"))
