"""Named queries over the driver tables and their oracle SQL.

The tables stand in for the corpus: nation, customer, orders and lineitem for jurisdictions, laws,
versions and provisions; events for the event log; labels for measurements that may be missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions import paths
from statuta.functions.tokeniser import ALL_STEMMERS
from statuta.operators import checks, graph, quality, relational, retrieval, search, temporal, units
from statuta.sources.tables import table
from statuta.streaming import events as feed
from statuta.streaming import runs

PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}
COMMON = ["the", "of", "and", "to", "in", "a", "is", "that", "for", "on"]
ERAS = [("early", 1900, 1993), ("middle", 1994, 1996), ("late", 1997, 2100)]
QUERIES, ORACLE = {}, {}
#: Queries that SQL can't match; tests hold them against brute force.
UNMATCHED = {}


def query(sql: str | None = None):
    def added(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return added


def unmatched(f):
    UNMATCHED[f.__name__] = f
    return f


@query("select o_custkey, o_orderkey, o_orderdate from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) rn from orders) where rn = 1")
def latest_per_group(spark: SparkSession, d: str) -> DataFrame:
    return relational.latest_per_group(table(spark, d, "orders"), ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey")).select("o_custkey", "o_orderkey", "o_orderdate")


@query("select l_suppkey, l_orderkey, l_linenumber, l_extendedprice, rank from (select *, row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber)::int rank from lineitem) where rank <= 3")
def topn_per_group(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return relational.top_n_per_group(rows, ["l_suppkey"], 3, F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"))


@query("""select o_orderkey, o_orderdate from orders, (select o_orderdate t, o_orderkey k from orders where o_orderkey = (select max(o_orderkey) from orders where o_orderkey <= 500)) c
where o_orderdate < t or (o_orderdate = t and o_orderkey < k) order by o_orderdate desc, o_orderkey desc limit 21""")
def keyset_page(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    cursor = rows.where("o_orderkey <= 500").agg(F.max("o_orderkey").alias("k")).first()["k"]
    return relational.keyset_page(rows, "o_orderdate", "o_orderkey", cursor, 20)


@query("select o_orderkey, o_totalprice, (select count(*) from orders where o_orderstatus = 'F')::bigint total from orders where o_orderstatus = 'F' order by o_totalprice desc, o_orderkey limit 20")
def total_over_page(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").where("o_orderstatus = 'F'")
    page = rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")
    return page.crossJoin(F.broadcast(rows.agg(F.count("*").alias("total"))))


@query("select o_custkey, " + ", ".join(f"count(*) filter (where o_orderpriority = '{v}')::bigint as {n}" for v, n in PRIORITIES.items()) + " from orders group by 1")
def severity_pivot_rollup(spark: SparkSession, d: str) -> DataFrame:
    return relational.pivot_counts(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", PRIORITIES)


@query("""select o_orderkey, o_totalprice from orders order by case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 when '3-MEDIUM' then 2 when '5-LOW' then 3 else 4 end, o_totalprice, o_orderdate desc, o_orderkey desc limit 50""")
def review_queue_order(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("o_orderpriority")
    rank = F.when(p == "1-URGENT", 0).when(p == "2-HIGH", 1).when(p == "3-MEDIUM", 2).when(p == "5-LOW", 3).otherwise(4)
    return table(spark, d, "orders").orderBy(rank, "o_totalprice", F.desc("o_orderdate"), F.desc("o_orderkey")).limit(50).select("o_orderkey", "o_totalprice")


@query("""select 'o_orderstatus' as facet, o_orderstatus as value, count(*)::bigint n from orders where o_orderpriority = '1-URGENT' group by 2
union all select 'o_orderpriority', o_orderpriority, count(*)::bigint from orders where o_orderstatus = 'F' group by 2""")
def facets_minus_self(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderstatus", "o_orderpriority")
    return relational.facets(rows, {"o_orderstatus": F.col("o_orderstatus") == "F", "o_orderpriority": F.col("o_orderpriority") == "1-URGENT"})


@query("select json_extract_string(props, '$.k') as k, event_type, count(*)::bigint n from events group by 1, 2")
def group_by_json_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.get_json_object("props", "$.k").alias("k"), "event_type").agg(F.count("*").alias("n"))


@query("select split_part(p_type, ' ', 1) as segment, count(*)::bigint n, count(distinct p_brand)::bigint brands from part group by 1")
def first_segment_groupby(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy(F.split_part("p_type", F.lit(" "), F.lit(1)).alias("segment")).agg(F.count("*").alias("n"), F.countDistinct("p_brand").alias("brands"))


@query("""select n_name, count(distinct c_custkey)::bigint laws, count(distinct o_orderkey)::bigint versions from nation left join customer on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey group by 1""")
def distinct_counts_left_chain(spark: SparkSession, d: str) -> DataFrame:
    versions = table(spark, d, "orders").groupBy("o_custkey").agg(F.count_distinct("o_orderkey").alias("v"))
    laws = table(spark, d, "customer").join(versions, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_nationkey").agg(F.count_distinct("c_custkey").alias("laws"), F.sum("v").alias("versions"))
    chain = table(spark, d, "nation").join(laws, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return chain.select("n_name", F.coalesce("laws", F.lit(0)).alias("laws"), F.coalesce("versions", F.lit(0)).alias("versions"))


@query("select c_custkey, c_name from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority in ('1-URGENT', '2-HIGH'))")
def semi_exists(spark: SparkSession, d: str) -> DataFrame:
    some = table(spark, d, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", "c_name").join(some, "c_custkey", "left_semi")


@query("""select o_custkey, o_orderkey, o_orderstatus from orders where o_orderstatus = 'F'
union all select o_custkey, o_orderkey, o_orderstatus from orders o where o_orderstatus = 'O' and not exists (select 1 from orders p where p.o_custkey = o.o_custkey and p.o_orderstatus = 'F')""")
def anti_preferred_fallback(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return relational.preferred_or_fallback(rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus = 'O'"), "o_custkey")


@query("""with r as (select year(l_shipdate) y, l_suppkey, round(avg(case when l_returnflag = 'R' then 1.0 else 0.0 end), 6) rate from lineitem where year(l_shipdate) in (1995, 1996) group by 1, 2)
select coalesce(a.l_suppkey, b.l_suppkey) l_suppkey, a.rate old_rate, b.rate new_rate, round(b.rate - a.rate, 6) delta, a.rate is not null and b.rate is null stopped, a.rate is null and b.rate is not null started
from (select * from r where y = 1995) a full join (select * from r where y = 1996) b on a.l_suppkey = b.l_suppkey""")
def full_outer_rate_delta(spark: SparkSession, d: str) -> DataFrame:
    rates = table(spark, d, "lineitem").groupBy(F.year("l_shipdate").alias("y"), "l_suppkey").agg(F.round(F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)), 6).alias("rate"))
    return relational.rate_delta(rates.where("y = 1995"), rates.where("y = 1996"), ["l_suppkey"]).withColumn("delta", F.round("delta", 6))


@query("select distinct k from (select l_partkey k from lineitem where l_returnflag = 'R' union select p_partkey from part where p_size > 40)")
def union_distinct_coverage(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("k"))
    return a.union(table(spark, d, "part").where("p_size > 40").select("p_partkey")).distinct()


@query("select c.doc_id, p.first from documents c join (select sha256(text) h, min(doc_id) as first from documents where text is not null group by 1) p on sha256(c.text) = p.h where c.doc_id > p.first")
def self_join_parent_hash(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("h"))
    return rows.join(rows.groupBy("h").agg(F.min("doc_id").alias("first")), "h").where("doc_id > first").select("doc_id", "first")


@query("""select coalesce(a.o_orderkey, b.o_orderkey) o_orderkey, coalesce(b.o_orderstatus, a.o_orderstatus) o_orderstatus from (select o_orderkey, o_orderstatus from orders where o_orderkey % 3 <> 0) a
full join (select o_orderkey, case when o_orderkey % 4 = 0 then 'X' end o_orderstatus from orders where o_orderkey % 2 = 0) b on a.o_orderkey = b.o_orderkey""")
def upsert_coalesce(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    batch = rows.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 4 == 0, "X"))
    return relational.upsert(rows.where("o_orderkey % 3 <> 0"), batch, "o_orderkey")


@query("select distinct o_custkey from (select o_custkey from orders where o_orderkey % 3 = 0 union all select c_custkey from customer where c_acctbal > 0)")
def insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    held = table(spark, d, "orders").where("o_orderkey % 3 = 0").select("o_custkey").distinct()
    return relational.insert_ignore(held, table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"])


TOKENS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z]+')"


@query(f"select term, count(distinct doc_id)::bigint ndoc from (select doc_id, unnest({TOKENS}) term from documents) where strlen(term) <= 128 group by 1")
def lexicon_df(spark: SparkSession, d: str) -> DataFrame:
    return search.lexicon(table(spark, d, "documents"), "doc_id", "text", search.ascii_tokens)


@unmatched
def lexicon_words(spark: SparkSession, d: str) -> DataFrame:
    """lexicon_df of whole words, by each document's language."""
    return search.lexicon(table(spark, d, "documents"), "doc_id", "text", lambda text: search.tokens(text, F.col("lang")))


@unmatched
def lexicon_stems(spark: SparkSession, d: str) -> DataFrame:
    """The stems of all documents, by each document's language, and how many documents hold them."""
    return search.lexicon(table(spark, d, "documents"), "doc_id", "text", lambda text: search.tokens(text, F.col("lang"), ALL_STEMMERS))


BM25 = f"""t as (select doc_id, {TOKENS} w from documents), s as (select doc_id, len(w) dl from t), a as (select count(*) n, avg(dl) avgdl from s),
p as (select term, doc_id, count(*) tf from (select doc_id, unnest(w) term from t) group by 1, 2), f as (select term, count(*) df from p group by 1),
q as (select distinct item_id, unnest({TOKENS}) term from benchmark),
b as (select item_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) score from q join p using (term) join f using (term) join s using (doc_id), a group by 1, 2)"""


@query(f"with {BM25} select item_id, doc_id, score, rank from (select *, row_number() over (partition by item_id order by score desc, doc_id)::int rank from b) where rank <= 10")
def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    return search.ranked(search.bm25(table(spark, d, "documents"), table(spark, d, "benchmark"), "doc_id", "item_id", tokenise=search.ascii_tokens), ["item_id"], "doc_id", 10)


@unmatched
def bm25_topk_words(spark: SparkSession, d: str) -> DataFrame:
    """bm25_topk of whole words; items have no language, so both sides are told none."""
    return search.ranked(search.bm25(table(spark, d, "documents"), table(spark, d, "benchmark"), "doc_id", "item_id"), ["item_id"], "doc_id", 10)


COSINE = "select vec_id, round(list_dot_product(embedding::double[], (select embedding::double[] from embeddings where vec_id = 7)), 6) score from embeddings"


@query(f"select vec_id, score from ({COSINE}) order by score desc, vec_id limit 10")
def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    return _nearest(spark, d, "vec_id = 7", 10).orderBy("rank").select("vec_id", "score")


def _nearest(spark: SparkSession, d: str, asked: str, k: int) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", "embedding")
    return search.nearest(rows, rows.where(asked).withColumnRenamed("vec_id", "query_id"), k)


EVERY = """select query_id, vec_id, score, row_number() over (partition by query_id order by score desc, vec_id)::int rank from (select q.vec_id query_id, c.vec_id,
round(list_dot_product(c.embedding::double[], q.embedding::double[]), 6) score from embeddings q, embeddings c"""


@query(f"select * from ({EVERY} where q.vec_id % 100 = 0)) where rank <= 10")
def cosine_topk_all(spark: SparkSession, d: str) -> DataFrame:
    """cosine_topk for every id divisible by 100."""
    return _nearest(spark, d, "vec_id % 100 = 0", 10)


@query(f"""with {BM25}, l as (select doc_id, row_number() over (order by score desc, doc_id) rank from b where item_id = 3 order by score desc, doc_id limit 30),
v as (select vec_id doc_id, row_number() over (order by score desc, vec_id) rank from ({COSINE}) order by score desc, vec_id limit 30)
select doc_id, round(sum(1.0::double / (60 + rank)), 8) score from (select * from l union all select * from v) group by 1 order by score desc, doc_id limit 10""")
def rrf_fusion(spark: SparkSession, d: str) -> DataFrame:
    lexical = search.bm25(table(spark, d, "documents"), table(spark, d, "benchmark").where("item_id = 3"), "doc_id", "item_id", tokenise=search.ascii_tokens).select("doc_id", "score")
    dense = _nearest(spark, d, "vec_id = 7", 30).withColumnRenamed("vec_id", "doc_id")
    return search.fuse([search.ranked(lexical.withColumn("one", F.lit(1)), ["one"], "doc_id", 30), dense], "doc_id", 10)


@query(f"""with {BM25}, l as (select item_id, doc_id, row_number() over (partition by item_id order by score desc, doc_id) rank from b),
v as (select query_id - 4 item_id, vec_id doc_id, rank from ({EVERY} where q.vec_id - 4 in (select item_id from benchmark)))),
u as (select item_id, doc_id, round(sum(1.0::double / (60 + rank)), 8) score from (select * from l where rank <= 30 union all select * from v where rank <= 30) group by 1, 2)
select * from (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id)::int rank from u) where rank <= 10""")
def rrf_fusion_all(spark: SparkSession, d: str) -> DataFrame:
    """rrf_fusion for every benchmark item: item i asks with vector i + 4, as item 3 does with vector 7."""
    items, rows = table(spark, d, "benchmark"), table(spark, d, "embeddings").select("vec_id", "embedding")
    lexical = search.ranked(search.bm25(table(spark, d, "documents"), items, "doc_id", "item_id", tokenise=search.ascii_tokens), ["item_id"], "doc_id", 30)
    asked = rows.select((F.col("vec_id") - 4).alias("item_id"), "embedding").join(items.select("item_id"), "item_id", "left_semi")
    dense = search.nearest(rows, asked, 30, query="item_id").withColumnRenamed("vec_id", "doc_id")
    return search.fuse([lexical, dense], "doc_id", 10, by=["item_id"])


REASON = """case when trim(coalesce(text, ''), ' ') = '' then 'kept' when regexp_matches(trim(text, ' '), '^\\[[a-z ]+\\]$') then 'placeholder'
when len(regexp_split_to_array(trim(text, ' '), '[ \\t\\n]+')) < 25 and regexp_matches(trim(text, ' '), '\\|.*\\||\\.{4,}|_{4,}') then 'table'
when len(regexp_split_to_array(trim(text, ' '), '[ \\t\\n]+')) < 25 and length(regexp_replace(trim(text, ' '), '[^0-9A-Za-z]', '', 'g')) > 0
 and length(regexp_replace(trim(text, ' '), '[^0-9]', '', 'g')) / length(regexp_replace(trim(text, ' '), '[^0-9A-Za-z]', '', 'g')) > 0.3 then 'digits' else 'kept' end"""


@query(f"select {REASON} reason, count(*)::bigint n from documents group by 1")
def exclusion_reason(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy(F.coalesce(search.exclusion_reason(F.col("text")), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


HYBRID = f"""with {BM25},
d as (select * from (select doc_id, lang, source, {REASON} reason from documents) where reason = 'kept' and doc_id not in (select doc_id from labels where quality = 0 and doc_id is not null)),
i as (select item_id, doc_id, lang, source from benchmark, d where item_id % 3 = 0 or (item_id % 3 = 1 and length(source) = 4) or (item_id % 3 = 2 and right(source, 1) = '7')),
l as (select item_id, doc_id, row_number() over (partition by item_id order by score desc, doc_id) rank from b semi join i using (item_id, doc_id) where item_id % 10 <> 9),
u as (select vec_id doc_id, case when label % 3 <> 0 then embedding else list_reverse(embedding) end::double[] v from embeddings),
v as (select item_id, doc_id, row_number() over (partition by item_id order by round(list_cosine_similarity(u.v, e.embedding::double[]), 6) desc, doc_id) rank from i join u using (doc_id) join embeddings e on e.vec_id = item_id + 4),
w as (select item_id, doc_id, round(sum(1.0::double / (60 + rank)), 8) score from (select * from l where rank <= 50 union all select * from v where rank <= 50 and item_id in (select item_id from l)) group by 1, 2
 union all select item_id, doc_id, 0.0::double from v where rank <= 10 and item_id not in (select item_id from l)),
r as (select w.item_id, w.doc_id, w.score, row_number() over (partition by w.item_id order by w.score desc, coalesce(case when w.score = 0 then v.rank end, 0), w.doc_id)::int rank from w left join v on v.item_id = w.item_id and v.doc_id = w.doc_id)
select item_id, doc_id, score, rank, lang, source from r join i using (item_id, doc_id) where rank <= 10"""


@query(HYBRID)
def hybrid_scoped(spark: SparkSession, d: str) -> DataFrame:
    """Every benchmark item in its scope of sources: poor documents and placeholders stay out, items without a text are answered by vectors alone.

    Vectors are of a new model where label % 3 isn't 0; an old model, here the reversed vectors, stands in for the others.
    """
    return _hybrid(spark, d, search.ascii_tokens)


@unmatched
def hybrid_scoped_stems(spark: SparkSession, d: str) -> DataFrame:
    """hybrid_scoped of the stems of whole words: documents by their language, items by every language of their scope."""
    return _hybrid(spark, d, lambda text: search.tokens(text, F.col("lang"), ALL_STEMMERS))


def _hybrid(spark: SparkSession, d: str, tokenise) -> DataFrame:
    docs, items, rows = table(spark, d, "documents"), table(spark, d, "benchmark"), table(spark, d, "embeddings")
    poor = table(spark, d, "labels").where("quality = 0").select("doc_id", F.lit(False).alias("normative")).distinct()
    excluded = search.exclusion_reason(F.col("text")).isNotNull().alias("excluded")
    found = docs.join(poor, "doc_id", "left").select(F.col("doc_id").alias("unit"), F.col("source").alias("version"), "text", "lang", F.lit("document").alias("kind"), F.coalesce("normative", F.lit(True)).alias("normative"), excluded)
    new = rows.where("label % 3 <> 0").select(F.col("vec_id").alias("unit"), F.lit("new").alias("model"), F.col("embedding").alias("vector"))
    vectors = new.unionByName(rows.select(F.col("vec_id").alias("unit"), F.lit("old").alias("model"), F.reverse("embedding").alias("vector")))
    asked = items.select(F.col("item_id").alias("query"), (F.col("item_id") % 3).alias("scope"), F.when(F.col("item_id") % 10 != 9, F.col("text")).alias("text"))
    asked = asked.join(rows.select((F.col("vec_id") - 4).alias("query"), F.col("embedding").alias("vector")), "query", "left")
    held = [F.lit(0), F.when(F.length("source") == 4, 1), F.when(F.right("source", F.lit(1)) == "7", 2)]
    scopes = docs.select("source").distinct().select(F.explode(F.array_compact(F.array(*held)).cast("array<long>")).alias("scope"), F.col("source").alias("version"))
    best = retrieval.hybrid(found, vectors, asked, scopes, 10, 50, "new", "old", tokenise=tokenise)
    told = retrieval.enriched(best, docs.select(F.col("doc_id").alias("unit"), "lang", "source"), [])
    return told.select(F.col("query").alias("item_id"), F.col("unit").alias("doc_id"), "score", "rank", "lang", "source")


EDGES = "e as (select p_partkey src, (p_partkey * 7 + 3) % (select count(*) from part) dst from part union all select p_partkey, p_partkey // 2 from part where p_size % 3 = 0)"


def _edges(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select("p_partkey", "p_size")
    n = parts.count()
    one = parts.select(F.col("p_partkey").alias("src"), (F.col("p_partkey") * 7 + 3) % n)
    return one.union(parts.where("p_size % 3 = 0").select("p_partkey", F.expr("p_partkey div 2"))).toDF("src", "dst")


@query(f"""with recursive {EDGES}, w as (select 1 as depth, src, dst, [src] visited from e where src in (5, 17) and dst <> src
union all select depth + 1, e.src, e.dst, list_append(visited, e.src) from w join e on e.src = w.dst where depth < 6 and not list_contains(list_append(visited, e.src), e.dst))
select depth, src, dst from w""")
def citation_walk_out(spark: SparkSession, d: str) -> DataFrame:
    start = spark.createDataFrame([(5,), (17,)], "node long")
    return graph.walk(_edges(spark, d), start, 6)


CITED = """e as (select l_orderkey * 10 + l_linenumber as edge_id, l_suppkey as src, case when l_returnflag <> 'R' then l_partkey % (select count(*) from supplier) + 1 end as dst, case when l_quantity > 49 then 'amends' when l_quantity > 48.5 then 'repeals' else 'cites' end as edge_class from lineitem where l_quantity > 49),
j as (select s_suppkey node from supplier where s_nationkey <> 7)"""


def _cited(spark: SparkSession, d: str) -> DataFrame:
    lines, n = table(spark, d, "lineitem"), table(spark, d, "supplier").count()
    target = F.when(F.col("l_returnflag") != "R", F.col("l_partkey") % n + 1)
    kind = F.when(F.col("l_quantity") > 49, "amends").when(F.col("l_quantity") > 48.5, "repeals").otherwise("cites")
    return lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("edge_id"), F.col("l_suppkey").alias("src"), target.alias("dst"), kind.alias("edge_class"))


def _chain(spark: SparkSession, d: str, inbound: bool) -> DataFrame:
    suppliers = table(spark, d, "supplier")
    return graph.citation_chain(_cited(spark, d), suppliers.select(F.col("s_suppkey").alias("node")), inbound, 3, ["amends"], suppliers.where("s_nationkey <> 7").select(F.col("s_suppkey").alias("node")))


def _chain_sql(near: str, far: str) -> str:
    return f"""with recursive {CITED}, h as (select edge_id, edge_class, {near} near, {far} node from e where {near} is not null and ({far} in (select node from j){' or dst is null' if far == 'dst' else ''})),
w as (select near as start, edge_id, edge_class, node, 1 as depth, [near] visited from h where near in (select s_suppkey from supplier)
union all select w.start, h.edge_id, h.edge_class, h.node, depth + 1, list_append(visited, h.near) from w join h on h.near = w.node where depth < 3 and not list_contains(visited, h.near))
select start, edge_id, edge_class, node, depth, bool_or(depth = 3) over (partition by start) as truncated from w"""


@query(_chain_sql("src", "dst"))
def citation_chain_out(spark: SparkSession, d: str) -> DataFrame:
    return _chain(spark, d, False)


@query(_chain_sql("dst", "src"))
def citation_chain_in(spark: SparkSession, d: str) -> DataFrame:
    return _chain(spark, d, True)


@query("""with recursive n as (select p_partkey node, nullif(p_partkey // 2, 0) parent, case when p_size % 7 = 0 then p_brand end v from part),
w as (select node, v, parent, 0 as hops from n union all select w.node, n.v, n.parent, hops + 1 from w join n on n.node = w.parent where w.v is null) select node, v as value, hops from w where v is not null""")
def nearest_nonnull_ancestor(spark: SparkSession, d: str) -> DataFrame:
    half = F.expr("nullif(p_partkey div 2, 0)")
    return graph.nearest_value(table(spark, d, "part").select(F.col("p_partkey").alias("node"), half.alias("parent"), F.when(F.col("p_size") % 7 == 0, F.col("p_brand")).alias("value")))


@query(f"with {EDGES} select dst, count(*)::bigint n, count(distinct src)::bigint sources from e where src <> dst group by 1")
def counterparty_counts(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d).where("src <> dst").groupBy("dst").agg(F.count("*").alias("n"), F.count_distinct("src").alias("sources"))


EFFECTS = "x as (select l_orderkey unit, case l_returnflag when 'R' then 'repeal' when 'A' then 'substitution' else case when l_linenumber % 2 = 0 then 'commencement' else 'other' end end action, case when l_linenumber % 5 <> 0 then l_shipdate end date, l_tax <= 0.06 applied from lineitem)"


def _effects(spark: SparkSession, d: str) -> DataFrame:
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    action = F.when(flag == "R", "repeal").when(flag == "A", "substitution").when(line % 2 == 0, "commencement").otherwise("other")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("unit"), action.alias("action"), F.when(line % 5 != 0, F.col("l_shipdate")).alias("date"), (F.col("l_tax") <= 0.06).alias("applied"))


@query(f"""with {EFFECTS}, g as (select unit, count(*) filter (action = 'repeal' and date <= '1996-06-30' and applied) r, count(*) filter (action = 'substitution' and date <= '1996-06-30' and applied) s,
count(*) filter (action = 'other' and date <= '1996-06-30' and applied) o, count(*) filter (action = 'commencement' and applied) c, count(*) filter (action = 'commencement' and date <= '1996-06-30' and applied) c2 from x group by 1)
select unit, state from (select unit, case when r > 0 then 'repealed' when c > 0 and c2 = 0 then 'not_yet_in_force' when s > 0 then 'text_unapplied' when o > 0 then 'affected' when c2 > 0 then 'in_force' end state from g) where state is not null""")
def state_at(spark: SparkSession, d: str) -> DataFrame:
    return temporal.state_at(_effects(spark, d), F.lit("1996-06-30").cast("timestamp"))


@query(f"""with {EFFECTS}, y as (select * from x where coalesce(applied, true) and unit is not null), k as (select distinct unit, date from y where date is not null union all select distinct unit, null from y),
m as (select k.unit, k.date as day, max(y.date) filter (action = 'repeal' and y.date <= k.date) r, max(y.date) filter (action = 'substitution' and y.date <= k.date) t, max(y.date) filter (action = 'commencement' and y.date <= k.date) c,
 min(y.date) filter (action = 'other' and y.date <= k.date) o, bool_or(action = 'commencement') hc, min(y.date) filter (action = 'commencement' and (k.date is null or y.date > k.date)) nx from k join y on y.unit = k.unit group by 1, 2),
n as (select unit, day, case when r is not null then 'repealed' when hc and c is null then 'not_yet_in_force' when t is not null then 'text_unapplied' when o is not null then 'affected' when c is not null then 'in_force' end state,
 case when r is not null then r when hc and c is null then nx when t is not null then t when o is not null then o else c end since from m),
g as (select *, lag(state) over w ps, lag(since) over w pn, row_number() over w rn from n window w as (partition by unit order by day nulls first))
select unit, state, since, case when state = 'affected' then 'other' end as action, start, until from (select unit, state, since, day as start, lead(day) over (partition by unit order by day nulls first) until
 from g where rn = 1 or state is distinct from ps or since is distinct from pn) where state is not null""")
def state_history(spark: SparkSession, d: str) -> DataFrame:
    return temporal.state_history(_effects(spark, d))


@query(f"""with {EFFECTS} select count(*) filter (unit is null)::bigint no_target, count(*) filter (unit is not null and date is null and not (action = 'commencement' and not applied))::bigint undated, count(*) filter (unit is not null and (date is not null or action = 'commencement') and not applied)::bigint unapplied from x where date is null or date <= '1996-06-30'""")
def hole_counts(spark: SparkSession, d: str) -> DataFrame:
    return temporal.holes(_effects(spark, d), F.lit("1996-06-30").cast("timestamp"))


@query(f"with {EFFECTS} select unit, string_agg(distinct strftime(date, '%Y-%m-%d'), ',' order by strftime(date, '%Y-%m-%d')) dates from x where date is not null group by 1")
def change_dates(spark: SparkSession, d: str) -> DataFrame:
    found = temporal.change_dates(_effects(spark, d).where("date is not null"))
    return found.select("unit", F.array_join(F.array_distinct(F.transform("dates", lambda x: F.date_format(x, "yyyy-MM-dd"))), ",").alias("dates"))


@query("""select l_partkey, l_returnflag, l_suppkey, n from (select *, row_number() over (partition by l_partkey, l_returnflag order by n desc, l_suppkey) rn from (select l_partkey, l_returnflag, l_suppkey, count(*)::bigint n from lineitem group by 1, 2, 3)) where rn = 1""")
def mirror_fold_multiplicity(spark: SparkSession, d: str) -> DataFrame:
    return temporal.fold_mirrors(table(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_suppkey"), ["l_partkey", "l_returnflag"], "l_suppkey")


@query("select case when year(o_orderdate) <= 1993 then 'early' when year(o_orderdate) <= 1996 then 'middle' else 'late' end era, o_orderstatus, count(*)::bigint n from orders group by 1, 2")
def era_bucket(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(temporal.era_of(F.year("o_orderdate"), ERAS).alias("era"), "o_orderstatus").agg(F.count("*").alias("n"))


@query("""select source, count(*) filter (toxic = 1)::bigint failed, count(*) filter (toxic <> 1)::bigint passed, count(*) filter (toxic is null)::bigint not_run,
case when count(toxic) > 0 then round(count(*) filter (toxic = 1) / count(toxic), 6) end rate from documents left join labels using (doc_id) group by 1""")
def tri_state_rates(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id", "left")
    return quality.tri_state_rates(rows, ["source"], F.col("toxic") == 1)


@query("""with g as (select l_suppkey, l_partkey - lag(l_partkey) over (partition by l_suppkey order by l_partkey) - 1 gap, l_partkey from (select distinct l_suppkey, l_partkey from lineitem)),
a as (select l_suppkey, count(*)::bigint numbers, coalesce(sum(gap), 0)::bigint missing, coalesce(max(gap), 0)::bigint longest, max(l_partkey) - min(l_partkey) + 1 span from g group by 1)
select l_suppkey, numbers, missing, longest, case when missing = 0 then 'none' when longest >= 3 or missing / span > 0.30 then 'defect' when longest = 1 and missing <= 3 then 'repeal' else 'ambiguous' end kind from a""")
def gap_runs_classify(spark: SparkSession, d: str) -> DataFrame:
    return quality.number_gaps(table(spark, d, "lineitem"), ["l_suppkey"], "l_partkey")


@query("select l_orderkey, l_linenumber from (select *, lag(l_shipdate) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) b from lineitem) where l_shipdate < b")
def order_breaks(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumn("place", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    return quality.order_breaks(rows, ["l_orderkey"], "place", "l_shipdate").select("l_orderkey", "l_linenumber")


@query("""with f as (select l_orderkey, case l_returnflag when 'R' then 2 when 'A' then 1 else 0 end r, l_linenumber, l_partkey from lineitem)
select l_orderkey, case when r = 2 then 'blocking' else 'warning' end grade, reason from (select l_orderkey, r, l_linenumber as reason, row_number() over (partition by l_orderkey order by r desc, l_linenumber) rn from f where r > 0) where rn = 1""")
def grade_fold(spark: SparkSession, d: str) -> DataFrame:
    flag = F.col("l_returnflag")
    rows = table(spark, d, "lineitem").withColumn("severity", F.when(flag == "R", "error").when(flag == "A", "warning").otherwise("info"))
    return quality.grade(rows, ["l_orderkey"], "severity", "l_linenumber", "l_linenumber")


@query(f"""select doc_id, rate, case when rate >= 120 then 'good' when rate >= 80 then 'fair' when rate >= 40 then 'poor' when rate is not null then 'illegible' end band from (select doc_id, case when len(w) >= 200 then
round(len(list_filter(w, lambda x: x in ({", ".join(f"'{w}'" for w in COMMON)}))) * 1000 / len(w), 6) end rate from (select doc_id, {TOKENS} w from documents))""")
def legibility_rates(spark: SparkSession, d: str) -> DataFrame:
    return _legibility(table(spark, d, "documents").select("doc_id", search.ascii_tokens(F.col("text")).alias("words")))


@unmatched
def legibility_words(spark: SparkSession, d: str) -> DataFrame:
    """legibility_rates of whole words."""
    return _legibility(table(spark, d, "documents").select("doc_id", search.tokens(F.col("text")).alias("words")))


def _legibility(rows: DataFrame) -> DataFrame:
    rated = rows.select("doc_id", quality.rate_per_thousand(F.col("words"), COMMON, 200).alias("rate"))
    return rated.withColumn("band", quality.band(F.col("rate")))


@query(f"""with t as (select doc_id, list_distinct({TOKENS}) w from documents) select a.doc_id, case when len(a.w) > 0 and len(b.w) > 0 then
round(1 - len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))), 6) end divergence from t a join t b on b.doc_id = a.doc_id + 1""")
def jaccard_divergence(spark: SparkSession, d: str) -> DataFrame:
    return _divergence(table(spark, d, "documents").select("doc_id", search.ascii_tokens(F.col("text")).alias("a")))


@unmatched
def divergence_words(spark: SparkSession, d: str) -> DataFrame:
    """jaccard_divergence of whole words, by each document's language."""
    return _divergence(table(spark, d, "documents").select("doc_id", search.tokens(F.col("text"), F.col("lang")).alias("a")))


def _divergence(rows: DataFrame) -> DataFrame:
    rows = rows.select("doc_id", F.array_distinct("a").alias("a"))
    after = rows.select((F.col("doc_id") - 1).alias("doc_id"), F.col("a").alias("b"))
    return rows.join(after, "doc_id").select("doc_id", quality.divergence(F.col("a"), F.col("b")).alias("divergence"))


@query("""select conv_id, case when a + p + g < 5 then 'inconclusive' when p = 0 and g = 0 then 'fully_aligned' when (a + 0.5 * p) / (a + p + g) >= 0.85 then 'largely_aligned' when (a + 0.5 * p) / (a + p + g) >= 0.5 then 'partially_aligned' else 'not_aligned' end as level
from (select conv_id, count(*) filter (role = 'assistant') a, count(*) filter (role = 'user') p, count(*) filter (role = 'system') g from conversations group by 1)""")
def alignment_level(spark: SparkSession, d: str) -> DataFrame:
    each = relational.pivot_counts(table(spark, d, "conversations"), ["conv_id"], "role", {"assistant": "a", "user": "p", "system": "g"})
    return each.select("conv_id", quality.alignment_level(F.col("a"), F.col("p"), F.col("g")).alias("level"))


KEPT = "list_filter(f.kept, lambda x: x >= o.t - 3600000000)"


@query(f"""with recursive o as (select user_id, event_id, epoch_us(ts) t, row_number() over (partition by user_id order by epoch_us(ts), event_id) rn from events),
f as (select user_id, event_id, rn, 0::bigint recent, [t] kept from o where rn = 1 union all
select o.user_id, o.event_id, o.rn, len({KEPT})::bigint, case when len({KEPT}) < 2 then list_append({KEPT}, o.t) else {KEPT} end from f join o on o.user_id = f.user_id and o.rn = f.rn + 1)
select event_id, user_id, recent, recent < 2 as allowed from f""")
def rate_limit(spark: SparkSession, d: str) -> DataFrame:
    return feed.within_limit(table(spark, d, "events").select("event_id", "user_id", "ts"), 3600, 2)


@query("select user_id, coalesce(arg_max(event_type, event_id) filter (event_type = 'purchase'), arg_max(event_type, event_id)) state, count(*)::bigint n from events group by 1")
def run_state_fold(spark: SparkSession, d: str) -> DataFrame:
    return feed.run_states(table(spark, d, "events"), "user_id", "event_id", "event_type", ["purchase"])


RUN_EVENTS = """l as (select user_id * 8 + event_id % 8 as run, ts, event_id as seq, floor(value)::bigint amount,
case event_type when 'click' then 'start' when 'view' then 'claim' when 'purchase' then 'succeed' when 'error' then case when event_id // 8 % 2 = 0 then 'fail' else 'cancel' end
else case event_id // 8 % 4 when 0 then 'seal' when 1 then 'count' when 2 then 'reopen' else 'pause' end end as kind from events where user_id is not null and ts is not null),
o as (select *, row_number() over (partition by run order by ts, seq) rn from l),
w as (select run, 0::bigint rn, null::timestamp ts, null::bigint seq, '' kind, 'queued' before, 'queued' after, false started, 0::bigint items, false accepted, null::bigint item from (select distinct run from o)
union all select o.run, o.rn, o.ts, o.seq, o.kind, w.after, case when o.kind = 'start' and w.after in ('queued', 'running') then 'running'
when o.kind in ('succeed', 'fail', 'cancel') and w.after in ('queued', 'running') then case o.kind when 'succeed' then 'succeeded' when 'fail' then 'failed' else 'cancelled' end
when o.kind = 'reopen' and not w.started and w.after = 'failed' then 'queued' else w.after end,
w.started or (o.kind = 'start' and w.after in ('queued', 'running')), case o.kind when 'claim' then w.items + 1 when 'count' then o.amount else w.items end,
case when o.kind in ('claim', 'seal', 'count') then true when o.kind in ('start', 'succeed', 'fail', 'cancel') then w.after in ('queued', 'running') when o.kind = 'reopen' then not w.started and w.after in ('queued', 'failed') else false end,
case when o.kind = 'claim' then w.items end from w join o on o.run = w.run and o.rn = w.rn + 1)"""


def run_events(rows: DataFrame) -> DataFrame:
    """run, ts, seq, kind and amount from the event log."""
    turn = F.expr("event_id div 8")
    ends = F.when(turn % 2 == 0, "fail").otherwise("cancel")
    rest = F.when(turn % 4 == 0, "seal").when(turn % 4 == 1, "count").when(turn % 4 == 2, "reopen").otherwise("pause")
    kind = F.when(F.col("event_type") == "click", "start").when(F.col("event_type") == "view", "claim").when(F.col("event_type") == "purchase", "succeed").when(F.col("event_type") == "error", ends).otherwise(rest)
    return rows.select((F.col("user_id") * 8 + F.col("event_id") % 8).alias("run"), "ts", F.col("event_id").alias("seq"), kind.alias("kind"), F.floor("value").cast("long").alias("amount"))


@query(f"with recursive {RUN_EVENTS} select run, seq, kind, before, after, accepted, item from w where rn > 0")
def run_transitions(spark: SparkSession, d: str) -> DataFrame:
    return runs.transitions(run_events(table(spark, d, "events"))).drop("ts")


@query(f"""with recursive {RUN_EVENTS} select run, max_by(after, rn) status, min(ts) filter (where accepted and kind = 'start') started_at,
case when max_by(after, rn) in ('succeeded', 'failed', 'cancelled') then max(ts) filter (where accepted and kind in ('succeed', 'fail', 'cancel')) end completed_at,
count(*) filter (where kind = 'claim')::bigint claims, coalesce(bool_or(kind = 'seal'), false) sealed, count(*)::bigint events, count(*) filter (where not accepted)::bigint refused from w where rn > 0 group by run""")
def run_machine(spark: SparkSession, d: str) -> DataFrame:
    return runs.states(runs.transitions(run_events(table(spark, d, "events"))))


@query("select time_bucket(interval 1 hour, ts) as start, event_type, count(*)::bigint n, round(sum(value), 4) total from events group by 1, 2")
def tumbling_counts(spark: SparkSession, d: str) -> DataFrame:
    return feed.tumbling_counts(table(spark, d, "events"))


@query("""select user_id, min(ts) as start, count(*)::bigint n from (select *, sum(fresh) over (partition by user_id order by ts, event_id) s from (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) < interval 30 minute then 0 else 1 end fresh from events)) group by user_id, s""")
def session_counts(spark: SparkSession, d: str) -> DataFrame:
    return feed.sessions(table(spark, d, "events"))


VERDICTS = "x as (select l_suppkey, case l_returnflag when 'N' then 'aligned' when 'A' then 'partial' else 'gap' end verdict, l_linestatus || l_linenumber::varchar as label, l_orderkey * 10 + l_linenumber as place from lineitem)"


@query(f"""with {VERDICTS}, c as (select l_suppkey, count(*) filter (verdict = 'aligned')::bigint aligned, count(*) filter (verdict = 'partial')::bigint partial, count(*) filter (verdict = 'gap')::bigint gap from x group by 1),
g as (select l_suppkey, label, row_number() over (partition by l_suppkey order by min(place), label) rn from x where verdict = 'gap' group by 1, 2), l as (select l_suppkey, string_agg(label, ',' order by rn) gaps from g where rn <= 8 group by 1)
select l_suppkey, aligned, partial, gap, round(100 * aligned / (aligned + partial + gap), 1) aligned_pct, round(100 * partial / (aligned + partial + gap), 1) partial_pct, round(100 * gap / (aligned + partial + gap), 1) gap_pct,
case when aligned + partial + gap < 5 then 'inconclusive' when partial = 0 and gap = 0 then 'fully_aligned' when (aligned + 0.5 * partial) / (aligned + partial + gap) >= 0.85 then 'largely_aligned' when (aligned + 0.5 * partial) / (aligned + partial + gap) >= 0.5 then 'partially_aligned' else 'not_aligned' end as level,
coalesce(gaps, '') gaps from c left join l using (l_suppkey)""")
def alignment_summary(spark: SparkSession, d: str) -> DataFrame:
    flag = F.col("l_returnflag")
    rows = table(spark, d, "lineitem").select("l_suppkey", F.when(flag == "N", "aligned").when(flag == "A", "partial").otherwise("gap").alias("verdict"), F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("label"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("place"))
    return quality.alignment_summary(rows, ["l_suppkey"], "verdict", "label", "place")


@query("""select c_custkey, c_acctbal from (select c_custkey, case when c_custkey % 5 > 0 then c_acctbal end c_acctbal from customer) where c_acctbal < 5000 or c_acctbal is null order by c_acctbal desc nulls last, c_custkey limit 21""")
def keyset_nulls_last(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 > 0, F.col("c_acctbal")).alias("c_acctbal"))
    return relational.keyset_after(rows, [("c_acctbal", False), ("c_custkey", True)], {"c_acctbal": 5000.0, "c_custkey": 2**62}, 20)


@query("""select c_custkey, c_nationkey from customer where c_nationkey < 12 or (c_nationkey = 12 and c_custkey > 40) order by c_nationkey desc, c_custkey limit 31""")
def keyset_mixed_directions(spark: SparkSession, d: str) -> DataFrame:
    return relational.keyset_after(table(spark, d, "customer").select("c_custkey", "c_nationkey"), [("c_nationkey", False), ("c_custkey", True)], {"c_nationkey": 12, "c_custkey": 40}, 30)


@query("""with v as (select o_orderkey, o_custkey, case when o_orderkey % 3 = 0 then 'fr' else 'en' end as language, case when o_orderkey % 3 = 0 then o_orderkey - 1 end parent, o_orderdate from orders)
select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by (language = 'fr') desc, o_orderdate desc, o_orderkey) rn from v where language = 'fr' or parent is null) where rn = 1""")
def latest_by_language(spark: SparkSession, d: str) -> DataFrame:
    french = F.col("o_orderkey") % 3 == 0
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.when(french, "fr").otherwise("en").alias("language"), F.when(french, F.col("o_orderkey") - 1).alias("parent"))
    return relational.latest_in_language(rows, "o_custkey", "fr", F.desc("o_orderdate"), F.asc("o_orderkey")).select("o_custkey", "o_orderkey")


@query("select p_partkey, round(p_retailprice - p_size * 0.35, 6) adjusted from (select * from part order by p_retailprice desc, p_partkey limit 200) order by adjusted desc, p_partkey")
def bounded_rerank(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", "p_retailprice", "p_size")
    return relational.reranked(rows, "p_retailprice", "p_size", "p_partkey").select("p_partkey", "adjusted")


@query("select o_orderkey from orders where o_orderstatus in ('F', 'P') union all select o_orderkey from orders where false")
def scope_fail_closed(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return relational.scoped(rows, "o_orderstatus", ["F", "P"]).union(relational.scoped(rows, "o_orderstatus", [])).select("o_orderkey")


@query("""select o_custkey, sum(n)::bigint n, string_agg(o_orderstatus || ':' || n, ',' order by o_orderstatus) classes from (select o_custkey, o_orderstatus, count(*)::bigint n from orders group by 1, 2) group by 1""")
def class_map_counts(spark: SparkSession, d: str) -> DataFrame:
    counted = relational.counts_map(table(spark, d, "orders"), ["o_custkey"], "o_orderstatus")
    return counted.select("o_custkey", "n", F.array_join(F.transform(F.map_entries("classes"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",").alias("classes"))


@query("""with a as (select o_orderkey k, o_orderstatus s from orders where o_orderkey % 7 > 0), b as (select o_orderkey k, case when o_orderkey % 4 = 0 then 'X' else o_orderstatus end s from orders where o_orderkey % 5 > 0)
select * from (select coalesce(a.k, b.k) o_orderkey, case when b.k is null then 'gone' when a.k is null then 'new' when a.s <> b.s then 'changed' end as change from a full join b on a.k = b.k) where change is not null""")
def skeleton_diff(spark: SparkSession, d: str) -> DataFrame:
    rows, key = table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), F.col("o_orderkey")
    after = rows.where(key % 5 > 0).withColumn("o_orderstatus", F.when(key % 4 == 0, "X").otherwise(F.col("o_orderstatus")))
    return relational.set_difference(rows.where(key % 7 > 0), after, ["o_orderkey"], ["o_orderstatus"])


@query("""with p as (select p_partkey, 'part_' || (p_partkey % 3)::varchar || '__sec_' || (p_partkey % 11)::varchar || case when p_partkey % 2 = 0 then '__art_' || p_partkey::varchar else '' end as path from part)
select p_partkey, array_to_string(split(path, '__')[:-2], '__') parent, split(path, '__')[-1] as last, len(split(path, '__'))::int depth, path = 'part_1__sec_1' or starts_with(path, 'part_1__sec_1__') inside from p""")
def path_functions(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("p_partkey")
    path = F.concat(F.lit("part_"), (key % 3).cast("string"), F.lit("__sec_"), (key % 11).cast("string"), F.when(key % 2 == 0, F.concat(F.lit("__art_"), key.cast("string"))).otherwise(""))
    rows = table(spark, d, "part").select(key, path.alias("path"))
    return rows.select("p_partkey", paths.parent_path(F.col("path")).alias("parent"), paths.last_segment(F.col("path")).alias("last"), F.size(paths.ancestors(F.col("path"))).alias("depth"), paths.in_subtree(F.col("path"), "part_1__sec_1").alias("inside"))


@query("""select o_orderkey, ltrim((o_orderkey % 1000)::varchar, '0') as number, year(o_orderdate)::int as year from orders where (o_orderkey % 1000) > 0""")
def citation_parse(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("o_orderkey") % 1000
    rows = table(spark, d, "orders").where(n > 0).select("o_orderkey", F.concat(F.lit("Act No. 00"), n.cast("string"), F.lit(" of "), F.year("o_orderdate").cast("string")).alias("text"))
    found = rows.select("o_orderkey", paths.citation(F.col("text")).alias("c"))
    return found.select("o_orderkey", "c.number", "c.year")


@query("""with recursive l as (select p_partkey as start, p_partkey node, 0 as depth from part where p_partkey % 50 = 0 union all select l.start, l.node // 2, depth + 1 from l where l.node // 2 > 0 and depth < 100) select * from l""")
def version_lineage(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "part").select(F.col("p_partkey").alias("node"), F.expr("nullif(p_partkey div 2, 0)").alias("parent"))
    return graph.lineage(nodes, nodes.where("node % 50 = 0"))


@query("select o_orderkey, o_orderstatus from orders where o_orderkey % 3 <> 0 union all select o_orderkey, 'X' from orders where o_orderkey % 3 = 0")
def replace_by_key(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return relational.replace_by_key(rows, rows.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("X")), ["o_orderkey"])


@query("""select coalesce(a.o_orderkey, b.o_orderkey) o_orderkey, case when b.o_orderkey is not null then b.s else a.o_orderstatus end o_orderstatus from (select o_orderkey, o_orderstatus from orders where o_orderkey % 3 <> 0) a
full join (select o_orderkey, case when o_orderkey % 4 = 0 then 'X' end s from orders where o_orderkey % 2 = 0) b on a.o_orderkey = b.o_orderkey""")
def upsert_overwrite(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    batch = rows.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 4 == 0, "X"))
    return relational.upsert(rows.where("o_orderkey % 3 <> 0"), batch, "o_orderkey", fill_nulls=False)


@query("""with p as (select l_partkey, arg_max(l_returnflag, (l_orderkey, l_linenumber)) flag, arg_max(l_linestatus, (l_orderkey, l_linenumber)) decision from lineitem where l_suppkey % 2 = 0 group by 1)
select l_orderkey, l_linenumber, case when l_returnflag = flag then decision end decision from lineitem left join p using (l_partkey) where l_suppkey % 2 = 1""")
def carry_forward(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey", F.col("l_linestatus").alias("decision"))
    new = rows.where("l_suppkey % 2 = 1").drop("decision")
    return relational.carry_forward(new, rows.where("l_suppkey % 2 = 0"), ["l_partkey"], ["l_returnflag"], "decision", F.desc("l_orderkey"), F.desc("l_linenumber")).select("l_orderkey", "l_linenumber", "decision")


@query("""with t as (select doc_id, regexp_extract_all(coalesce(text, ''), '[0-9]+') w from documents) select a.doc_id, case when greatest(len(a.w), len(b.w)) > 0 then
round(coalesce(list_sum(list_transform(list_distinct(list_filter(a.w, lambda x: list_contains(b.w, x))), lambda x: least(len(list_filter(a.w, lambda y: y = x)), len(list_filter(b.w, lambda y: y = x))))), 0) / greatest(len(a.w), len(b.w)), 6) end parity
from t a join t b on b.doc_id = a.doc_id + 1""")
def numeral_parity(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[0-9]+"), F.lit(0)).alias("a"))
    after = rows.select((F.col("doc_id") - 1).alias("doc_id"), F.col("a").alias("b"))
    return rows.join(after, "doc_id").select("doc_id", quality.numeral_parity(F.col("a"), F.col("b")).alias("parity"))


@query("select user_id, event_type, event_id, value from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) rn from events) where rn = 1")
def latest_fetch(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value")
    latest = rows.groupBy("user_id", "event_type").agg(F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id")).alias("last"))
    return latest.select("user_id", "event_type", "last.event_id", "last.value")


@query("select o_orderkey, y from (select o_orderkey, case when o_orderkey % 9 > 0 then year(o_orderdate)::int end y from orders) where y is null or y between 1993 and 1995")
def year_range_keeps_nulls(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 > 0, F.year("o_orderdate")).alias("y"))
    return rows.where(F.col("y").isNull() | F.col("y").between(1993, 1995))


@query("select quality, count(*)::bigint n from labels where quality is distinct from 1 group by 1")
def stale_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").where(~F.col("quality").eqNullSafe(1)).groupBy("quality").agg(F.count("*").alias("n"))


@query("select c_custkey, latest, coalesce(n, 0)::bigint n from customer left join (select o_custkey, max(o_orderdate) latest, count(*) n from orders group by 1) on o_custkey = c_custkey")
def left_latest_dates(spark: SparkSession, d: str) -> DataFrame:
    dates = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("latest"), F.count("*").alias("n"))
    return table(spark, d, "customer").select("c_custkey").join(dates, "c_custkey", "left").select("c_custkey", "latest", F.coalesce("n", F.lit(0)).alias("n"))


@query("""select o_orderkey, count(l_orderkey)::bigint findings, count(*) filter (where l_returnflag = 'R')::bigint critical, count(*) filter (where l_returnflag = 'A')::bigint major
from orders left join lineitem on l_orderkey = o_orderkey group by 1""")
def run_finding_counts(spark: SparkSession, d: str) -> DataFrame:
    counted = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("findings"), F.count_if(F.col("l_returnflag") == "R").alias("critical"), F.count_if(F.col("l_returnflag") == "A").alias("major"))
    return table(spark, d, "orders").select("o_orderkey").join(counted, "o_orderkey", "left").na.fill(0)


@query("select distinct f.l_orderkey from lineitem f left join (select distinct l_orderkey, l_linenumber from lineitem where l_quantity > 5) n on n.l_orderkey = f.l_orderkey and n.l_linenumber = f.l_linenumber where n.l_orderkey is null")
def anti_missing_notes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return units.lacking(rows, rows.where("l_quantity > 5"), ["l_orderkey", "l_linenumber"], "l_orderkey")


@query("""with t as (select l_orderkey, '/act/' || l_suppkey::varchar || '/part_' || (l_linenumber % 3)::varchar || '/art_' || l_linenumber::varchar as uri from lineitem),
w as (select '/act/' || s_suppkey::varchar as work from supplier union all select '/act/' || s_suppkey::varchar || '/part_1' from supplier where s_suppkey % 2 = 0)
select work, count(*)::bigint n, count(distinct l_orderkey)::bigint laws from t join w on starts_with(uri, work || '/') group by 1""")
def uri_prefix_join(spark: SparkSession, d: str) -> DataFrame:
    act = lambda key: F.concat(F.lit("/act/"), F.col(key).cast("string"))
    uri = F.concat(act("l_suppkey"), F.lit("/part_"), (F.col("l_linenumber") % 3).cast("string"), F.lit("/art_"), F.col("l_linenumber").cast("string"))
    held = table(spark, d, "supplier")
    works = held.select(act("s_suppkey").alias("work")).union(held.where("s_suppkey % 2 = 0").select(F.concat(act("s_suppkey"), F.lit("/part_1"))))
    found = units.under_works(table(spark, d, "lineitem").select("l_orderkey", uri.alias("uri")), "uri", works, "work")
    return found.groupBy("work").agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("laws"))


@query("""select event_id, case event_id % 3 when 0 then c_nationkey when 1 then o_custkey else p_size end::bigint as owner from events left join customer on event_id % 3 = 0 and c_custkey = user_id
left join orders on event_id % 3 = 1 and o_orderkey = user_id left join part on event_id % 3 = 2 and p_partkey = user_id""")
def polymorphic_owner(spark: SparkSession, d: str) -> DataFrame:
    part = F.col("event_id") % 3
    rows = table(spark, d, "events").select("event_id", F.when(part == 0, "law").when(part == 1, "version").otherwise("provision").alias("kind"), F.col("user_id").alias("ref"))
    pairs = {"law": ("customer", "c_custkey", "c_nationkey"), "version": ("orders", "o_orderkey", "o_custkey"), "provision": ("part", "p_partkey", "p_size")}
    held = {kind: table(spark, d, name).select(F.col(key).alias("key"), F.col(owner).alias("owner")) for kind, (name, key, owner) in pairs.items()}
    return units.owners(rows, "kind", "ref", held).select("event_id", "owner")


@query("select c.event_id, c.event_type, p.event_type as parent_type from events c join events p on p.event_id = c.event_id // 2 where c.event_id > 0")
def runs_with_parent_kind(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", "event_type")
    parents = rows.select(F.col("event_id").alias("parent"), F.col("event_type").alias("parent_type"))
    return rows.where("event_id > 0").withColumn("parent", F.expr("event_id div 2")).join(parents, "parent").select("event_id", "event_type", "parent_type")


@query("select p_partkey, w[i] as term, i::int ordinal from (select p_partkey, w, unnest(range(1, len(w) + 1)) i from (select p_partkey, string_split(p_type, ' ') w from part))")
def terms_with_ordinality(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.posexplode(F.split("p_type", " ")).alias("place", "term"))
    return rows.select("p_partkey", "term", (F.col("place") + 1).alias("ordinal"))


@query("select l_orderkey, case when bool_or(l_linenumber = 6) then null else round(avg(case when l_returnflag = 'R' then 1.0 else 0.0 end), 6) end as share from lineitem group by 1")
def placeholder_share(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", F.when(F.col("l_linenumber") != 6, F.col("l_returnflag") == "R").alias("flag"))
    return units.placeholder_share(rows, ["l_orderkey"], "flag")


@query("""select (select count(*) from orders)::bigint entries, (select count(*) from orders where o_custkey in (select c_custkey from customer where c_acctbal > 0))::bigint linked,
(select count(distinct o_custkey) from orders)::bigint laws""")
def registry_coverage(spark: SparkSession, d: str) -> DataFrame:
    held = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.lit(1).alias("held"))
    rows = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).join(held, "o_custkey", "left")
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("entries"), F.coalesce(F.sum(F.when(F.col("held") == 1, F.col("n"))), F.lit(0)).alias("linked"), F.count("o_custkey").alias("laws"))


@query("select user_id, count(*)::bigint ref_count, count(*) filter (where event_type like 'p%')::bigint mod_count from events group by 1")
def reference_impact(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("ref_count"), F.count_if(F.col("event_type").like("p%")).alias("mod_count"))


@query("select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by (o_orderkey % 3 > 0) desc, o_orderdate desc, o_orderkey)::int as place from orders")
def recovery_order(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    placed = units.positions(rows, ["o_custkey"], F.desc(F.col("o_orderkey") % 3 > 0), F.desc("o_orderdate"), F.asc("o_orderkey"))
    return placed.select("o_custkey", "o_orderkey", (F.col("position") + 1).alias("place"))


@query("select doc_id, lang, source, (row_number() over (partition by lang, source order by doc_id) - 1)::int as position from documents")
def section_positions(spark: SparkSession, d: str) -> DataFrame:
    return units.positions(table(spark, d, "documents").select("doc_id", "lang", "source"), ["lang", "source"], F.asc("doc_id"))


@query("""with c as (select conv_id, turn, sum(case when role = 'user' then 1 else 0 end) over (partition by conv_id order by turn rows unbounded preceding)::bigint as chapter from (select distinct conv_id, turn, role from conversations))
select conv_id, turn, chapter, ((row_number() over (partition by conv_id, chapter order by turn) - 1) // 2)::int as batch from c""")
def chapter_batches(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role").distinct()
    return units.chapter_batches(rows, ["conv_id"], F.col("role") == "user", 2, F.asc("turn")).select("conv_id", "turn", "chapter", "batch")


SPANS = "s as (select conv_id, turn, size, coalesce(sum(size + 1) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0)::bigint as start from (select conv_id, turn, coalesce(length(text), 0)::bigint as size from conversations))"


@query(f'with {SPANS} select conv_id, turn, start, start + size as "end" from s')
def page_spans(spark: SparkSession, d: str) -> DataFrame:
    return units.page_spans(table(spark, d, "conversations"), "conv_id", "turn", "text")


@query(f'with {SPANS} select conv_id, o as "offset", turn from s join (select distinct conv_id, conv_id % 97 * 5 as o from conversations) using (conv_id) where start <= o and o < start + size')
def offset_to_page(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations")
    asked = rows.select("conv_id", (F.col("conv_id") % 97 * 5).alias("offset")).distinct()
    return units.page_of(asked, units.page_spans(rows, "conv_id", "turn", "text"), "conv_id", "offset").select("conv_id", "offset", "turn")


@query("select l_orderkey, l_linenumber, l_extendedprice from lineitem order by l_orderkey, l_linenumber, l_extendedprice limit 50 offset 100")
def windowed_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rows.orderBy("l_orderkey", "l_linenumber", "l_extendedprice").offset(100).limit(50)


@query("select lang as language from documents where lang is not null union select unnest(json_keys(props)) from events")
def languages_and_keys(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "events").select(F.explode(F.json_object_keys("props")).alias("language"))
    return table(spark, d, "documents").where("lang is not null").select(F.col("lang").alias("language")).union(keys).distinct()


@query("""with m as (select * from orders where o_orderstatus = 'F'), l as (select o_custkey, count(*)::bigint matches from m group by 1 order by matches desc, o_custkey limit 20)
select o_custkey, matches, o_orderkey, rank from (select m.o_custkey, matches, o_orderkey, row_number() over (partition by m.o_custkey order by o_totalprice desc, o_orderkey)::int rank from m join l on l.o_custkey = m.o_custkey) where rank <= 3""")
def grouped_search(spark: SparkSession, d: str) -> DataFrame:
    matches = table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", "o_totalprice")
    found = units.grouped_matches(matches, "o_custkey", 20, [F.desc("matches"), F.asc("o_custkey")], 3, [F.desc("o_totalprice"), F.asc("o_orderkey")])
    return found.select("o_custkey", "matches", "o_orderkey", "rank")


@query("""with c as (select p_partkey, lpad((p_partkey * 37 % 10000)::varchar, 4, '0') as code from part), a as (select distinct lpad((s_suppkey % 100)::varchar, 2, '0') as asked from supplier union select '0037')
select p_partkey, asked, asked = code as exact from c join a on starts_with(code, asked)""")
def goods_code_lookup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.lpad((F.col("p_partkey") * 37 % 10000).cast("string"), 4, "0").alias("code"))
    asked = table(spark, d, "supplier").select(F.lpad((F.col("s_suppkey") % 100).cast("string"), 2, "0").alias("asked")).union(spark.range(1).select(F.lit("0037"))).distinct()
    return units.code_matches(rows, "code", asked, "asked").select("p_partkey", "asked", "exact")


@query("select event_id, user_id, event_type from events where event_type in ('purchase', 'error') and ts >= timestamp '2024-01-03 00:00:00'")
def feed_filters(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").where(F.col("event_type").isin("purchase", "error") & (F.col("ts") >= F.lit("2024-01-03 00:00:00").cast("timestamp")))
    return rows.select("event_id", "user_id", "event_type")


@query("select event_id, user_id from events where user_id in (3, 5, 8)")
def scoped_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", "user_id")
    return checks.scoped(rows, "user_id", [3, 5, 8]).union(checks.scoped(rows, "user_id", []))


@query("select event_id from events where coalesce(json_extract_string(props, '$.k') = '7', false)")
def json_containment(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where(checks.holds(F.col("props"), {"k": "7"})).select("event_id")


@query("select o_orderkey, nullif(year(o_orderdate), 1995)::int as year from orders where nullif(year(o_orderdate), 1995) is null or nullif(year(o_orderdate), 1995) >= 1997")
def year_or_unknown(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", F.nullif(F.year("o_orderdate"), F.lit(1995)).alias("year"))
    return rows.where(checks.from_year(F.col("year"), 1997))


@query("select o_orderstatus, count(*) filter (where nullif(o_orderkey % 4, 3) is distinct from 2)::bigint as stale from orders group by 1")
def stale_rows(spark: SparkSession, d: str) -> DataFrame:
    version = F.nullif(F.col("o_orderkey") % 4, F.lit(3))
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count_if(checks.stale(version, F.lit(2))).alias("stale"))


@query("select p_partkey from part where list_has_any(string_split(p_name, ' '), ['cold']) or (ltrim(lpad(p_partkey::varchar, 6, '0'), '0') = '17' and 1990 + p_size = 1990 + (select p_size from part where p_partkey = 17))")
def title_or_citation(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", "p_name", (F.col("p_size") + 1990).alias("year"))
    cited = rows.where("p_partkey = 17").first()
    found = checks.title_or_citation(F.split("p_name", " "), ["cold"], F.lpad(F.col("p_partkey").cast("string"), 6, "0"), F.col("year"), cited and ("0017", cited["year"]))
    return rows.where(found).select("p_partkey")


UNITS = "u as (select user_id % 5 as doc, 'art_' || (event_id % 20) || '__para_' || (event_id % 23) as path from events)"


def _units(spark: SparkSession, d: str) -> DataFrame:
    number = lambda n: (F.col("event_id") % n).cast("string")
    return table(spark, d, "events").select((F.col("user_id") % 5).alias("doc"), F.concat(F.lit("art_"), number(20), F.lit("__para_"), number(23)).alias("path"))


@query(f"""with {UNITS}, v as (select distinct doc, path from u), a as (select distinct user_id % 5 as doc, unnest(['para_' || (user_id % 30), 'art_3__para_3']) as wanted from events),
m as (select a.doc, wanted, max(path) filter (path = wanted) as exact, count(*) n, min(path) as least from a join v on a.doc = v.doc and (path = wanted or ends_with(path, '__' || wanted)) group by 1, 2)
select doc, wanted, coalesce(exact, case when n = 1 then least end) as path from a left join m using (doc, wanted)""")
def unit_lookup(spark: SparkSession, d: str) -> DataFrame:
    users = table(spark, d, "events").select("user_id").distinct()
    wanted = F.explode(F.array(F.concat(F.lit("para_"), (F.col("user_id") % 30).cast("string")), F.lit("art_3__para_3")))
    asked = users.select((F.col("user_id") % 5).alias("doc"), wanted.alias("wanted")).distinct()
    return checks.units_found(asked, _units(spark, d), "doc", "wanted", "path").select("doc", "wanted", "path")


@query(f"""with {UNITS} select doc, 'para' as kind, count(*)::bigint n, array_to_string(list_sort(list(distinct split_part(path, '__para_', 2)::int)), ',') as numbers from u group by 1""")
def units_by_kind(spark: SparkSession, d: str) -> DataFrame:
    return checks.kinds(_units(spark, d), "doc", "path")


@query(f"with {UNITS} select doc, path, count(*)::bigint n from u group by 1, 2 having count(*) > 1")
def duplicate_unit_paths(spark: SparkSession, d: str) -> DataFrame:
    return checks.duplicate_paths(_units(spark, d), "doc", "path")


@query("""with s as (select l_suppkey as k, l_linenumber as amount, count(*) n from lineitem where l_returnflag = 'R' group by 1, 2), t as (select l_suppkey as k, l_linenumber as amount, count(*) n from lineitem where l_returnflag = 'A' group by 1, 2)
select k, amount, greatest(coalesce(s.n, 0) - coalesce(t.n, 0), 0)::bigint missing, greatest(coalesce(t.n, 0) - coalesce(s.n, 0), 0)::bigint extra from s full join t using (k, amount) where coalesce(s.n, 0) <> coalesce(t.n, 0)""")
def money_deltas(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_linenumber").alias("amount"), "l_returnflag")
    return checks.multiset_deltas(rows.where("l_returnflag = 'R'"), rows.where("l_returnflag = 'A'"), ["k", "amount"])


@query("""select o_orderkey, exists (select 1 from orders i where i.o_custkey = o.o_custkey and i.o_orderstatus = 'F' and i.o_orderdate <= o.o_orderdate and (i.o_orderkey % 3 = 0 or o.o_orderdate <= i.o_orderdate + interval 200 day)) as inside from orders o""")
def membership_intervals(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders")
    until = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate") + F.expr("interval 200 days"))
    spans = rows.where("o_orderstatus = 'F'").select("o_custkey", F.col("o_orderdate").alias("since"), until.alias("until"))
    return checks.within(rows.select("o_orderkey", "o_custkey", "o_orderdate"), spans, "o_custkey", "o_orderdate").select("o_orderkey", "inside")


@query("""with r as (select o_custkey as law, o_orderkey as run from orders where o_orderstatus = 'F' qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1),
f as (select l_orderkey as run, count(*) filter (l_returnflag = 'R')::bigint as "R", count(*) filter (l_returnflag = 'A')::bigint as "A" from lineitem group by 1)
select c_custkey as law, run, case when run is not null then coalesce("R", 0) end as "R", case when run is not null then coalesce("A", 0) end as "A" from customer left join r on law = c_custkey left join f using (run)""")
def latest_run_severities(spark: SparkSession, d: str) -> DataFrame:
    laws = table(spark, d, "customer").select(F.col("c_custkey").alias("law"))
    runs = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("law"), F.col("o_orderkey").alias("run"), "o_orderdate")
    findings = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("run"), F.col("l_returnflag").alias("severity"))
    return checks.latest_severities(laws, runs, findings, "law", "run", "o_orderdate", ["R", "A"])


@query("""with m as (select l_orderkey, l_linenumber, case when l_linenumber < 6 then l_extendedprice end as ink, case when l_linenumber <> 2 then l_quantity / 60 end as repeats, case when l_linenumber <> 2 then l_discount * 4 end as forms, case when l_linenumber < 4 then 1 - l_tax * 2 end as purity,
case when l_linenumber < 5 then l_quantity / 50 end as divergence, case when l_linenumber <> 6 then 1 - l_discount * 3 end as parity from lineitem)
select l_orderkey, l_linenumber, case when coalesce(ink < 5000, false) or coalesce(repeats > 0.5, false) or coalesce(forms > 0.3, false) or coalesce(purity < 0.85, false) then 'escalate'
when coalesce(divergence > 0.7, false) or coalesce(parity < 0.8, false) or coalesce(ink, repeats, forms, purity, divergence, parity) is null then 'reread' else 'accept' end as verdict from m""")
def page_verdicts(spark: SparkSession, d: str) -> DataFrame:
    n, q, less = F.col("l_linenumber"), F.col("l_quantity"), F.col("l_discount")
    measures = [F.when(n < 6, F.col("l_extendedprice")), F.when(n != 2, q / 60), F.when(n != 2, less * 4), F.when(n < 4, 1 - F.col("l_tax") * 2), F.when(n < 5, q / 50), F.when(n != 6, 1 - less * 3)]
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", checks.page_verdict(*measures).alias("verdict"))


@query("""with c as (select conv_id, sum(len(regexp_extract_all(coalesce(text, ''), '[.;:]'))) filter (role = 'user') as source, sum(len(regexp_extract_all(coalesce(text, ''), '[.;:]'))) filter (role = 'assistant') as target from conversations group by 1)
select conv_id, coalesce(source - target >= 2 and target < 0.8 * source, false) as gap, case when abs(source - target) <= 1 then 'clean' when abs(source - target) = 2 then 'warning' when abs(source - target) > 2 then 'error' end as level from c""")
def clause_parity(spark: SparkSession, d: str) -> DataFrame:
    clauses = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("[.;:]"))
    counted = table(spark, d, "conversations").groupBy("conv_id").agg(*[F.sum(F.when(F.col("role") == role, clauses)).alias(name) for role, name in (("user", "source"), ("assistant", "target"))])
    source, target = F.col("source"), F.col("target")
    return counted.select("conv_id", checks.clause_gap(source, target).alias("gap"), checks.cover_level(source, target).alias("level"))


@query("""select l_orderkey, l_linenumber, case when l_linenumber = 7 then 'ungraded' when l_discount > 0.08 or l_returnflag = 'R' or l_quantity > 45 or l_tax > 0.07 then 'C'
when l_returnflag = 'A' or l_linenumber = 3 or l_linestatus = 'F' then 'B' else 'A' end as grade from lineitem""")
def translation_grades(spark: SparkSession, d: str) -> DataFrame:
    n, flag = F.col("l_linenumber"), F.col("l_returnflag")
    audit = {"numeric_slot_recall": F.when(n != 7, F.when(F.col("l_tax") > 0.07, 0.5).otherwise(1.0)), "notes_status": F.when(flag == "R", "failed").when(flag == "A", "partial").otherwise("ok"), "units_total": F.col("l_orderkey"), "fallback_ratio": F.when(F.col("l_discount") > 0.08, 0.2).otherwise(0.01), "money_missing": F.col("l_quantity") > 45, "clause_gap": n == 3, "judge": F.when(F.col("l_linestatus") == "F", "warn")}
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", checks.translation_grade(audit).alias("grade"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hybrid retrieval: BM25 and exact vector search, fused by reciprocal ranks."""
    return rrf_fusion_all(spark, sf_dir)


def queries():
    return dict(QUERIES)


def unmatched_queries():
    return dict(UNMATCHED)


def oracle_sql():
    return dict(ORACLE)


from statuta.plans import structural  # noqa: E402, F401  registers its queries here
