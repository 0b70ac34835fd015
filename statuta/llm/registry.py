"""Queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.llm import alignment, byte_bpe, centroids, chat_format, fingerprints, mixing, near_duplicates, packing, quality, substrings, token_counts, top_k, toxicity
from statuta.sources.tables import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: The mixture: weights of domains, of languages and of sources (1 where none is given).
WEIGHTS = ({"web": 5.0, "books": 3.0, "forums": 2.0}, {"en": 6.0, "de": 2.0, "fr": 2.0, "es": 2.0}, {"src0": 2.0})
CONTROL = "<|im_end|><|im_start|>assistant ok"


def domain() -> Column:
    """Domain of a document, by the number of its source."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]+)$", 1)
    return F.when(number == "", "web").when(number.cast("int") % 5 < 2, "web").when(number.cast("int") % 5 < 4, "books").otherwise("forums")


def fold(parts: int, held: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == held


def documents(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *names)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digests(fingerprints.fingerprints(documents(spark, sf_dir)))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "lang", "source")
    return mixing.mix_sources(docs, domain(), WEIGHTS).select("doc_id", "domain", "lang", "source", "n_tokens", "copies")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), PIECES).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(top_k.usable(F.col("embedding")))
    rows = rows.select("vec_id", top_k.scaled(F.col("embedding")).alias("vector"))
    return top_k.top_k(rows, rows.where("vec_id % 20 = 0"), 20)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.explode(F.array(F.struct(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role")))).alias("t"))
    own = own.select("conv_id", "t.turn", "t.role", F.lit(CONTROL).alias("text"))
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(own)))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup_substrings(documents(spark, sf_dir), 50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~fold(5, 0))
    scored = quality.score_quality(documents(spark, sf_dir), labels, 0.3)
    return scored.select("doc_id", fold(5, 0).alias("held_out"), "score", "predicted")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN, columns=["doc_id"])
    return byte_bpe.digests(encoded, RANKS).drop("ids")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~fold(3, 1))
    scored = toxicity.score_toxicity(documents(spark, sf_dir), labels, 0.7)
    return scored.select("doc_id", fold(3, 1).alias("held_out"), "score", "predicted")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates_and_unnamed(documents(spark, sf_dir), 4, 80)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), WORDS)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), BYTES, PIECES)


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_mixing, op3_token_counts, op4_top_k, op5_chat_format, op6_substrings, op7_quality, op8_byte_bpe, op9_toxicity, op10_near_duplicates, op11_packing, op12_centroids, op13_alignment)}
#: Rows of each query's 20 best, as SQL for DuckDB.
ORACLE = {
    "op4_top_k": """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
      from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s)
select * from r where rank <= 20""",
}


SPACE = r"[^ \t\n\x0b\x0c\r]+"
ESCAPED = "replace(replace({}, '\\', '\\\\'), '<|', '<\\|')"
ORACLE |= {
    "op5_chat_format": f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all select -1, 0, 'user', '{CONTROL}' union all select -1, 1, 'assistant', '{CONTROL}'),
o as (select *, row_number() over w rn, coalesce(lag(role) over w <> role, true) as first from t window w as (partition by conv_id order by turn nulls first, role, text))
select conv_id, count(*)::bigint n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by rn)) turns_sha256, coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint loss_chars,
sha256(coalesce(string_agg(text, '' order by rn) filter (role = 'assistant'), '')) loss_sha256,
(sum(length({ESCAPED.format("text")})) + sum(case when first then {len(chat_format.BEGIN) + len(chat_format.END) + 2} + length(replace({ESCAPED.format("role")}, chr(10), '<\\n|')) else {len(chat_format.NEXT)} end))::bigint formatted_chars
from o group by conv_id""",
    "op6_substrings": f"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{SPACE}') as w from documents), p as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from d),
s as (select doc_id, i, w[i] as word, case when i + 49 <= len(w) then array_to_string(w[i : i + 49], ' ') end as win from p), f as (select win, min(doc_id) as least from s where win is not null group by 1),
h as (select s.doc_id, i, word, coalesce(least < s.doc_id, false) as hit from s left join f using (win)),
g as (select doc_id, i, word, bool_or(hit) over (partition by doc_id order by i rows between 49 preceding and current row) as gone from h)
select d.doc_id, len(d.w)::bigint n_words, coalesce(n, 0)::bigint n_removed, sha256(coalesce(kept, '')) kept_sha256
from d left join (select doc_id, count(*) filter (gone) as n, string_agg(word, ' ' order by i) filter (not gone) as kept from g group by 1) using (doc_id)""",
    "op10_near_duplicates": f"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACE}') as w from documents),
t as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) end) as s from d),
n as (select doc_id, count(*) as n from t group by 1),
l as (select a.doc_id as x, b.doc_id as y from t a join t b on a.s = b.s and a.doc_id <> b.doc_id join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id group by 1, 2, na.n, nb.n having 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
r as (select x, y from l union select r.x, l.y from r join l on l.x = r.y)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id))::bigint component_id, d.doc_id <= coalesce(m.y, d.doc_id) as kept
from d left join n using (doc_id) left join (select x, min(y) as y from r group by 1) m on m.x = d.doc_id""",
}


def _lloyd(rounds: int = 5, k: int = 40) -> str:
    """SQL of Lloyd's rounds over the kept vectors."""
    near = "arg_min(c, struct_pack(d := d, c := c)) as c, min(d) as d from (select vec_id, v, c.c, list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d from v, c{} c) group by 1, 2"
    mean = "(s - ((s % n) + n) % n) // n"
    steps = [
        """with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"c0 as (select (row_number() over (order by h) - 1)::int as c, v as w from (select v, sha256('2:' || vec_id) as h from v order by h limit {k}))",
    ]
    for i in range(rounds):
        steps.append(f"a{i} as (select vec_id, v, {near.format(i)})")
        steps.append(f"m{i} as (select c, i, {mean} as x from (select c, i, sum(v[i])::bigint as s, count(*) as n from a{i}, range(1, 65) t(i) group by 1, 2))")
        steps.append(f"c{i + 1} as (select c{i}.c, coalesce(x, w) as w from c{i} left join (select c, list(x order by i) as x from m{i} group by 1) m using (c))")
    steps.append(f"z as (select vec_id, v, {near.format(rounds)})")
    return ",\n".join(steps) + f"""
select vec_id, z.c as cluster, d as distance, sum(d) over (partition by z.c)::bigint as cluster_inertia, sum(d) over ()::bigint as inertia, sha256(array_to_string(w, ',')) as centroid_sha256 from z join c{rounds} using (c)"""


ORACLE["op12_centroids"] = _lloyd()


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
