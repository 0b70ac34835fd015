"""Vector search and fusion serve every query of their table."""

from statuta.operators import search
from statuta.plans import registry

FOLDER = "/root/testdata/sf0.001"
ROWS = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (4, None), (5, [1.0])]


def test_every_query_is_served(spark):
    rows = spark.createDataFrame(ROWS, "vec_id long, embedding array<float>")
    asked = spark.createDataFrame([("a", [2.0, 0.5]), ("b", [0.0, 1.0]), ("none", None)], "query_id string, embedding array<float>")
    got = sorted(tuple(r) for r in search.nearest(rows, asked, 4).select("query_id", "rank", "vec_id", "score").collect())
    assert got == [
        ("a", 1, 1, 2.0), ("a", 2, 3, 2.0), ("a", 3, 2, 0.5), ("a", 4, 4, None), ("b", 1, 2, 1.0), ("b", 2, 1, 0.0), ("b", 3, 3, 0.0), ("b", 4, 4, None),
        *[("none", i, i, None) for i in range(1, 5)],
    ]
    assert search.nearest(rows, asked.limit(0), 4).count() == 0 == search.nearest(rows.limit(0), asked, 4).count()


def test_blocks_change_nothing(spark, monkeypatch):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding")
    asked = rows.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    want = sorted(tuple(r) for r in search.nearest(rows, asked, 7).collect())
    monkeypatch.setattr(search, "QUERY_BLOCK", 3)
    monkeypatch.setattr(search, "VECTOR_BLOCK", 20)
    assert sorted(tuple(r) for r in search.nearest(rows, asked, 7).collect()) == want and len(want) == 70


def test_fusion_of_all_items_holds_the_one_item(spark):
    every = registry.rrf_fusion_all(spark, FOLDER)
    assert every.select("item_id").distinct().count() == 40
    one = {(r["doc_id"], r["score"]) for r in registry.rrf_fusion(spark, FOLDER).collect()}
    assert {(r["doc_id"], r["score"]) for r in every.where("item_id = 3").collect()} == one
