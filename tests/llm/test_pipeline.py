"""The corpus pipeline, stage by stage."""

import corpus_pipeline

from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, FOLDER).cache()
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == corpus_pipeline.COLUMNS and set(after) <= set(before) and after
        if name == "near_dedup":
            found = brute.near_duplicates(list(before.items()), 5, 80)
            assert set(after) == {d for d in before if found[d][1] == d}
        if name == "substring_dedup":
            want = brute.substrings(list(before.items()))
            assert all(after[d] == (" ".join(want[d][2]) if want[d][1] else before[d]) for d in before)
    last = {r["doc_id"]: (r["ids"], r["decoded_sha256"]) for r in corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()}
    assert last == {d: (brute.bpe().encode_ordinary(t or ""), brute.sha(t or "")) for d, t in after.items()}
