"""The registered queries of the operators against their SQL, and the contract of those without."""

import pytest

from statuta.llm import registry
from tests.llm import brute
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, name):
    compare(spark, FOLDER, registry.queries()[name], registry.oracle_sql()[name], connect(FOLDER))


def test_token_counts_and_bpe_cover_every_document(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    sp, bpe = brute.sentences(), brute.bpe()
    counted = {r["doc_id"]: (r["n_tokens"], r["over_limit"]) for r in registry.op3_token_counts(spark, FOLDER).collect()}
    assert counted == {d: (n := len(sp.encode(t)), n > 4096) for d, t in texts.items()}
    coded = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in registry.op8_byte_bpe(spark, FOLDER).collect()}
    want = {d: bpe.encode_ordinary(t) for d, t in texts.items()}
    assert coded == {d: (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(texts[d])) for d, ids in want.items()}
