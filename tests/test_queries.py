"""Every registered query against its SQL."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from statuta.plans import registry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, db, name):
    sql = registry.oracle_sql().get(name)
    assert sql, name
    compare(spark, FOLDER, registry.queries()[name], sql, db)


def test_numeral_parity_counts_repeated_numerals(spark, tmp_path):
    texts = ["7 7 7 8", "7 8 8", "7 7", "", None, "1", "1 1 1"]
    pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts}), tmp_path / "documents.parquet")
    compare(spark, tmp_path, registry.numeral_parity, registry.oracle_sql()["numeral_parity"], connect(tmp_path))
    assert {r["doc_id"]: r["parity"] for r in registry.numeral_parity(spark, str(tmp_path)).collect()} == {0: 0.5, 1: round(1 / 3, 6), 2: 0.0, 3: None, 4: 0.0, 5: round(1 / 3, 6)}
