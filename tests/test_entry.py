"""The entry module without the training-data half, ancestors without a limit, and no folder of one machine on a cluster."""

import subprocess
import sys
from pathlib import Path

import pytest

from statuta.operators import graph
from statuta.sources import tables

ROOT = Path(__file__).resolve().parents[1]


def test_core_queries_without_the_tokenizers():
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; q = e.queries(); assert 'bm25_topk' in q and 'pipeline' not in q and not any(k.startswith('op1') for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, timeout=120)


def test_every_ancestor_is_seen(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None, "root" if not i else None) for i in range(120)], "node int, parent int, value string")
    assert {(r["node"], r["value"], r["hops"]) for r in graph.nearest_value(chain).collect()} == {(i, "root", i) for i in range(120)}
    odd = spark.createDataFrame([(1, 2, None), (2, 1, None), (3, 1, None), (4, 9, None), (5, 6, None), (6, None, "x"), (6, None, "x"), (None, 6, None)], "node int, parent int, value string")
    assert sorted(tuple(r) for r in graph.nearest_value(odd).collect()) == [(5, "x", 1), (6, "x", 0)]
    assert graph.nearest_value(chain.limit(0)).count() == 0


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Frame:
        class sparkSession:  # noqa: N801
            sparkContext = Context()
            conf = {}  # noqa: RUF012

    with pytest.raises(ValueError, match=r"spark.checkpoint.dir"):
        tables.checkpointed(Frame())
