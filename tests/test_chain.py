"""Citation chains, both ways, against a plain walk."""

import random

import pytest
from statuta.operators import graph


def plain(edges, starts, inbound, depth, classes, allowed):
    out = []
    for start in {s for s in starts if s is not None}:
        todo, found = [(start, [], 1)], []
        while todo:
            near, visited, level = todo.pop()
            for edge, src, dst, kind in edges:
                a, b = (dst, src) if inbound else (src, dst)
                if a != near or (classes is not None and kind not in classes) or (b is None and inbound) or (allowed is not None and b is not None and b not in allowed):
                    continue
                found.append((start, edge, kind, b, level))
                if b is not None and b not in [*visited, near] and level < depth:
                    todo.append((b, [*visited, near], level + 1))
        out += [(*f, any(x[4] == depth for x in found)) for f in found]
    return sorted(out, key=repr)


@pytest.mark.parametrize("inbound", [False, True])
@pytest.mark.parametrize(("depth", "classes", "allowed"), [(3, None, None), (2, ["a", "b"], [1, 2, 3, 4, 5]), (3, [], None), (1, ["a"], []), (0, None, None)])
def test_chain(spark, inbound, depth, classes, allowed):
    """Cycles, loops, dangling targets, null classes, parallel edges, null and repeated starts."""
    draw = random.Random(3)
    edges = [(i, draw.randrange(1, 8), draw.choice([None, *range(1, 8)]), draw.choice(["a", "b", "c", None])) for i in range(18)] + [(50, 2, 2, "a"), (51, 1, 2, "a"), (52, 2, 1, "a"), (52, 2, 1, "a")]
    starts = [1, 2, 2, None, 77]
    frame = spark.createDataFrame(edges, "edge_id int, src int, dst int, edge_class string")
    some = None if allowed is None else spark.createDataFrame([(x,) for x in [*allowed, *allowed, None]], "node int")
    got = graph.citation_chain(frame, spark.createDataFrame([(s,) for s in starts], "node int"), inbound, depth, classes, some)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(edges, starts, inbound, max(depth, 1), classes, allowed)


def test_empty(spark):
    edges = spark.createDataFrame([], "edge_id int, src int, dst int, edge_class string")
    assert graph.citation_chain(edges, spark.createDataFrame([(1,)], "node int")).count() == 0
