import random

import pytest

from shelfcast.llm.components import connected_components


def want(edges):
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(label[a], label[b])
            if label[a] != least or label[b] != least:
                label[a] = label[b] = least
                changed = True
    return label


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {
        "chain": [(i, i + 1) for i in range(50)] + [(70, 70)],
        "star": [(-5, i) for i in range(40)] + [(100, 101)],
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)],
    }[kind]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == want(edges) and len(got) == len(want(edges))


def test_empty(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
