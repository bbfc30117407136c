import random

from visitflow.llm.components import connected


def test_components_of_random_links_chains_and_stars(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    links += [(i, i + 1) for i in range(1_000, 1_060)] + [(2_000, i) for i in range(2_001, 3_000)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.id: r.component_id for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_no_links(spark):
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
