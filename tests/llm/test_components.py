import random

from feedlake.llm.components import components


def roots(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_any_links(spark):
    rule = random.Random(3)
    links = [(rule.randrange(300), rule.randrange(300)) for _ in range(200)]
    links += [(i, i + 1) for i in range(1000, 1060)]  # a long path
    links += [(2000, 2001 + i) for i in range(100)]  # a hub
    frame = spark.createDataFrame([*links, (None, 4), (4, None)], "a long, b long")
    found = {row.id: row.component for row in components(frame).collect()}
    assert found == roots([(a, b) for a, b in links if a != b])


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []


def test_stars_need_no_round(spark, monkeypatch):
    from feedlake.llm import components as module

    rounds, step = [], module._large_star
    monkeypatch.setattr(module, "_large_star", lambda links: rounds.append(1) or step(links))
    stars = [(5, 1), (1, 7), (9, 2), (2, 3), (3, 3), (None, 4), (7, 1)]
    found = module.components(spark.createDataFrame(stars, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(1, 1), (5, 1), (7, 1), (2, 2), (3, 2), (9, 2)}
    assert not rounds
    path = [(i, i + 1) for i in range(9)] + [(20, 9), (30, 31)]
    found = module.components(spark.createDataFrame(path, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in [*range(10), 20]} | {(30, 30), (31, 30)}
    assert rounds
