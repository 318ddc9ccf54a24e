import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import embedding_dedup, topk
from tests.llm.test_components import roots

SCHEMA = "vec_id long, embedding array<float>"
UNSOUND = [None, [], [None, 1.0], [math.nan, 0.0], [math.inf, 0.0]]


def _families(rule, families=25, dim=16):
    rows = []
    for _ in range(families):
        base = rule.standard_normal(dim)
        for _ in range(rule.integers(1, 9)):
            rows.append(base + rule.uniform(0, 0.5) * rule.standard_normal(dim))
    return [[float(np.float32(x)) for x in row] for row in rows]


def near_by_hand(rows, threshold):
    sound = {i: np.array(v) for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)}
    links = []
    for i in sound:
        for j in sound:
            if i < j and len(sound[i]) == len(sound[j]):
                a, b = sound[i], sound[j]
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    links.append((i, j))
    count = [sum(i in link for link in links) for i in range(len(rows))]
    root = roots(links)
    least = {}
    for i, (vec_id, _) in enumerate(rows):
        r = root.get(i, i)
        least[r] = min((x for x in (least.get(r), vec_id) if x is not None), default=None)
    ids = [least[root.get(i, i)] for i in range(len(rows))]
    return [(v, n, c, v is not None and v == c) for (v, _), n, c in zip(rows, count, ids)]


@pytest.mark.parametrize("block", [2048, 16])
def test_links_and_components(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BUCKET", block // 4)
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    vectors = _families(np.random.default_rng(5))
    vectors += [vectors[0]] * 30 + [[0.0] * 16, [1.0, 2.0], [2.0, 4.0]] + UNSOUND
    rows = list(enumerate(vectors)) + [(3, vectors[3]), (None, vectors[5]), (None, [7.0])]
    embeddings = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS label", "2 AS c", "3 AS n")
    found = embedding_dedup.near_duplicates(embeddings.repartition(3), 0.9, recall=0.99999)
    found = [tuple(row) for row in found.collect()]
    assert sorted(map(str, found)) == sorted(map(str, near_by_hand(rows, 0.9)))


def test_recall_does_not_fall_with_size():
    for classes in (10, 10_000, 10**6, 10**9):
        planes = embedding_dedup.Planes.fitting(classes, 0.9)
        same = (1 - math.acos(0.9) / math.pi) ** planes.bits
        assert 1 - (1 - same) ** planes.tables >= embedding_dedup.RECALL


def test_very_large_and_small_vectors(spark):
    rows = [(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [1.0, -1.0])]
    found = embedding_dedup.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    )
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def best_by_hand(rows, k, factor):
    sound = [
        (vec_id, i, np.floor(factor * np.array(v)))
        for i, (vec_id, v) in enumerate(rows)
        if vec_id is not None and v and None not in v and np.isfinite(v).all()
    ]
    found = []
    for query_id, i, query in sound:
        if query_id % 5 == 0:
            scored = sorted(
                (-int(query @ vector), vec_id) for vec_id, j, vector in sound if i != j and len(vector) == len(query)
            )
            found += [(query_id, r + 1, vec_id, -s) for r, (s, vec_id) in enumerate(scored[:k])]
    return sorted(found)


@pytest.mark.parametrize("sizes", [(8192, 2048), (40, 7)])
def test_top_k(spark, monkeypatch, sizes):
    monkeypatch.setattr(topk, "CANDIDATES", sizes[0])
    monkeypatch.setattr(topk, "QUERIES", sizes[1])
    vectors = _families(np.random.default_rng(6))
    vectors += [vectors[0]] * 40 + [[0.0] * 16] * 3 + [[1.0, 2.0], [2.0, 4.0]] + UNSOUND
    rows = list(enumerate(vectors)) + [(None, vectors[1]), (5, vectors[5])]
    embeddings = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS row", "2 AS score", "3 AS dim")
    found = topk.top_k(embeddings.repartition(3), F.col("vec_id") % 5 == 0, k=6, factor=8)
    assert sorted(tuple(row) for row in found.collect()) == best_by_hand(rows, 6, 8)


def test_it_stops_early():
    rule = np.random.default_rng(7)
    vectors = rule.integers(-3, 4, (4000, 8))
    vectors[:30] += np.array([40, 0, 30, 0, 0, 0, 0, 0])
    lists = topk.Lists(vectors)
    seen = []
    monitored = lists.seen

    def watch(query, depth):
        seen.append(len(monitored(query, depth)))
        return monitored(query, depth)

    lists.seen = watch
    query = np.array([[9.0, 0, 9, 0, 0, 0, 0, 0]])
    ((rows, scores),) = lists.best(query, np.arange(4000), [-1], 10)
    every = vectors @ query[0]
    assert scores.tolist() == sorted(every.tolist(), reverse=True)[:10]
    assert max(seen) < 1000


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, F.col("vec_id") % 5 == 0).collect() == []
    assert embedding_dedup.near_duplicates(empty).collect() == []


def test_any_finite_component_takes_part(spark):
    rows = [(0, [1e9]), (1, [1.0]), (2, [-4e7]), (5, [2.0**20]), (6, [1e-300])]
    embeddings = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(embeddings, F.col("vec_id") % 5 == 0, k=2).collect()
    whole = [(i, math.floor(64 * x)) for i, (x,) in rows]
    expected = []
    for i in (0, 5):
        scores = sorted((-whole[0 if i == 0 else 3][1] * x, j) for j, x in whole if j != i)
        expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:2])]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_the_threshold_stops_at_large_scores_too():
    rule = np.random.default_rng(7)
    vectors = rule.integers(-3, 4, (4000, 8)) * 2.0**30
    vectors[:30] += np.array([40, 0, 30, 0, 0, 0, 0, 0]) * 2.0**30
    lists = topk.Lists(vectors, wide=True)
    seen, monitored = [], lists.seen
    lists.seen = lambda query, depth: seen.append(len(monitored(query, depth))) or monitored(query, depth)
    ((rows, scores),) = lists.best(np.array([[9.0, 0, 9, 0, 0, 0, 0, 0]]) * 2.0**30, np.arange(4000), [-1], 10)
    exact = sorted((9 * (int(v[0]) + int(v[2])) << 30 for v in vectors), reverse=True)
    assert scores.tolist() == exact[:10] and max(seen) < 1000


def test_recall_at_the_threshold_with_the_default_planes():
    """Pairs at a cosine of exactly 0.9 that meet in a bucket of some table."""
    rule = np.random.default_rng(12)
    for classes, pairs in ((10_000, 2_000), (10**8, 1_000)):
        planes = embedding_dedup.Planes.fitting(classes, 0.9)
        one = rule.standard_normal((pairs, 64))
        one /= np.linalg.norm(one, axis=1)[:, None]
        other = rule.standard_normal((pairs, 64))
        other -= (other * one).sum(axis=1)[:, None] * one
        other /= np.linalg.norm(other, axis=1)[:, None]
        other = 0.9 * one + math.sqrt(1 - 0.81) * other
        met = (planes.buckets(one) == planes.buckets(other)).any(axis=1)
        assert met.mean() >= 0.99


@pytest.mark.parametrize("size", [2.0**15, 2.0**20, 2.0**24])
def test_large_components_are_exact(spark, size):
    rule = np.random.default_rng(8)
    vectors = (rule.integers(-64, 65, (60, 9)) / 64 * size).tolist() + rule.uniform(-1, 1, (60, 9)).tolist()
    rows = list(enumerate(vectors)) + [(200, [size, size]), (201, [size, 1 / 64]), (202, [size, 2 / 64])]
    embeddings = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(embeddings, F.col("vec_id") % 5 == 0, k=6)
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    expected = []
    for i, query in whole:
        others = [(-sum(a * b for a, b in zip(query, v)), j) for j, v in whole if j != i and len(v) == len(query)]
        if i % 5 == 0:
            expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(others)[:6])]
    assert sorted(tuple(row) for row in found.collect()) == sorted(expected)


def test_scores_beyond_a_long_are_refused(spark):
    rows = [(0, [2.0**24] * 9), (1, [2.0**24] * 9)]
    embeddings = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(embeddings, F.col("vec_id") % 5 == 0).collect()


def test_deep_queries_do_not_look_up_every_place(monkeypatch):
    rng = np.random.default_rng(3)
    for wide in (False, True):
        vectors = rng.integers(-40, 40, size=(600, 32)).astype(float)
        asked, own = vectors[:90:3], list(range(0, 90, 3))
        lists, looked_up = topk.Lists(vectors, wide), []
        seen = lists.seen
        monkeypatch.setattr(lists, "seen", lambda q, d: looked_up.append((d + 1) * len(q)) or seen(q, d))
        found = list(lists.best(asked, np.arange(600), own, 5))
        for query, mine, (rows, scores) in zip(asked, own, found):
            exact = vectors @ query
            exact[mine] = -np.inf
            first = np.lexsort((np.arange(600), -exact))[:5]
            assert rows.tolist() == first.tolist() and scores.tolist() == exact[first].tolist()
        assert max(looked_up) <= 600
