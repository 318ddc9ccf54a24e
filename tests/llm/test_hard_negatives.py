import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"
UNSOUND = [None, [], [None, 1.0], [math.nan, 0.0], [math.inf, 0.0]]


def by_hand(rows, factor=256, positives=5, negatives=10, low=30, high=90):
    sound = [
        (vec_id, [math.floor(factor * x) for x in vector], label)
        for vec_id, vector, label in rows
        if vec_id is not None and label is not None and vector
        and all(x is not None and math.isfinite(x) for x in vector)
    ]
    made = []
    for i, (anchor, a, label) in enumerate(sound):
        if anchor % 100:
            continue
        others = [
            (-sum(x * y for x, y in zip(a, v)), vec_id, other)
            for j, (vec_id, v, other) in enumerate(sound) if j != i and len(v) == len(a)
        ]
        alike = sorted(o[:2] for o in others if o[2] == label)[:positives]
        unlike = sorted(o[:2] for o in others if o[2] != label)
        for score, positive in alike:
            fits = [(s, n) for s, n in unlike if low * -score <= -100 * s <= high * -score]
            for rank, (s, n) in enumerate(fits[:negatives], 1):
                made.append((anchor, positive, rank, n, -score, -s))
    return sorted(made)


def mined(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS row", "2 AS block", "3 AS cluster", "4 AS DIM"
    )
    found = hard_negatives.mine(table.repartition(3), F.col("vec_id") % 100 == 0, **options)
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    return sorted(tuple(row) for row in found.collect())


def families(count=900, dim=12, seed=3):
    rule = np.random.default_rng(seed)
    bases = rule.standard_normal((12, dim))
    rows = []
    for i in range(count):
        vector = bases[rule.integers(12)] + rule.uniform(0.1, 1.5) * rule.standard_normal(dim)
        rows.append((i, [float(x) for x in vector], int(rule.integers(4))))
    return rows


@pytest.mark.parametrize("block,piece", [(8192, 1024), (50, 2)])
def test_like_all_pairs(spark, monkeypatch, block, piece):
    monkeypatch.setattr(hard_negatives, "CANDIDATES", block)
    monkeypatch.setattr(hard_negatives, "PIECE", piece)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    rows = families()
    rows += [(1000 + i, rows[200][1], i % 4) for i in range(120)]  # one very common vector
    rows += [(2000, [0.0] * 12, 1), (2100, [1.0, 2.0], 1), (2101, [1.0, 1.5], 1), (2102, [1.0, 0.5], 2)]
    rows += [(2300 + 100 * i, bad, 1) for i, bad in enumerate(UNSOUND)]
    rows += [(300, rows[300][1], rows[300][2]), (None, rows[5][1], 1), (3100, rows[5][1], None)]
    expected = by_hand(rows)
    assert expected
    assert mined(spark, rows) == expected


def test_small_numbers_tie(spark):
    rule = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rule.integers(-1, 3, 4) / 256], i % 3) for i in range(400)]
    assert mined(spark, rows) == by_hand(rows)


def test_large_components(spark):
    rule = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rule.integers(-(2**18), 2**19, 6)], i % 2) for i in range(210)]
    rows += [(500 + i, [x * 4 for x in v], label) for i, v, label in rows[:10]]
    assert mined(spark, rows) == by_hand(rows)
    with pytest.raises(Exception, match="does not fit a long"):
        mined(spark, [(0, [1e30], 1), (1, [1e30], 1), (2, [6e29], 2)])


def test_other_ranges_and_counts(spark):
    rows = families(300)
    options = dict(factor=64, positives=2, negatives=3, low=-100, high=70)
    assert mined(spark, rows, **options) == by_hand(rows, **options)


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == []


def test_bounds_hold():
    rule = np.random.default_rng(4)
    anchors = rule.standard_normal((30, 8)) + 2 * rule.standard_normal(8)
    candidates = rule.standard_normal((500, 8)) * rule.uniform(0.1, 9, (500, 1))
    shared = hard_negatives.SharedList(anchors, candidates)
    scores = anchors @ candidates[shared.order].T
    assert (scores <= shared.norms[:, None] * shared.bounds[None, :]).all()
    assert (np.diff(shared.bounds) <= 0).all()


def test_walk_stops_early():
    rule = np.random.default_rng(4)
    near = rule.standard_normal(8) + 0.01 * rule.standard_normal((600, 8))
    far = rule.standard_normal((6000, 8)) * 0.1
    shared = hard_negatives.SharedList(near[:5], np.concatenate((near[5:], far)))
    seen = []

    class Counting(hard_negatives.Goal):
        def offer(self, scores, places):
            seen.append(len(places))
            super().offer(scores, places)

    goals = [[Counting(5)] for _ in range(5)]
    shared.walk(goals, np.ones((5, 6595), dtype=bool))
    assert sum(seen) < 5 * 2000
