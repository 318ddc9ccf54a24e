from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedlake.llm import mixing


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, 12), st.integers(1, 4), max_size=6), st.integers(0, 60))
def test_knapsack_against_all_sums(lengths, budget):
    sizes = np.array(list(lengths), dtype=np.int64)
    counts = np.array(list(lengths.values()), dtype=np.int64)
    taken = mixing.knapsack(sizes, counts, budget)
    assert (0 <= taken).all() and (taken <= counts).all()
    sums = {0}
    for size, count in lengths.items():
        sums = {s + size * n for s in sums for n in range(count + 1)}
    near = min(abs(s - budget) for s in sums)
    assert abs(int((sizes * taken).sum()) - budget) == near


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(1, 2000), st.integers(1, 30), min_size=1, max_size=80), st.floats(0, 1))
def test_fit_comes_near(lengths, part):
    sizes = np.array(list(lengths), dtype=np.int64)
    counts = np.array(list(lengths.values()), dtype=np.int64)
    budget = int(part * (sizes * counts).sum())
    taken = mixing.fit(sizes, counts, budget)
    assert (0 <= taken).all() and (taken <= counts).all()
    assert abs(int((sizes * taken).sum()) - budget) <= sizes.max()


def all_sums(lengths, counts):
    reach = 1
    for length, count in zip(lengths.tolist(), counts.tolist()):
        for _ in range(count):
            reach |= reach << length
    return reach


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 900), st.integers(1, 5), min_size=1, max_size=25), st.floats(0, 1))
def test_no_choice_comes_nearer(lengths, part):
    sizes = np.array(list(lengths), dtype=np.int64)
    counts = np.array(list(lengths.values()), dtype=np.int64)
    budget = int(part * (sizes * counts).sum())
    taken = mixing.fit(sizes, counts, budget)
    assert (0 <= taken).all() and (taken <= counts).all()
    reach, miss = all_sums(sizes, counts), abs(int((sizes * taken).sum()) - budget)
    nearer = [budget + d for d in range(-miss + 1, miss) if budget + d >= 0]
    assert not any(reach >> s & 1 for s in nearer)


def test_every_source_of_the_test_tables_is_met(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = mixing.mix(documents).collect()
    sources = defaultdict(list)
    for row in found:
        sources[row.source].append(row)
    for rows in sources.values():
        taken = sum(r.size * r.times for r in rows)
        passes = min(3, int(rows[0].target // rows[0].source_size))
        budget = round(rows[0].target) - passes * rows[0].source_size if passes < 3 else 0
        lengths = Counter(r.size for r in rows)
        reach = all_sums(np.array(list(lengths)), np.array(list(lengths.values())))
        least = next(d for d in range(10**6) if reach >> (budget + d) & 1 or (budget >= d and reach >> (budget - d) & 1))
        assert abs(taken - passes * rows[0].source_size - budget) == least


def test_very_long_and_empty_documents():
    lengths, counts = np.array([0, 400, 2_000_000]), np.array([1, 500, 1])
    taken = mixing.fit(lengths, counts, 1_000_000)
    assert (0 <= taken).all() and (taken <= counts).all() and taken[1:].tolist() == [500, 0]
    assert mixing.fit(np.array([0, 2_000_000]), np.array([1, 1]), 900_000)[1] == 0
    assert mixing.fit(np.array([0, 2_000_000]), np.array([1, 1]), 1_100_000)[1] == 1


def test_a_source_of_one_giant_and_one_empty_document(spark):
    rows = [(1, "w " * 500_000, "a"), (2, "", "a"), (3, "w " * 400_000, "b"), (4, None, "b")]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r.doc_id: r.times for r in found.collect() if r.size} == {1: 1, 3: 1}


def test_targets_by_hand():
    assert mixing.fill([80, 10, 10], (5, 2, 1), 3) == pytest.approx([62.5, 25, 12.5])
    assert mixing.fill([10, 50, 40], (5, 2, 1), 3) == pytest.approx([30, 140 / 3, 70 / 3])
    assert mixing.fill([0, 10], (5, 2), 3) == pytest.approx([0, 10])
    assert mixing.fill([0, 0], (5, 2), 3) == [0, 0]
    assert mixing.fill([], (), 3) == []


def _documents(spark):
    rows = [(i, "w " * (1 + (i * 7) % 50), f"s{i % 5}") for i in range(600)]
    rows += [(1000 + i, "same size", "hot") for i in range(400)]
    rows += [(2000, None, "s1"), (2001, "", "s1"), (2002, "a b", None), (None, "a b c", None)]
    rows += [(2003, "x " * 40_000, "s2"), (5, "dup row", "s0"), (5, "dup row", "s0"), (2004, " ", "none")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return rows, frame.selectExpr("*", "1 AS times", "2 AS n", "3 AS hash", "4 AS q_size")


def test_mix(spark):
    rows, documents = _documents(spark)
    found = mixing.mix(documents.repartition(3)).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in found) == Counter(rows)
    sizes, taken, aims = Counter(), Counter(), {}
    for r in found:
        assert r.size == len((r.text or "").split()) and 0 <= r.times <= 3
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.times
        aims[r.source] = (r.source_size, r.target)
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    expected = mixing.fill([sizes[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 3)
    for name, target in zip(names, expected):
        assert aims[name] == (sizes[name], pytest.approx(target))
        longest = max(r.size for r in found if r.source == name)
        assert abs(taken[name] - target) <= max(2, longest / 2)
    again = mixing.mix(documents.repartition(11)).collect()
    assert Counter(map(str, found)) == Counter(map(str, again))
    seeds = [
        {(r.doc_id, r.times) for r in mixing.mix(documents.where("source like 's%' and doc_id <> 2003"), seed).collect()}
        for seed in (0, 1)
    ]
    assert seeds[0] != seeds[1]


def test_mixed_rows(spark):
    _, documents = _documents(spark)
    times = defaultdict(int)
    for row in mixing.mix(documents).collect():
        times[row.doc_id, row.text, row.source] += row.times
    rows = mixing.mixed(documents)
    assert rows.columns == documents.columns
    found = Counter((r.doc_id, r.text, r.source) for r in rows.collect())
    assert found == Counter({key: n for key, n in times.items() if n})


def test_without_broadcast_and_empty(spark, monkeypatch):
    _, documents = _documents(spark)
    expected = Counter(map(str, mixing.mix(documents).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert Counter(map(str, mixing.mix(documents).collect())) == expected
    assert mixing.mix(documents.limit(0)).collect() == []


def test_rows_that_repeat_a_document(spark):
    rows = [(None, "w " * 10, "a", i % 2, {"k": 1}) for i in range(300)] + [(1, "w " * 1000, "b", 0, None)]
    rows += [(7, "x y", "c", i, None) for i in range(200)] + [(8, "x " * 20, "c", 0, None)]
    schema = "doc_id long, text string, source string, number int, hash map<string,int>"
    documents = spark.createDataFrame(rows, schema)
    for dealt in (documents.repartition(5), documents.coalesce(1)):
        found = mixing.mix(dealt).collect()
        assert Counter(map(str, ((r.doc_id, r.text, r.source, r.number, r.hash) for r in found))) == Counter(map(str, rows))
        for name in "abc":
            mine = [r for r in found if r.source == name]
            longest = max(r.size for r in mine)
            miss = abs(sum(r.size * r.times for r in mine) - mine[0].target)
            assert miss <= (longest if name == "b" else 5)
    keys = [Counter((r.doc_id, r.size, r.source, r.number, r.times) for r in mixing.mix(d).collect())
            for d in (documents.repartition(5), documents.repartition(2, "number"))]
    assert keys[0] == keys[1]


def test_targets_need_no_python_workers(spark):
    rows = [("b", 10), (None, 30), ("a", 20), ("", 0)]
    sources = spark.createDataFrame(rows, "source string, source_size long")
    found = mixing.targets(sources)
    assert found.schema.simpleString() == "struct<source:string,source_size:bigint,target:double>"
    assert sorted(map(str, found.drop("target").collect())) == sorted(map(str, sources.collect()))
    assert [row.source for row in found.collect()] == ["", "a", "b", None]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan
    assert mixing.targets(sources.limit(0)).collect() == []
