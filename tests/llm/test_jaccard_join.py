import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import jaccard_join
from feedlake.llm.frames import written
from feedlake.llm.jaccard_join import Similarity
from tests.llm.test_components import roots

CAPITALS = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(CAPITALS))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def by_hand(rows, similarity):
    sets = {doc_id: shingles(text, similarity.words) for doc_id, text in rows}
    ids, links = sorted(sets), []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if similarity.linked(len(sets[a]), len(sets[b]), len(sets[a] & sets[b])):
                links.append((a, b))
    root = roots(links)
    return {doc_id: (len(found), root.get(doc_id, doc_id)) for doc_id, found in sets.items()}


def corpus():
    rule = random.Random(11)

    def words(n):
        return [f"w{rule.randrange(3000)}" for _ in range(n)]

    passage, rows = words(60), []
    for _ in range(12):
        base = words(rule.randrange(20, 150))
        for _ in range(rule.randrange(1, 12)):
            copy = list(base)
            for _ in range(rule.randrange(0, 5)):
                copy[rule.randrange(len(copy))] = f"x{rule.randrange(10**6)}"
            rows.append(copy)
    rows += [passage + words(rule.randrange(1, 30)) for _ in range(40)]
    base = words(80)
    for i in range(60):  # a chain: each is near the next one only
        base = [*base[:i], f"y{i}", *base[i + 1 :]] if i < len(base) else base
        rows.append(base)
    texts = [" ".join(row) for row in rows]
    texts += ["", None, " \t\n", "One", "one", "one two", "ONE\x0bTWO", "one\xa0two", "a b c d", "a b c d"]
    texts += [texts[0].upper(), texts[0], "long " * 20_000 + "end", "long " * 30_000 + "end"]
    rule.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("similarity", [Similarity(3, 90, 100), Similarity(5, 80, 100)])
def test_against_all_pairs(spark, similarity):
    rows = corpus()
    documents = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS n", "2 AS sig", "3 AS prefix"
    )
    found = jaccard_join.jaccard_join(documents.repartition(5), similarity).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == by_hand(rows, similarity)


def test_common_shingles_go_last(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEAST_COMMON", 1)
    rows = corpus()
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.jaccard_join(documents, Similarity(3, 90, 100)).collect()
    expected = by_hand(rows, Similarity(3, 90, 100))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_repeated_and_missing_ids(spark):
    text = "a text of some words that is long enough"
    rows = [(None, text), (7, text), (7, text), (9, text), (None, "another one without any id"), (None, None)]
    found = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(
        map(str, [(None, 5, 7), (7, 5, 7), (7, 5, 7), (9, 5, 7), (None, 1, None), (None, 0, None)])
    )


def test_empty_table(spark):
    documents = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.jaccard_join(documents).collect() == []


def test_a_bitmap_takes_as_many_jobs_whatever_the_partitions(spark):
    wide = spark.newSession()
    wide.conf.set("spark.sql.shuffle.partitions", "40")
    wide.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = written(wide.range(5000).selectExpr("id * 7919 AS t"), "repeated")
    context = spark.sparkContext
    context.setJobGroup("bitmap", "bitmap")
    try:
        bits = jaccard_join._bitmap(rows, F.col("t"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("bitmap")) < 10
    assert jaccard_join._within(bits, np.arange(5000, dtype=np.int64) * 7919).all()
    assert not jaccard_join._within(bits, np.array([1, 2, 7918], dtype=np.int64)).any()
