import zlib

import numpy as np

from feedlake.llm import quality
from feedlake.llm.frames import table


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_accuracy(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = quality.classify(documents.select("doc_id", "text"), labels)
    rows = judged.join(labels, "doc_id").select("doc_id", "held_out", "predicted", "quality").collect()
    assert all(row.held_out == held_out(row.doc_id) for row in rows)
    tested = [row.predicted == row.quality for row in rows if row.held_out]
    assert len(tested) > 50 and np.mean(tested) > 0.95
    assert judged.count() == documents.count()


def _toy(spark):
    rows = [(i, "plain words in a line " * (1 + i % 5) if i % 2 else f"$$ %% {i} ## " * 9) for i in range(200)]
    rows += [(500, None), (501, ""), (None, "plain words"), (502, "word " * 100_000), (1, rows[1][1])]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(200)] + [(None, 1), (501, None), (500, 7), (3, 1)],
        "doc_id long, quality int",
    )
    return documents, labels


def test_learns_and_judges_every_row(spark):
    documents, labels = _toy(spark)
    clashing = documents.selectExpr("*", "1 AS score", "'x' AS Predicted", "2 AS quality", "3 AS label_id")
    found = quality.classify(clashing, labels).collect()
    assert len(found) == 205
    for row in found:
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
        if row.doc_id is not None and row.doc_id < 200:
            assert row.predicted == row.doc_id % 2
            assert row.held_out == held_out(row.doc_id)
    again = quality.classify(documents.repartition(7), labels).collect()
    assert {(r.doc_id, r.score) for r in found} == {(r.doc_id, r.score) for r in again}


def test_labels_held_out_do_not_matter(spark):
    documents, labels = _toy(spark)
    changed = labels.collect()
    changed = [(r.doc_id, 1 - r.quality if held_out(r.doc_id) and r.quality in (0, 1) else r.quality) for r in changed]
    other = spark.createDataFrame(changed, "doc_id long, quality int")
    one, two = (quality.learn(documents, rows) for rows in (labels, other))
    assert all(np.array_equal(a, b) for a, b in zip(vars(one).values(), vars(two).values()))


def test_without_labels(spark):
    documents, labels = _toy(spark)
    for some in (labels.limit(0), labels.where("quality = 1")):
        scores = {row.score for row in quality.classify(documents, some).collect()}
        assert len(scores) == 1
    assert quality.classify(documents.limit(0), labels).collect() == []


def test_flat_trees_walk_like_nested_ones():
    rule = np.random.default_rng(1)
    values = rule.standard_normal((600, quality.STATISTICS))
    labels = (values[:, 0] + values[:, 1] * values[:, 2] > 0).astype(float)
    trees = quality.train(values, labels)
    binned = quality.binned_by(trees.edges, values)
    expected = []
    for row in binned:
        total = trees.start
        for feature, limit, value in zip(trees.feature, trees.limit, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > limit[node] else 1)
            total += value[node - len(feature)]
        expected.append(1 / (1 + np.exp(-total)))
    assert np.allclose(trees.scores(values), expected)
    assert np.mean((trees.scores(values) >= 0.5) == labels) > 0.95
