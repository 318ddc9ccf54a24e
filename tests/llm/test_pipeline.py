from collections import Counter, defaultdict

import pyarrow as pa

import corpus_pipeline
from feedlake.llm import jaccard_join, mixing, packing
from feedlake.llm.frames import SENT, SENT_CONF, table
from tests.llm.test_jaccard_join import by_hand
from tests.llm.test_quality import held_out

DIR = "/sf0.001"


def test_stages_one_by_one(spark, sf_dir):
    sf_dir = sf_dir.rsplit("/", 1)[0] + DIR
    docs = table(spark, sf_dir, "documents").cache()
    before = docs.collect()
    good = corpus_pipeline.keep_good(spark, docs, sf_dir).cache()
    assert good.columns == docs.columns
    kept = {row.doc_id for row in good.collect()}
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    right = [(row.doc_id in kept) == (labels[row.doc_id] == 1) for row in before
             if row.doc_id in labels and held_out(row.doc_id)]
    assert sum(right) >= 0.9 * len(right)

    one = corpus_pipeline.keep_one_of_each(spark, good, sf_dir).cache()
    rows = [(row.doc_id, row.text) for row in good.collect()]
    expected = by_hand(rows, jaccard_join.Similarity(5, 80, 100))
    assert {r.doc_id for r in one.collect()} == {d for d, (_, c) in expected.items() if d == c}

    mix = corpus_pipeline.mix_sources(spark, one, sf_dir).cache()
    assert mix.columns == docs.columns
    words, taken = Counter(), Counter()
    for row in one.collect():
        words[row.source] += len(row.text.split())
    for row in mix.collect():
        taken[row.source] += len(row.text.split())
    names = sorted(words)
    targets = mixing.fill([words[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 3)
    assert all(abs(taken[n] - t) <= 0.1 * t + 50 for n, t in zip(names, targets))

    packed = corpus_pipeline.pack_sequences(spark, mix, sf_dir).collect()
    assert len({(r.doc_id, r.copy) for r in packed}) == mix.count()
    fill = defaultdict(int)
    for row in packed:
        fill[row.sequence_id] += row.length
    assert max(fill.values()) <= 4096
    assert len(fill) <= sum(fill.values()) / 4096 * 1.05 + 1


def test_copies_of_a_row_go(spark, sf_dir):
    text = "one text of nine words that is long enough"
    rows = [(1, text), (1, text), (2, text), (None, text), (3, "another"), (None, "alone"), (None, "alone")]
    docs = spark.createDataFrame([(*r, "en", "s", 3) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    found = corpus_pipeline.keep_one_of_each(spark, docs, sf_dir).collect()
    assert sorted(str(r.doc_id) for r in found) == ["1", "3", "None"]


def test_rows_that_repeat_a_doc_id(spark, sf_dir):
    a, b = "one text of nine words that is long enough", "quite another text without any copy in here"
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(3, a), (5, a), (5, b), (7, long), (7, long + " more"), (2**62, "a hash id"), (2**63 - 1, "larger"),
            (-4, a + " "), (8, ""), (8, ""), (8, None), (8, None), (9, ""), (None, ""), (None, "")]
    docs = spark.createDataFrame([(*r, "en", "s", 3) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    found = corpus_pipeline.keep_one_of_each(spark, docs.repartition(3), sf_dir)
    assert found.columns == docs.columns
    kept = Counter((r.doc_id, (r.text or "").split(" more")[0]) for r in found.collect())
    expected = [(-4, a + " "), (5, b), (7, long), (2**62, "a hash id"), (2**63 - 1, "larger"),
                (8, ""), (8, ""), (9, ""), (None, ""), (None, "")]
    assert kept == Counter(expected)


def test_stages_and_run(spark, sf_dir):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    sf_dir = sf_dir.rsplit("/", 1)[0] + DIR
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and {r.piece for r in rows} >= {0}


def test_empty_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, sf_dir)
        assert found.count() == 0
        if stage is not corpus_pipeline.pack_sequences:
            docs = found


def test_columns_that_the_stages_use_themselves(spark, sf_dir):
    sf_dir = sf_dir.rsplit("/", 1)[0] + DIR
    docs = table(spark, sf_dir, "documents").selectExpr(
        "*", "-7.0 AS Score", "42 AS predicted", "1 AS quality_score", "2 AS row_number", "3 AS copy",
        "4 AS size", "5 AS times", "6 AS mix_order", "'x' AS n", "7 AS component_id",
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns[5:] == ["Score", "predicted", "quality_score", "row_number", "copy", "size",
                                    "times", "mix_order", "n", "component_id"]
        assert {tuple(row)[5:] for row in docs.collect()} == {(docs.first().Score, 42, 1, 2, 3, 4, 5, 6, "x", 7)}
        assert float(docs.first().Score) == -7.0


def test_texts_are_sent_to_workers_in_small_batches(spark, tmp_path):
    rows = [(i, "word " * 2000, "en", "a") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    spark.createDataFrame([(0, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes], "rows": [batch.num_rows]})

    stages = dict(corpus_pipeline.STAGES)
    before = spark.conf.get(SENT_CONF, None)
    try:
        for name in ("quality classifier", "mixing sources"):
            spark.conf.unset(SENT_CONF)
            stages[name](spark, docs, str(tmp_path))
            found = docs.coalesce(1).mapInArrow(sizes, "n long, rows long").collect()
            assert sum(row.rows for row in found) == len(rows)
            assert max(row.n for row in found) < 1.5 * SENT
        spark.conf.set(SENT_CONF, "1m")
        stages["mixing sources"](spark, docs, str(tmp_path))
        assert spark.conf.get(SENT_CONF) == "1m"
    finally:
        spark.conf.unset(SENT_CONF) if before is None else spark.conf.set(SENT_CONF, before)
