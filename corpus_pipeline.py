"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table. All but the last return the columns
of documents. Between stages the table is written and read again.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import jaccard_join, mixing, packing, quality
from feedlake.llm.frames import WORD, fresh, sends_little, table, written
from feedlake.llm.queries import SEQUENCE_END_ID, SEQUENCE_LENGTH, workers_find_package
from feedlake.llm.tokens import default_vocabulary


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from the labels of sf_dir."""
    _ready(spark)
    trees = quality.learn(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "quality_score")
    predicted = fresh(docs, "quality_predicted")
    judged = quality.score(docs, trees, names=(score, predicted))
    return judged.where(F.col(predicted) == 1).select(*_columns(docs))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-copies (five words, similarity 0.8) the row of the smallest doc_id.

    Rows are told apart by a number of their own, so rows that repeat a doc_id are compared like
    any others. Rows without a doc_id count as larger than all others: one stays if it is near no
    row that has an id. A text without words is near nothing; of rows that have one and the same
    doc_id and such a text one stays.
    """
    _ready(spark)
    row = fresh(docs, "row_number")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    similar = jaccard_join.Similarity(words=5, num=80, den=100)
    texts = numbered.select(F.col(row).alias("doc_id"), "text")
    found = written(jaccard_join.jaccard_join(texts, similar), "near")
    group = found.where("n_shingles > 0").select(F.col("doc_id").alias("number"), "component_id")
    ids = numbered.select(F.col(row).alias("number"), "doc_id")
    order = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "number"))
    first = ids.join(group, "number").groupBy("component_id").agg(order.alias("first"))
    gone = group.select("number").join(first.select("first.number"), "number", "left_anti")
    blank = numbered.where("doc_id is not null").where(~F.coalesce(F.col("text").rlike(WORD), F.lit(False)))
    blank = blank.select(F.col(row).alias("number"), "doc_id", "text")
    one = blank.groupBy("doc_id", "text").agg(F.min("number").alias("number"))
    again = blank.select("number").join(one.select("number"), "number", "left_anti")
    gone = written(gone.union(again), "gone")
    kept = numbered.join(gone.withColumnRenamed("number", row), row, "left_anti")
    return kept.select(*_columns(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask."""
    _ready(spark)
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    _ready(spark)
    vocabulary = default_vocabulary()
    return packing.pack_documents(docs, vocabulary, SEQUENCE_END_ID, SEQUENCE_LENGTH, lasting=False)


def _ready(spark: SparkSession) -> None:
    """The stages share executors and workers: what one leaves in memory, the next has not."""
    workers_find_package(spark)
    sends_little(spark)


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{name}`") for name in docs.columns]


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: None: trained trees, components and packing are not expressible. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
