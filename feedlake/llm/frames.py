"""Small helpers that the operators of this subpackage share."""

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.workspace import work_folder

#: What separates words in every operator: the space and the five ASCII controls before it.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of the batches that Spark sends to workers, for a session that `sends_little`.
SENT = 2_900_000
SENT_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back, so that nothing is computed twice."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sends_little(spark: SparkSession) -> None:
    """From now on Spark sends batches of about SENT bytes to workers in this session.

    By default it is 64 MB, which every task holds in the executor as it fills a batch, and its
    worker as it reads one. A limit that the session has been given stays.
    """
    if spark.conf.get(SENT_CONF, None) is None:
        spark.conf.set(SENT_CONF, f"{SENT}b")


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 6_000_000):
    """The rows of `batches` in slices whose texts in `column` hold about `limit` bytes.

    A text longer than the limit is a slice of its own. What is built from a slice is so
    bounded by the limit and the longest text, however many rows Spark puts in a batch. After
    each batch what is free goes back to the system, as workers outlive their tasks.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        start = size = 0
        for i, length in enumerate(pc.binary_length(texts).to_pylist()):
            if size and size + (length or 0) > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += length or 0
        if batch.num_rows > start:
            yield batch.slice(start)
        del batch, texts
        give_back()


def give_back() -> None:
    """Returns free memory of Arrow and of the C library, where it is one that can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in turn, as ASCII white space parts them, and where each text's
    words begin, with the end. A null text has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = lists.values, lists.offsets.to_numpy().astype(np.int64)
    there = pc.not_equal(pc.binary_length(flat), 0)
    kept = np.concatenate(([0], np.cumsum(there.to_numpy(zero_copy_only=False))))
    return flat.filter(there), kept[offsets]


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or a longer one that no column of `df` has in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def words(text) -> F.Column:
    """How many words a text has; 0 if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
