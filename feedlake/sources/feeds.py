"""The three feeds, always read with their schema: one pass, and stable column types.

A line that is not JSON, or does not fit the schema as a whole, is kept as text in the column
BAD of the frame. `staged` and `problems` say what there is of it.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.sources.array_feeds import read_array

BAD = "_corrupt_record"


def _read(spark: SparkSession, path, schema: str, json_lines: bool) -> DataFrame:
    if not json_lines:
        return read_array(spark, path, schema, BAD)
    reader = spark.read.schema(f"{schema}, {BAD} string").option("columnNameOfCorruptRecord", BAD)
    return reader.json(path)


def read_details(spark: SparkSession, path, json_lines: bool = True) -> DataFrame:
    return _read(spark, path, schemas.DETAILS_FEED, json_lines)


def read_search(spark: SparkSession, path, json_lines: bool = True) -> DataFrame:
    return _read(spark, path, schemas.SEARCH_FEED, json_lines)


def read_reviews(spark: SparkSession, path, json_lines: bool = True) -> DataFrame:
    return _read(spark, path, schemas.REVIEWS_FEED, json_lines)


def problems(feed: DataFrame) -> DataFrame:
    """One row: records, and how many of them could not be read."""
    bad = F.count(BAD) if BAD in feed.columns else F.lit(0).cast("long")
    return feed.agg(F.count(F.lit(1)).alias("records"), bad.alias("bad"))


def staged(feed: DataFrame, folder: str, allow_bad: bool = False, sources=()) -> DataFrame:
    """The feed as Parquet in a new folder below `folder`, written now and read back.

    The builds read a feed several times, mostly for its id. Text has to be parsed whole each
    time; staged, it is parsed once and later reads take only the columns they need.

    Fails if any record could not be read (a feed of JSON arrays read as JSON Lines has nothing
    but such records). With `allow_bad` they are left in <folder>/...-bad instead, and the feed
    goes on without them. Nothing is overwritten. `sources`: paths the feed is read from, which
    must not hold the new folder.
    """
    spark, name = feed.sparkSession, uuid.uuid4().hex
    path = f"{folder.rstrip('/')}/{name}"
    for source in sources:
        if path.startswith(f"{str(source).rstrip('/')}/"):
            raise ValueError(f"a feed read from {source} cannot be staged in {folder}")
    feed.write.mode("errorifexists").parquet(path)
    written = spark.read.schema(feed.schema).parquet(path)
    if BAD not in feed.columns:
        return written
    counts = problems(written).first()
    if counts["bad"] and not allow_bad:
        raise ValueError(
            f"{counts['bad']} of {counts['records']} records cannot be read; is the layout right?"
        )
    if counts["bad"]:
        written.where(F.col(BAD).isNotNull()).select(BAD).write.text(f"{path}-bad")
    return written.where(F.col(BAD).isNull()).drop(BAD)
