"""An inner join of two large tables on a key that may be hot on both sides.

Heavy keys are found by a sketch of the most frequent values, which tasks fill and Spark merges;
their rows are then counted exactly. The rows of a heavy key on its larger side are dealt to
as many shares as keep each within a bound, by a hash of the row; those of its smaller side are
repeated for every share. All other keys are joined as they are, in the same shuffle.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.workspace import kept

#: Rows of one key that a task may be given, from the larger side, and pairs it may make.
SHARE_ROWS, SHARE_PAIRS = 1_000_000, 50_000_000
#: Values a sketch tracks: all that are more than that share of the rows are among them.
TRACKED, FOUND = 10_000, 1_000


def _frequent(df: DataFrame, key: str) -> DataFrame:
    """(_key) of the most frequent values, FOUND at most."""
    found = F.call_function("approx_top_k", F.col(key), F.lit(FOUND), F.lit(TRACKED))
    items = df.where(F.col(key).isNotNull()).agg(found.alias("found"))
    return items.select(F.explode("found.item").alias("_key"))


def _counted(df: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    rows = df.select(key).join(F.broadcast(keys), F.col(key) == F.col("_key"))
    return rows.groupBy("_key").agg(F.count(F.lit(1)).alias(name))


def heavy_keys(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    share_rows: int = SHARE_ROWS,
    share_pairs: int = SHARE_PAIRS,
) -> DataFrame:
    """(_key, _shares, _left_dealt) of the keys that need more than one share, 2 * FOUND rows at
    most. _left_dealt: the left side is the larger one, whose rows are dealt."""
    keys = kept(_frequent(left, left_key).union(_frequent(right, right_key)).distinct(), "keys")
    # A key of one side alone makes no pairs, but its rows travel as well.
    both = _counted(left, left_key, keys, "_l").join(
        _counted(right, right_key, keys, "_r"), "_key", "full"
    )
    both = both.fillna(0, ["_l", "_r"])
    larger = F.greatest("_l", "_r")
    pairs = F.col("_l").cast("double") * F.col("_r")
    # Pairs are cut along the larger side, so no finer than its rows.
    shares = F.least(F.greatest(F.ceil(larger / share_rows), F.ceil(pairs / share_pairs)), larger)
    heavy = both.select(
        "_key", shares.cast("int").alias("_shares"), (F.col("_l") >= F.col("_r")).alias("_left_dealt")
    )
    return kept(heavy.where("_shares > 1"), "heavy")


def _shared_out(df: DataFrame, key: str, heavy: DataFrame, dealt: Column) -> DataFrame:
    """`df` with _share: dealt rows once, the others of heavy keys for every share."""
    one = F.pmod(F.xxhash64(*df.columns), F.col("_shares")).cast("int")
    shares = (
        F.when(F.col("_shares").isNull(), F.array(F.lit(0)))
        .when(dealt, F.array(one))
        .otherwise(F.sequence(F.lit(0), F.col("_shares") - 1))
    )
    # At most 2 * FOUND keys, whatever the tables hold.
    joined = df.join(F.broadcast(heavy), F.col(key) == F.col("_key"), "left")
    return joined.withColumn("_share", F.explode(shares)).drop("_key", "_shares", "_left_dealt")


def salted_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, heavy: DataFrame
) -> DataFrame:
    """The inner join of both sides on their keys, all columns of both, by `heavy_keys`.

    Null keys meet nothing. Rows that are equal in all columns share a share. What keys are
    heavy changes how the rows are dealt, never which there are. Columns must not clash.
    """
    a = _shared_out(left, left_key, heavy, F.col("_left_dealt"))
    b = _shared_out(right, right_key, heavy, ~F.col("_left_dealt"))
    b = b.withColumnRenamed("_share", "_other_share")
    met = (F.col(left_key) == F.col(right_key)) & (F.col("_share") == F.col("_other_share"))
    return a.join(b, met, "inner").drop("_share", "_other_share")
