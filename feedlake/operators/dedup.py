"""One row per key, always the same one.

The survivor is the smallest row, comparing the `order` columns first and then all the
others from left to right, nulls first. Spark keeps the first rows per key within each map
task before it shuffles (a group limit below the exchange), so a key that holds a third of
all rows, or a third of all rows being copies of one, costs no more than any other.

Unique rows are often joined with rows among which a key is hot. Adaptive execution splits
a hot key only if both sides of the join are shuffled for that join, but rows made unique
on the join key already lie where the join wants them and are not shuffled again. With
`for_join` the work is therefore spread by the key and a number made from it: same groups,
same result, and one more shuffle of the unique rows in return for a join that can be split.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _made_from(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(2))


def first_rows(
    df: DataFrame,
    keys: Sequence[str],
    count: int,
    order: Sequence[str] = (),
    for_join: bool = False,
) -> DataFrame:
    """The `count` smallest rows per `keys`; null keys compare equal."""
    first = [name for name in order if name not in keys]
    rest = [name for name in df.columns if name not in keys and name not in first]
    spread = [_made_from(keys)] if for_join else []
    smallest_first = Window.partitionBy(*keys, *spread).orderBy(*first, *rest)
    ranked = df.withColumn("_rank", F.row_number().over(smallest_first))
    return ranked.where(F.col("_rank") <= count).drop("_rank")


def dedup(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), for_join: bool = False
) -> DataFrame:
    """The smallest row per `keys`."""
    if set(df.columns) == set(keys):
        return df.distinct()
    return first_rows(df, keys, 1, order, for_join)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of one column, to be joined with rows among which some are hot."""
    return df.select(key, _made_from([key]).alias("_made")).distinct().select(key)
