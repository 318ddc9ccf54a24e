"""Running sums within groups, one of which may hold a third of all rows.

A window sorts each group in one task. So the groups with very many rows are cut into buckets,
ranges of the order, first: a row's sum is that of the buckets before its own, which are few,
and that of the rows before it in its bucket. The sums do not depend on where a group is cut.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.workspace import kept

#: Rows of a group that one task may sort.
BUCKET_ROWS = 1_000_000
#: Ranges that a larger group is cut into, and what the sketch of its order may be off by.
BUCKETS, ACCURACY = 256, 4096
#: Groups cut that are broadcast at most: a key and the edges of their ranges each.
BROADCAST_GROUPS = 2_000


def _edges(df: DataFrame, group: str, order: str, bucket_rows: int) -> DataFrame | None:
    """(_group, _edges) of the groups with more than `bucket_rows` rows; None without any."""
    spread = F.pmod(F.xxhash64(group), F.lit(2)).alias("_made")  # counts before the shuffle
    sizes = df.where(F.col(group).isNotNull()).groupBy(group, spread).count()
    large = sizes.where(F.col("count") > bucket_rows).select(F.col(group).alias("_group"))
    large = kept(large, "large")
    if large.isEmpty():
        return None
    steps = [i / BUCKETS for i in range(1, BUCKETS)]
    rows = df.join(large, F.col(group) == F.col("_group"), "left_semi")
    # Partial sketches are merged, so no task sees all rows of a group.
    found = rows.groupBy(F.col(group).alias("_group")).agg(
        F.array_distinct(F.percentile_approx(order, steps, ACCURACY)).alias("_edges")
    )
    return kept(found, "edges")


def running_sum(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    value: Column,
    name: str,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """`df` with `name`: the sum of `value` over the rows before each one in its group.

    order: columns that put the rows of a group in an order without ties, nulls first; the
    first one must be a number or a time, and is what large groups are cut by. Rows that
    share its value stay together. Rows with a null group are one group, which is not cut.
    A null value counts 0. No rows, no sums.
    """
    valued = df.withColumn("_value", F.coalesce(value, F.lit(0)))
    edges = _edges(df, group, order[0], bucket_rows)
    if edges is None:
        before = Window.partitionBy(group).orderBy(*order)
        before = before.rowsBetween(Window.unboundedPreceding, -1)
        summed = F.coalesce(F.sum("_value").over(before), F.lit(0))
        return valued.withColumn(name, summed).drop("_value")
    cut = F.broadcast(edges) if edges.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS else edges
    placed = valued.join(cut, F.col(group) == F.col("_group"), "left").withColumn(
        "_bucket", F.coalesce(F.size(F.filter("_edges", lambda e: e < F.col(order[0]))), F.lit(0))
    )
    placed = placed.withColumn("_bucket", F.greatest("_bucket", F.lit(0))).drop("_edges", "_group")
    before = Window.partitionBy(group, "_bucket").orderBy(*order)
    inner = F.coalesce(
        F.sum("_value").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    within = placed.withColumn("_inner", inner)

    # A row for each range of the groups that were cut.
    ranges = placed.join(cut.select("_group"), F.col(group) == F.col("_group"), "left_semi")
    ranges = ranges.groupBy(group, "_bucket").agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy(group).orderBy("_bucket")
    offset = F.sum("_total").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    offsets = ranges.select(
        F.col(group).alias("_group"),
        F.col("_bucket").alias("_range"),
        F.coalesce(offset, F.lit(0)).alias("_offset"),
    )
    same = (F.col(group) == F.col("_group")) & (F.col("_bucket") == F.col("_range"))
    summed = within.join(offsets, same, "left")
    total = F.col("_inner") + F.coalesce("_offset", F.lit(0))
    return summed.withColumn(name, total).drop(
        "_value", "_bucket", "_inner", "_group", "_range", "_offset"
    )
