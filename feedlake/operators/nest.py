"""Reviews back into one array per property.

One row per property is the wanted shape, but a row cannot hold a third of a large table.
So the few groups above a limit of rows are found first (`hot_groups`), their rows are dealt
to numbered parts (`deal`), and `nest` makes one row per group and part. All other groups
have the single part 0. No review is left out. `repeat` gives each part its property row,
and `with_totals` says in each part how many reviews and parts the whole group has.

`deal_by_bytes` cuts groups by how long their reviews are instead, in the order of their ids:
what a row holds is then bounded in bytes, whatever the reviews are like. `with_totals_by_part`
goes with it.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import fixed_values as V
from feedlake.operators.running import BUCKET_ROWS, running_sum
from feedlake.workspace import kept

ROW_LIMIT = 10_000
# Longest list of hot keys that is broadcast: a key and a number each, a few MB in all.
BROADCAST_KEYS = 50_000


def has_more(df: DataFrame, group: Sequence[str], limit: int) -> bool:
    """Whether any group has more than `limit` rows. Counts, in part before the shuffle."""
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return bool(counts.where(F.col("n") > limit).take(1))


def hot_groups(
    df: DataFrame,
    key: str,
    limit: int = ROW_LIMIT,
    broadcast_keys: int = BROADCAST_KEYS,
    member: str | None = None,
) -> DataFrame | None:
    """(key, parts) of the groups of `key` with more than `limit` rows; None if there are none.
    If `member` is named, the total of its values that are not null is a third column.

    The list is counted: it carries a broadcast hint only if short, else it is joined by
    shuffle. It is written to a work folder, as it is used more than once.
    """
    spread = F.pmod(F.xxhash64(key), F.lit(2)).alias("_made")  # see operators.dedup
    totals = [F.count(member).alias("_total")] if member else []
    sizes = df.where(F.col(key).isNotNull()).groupBy(key, spread).agg(
        F.count("*").alias("n"), *totals
    )
    hot = sizes.where(F.col("n") > limit).select(
        F.col(key).alias("_hot"),
        F.ceil(F.col("n") / F.lit(limit)).cast("int").alias("_parts"),
        *(["_total"] if member else []),
    )
    found = hot.limit(broadcast_keys + 1).count()
    if found == 0:
        return None
    written = kept(hot, "hot")
    return F.broadcast(written) if found <= broadcast_keys else written


def deal(df: DataFrame, key: str, member: str, hot: DataFrame) -> DataFrame:
    """Add `part`. Rows of a hot group are dealt by the first 32 bits of the md5 of `member`.

    So equal members share a part, a task that runs again deals them the same way, and any
    other system can tell the part of a review. Only rows of hot groups are hashed.
    """
    bits = F.conv(F.substring(F.md5(F.col(member).cast("string")), 1, 8), 16, 10).cast("bigint")
    part = F.when(F.col("_parts").isNotNull(), F.pmod(bits, F.col("_parts")).cast("int"))
    dealt = df.join(hot, F.col(key) == F.col("_hot"), "left")
    return dealt.withColumn("part", F.coalesce(part, F.lit(0))).drop(
        "_hot", "_parts", "_total"
    )


def row_bytes(df: DataFrame, fields: Sequence[str]) -> Column:
    """Bytes of the text in `fields`, and 8 for each other one that is not null."""
    types = dict(df.dtypes)
    sizes = [
        F.octet_length(name) if types[name] == "string" else F.when(F.col(name).isNotNull(), 8)
        for name in fields
    ]
    return sum((F.coalesce(size, F.lit(0)) for size in sizes), F.lit(0).cast("long"))


def deal_by_bytes(
    df: DataFrame,
    key: str,
    member: str,
    fields: Sequence[str],
    limit: int,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add `part`. Rows of a group, one per `member`, are cut in its order at every `limit` bytes.

    A row belongs to the part in which it begins, so the rows of a part have less than `limit`
    bytes before the last one. One that is longer than that leaves the numbers unused which
    it covers. Rows without a member count nothing. A hot group is summed up on two levels.
    """
    size = F.when(F.col(member).isNotNull(), row_bytes(df, fields))
    summed = running_sum(df, key, [member], size, "_before", bucket_rows)
    return summed.withColumn("part", F.floor(F.col("_before") / limit).cast("int")).drop("_before")


def repeat(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Each row once for every part of its group, numbered in `part`."""
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    repeated = df.join(hot, F.col(key) == F.col("_hot"), "left")
    return repeated.withColumn("part", F.explode(F.sequence(F.lit(0), last))).drop(
        "_hot", "_parts", "_total"
    )


def nest(
    df: DataFrame,
    group_columns: Sequence[str],
    fields: Sequence[str] = V.REVIEW_FIELDS,
    present: str = "review_id",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per group with `reviews`, sorted by the first field, from non-null `present`."""
    review = F.when(F.col(present).isNotNull(), F.struct(*fields))
    grouped = df.groupBy(*group_columns).agg(*extra, F.collect_list(review).alias("reviews"))
    return grouped.withColumn("reviews", F.sort_array("reviews"))


def with_totals(nested: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Add total_reviews and parts of the whole group to each row of `nested`.

    Those of hot groups come from the list of them, made with a `member`; all others are in
    one row.
    """
    if hot is None:
        return nested.withColumns({"total_reviews": total_reviews(), "parts": F.lit(1)})
    listed = nested.join(hot, F.col(key) == F.col("_hot"), "left")
    return (
        listed.withColumn("total_reviews", F.coalesce(F.col("_total").cast("int"), total_reviews()))
        .withColumn("parts", F.coalesce("_parts", F.lit(1)))
        .drop("_hot", "_parts", "_total")
    )


def with_totals_by_part(nested: DataFrame, key: str) -> DataFrame:
    """Add total_reviews and parts of the whole group to each row of `nested`, counted from its
    rows; their arrays are not moved for it."""
    totals = nested.groupBy(F.col(key).alias("_whole")).agg(
        F.sum(total_reviews()).cast("int").alias("total_reviews"),
        F.count(F.lit(1)).cast("int").alias("parts"),
    )
    return nested.join(totals, F.col(key) == F.col("_whole")).drop("_whole")


def total_reviews(reviews: str = "reviews") -> Column:
    """Length of the array, 0 for null."""
    return F.coalesce(F.array_size(reviews), F.lit(0))
