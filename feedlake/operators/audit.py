"""Row counts of a build without counting jobs.

`observed` counts rows on their way into a write. It must be the last step before the
write: there a row is counted once even if executors are lost, while a count taken before
a shuffle would grow when that shuffle's tasks run again. Counts from before a shuffle
come from `audit_counts`, one query over pre-aggregated keys.
"""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """`df` with `rows` and the named metrics observed by the write that follows."""
    observation = Observation(name)
    counted = df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *[metric.alias(metric_name) for metric_name, metric in metrics.items()],
    )
    return counted, observation


def audit_counts(details: DataFrame, search: DataFrame) -> DataFrame:
    """One row of counts for the rental build, from extracted details and search rows.

    Both sides are reduced to one row per key before they meet, so nothing is counted on
    the joined rows and a hot key costs one row.
    """
    key = F.col("source_id")
    missing = key.isNull() | (key == "")
    per_id = (
        details.withColumn("_key", F.when(~missing, key))
        .groupBy("_key")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    per_search = search.groupBy("search_id").agg(
        F.count(F.lit(1)).alias("offers"),
        F.count_if(F.col("usd_price").isNull()).alias("priceless"),
    )
    kept = F.col("_key").isNotNull()
    copies, offers = F.col("copies"), F.col("offers")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return per_id.join(per_search, F.col("_key") == F.col("search_id"), "left").agg(
        total(copies).alias("details_rows"),
        total(F.when(~kept, copies)).alias("dropped_missing_key"),
        total(F.when(kept, copies - 1)).alias("removed_duplicates"),
        total(offers).alias("matched_rows"),
        F.count_if(kept & offers.isNull()).alias("unmatched_rows"),
        total(F.col("priceless")).alias("defaulted_prices"),
    )
