"""Column profiles from sketches that are kept per partition and merged.

One pass makes, for each partition of a table and each column, exact counts and bounds, and three
sketches: of the distinct values, of the quantiles of numbers, and of the most frequent values.
Profiles of partitions are small rows that can be stored; a partition that changes is profiled
anew, and the table's profile is merged from the rows without reading it again.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the registers of the distinct sketch, and its relative standard error.
REGISTERS, DISTINCT_ERROR = 12, 0.016
#: Size of the quantile sketch, and by how much a rank may be off (at 99 %).
QUANTILE_SIZE, RANK_ERROR = 200, 0.0166
#: Values the frequency sketch tracks; counts are off by at most the rows divided by it.
TRACKED, FREQUENT = 1_000, 5

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _is_number(dtype: str) -> bool:
    return dtype in NUMERIC or dtype.startswith("decimal")


def _column(name: str, dtype: str, text_column: str) -> Column:
    value, text = F.col(f"`{name}`"), F.col(f"`{text_column}`")
    # The two zeros are one value.
    number = value.cast("double") + 0.0 if _is_number(dtype) else F.lit(None).cast("double")
    return F.struct(
        F.lit(name).alias("name"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(value.isNull()).alias("nulls"),
        F.min(number).alias("least"),
        F.max(number).alias("most"),
        F.min(F.lit(None) if _is_number(dtype) else text).cast("string").alias("first"),
        F.max(F.lit(None) if _is_number(dtype) else text).cast("string").alias("last"),
        F.hll_sketch_agg(text, REGISTERS).alias("distinct_sketch"),
        F.kll_sketch_agg_double(number, QUANTILE_SIZE).alias("quantile_sketch"),
        F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED)).alias("frequent_sketch"),
    )


def partition_profiles(df: DataFrame, by: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """Per partition (`by`) and column: rows, nulls, least and most of numbers, first and last of
    all else as text, and the three sketches. columns: all that are not in `by` if not given;
    they must be of simple types. Partial sketches are merged, however large a partition is.
    """
    types = dict(df.dtypes)
    chosen = [name for name in (columns or df.columns) if name not in by]
    # Each value is made a text once, for all that is made of it.
    texts = {name: f"_text_{i}" for i, name in enumerate(chosen)}
    told = df.select(
        *by,
        *[F.col(f"`{name}`") for name in chosen],
        *[F.col(f"`{name}`").cast("string").alias(text) for name, text in texts.items()],
    )
    # Counts and sketches of all columns in one pass.
    columns_made = [_column(name, types[name], texts[name]) for name in chosen]
    made = told.groupBy(*by).agg(F.array(*columns_made).alias("_made"))
    return made.select(*by, F.inline("_made"))


def merged_profile(profiles: DataFrame) -> DataFrame:
    """Per column of stored `partition_profiles`, over all partitions: rows, nulls, least, most,
    first, last; about how many distinct values there are, the quartiles of numbers (null if
    there are none), and the most frequent values as text with about how many rows have them."""
    quartiles = [
        F.when(
            F.col("least").isNotNull(),
            F.kll_sketch_get_quantile_double("quantiles", F.lit(share)),
        )
        for share in (0.25, 0.5, 0.75)
    ]
    merged = profiles.groupBy("name").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantiles"),
        F.call_function("approx_top_k_combine", F.col("frequent_sketch"), F.lit(TRACKED)).alias("frequent"),
    )
    top = F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(FREQUENT))
    return merged.select(
        "name", "rows", "nulls", "least", "most", "first", "last", "distinct",
        F.array(*quartiles).alias("quartiles"), top.alias("frequent"),
    )
