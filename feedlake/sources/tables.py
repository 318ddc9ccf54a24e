"""Partitioned Parquet tables: written by partition overwrite, read with their schema."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.sources.listing import list_files
from feedlake.workspace import kept

__all__ = [
    "changed_partitions", "encode_partitions", "list_files", "overwrite_option", "read_table",
    "rewrite_changed", "row_count", "schema_table", "spread_for_write", "write_backup",
    "write_table",
]

# A partition directory cannot tell empty text from null, so empty text gets a name.
EMPTY_PARTITION = "__EMPTY__"


# For rows that hold long arrays. A row group is held in memory when written and decoded at
# once when read, so it is kept small, and its size is looked at every few rows.
LONG_ROWS = {"parquet.block.size": 32 << 20, "parquet.block.size.row.check.min": 10}


def _text_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [name for name in names if isinstance(df.schema[name].dataType, T.StringType)]


def _escaped(name: str) -> Column:
    """Empty text, and text that starts with the marker, gets the marker before it."""
    text = F.col(name)
    marked = (text == "") | text.startswith(EMPTY_PARTITION)
    return F.when(marked, F.concat(F.lit(EMPTY_PARTITION), text)).otherwise(text)


def _plain(name: str) -> Column:
    text = F.col(name)
    after = F.substring(text, len(EMPTY_PARTITION) + 1, 2**31 - 1)
    return F.when(text.startswith(EMPTY_PARTITION), after).otherwise(text)


def spread_for_write(df: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """Rows of a partition together, so that files are few, but not all in one task.

    A rebalance splits a partition that is too big for one task (a country with a third of
    all rows) and merges small ones, from the sizes the shuffle measured.
    """
    if not partition_columns:
        return df.hint("rebalance")
    return df.hint("rebalance", *[F.col(name) for name in partition_columns])


def encode_partitions(df: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    text = _text_columns(df, partition_columns)
    return df.withColumns({name: _escaped(name) for name in text})


def overwrite_option(mode: str) -> str:
    """Spark's name for a write mode."""
    if mode not in ("dynamic", "full"):
        raise ValueError(f"mode must be 'dynamic' or 'full', got {mode!r}")
    return "dynamic" if mode == "dynamic" else "static"


def write_table(
    df: DataFrame,
    path: str,
    partition_columns: Sequence[str] = (),
    mode: str = "dynamic",
    max_records_per_file: int = 0,
    spread: bool = True,
    options: Mapping[str, object] | None = None,
) -> None:
    """Write `df` to `path`, creating it if need be.

    mode "dynamic" replaces the partitions that occur in `df` and leaves all others;
    mode "full" replaces the whole table, so partitions gone from the feed go as well.
    """
    if mode == "dynamic" and not partition_columns:
        raise ValueError("mode 'dynamic' needs partition columns")
    rows = encode_partitions(df, partition_columns)
    if spread:
        rows = spread_for_write(rows, partition_columns)
    writer = (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite_option(mode))
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_records_per_file)
        .options(**(options or {}))
    )
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    writer.parquet(path)


def read_table(
    spark: SparkSession, path: str, schema: str, partition_columns: Sequence[str] = ()
) -> DataFrame:
    """Read `path` with `schema`, columns in its order.

    Columns the files lack (added to the table later) are null, and partition values keep
    the declared type: `01` stays text. Filters on partition columns still prune.
    """
    df = spark.read.schema(schema).parquet(path)
    declared = T.StructType.fromDDL(schema).fieldNames()
    text = set(_text_columns(df, partition_columns))
    return df.select(
        *[
            _plain(name).alias(name) if name in text else F.col(name)
            for name in declared
        ]
    )


def _fingerprints(df: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """Per partition its rows, and sums of hashes that do not depend on their order."""
    columns = sorted(df.columns)
    hashes = [
        F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(20,0)")).alias(f"_hash{seed}")
        for seed in (1, 2)
    ]
    return df.groupBy(*partition_columns).agg(F.count(F.lit(1)).alias("rows"), *hashes)


def changed_partitions(
    old: DataFrame, new: DataFrame, partition_columns: Sequence[str]
) -> DataFrame:
    """Per partition of either table: its values, rows_before, rows_after (0 where it is not)
    and change: new, changed, same or gone.

    Both hold the same columns, in any order. Partitions are compared as multisets of rows, so
    the order of rows does not matter and the number of copies does. Two sums of 64-bit hashes
    stand for the rows; they are summed up before anything is shuffled. Null is a partition
    value of its own. Columns of maps cannot be compared.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("the tables have different columns")
    before = _fingerprints(old, partition_columns).withColumnsRenamed(
        {name: f"_old_{name}" for name in (*partition_columns, "rows", "_hash1", "_hash2")}
    )
    after = _fingerprints(new, partition_columns)
    same_values = [F.col(name).eqNullSafe(F.col(f"_old_{name}")) for name in partition_columns]
    both = after.join(before, same_values, "full")
    hashes = [F.col(f"_hash{i}") == F.col(f"_old__hash{i}") for i in (1, 2)]
    change = (
        F.when(F.col("_old_rows").isNull(), "new")
        .when(F.col("rows").isNull(), "gone")
        .when((F.col("rows") == F.col("_old_rows")) & hashes[0] & hashes[1], "same")
        .otherwise("changed")
    )
    values = [
        F.when(F.col("rows").isNull(), F.col(f"_old_{name}")).otherwise(F.col(name)).alias(name)
        for name in partition_columns
    ]
    return both.select(
        *values,
        F.coalesce("_old_rows", F.lit(0)).alias("rows_before"),
        F.coalesce("rows", F.lit(0)).alias("rows_after"),
        change.alias("change"),
    )


def rewrite_changed(
    spark: SparkSession, path: str, df: DataFrame, partition_columns: Sequence[str]
) -> DataFrame:
    """Brings the table at `path` to hold `df`, writing only partitions that are new or changed.

    Returns what `changed_partitions` says, a written table. Files of the other partitions are
    not touched, so readers and copies of them need not be brought up to date. Partitions that
    `df` lacks are named as gone and stay, as with every dynamic overwrite.
    """
    schema = ", ".join(f"`{name}` {dtype}" for name, dtype in df.dtypes)
    old = read_table(spark, path, schema, partition_columns)
    changes = kept(changed_partitions(old, df, partition_columns), "changes")
    due = changes.where(F.col("change").isin("new", "changed")).select(
        *[F.col(name).alias(f"_due_{name}") for name in partition_columns]
    )
    if not due.isEmpty():
        met = [F.col(name).eqNullSafe(F.col(f"_due_{name}")) for name in partition_columns]
        # What is written must not be read from the files that the write replaces.
        rows = kept(df.join(due, met, "left_semi"), "due")
        write_table(rows, path, partition_columns)
    return changes


def write_backup(df: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> None:
    """Unpartitioned Parquet copy of a table, replacing the last one.

    It is a folder of files of bounded size rather than a single file, as a single file
    would put all rows through one task.
    """
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).parquet(path)


def row_count(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def schema_table(df: DataFrame) -> DataFrame:
    """One row per column: name, type and number of values that are not null."""
    filled = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("column"),
                    F.lit(dtype).alias("dtype"),
                    F.count(F.col(f"`{name}`")).alias("filled"),
                )
                for name, dtype in df.dtypes
            ]
        ).alias("columns")
    )
    return filled.select(F.inline("columns"))
