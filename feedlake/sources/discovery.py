"""Tables whose files were written with different schemas, read by what the files say.

The footers are read by tasks. The types a column has are joined in a lattice: whole numbers
widen to longer ones, then to doubles; types that have nothing in common meet as text, and are
named as a conflict. The join is an aggregate over the footers, so it does not matter in what
order files come, and any number of generations of a table may be mixed.
"""

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.sources.listing import list_files
from feedlake.workspace import kept

#: Numbers from the narrowest to the widest. A long of more than 53 bits loses its last ones.
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
FOOTER = "path string, place long, name string, type string"


def footers(spark: SparkSession, path: str) -> DataFrame:
    """path, place, name, type of every column in every Parquet file below `path`, place being
    where it stands in its file. A file without columns gives no rows. Files are opened by
    Arrow; types it has and Spark's names do not are named as Arrow does."""

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        names = {
            "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint",
            "float": "float", "double": "double", "string": "string", "large_string": "string",
            "bool": "boolean", "date32[day]": "date", "binary": "binary",
        }

        def named(kind) -> str:
            if pa.types.is_timestamp(kind):
                return "timestamp" if kind.tz else "timestamp_ntz"
            if pa.types.is_decimal(kind):
                return f"decimal({kind.precision},{kind.scale})"
            return names.get(str(kind), str(kind))

        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                if path.startswith("file:"):
                    system, place = fs.LocalFileSystem(), path[5:]
                else:
                    system, place = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
                with system.open_input_file(place) as source:
                    schema = pq.read_schema(source)
                found += [
                    {"path": path, "place": i, "name": field.name, "type": named(field.type)}
                    for i, field in enumerate(schema)
                ]
            if found:
                yield pa.RecordBatch.from_pylist(found)

    files = list_files(spark, path).select("path").where(F.col("path").endswith(".parquet"))
    return kept(files.repartition("path").mapInArrow(read, FOOTER), "footers")


def _joined(types: Column) -> Column:
    """The least type that all of `types`, an array of distinct ones, can be read as."""
    ranks = F.transform(types, lambda t: F.array_position(F.lit(list(NUMBERS)), t))
    number = F.element_at(F.lit(list(NUMBERS)), F.greatest(F.array_max(ranks), F.lit(1)).cast("int"))
    # A long beside a float needs a double.
    wide = F.array_contains(types, "float") & (F.array_contains(types, "bigint") | F.array_contains(types, "int"))
    return (
        F.when(F.size(types) == 1, types[0])
        .when(F.array_min(ranks) > 0, F.when(wide, "double").otherwise(number))
        .otherwise("string")
    )


def discovered_schema(found: DataFrame) -> DataFrame:
    """A row per column of `footers`: name, type, types (sorted), files (that have it) and
    conflict (its types have nothing in common, so it is read as text). Ordered by the first
    place that a file has it at, then by name."""
    columns = found.groupBy("name").agg(
        F.sort_array(F.collect_set("type")).alias("types"),  # as many as there are types
        F.countDistinct("path").alias("files"),
        F.min("place").alias("place"),
    )
    ranks = F.transform("types", lambda t: F.array_position(F.lit(list(NUMBERS)), t))
    conflict = (F.size("types") > 1) & (F.array_min(ranks) == 0)
    return columns.select(
        "name", _joined(F.col("types")).alias("type"), "types", "files", conflict.alias("conflict"), "place"
    ).orderBy("place", "name").drop("place")


def read_discovered(
    spark: SparkSession, path: str, partition_columns: Sequence[str] = ()
) -> DataFrame:
    """The table at `path`, with every column that any of its files has, in the joined types.

    Columns a file lacks are null. Partition columns come last, as text. Files of one schema are
    read together, so there are as many scans as schemas; each prunes by filters and columns on
    its own. The names of the files come to the driver, as they do in any scan. Names that
    differ in case only cannot be told apart and are an error, as is a table without files.
    """
    found = footers(spark, path)
    schema = discovered_schema(found).collect()  # a row a column
    if not schema:
        raise ValueError(f"no file in {path} has a column")
    lowered = [row["name"].lower() for row in schema]
    if len(set(lowered)) < len(lowered):
        raise ValueError(f"columns of {path} differ in case only")
    own = F.sort_array(F.collect_list(F.struct("place", "name", "type"))).alias("own")
    generations = found.groupBy("path").agg(own).groupBy("own").agg(F.collect_list("path").alias("files"))
    parts = []
    for row in generations.collect():
        declared = [f"`{field['name']}` {field['type']}" for field in row["own"]]
        declared += [f"`{name}` string" for name in partition_columns]
        reader = spark.read.schema(", ".join(declared)).option("basePath", path)
        read = reader.parquet(*row["files"])
        has = {field["name"] for field in row["own"]}
        parts.append(
            read.select(
                *[
                    (F.col(f"`{c['name']}`") if c["name"] in has else F.lit(None))
                    .cast(c["type"])
                    .alias(c["name"])
                    for c in schema
                ],
                *partition_columns,
            )
        )
    return reduce(DataFrame.unionAll, parts)
