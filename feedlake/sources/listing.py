"""What files there are below a folder, listed by tasks.

Folders are listed level by level: the folders found by one round are dealt to the tasks of
the next. Neither the files nor the folders come to the driver.
"""

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.workspace import kept, qualified

ENTRY = "path string, folder boolean, size long, modified_at timestamp"


def list_files(spark: SparkSession, path: str, hidden: bool = False) -> DataFrame:
    """path, size, modified_at of the files below `path`, named in full as Spark names them.

    Names that begin with a dot or an underscore are left out, with all below them, unless
    `hidden`. A folder that is not there, or goes while it is listed, has no files. Folders are
    opened by Arrow: local ones, or by any scheme it knows.
    """
    # A local function goes to the workers by itself; they need not have this package.
    def listed(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for path in batch.column("path").to_pylist():
                if path.startswith("file:"):
                    system, place, root = fs.LocalFileSystem(), path[5:], "file:"
                else:
                    system, place = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
                    root = path[: len(path.rstrip("/")) - len(place.rstrip("/"))]
                entries = system.get_file_info(fs.FileSelector(place, allow_not_found=True))
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": [root + entry.path for entry in entries],
                        "folder": [entry.type == fs.FileType.Directory for entry in entries],
                        "size": [entry.size for entry in entries],
                        "modified_at": [entry.mtime for entry in entries],
                    },
                    schema=pa.schema(
                        [
                            ("path", pa.string()),
                            ("folder", pa.bool_()),
                            ("size", pa.int64()),
                            ("modified_at", pa.timestamp("us", "UTC")),
                        ]
                    ),
                )

    shown = F.lit(True) if hidden else ~F.element_at(F.split("path", "/"), -1).rlike("^[._]")
    frontier = spark.range(1).select(F.lit(qualified(spark, path)).alias("path"))
    rounds = []
    while not rounds or not frontier.isEmpty():
        dealt = frontier.repartition(F.col("path"))  # a task may get many folders, not all
        found = kept(dealt.mapInArrow(listed, ENTRY).where(shown), "listing")
        rounds.append(found)
        frontier = found.where("folder").select("path")
    every = reduce(DataFrame.unionAll, rounds)
    return every.where(~F.col("folder")).select("path", "size", "modified_at")


def referenced_files(table: DataFrame) -> DataFrame:
    """(path) of the files that `table`, read from files, is made of, named as `list_files` does:
    the metadata column has them as URIs, in which some letters are escaped."""
    uri = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return table.select(F.url_decode(uri).alias("path")).distinct()
