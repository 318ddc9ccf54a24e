"""Where intermediate tables go."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors share: spark.checkpoint.dir, or else the checkpoint folder set
    on the SparkContext. None if neither is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.sparkContext.getCheckpointDir()


def qualified(spark: SparkSession, path: str) -> str:
    """`path` with scheme and host, as Spark itself resolves it: one without a scheme is on the
    cluster's default file system, not on the disk of whoever opens it."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(named).toString()


def work_folder(spark: SparkSession, name: str) -> str:
    """The name of a new folder below the shared folder."""
    root = shared_folder(spark)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """`df` written to a work folder and read back, for a result that is used again."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
