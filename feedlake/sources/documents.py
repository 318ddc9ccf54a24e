"""One JSON document per property."""

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake import fixed_values as V
from feedlake.functions.names import document_key
from feedlake.operators.nest import total_reviews
from feedlake.sources.tables import encode_partitions, overwrite_option, spread_for_write
from feedlake.workspace import kept

#: Bytes of documents in a file of an indexed set.
SHARD_BYTES = 128 << 20


def _document_reviews(nested: DataFrame) -> Column:
    """The reviews with their document names. A cast renames fields by position."""
    review = nested.schema["reviews"].dataType.elementType
    renamed = T.StructType(
        [
            T.StructField(V.DOCUMENT_REVIEW_NAMES.get(field.name, field.name), field.dataType)
            for field in review
        ]
    )
    return F.coalesce(F.col("reviews").cast(T.ArrayType(renamed)), F.array())


def _total(nested: DataFrame) -> Column:
    """total_reviews of the whole property; the length of its array if `nested` does not say."""
    said = F.col("total_reviews") if "total_reviews" in nested.columns else total_reviews()
    return said.cast("int").alias("total_reviews")


def documents(
    nested: DataFrame, scalars: Sequence[str], key: str, pretty: bool = False
) -> DataFrame:
    """(doc_key, country_code, document) for each row of `nested`.

    The document holds `scalars`, total_reviews and reviews, nulls included, on one line
    unless `pretty`. A property too big for one row has several documents. Only these say
    their number and into how many the property was dealt, in `part` and `parts` before the
    reviews; the number is also in the key, and total_reviews is of the whole.
    """
    doc_key = document_key(F.col(key))
    if "part" in nested.columns:
        part = F.col("part")
        doc_key = F.when(part > 0, F.concat_ws(".", doc_key, part)).otherwise(doc_key)

    def body(*counts: Column) -> Column:
        reviews = _document_reviews(nested).alias("reviews")
        whole = F.struct(*scalars, _total(nested), *counts, reviews)
        return F.to_json(whole, {"ignoreNullFields": "false", "pretty": pretty})

    document = body()
    if {"part", "parts"} <= set(nested.columns):
        split = [F.col(name).cast("int").alias(name) for name in ("part", "parts")]
        document = F.when(F.col("parts") > 1, body(*split)).otherwise(document)
    return nested.select(doc_key.alias("doc_key"), "country_code", document.alias("document"))


def _write_text(docs: DataFrame, path: str, folder: str, mode: str) -> None:
    (
        docs.select("document", folder)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite_option(mode))
        .partitionBy(folder)
        .text(path)
    )


def write_documents(
    docs: DataFrame, path: str, mode: str = "full", spread: bool = True
) -> None:
    """JSON Lines, one document per line, in one folder per country. The default.

    mode "dynamic" replaces the countries that occur in `docs` and leaves all others.
    """
    rows = encode_partitions(docs.select("document", "country_code"), ["country_code"])
    if spread:
        rows = spread_for_write(rows, ["country_code"])
    _write_text(rows, path, "country_code", mode)


def write_document_files(docs: DataFrame, path: str, mode: str = "full") -> None:
    """One folder with one file per key, `doc_key=<key>/`. For small sets of documents.

    Two documents with one key would share a folder, so they are an error.
    """
    clash = docs.groupBy("doc_key").count().where("count > 1").select("doc_key").take(5)
    if clash:
        raise ValueError(f"several documents share a key: {[row.doc_key for row in clash]}")
    _write_text(docs, path, "doc_key", mode)


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_indexed(
    docs: DataFrame, path: str, index_path: str, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """JSON Lines in files of some `shard_bytes`, and an index to fetch single documents by.

    Documents are dealt to shards by a hash of their key, one file each, in the order of key
    and text. A task writes many shards if they are small. The index, a Parquet table at `index_path`, has a row for each: doc_key, file,
    offset and length in bytes, crc32. Offsets are running sums within a shard, which is no
    longer than one task writes. Keys need not be distinct. Both are replaced; the index is
    written last. Returns it. No documents, no files and an empty index.
    """
    spark = docs.sparkSession
    size = F.octet_length("document").cast("long")
    rows = kept(docs.select("doc_key", "document"), "documents")
    total = rows.agg(F.coalesce(F.sum(size + 1), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-total // shard_bytes))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_key"), F.lit(shards)).cast("int"))
    order = ("doc_key", "document")
    tasks = min(shards, max(_partitions(spark), -(-total // SHARD_BYTES)))
    ordered = dealt.repartition(tasks, "shard").sortWithinPartitions("shard", *order)
    _write_text(ordered, path, "shard", "full")

    named = spark.createDataFrame([], "shard int, file string")
    if total:
        files = spark.read.format("binaryFile").load(path)  # names alone are read
        named = files.select(F.col("shard").cast("int"), F.col("path").alias("file"))
        if named.groupBy("shard").count().where("count > 1").take(1):
            raise ValueError(f"a shard in {path} has several files")
    before = Window.partitionBy("shard").orderBy(*order)
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.select(
        "shard",
        "doc_key",
        F.coalesce(F.sum(size + 1).over(before), F.lit(0)).alias("offset"),
        size.alias("length"),
        F.crc32("document").alias("crc32"),
    )
    index = placed.join(named, "shard").select("doc_key", "file", "offset", "length", "crc32")
    index.write.mode("overwrite").parquet(index_path)
    return spark.read.schema(index.schema).parquet(index_path)


def fetch(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_key, document) of the documents whose key is in `wanted` (doc_key), by an index that
    `write_indexed` made. Only their bytes are read; those of a file together, in order.

    Keys that are null or not in the index give no row, repeated ones one row a document. Bytes
    that do not have the checksum of the index fail the job. Files are opened by Arrow: local
    ones, or by any scheme it knows.
    """

    def read(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa
        from pyarrow import fs

        name, source = None, None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["file"] != name:
                    name = row["file"]
                    if name.startswith("file:"):
                        system, place = fs.LocalFileSystem(), "/" + name[5:].lstrip("/")
                    else:
                        system, place = fs.FileSystem.from_uri(name.replace("s3a://", "s3://", 1))
                    source = system.open_input_file(place)
                source.seek(row["offset"])
                data = source.read(row["length"])
                if zlib.crc32(data) != row["crc32"]:
                    raise ValueError(f"{name} does not hold {row['doc_key']} at {row['offset']}")
                found.append({"doc_key": row["doc_key"], "document": data.decode()})
            if found:
                yield pa.RecordBatch.from_pylist(found)

    keys = wanted.select("doc_key").where(F.col("doc_key").isNotNull()).distinct()
    rows = index.join(keys, "doc_key", "left_semi")
    # By number: rows of an index are short, and would be put together into too few tasks.
    tasks = _partitions(index.sparkSession)
    rows = rows.repartition(tasks, "file").sortWithinPartitions("file", "offset")
    return rows.mapInArrow(read, "doc_key string, document string")


def read_documents(spark, path: str, schema: str, pretty: bool = False) -> DataFrame:
    """Documents back as rows, from either layout; pretty ones take several lines each."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    return reader.option("multiLine", pretty).json(path)
