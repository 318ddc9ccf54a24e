"""Token ids in files of independent zstandard frames with a seek table.

A file holds one frame per document, in ascending order of doc_id, then a skippable frame
with the ids of the documents, then the seek table: a skippable frame with compressed size,
decompressed size and checksum of every frame before it, laid out as in the public format
"Zstandard Seekable". A common decompressor reads the file from front to back; a reader that
wants some documents reads the two tables at the end and decompresses only their frames.

The files' names are kept in a manifest, a table Spark commits. A task that is run again
writes a file of another name, and only the one that its finished attempt reports counts.
"""

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlake.llm.frames import small_batches, written
from feedlake.llm.tokens import TEXTS, encoder, little_endian

# Fixed values of the public format.
SKIPPABLE_MAGIC = 0x184D2A50
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

ENTRY = struct.Struct("<III")
FOOTER = struct.Struct("<IBI")
HEAD = struct.Struct("<II")
DOC = struct.Struct("<?q")

MANIFEST = "file long, path string, n_docs long, n_tokens long"
DOCUMENTS = "file long, position long, doc_id long, n_tokens long, ids_crc32 long"


def qualified(spark: SparkSession, folder: str) -> str:
    """`folder` with scheme and host, as Spark itself would resolve it: one without a scheme is
    on the cluster's default file system, not on the disk of whoever opens it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString()


def _filesystem(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), path


def checksum(data: bytes) -> int:
    """The low 32 bits of XXH64, as the seek table wants."""
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def write_file(path: str, documents: Iterable[tuple[int | None, bytes]]) -> tuple[int, int]:
    """Writes documents (id, ids as bytes) as they come; returns how many, and their tokens.

    Only the tables, 21 bytes a document, are held until the end.
    """
    import zstandard

    filesystem, place = _filesystem(path)
    compress = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
    seek, ids, count, tokens = bytearray(), bytearray(), 0, 0
    with filesystem.open_output_stream(place, compression=None) as out:
        for doc_id, data in documents:
            frame = compress(data)
            out.write(frame)
            seek += ENTRY.pack(len(frame), len(data), checksum(data))
            ids += DOC.pack(doc_id is not None, doc_id or 0)
            count += 1
            tokens += len(data) // 4
        out.write(HEAD.pack(SKIPPABLE_MAGIC, len(ids)) + ids)
        seek += ENTRY.pack(HEAD.size + len(ids), 0, checksum(b""))
        seek += FOOTER.pack(count + 1, HAS_CHECKSUMS, SEEKABLE_MAGIC)
        out.write(HEAD.pack(SEEK_TABLE_MAGIC, len(seek)) + seek)
    return count, tokens


class TokenFile:
    """A file opened for reading: its documents' ids, and their tokens frame by frame."""

    def __init__(self, path: str):
        filesystem, place = _filesystem(path)
        self.source = filesystem.open_input_file(place)
        size = self.source.size()
        frames, flags, magic = FOOTER.unpack(self._bytes(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_MAGIC or flags != HAS_CHECKSUMS:
            raise ValueError(f"{path} has no seek table with checksums")
        length = frames * ENTRY.size + FOOTER.size
        table = self._bytes(size - length, length)
        entries = [ENTRY.unpack_from(table, i * ENTRY.size) for i in range(frames)]
        self.frames, place = [], 0
        for compressed, plain, check in entries[:-1]:
            self.frames.append((place, compressed, plain, check))
            place += compressed
        ids = self._bytes(place + HEAD.size, entries[-1][0] - HEAD.size)
        self.doc_ids = [doc if there else None for there, doc in DOC.iter_unpack(ids)]

    def _bytes(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def tokens(self, position: int) -> bytes:
        """The ids of the document at `position`. Raises ValueError if they are damaged."""
        import zstandard

        start, compressed, plain, check = self.frames[position]
        data = zstandard.ZstdDecompressor().decompress(self._bytes(start, compressed))
        if len(data) != plain or checksum(data) != check:
            raise ValueError(f"frame {position} does not have the checksum of its entry")
        return data

    def find(self, doc_id: int) -> list[int]:
        """The positions of the documents with that id."""
        return [i for i, there in enumerate(self.doc_ids) if there == doc_id]

    def close(self) -> None:
        self.source.close()


def write_token_files(
    documents: DataFrame, folder: str, vocabulary: str, end_id: int, files: int | None = None
) -> DataFrame:
    """Encodes the whole text of every document and writes token files below `folder`.

    documents: doc_id, text; other columns are ignored. A null text has no tokens but the end
    id, like an empty one. Rows without doc_id come first; rows that repeat an id stand side
    by side, ordered by a hash of the text; even equal rows may be dealt to several files. A
    text is encoded whole: its words and ids are held at once, some 20 bytes a byte of text.
    folder: one that all executors share, on a file system that both Spark and Arrow open.
    files: how many; the number of shuffle partitions if not given.

    Returns the manifest: file (from 0, in the order of doc_id), path, n_docs, n_tokens.
    Files without documents are not written. An empty table gives an empty manifest.
    """
    spark = documents.sparkSession
    count = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end = encoder(vocabulary), little_endian([end_id])

        def encoded():
            for batch in small_batches(batches, "text", TEXTS):
                texts = encode(batch.column("text"))
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), texts):
                    yield doc_id, ids + end

        found = encoded()
        if (first := next(found, None)) is None:
            return
        number = TaskContext.get().partitionId()
        path = f"{folder}/tokens-{number:06d}-{uuid.uuid4().hex}.zst"
        docs, tokens = write_file(path, _chain(first, found))
        yield pa.RecordBatch.from_pylist(
            [{"file": number, "path": path, "n_docs": docs, "n_tokens": tokens}]
        )

    folder = qualified(spark, folder)
    _make_folder(folder)
    # The row's number parts copies of one document, of which there may be very many.
    order = ("doc_id", "tie", "row")
    ordered = documents.select(
        "doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row")
    )
    ordered = ordered.repartitionByRange(count, *order).sortWithinPartitions(*order)
    return written(ordered.select("doc_id", "text").mapInArrow(write, MANIFEST), "manifest")


def _chain(first, rest):
    yield first
    yield from rest


def _make_folder(folder: str) -> None:
    filesystem, place = _filesystem(folder)
    filesystem.create_dir(place, recursive=True)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """What the files of `manifest` hold, per document, each frame checked.

    Returns file, position (in the file), doc_id, n_tokens, ids_crc32. A frame whose bytes do
    not have the checksum of the seek table fails the job.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                source, rows = TokenFile(row["path"]), []
                for position, doc_id in enumerate(source.doc_ids):
                    data = source.tokens(position)
                    rows.append((row["file"], position, doc_id, len(data) // 4, zlib.crc32(data)))
                    if len(rows) == 10_000:
                        yield _documents(rows)
                        rows = []
                source.close()
                if rows:
                    yield _documents(rows)

    # One task a file: the manifest's rows are few and would else share a task.
    files = manifest.select("file", "path").repartition(_tasks(manifest.sparkSession), "file")
    return files.mapInArrow(read, DOCUMENTS)


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    names = ("file", "position", "doc_id", "n_tokens", "ids_crc32")
    columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
    return pa.RecordBatch.from_arrays(columns, names)


def token_positions(manifest: DataFrame) -> DataFrame:
    """The digest of `read_token_files` with start: the ids of all documents before each.

    Offsets of files come from the manifest, a row a file; within a file the tokens are
    summed up by position.
    """
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = manifest.select(
        F.col("file"), F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("offset")
    )
    earlier = (
        Window.partitionBy("file")
        .orderBy("position")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))
    documents = read_token_files(manifest).withColumn("inside", inside)
    return documents.join(offsets, "file").select(
        "doc_id",
        (F.col("offset") + F.col("inside")).cast("long").alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def read_documents(manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ids of the documents whose doc_id is in `wanted`; only their frames are read.

    Returns doc_id, ids (bytes). A doc_id that occurs several times gives as many rows; ids
    that are null or in no file give none. Of the files' tables of ids all are read, and joined
    with `wanted` by id.
    """
    ids = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).where(
        F.col("doc_id").isNotNull()
    )

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                source = TokenFile(path)
                source.close()
                doc_ids = pa.array(source.doc_ids, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(doc_ids)), pa.array(range(len(doc_ids)), pa.int64()), doc_ids],
                    ["path", "position", "doc_id"],
                )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, path = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path:
                    path, source = row["path"], TokenFile(row["path"])
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": [row["doc_id"]], "ids": [source.tokens(row["position"])]}
                )

    files = manifest.select("path").repartition(_tasks(manifest.sparkSession), "path")
    index = files.mapInArrow(listed, "path string, position long, doc_id long")
    places = index.join(ids.distinct(), "doc_id", "left_semi")
    places = places.repartition("path").sortWithinPartitions("path", "position")
    return places.mapInArrow(fetch, "doc_id long, ids binary")
