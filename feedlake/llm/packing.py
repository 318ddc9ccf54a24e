"""Best-fit packing of documents into training sequences of bounded length.

Documents are cut into pieces; pieces stream through tasks, each of which keeps a fixed number
of open sequences. A piece goes to the fullest open sequence it fits into. If it fits into
none, a new one is opened, and if there are too many then, the fullest is closed. Open
sequences are found by their free space: a bit is set for every amount of free space that an
open sequence has, so the best fit is the lowest bit not below the length of the piece.

Only lengths are packed. Tokens stay where they are, named by doc_id, piece and start.
"""

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import small_batches, written
from feedlake.llm.tokens import FEW_REMEMBERED, FEW_TEXTS, TEXTS, encoder, forget, little_endian

#: Sequences a task keeps open. More fit better and cost a few bytes each.
OPEN_SEQUENCES = 1024
#: Pieces a task should get at least: every task closes its open sequences half empty, so
#: little work is not spread thin.
PIECES_PER_TASK = 100_000

PIECES = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long"
SEQUENCE_BITS = 40


class OpenBins:
    """Bins of `capacity`, at most `limit` of them open."""

    def __init__(self, capacity: int, limit: int = OPEN_SEQUENCES):
        self.capacity, self.limit = capacity, limit
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.spaces = 0  # bit s is set if an open bin has s free
        self.open = self.opened = 0

    def place(self, length: int) -> tuple[int, int]:
        """Puts an item into a bin; returns the bin's number and the place in it."""
        fitting = self.spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.capacity, self.opened
            self.opened += 1
            if length < self.capacity and self.open == self.limit:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # the fullest
        if space > length:
            self._put(space - length, number)
        return number, self.capacity - space

    def _take(self, space: int) -> int:
        number = self.by_space[space].pop()
        self.open -= 1
        if not self.by_space[space]:
            self.spaces &= ~(1 << space)
        return number

    def _put(self, space: int, number: int) -> None:
        self.by_space[space].append(number)
        self.spaces |= 1 << space
        self.open += 1


def pieces(
    documents: DataFrame, vocabulary: str, end_id: int, capacity: int, lasting: bool = True
) -> DataFrame:
    """The documents' token ids, end id included, cut into pieces of `capacity`.

    Only longer documents are cut, and only their last piece may be shorter than `capacity`.
    A null text has no ids but the end id. Repeated rows are packed each by itself; `copy`
    tells them apart. Returns doc_id, copy, piece, start, length, ids_crc32 (of the piece).

    lasting: whether workers keep the encoder for their next tasks, or free it after each. One
    that does not last remembers fewer words and takes smaller slices, as it shares the memory.
    """
    texts, remembered = (TEXTS, None) if lasting else (FEW_TEXTS, FEW_REMEMBERED)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary, remembered), little_endian([end_id])
        for batch in small_batches(batches, "text", texts):
            rows = []
            encoded = encode(batch.column("text"))
            ids = (batch.column("doc_id").to_pylist(), batch.column("copy").to_pylist())
            for doc_id, copy, tokens in zip(*ids, encoded):
                tokens += end
                for piece, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[at : at + 4 * capacity]
                    rows.append((doc_id, copy, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield _batch(rows, PIECES)
        if not lasting:
            del encode
            forget(vocabulary)

    named = documents.select("doc_id", "text", F.monotonically_increasing_id().alias("copy"))
    return named.mapInArrow(cut, PIECES)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [field.split() for field in schema.split(", ")]
    columns = [
        pa.array(column, kinds[kind])
        for column, (_, kind) in zip(zip(*rows) if rows else [()] * len(fields), fields)
    ]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


def pack(
    items: DataFrame, capacity: int, open_sequences: int = OPEN_SEQUENCES, tasks: int | None = None
) -> DataFrame:
    """Adds sequence_id and offset to items with a `length` of 1 to `capacity`.

    Items meet in an order given by a hash of their columns, as sequences fill up best when
    long and short items are mixed, and so that a task that runs again packs alike. A hot
    length, source or document is dealt to all tasks by that hash. Items that fill a sequence
    alone take one each. Columns called sequence_id or offset are replaced.

    tasks: how many pack, each with sequences of its own; by default one for each
    PIECES_PER_TASK items, and no more than the shuffle partitions.
    """
    spark = items.sparkSession
    items = items.drop("sequence_id", "offset")
    if tasks is None:
        most = int(spark.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(1, min(most, items.count() // PIECES_PER_TASK))
    fields = items.schema.fields
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins = OpenBins(capacity, open_sequences)
        first = TaskContext.get().partitionId() << SEQUENCE_BITS
        for batch in batches:
            lengths = batch.column("length").to_pylist()
            placed = [bins.place(length) for length in lengths]
            numbers = pa.array([first + number for number, _ in placed], pa.int64())
            offsets = pa.array([offset for _, offset in placed], pa.int64())
            yield batch.append_column("sequence_id", numbers).append_column("offset", offsets)

    order = F.xxhash64(*[F.col(f"`{f.name}`") for f in fields], F.lit(1))
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{f.name}`") for f in fields]), F.lit(tasks))
    keyed = items.repartition(tasks, dealt).sortWithinPartitions(order)
    return keyed.mapInArrow(assign, f"{schema}, sequence_id long, offset long")


def pack_documents(
    documents: DataFrame,
    vocabulary: str,
    end_id: int,
    capacity: int = 4096,
    open_sequences: int = OPEN_SEQUENCES,
    lasting: bool = True,
) -> DataFrame:
    """Packs documents (doc_id, text; other columns are ignored) into sequences.

    Returns per piece doc_id, copy, piece, start, length, ids_crc32, sequence_id, offset. An
    empty table gives no rows. A doc_id may be null or occur several times. lasting: as in `pieces`.
    """
    cut = written(pieces(documents, vocabulary, end_id, capacity, lasting), "pieces")
    return pack(cut, capacity, open_sequences)


def sequence_tokens(
    packed: DataFrame, documents: DataFrame, vocabulary: str, end_id: int
) -> DataFrame:
    """The sequences themselves: sequence_id, ids (bytes), length, from documents packed before.

    doc_id must name one row of `documents`. At most one sequence is held at a time by a task.
    """

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary), little_endian([end_id])
        for batch in small_batches(batches, "text", TEXTS):
            encoded = encode(batch.column("text"))
            rows = []
            for row, tokens in zip(batch.drop_columns(["text"]).to_pylist(), encoded):
                tokens += end
                part = tokens[4 * row["start"] : 4 * (row["start"] + row["length"])]
                rows.append({k: row[k] for k in ("sequence_id", "offset")} | {"part": part})
            yield pa.RecordBatch.from_pylist(rows)

    found = packed.join(documents.select("doc_id", "text"), "doc_id").select(
        "sequence_id", "offset", "start", "length", "text"
    )
    parts = found.mapInArrow(slices, "sequence_id long, offset long, part binary")
    whole = F.array_sort(F.collect_list(F.struct("offset", "part")))
    joined = F.aggregate(whole, F.lit(b""), lambda ids, x: F.concat(ids, x["part"]))
    return (
        parts.groupBy("sequence_id")
        .agg(joined.alias("ids"))
        .withColumn("length", (F.length("ids") / 4).cast("long"))
    )
