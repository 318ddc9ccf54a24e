"""Near-duplicate embeddings: sign hashes of random hyperplanes, verified by exact cosine.

Equal vectors are one class. Every class is hashed in several tables, each time to the signs of
its products with some random hyperplanes, and is compared with all classes in its buckets. The
number of planes grows with the logarithm of the classes, so that buckets stay as full, and the
number of tables so that a pair at the threshold meets with the same probability at any size.

No pairs leave a task: a task compares the blocks of one or two parts of a bucket, and returns
for each class how many vectors it found and one class of its local component. A pair counts
in the first table that it meets in only.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.components import components
from feedlake.llm.frames import written
from feedlake.llm.vectors import rows_of

#: Classes a bucket holds on average, and at most before it is split into parts.
BUCKET = 512
BLOCK = 2048
#: Chance that a pair with a cosine just at the threshold meets in some table.
RECALL = 0.999

FOUND = "c long, links long, root long"


@dataclass(frozen=True)
class Planes:
    """`tables` times `bits` hyperplanes, the same in every task."""

    tables: int
    bits: int
    seed: int = 17

    @classmethod
    def fitting(cls, classes: int, threshold: float, recall: float = RECALL) -> "Planes":
        """Planes for so many classes. A pair at the threshold has the same sign with respect
        to a random plane with probability 1 - angle / pi."""
        bits = max(1, min(30, round(math.log2(max(classes, 2) / BUCKET))))
        same = (1 - math.acos(threshold) / math.pi) ** bits
        return cls(math.ceil(math.log(1 - recall) / math.log(1 - same)), bits)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """vector x table: the bucket of each vector in each table."""
        random = np.random.RandomState((self.seed, vectors.shape[1]))
        planes = random.standard_normal((vectors.shape[1], self.tables * self.bits))
        signs = (vectors @ planes > 0).reshape(len(vectors), self.tables, self.bits)
        return signs @ (1 << np.arange(self.bits, dtype=np.int64))


def near_duplicates(
    embeddings: DataFrame, threshold: float = 0.9, recall: float = RECALL
) -> DataFrame:
    """Links between vectors with a cosine of at least `threshold`, and their components.

    embeddings: vec_id, embedding (array of numbers); other columns are ignored. Returns per row
    vec_id, n_links (other rows linked directly), component_id (smallest vec_id reachable by
    links, itself included) and kept (vec_id = component_id). No link is below the threshold; a
    pair at it is missed with probability 1 - recall, a closer one less often.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing,
    as do vectors of different lengths with each other. Rows that repeat a vec_id are vectors of
    their own. A null vec_id is never the smallest, and is not kept. No rows, no result.
    """
    named = written(_named(embeddings), "vectors")
    classes = _classes(named)
    planes = Planes.fitting(classes.count(), threshold, recall)
    found = written(_compared(_dealt(classes, planes), planes, threshold), "found")
    return _result(named, classes, found)


def _named(embeddings: DataFrame) -> DataFrame:
    """vec_id, sig (hash of the vector; null if it takes no part) and vector (its doubles)."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            data = [_sound(row) for row in rows_of(batch.column("embedding"))]
            signatures = [None if d is None else xxhash.xxh3_128_digest(d) for d in data]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(signatures, pa.binary()),
                    pa.array(data, pa.binary()),
                ],
                ["vec_id", "sig", "vector"],
            )

    ids = F.col("vec_id").cast("long").alias("vec_id")
    doubles = F.col("embedding").cast("array<double>").alias("embedding")
    schema = "vec_id long, sig binary, vector binary"
    return embeddings.select(ids, doubles).mapInArrow(name, schema)


def _sound(row: np.ndarray | None) -> bytes | None:
    """The vector's bytes, scaled so that the product of any two can neither overflow nor
    vanish, by a power of two: cosines stay what they are."""
    if row is None or not row.any():
        return None
    exponent = int(np.frexp(np.abs(row).max())[1])
    return np.ldexp(row, -exponent).tobytes()


def _classes(named: DataFrame) -> DataFrame:
    """One row per distinct vector: c (a number), sig, n (rows), vec_id (smallest), vector."""
    classes = (
        named.where("sig is not null")
        .groupBy("sig")
        .agg(
            F.count("*").alias("n"),
            F.min("vec_id").alias("vec_id"),
            F.first("vector").alias("vector"),
        )
    )
    return written(classes.withColumn("c", F.monotonically_increasing_id()), "classes")


def _dealt(classes: DataFrame, planes: Planes) -> DataFrame:
    """A row per class, table and pair of parts of a bucket that the class is compared in."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("vector").to_pylist()
            lengths = np.array([len(d) for d in data])
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                rows = np.frombuffer(b"".join(data[i] for i in at), dtype=np.float64)
                keys = planes.buckets(rows.reshape(len(at), -1)).astype(np.int32)
                yield (
                    batch.take(pa.array(at))
                    .append_column("dim", pa.array(np.full(len(at), length // 8, np.int32)))
                    .append_column("keys", pa.array(keys.tolist(), pa.list_(pa.int32())))
                )

    schema = "c long, n long, vector binary, dim int, keys array<int>"
    keyed = written(classes.select("c", "n", "vector").mapInArrow(hashed, schema), "keys")
    bucket = ["table", "dim", "bucket"]
    counts = keyed.select("dim", F.posexplode("keys").alias("table", "bucket"))
    crowded = counts.groupBy(*bucket).count().where(F.col("count") > BLOCK)
    parts = F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")
    crowded = written(crowded.select(*bucket, parts), "crowded")
    rows = keyed.select("*", F.posexplode("keys").alias("table", "bucket"))
    rows = rows.join(crowded, bucket, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("c", "table"), F.col("parts")).cast("int")
    rows = rows.withColumn("part", part).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    return rows.select(
        *bucket,
        F.least("part", "other").alias("low"),
        F.greatest("part", "other").alias("high"),
        "part",
        "c",
        "n",
        "vector",
        "keys",
    )


def _compared(dealt: DataFrame, planes: Planes, threshold: float) -> DataFrame:
    """Per class and block: links found there first (in vectors), and a class linked by them."""
    key = ["table", "dim", "bucket", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = list(zip(*(batch.column(name).to_pylist() for name in key)))
            starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            for first, end in zip(starts, [*starts[1:], len(keys)]):
                if held and keys[first] != last:
                    yield from _block(pa.Table.from_batches(held), threshold)
                    held = []
                held.append(batch.slice(first, end - first))
                last = keys[first]
        if held:
            yield from _block(pa.Table.from_batches(held), threshold)

    spread = dealt.repartition(*key).sortWithinPartitions(*key)
    return spread.mapInArrow(compare, FOUND)


def _block(rows: pa.Table, threshold: float) -> Iterator[pa.RecordBatch]:
    """Compares the classes of one block, or those of its two parts with each other."""
    if len(rows) < 2:
        return
    vectors = np.frombuffer(b"".join(rows["vector"].to_pylist()), dtype=np.float64)
    vectors = vectors.reshape(len(rows), -1)
    unit = np.linalg.norm(vectors, axis=1)
    keys = np.array(rows["keys"].to_pylist(), dtype=np.int32)
    table, low, high = (rows[name][0].as_py() for name in ("table", "low", "high"))
    part = rows["part"].to_numpy()
    one = np.arange(len(rows)) if low == high else np.flatnonzero(part == low)
    other = one if low == high else np.flatnonzero(part == high)
    firsts, seconds = [], []
    for at in range(0, len(one), 256):  # bounds what is held to 256 x 2 BLOCK numbers
        some = one[at : at + 256]
        cosine = (vectors[some] @ vectors[other].T) / np.outer(unit[some], unit[other])
        i, j = np.nonzero(cosine >= threshold)
        i, j = some[i], other[j]
        new = i < j if low == high else np.ones(len(i), dtype=bool)
        i, j = i[new], j[new]
        for earlier in range(table):
            if not len(i):
                break
            apart = keys[i, earlier] != keys[j, earlier]
            i, j = i[apart], j[apart]
        firsts.append(i)
        seconds.append(j)
    i, j = np.concatenate(firsts), np.concatenate(seconds)
    if not len(i):
        return
    size, c = rows["n"].to_numpy(), rows["c"].to_numpy()
    links = np.zeros(len(rows), dtype=np.int64)
    np.add.at(links, i, size[j])
    np.add.at(links, j, size[i])
    root = _local_roots(len(rows), i, j)
    met = np.flatnonzero(links)
    yield pa.RecordBatch.from_arrays(
        [pa.array(c[met]), pa.array(links[met]), pa.array(c[root[met]])], ["c", "links", "root"]
    )


def _local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, i, root[j])
        np.minimum.at(least, j, root[i])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _result(named: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("c").alias("a"), F.col("root").alias("b")))
    roots = joined.select(F.col("id").alias("c"), "component")
    placed = classes.select("c", "sig", "n", "vec_id").join(links, "c", "left").join(roots, "c", "left")
    placed = placed.withColumn("component", F.coalesce("component", "c"))
    smallest = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    known = placed.join(smallest, "component").select(
        "sig", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    known = written(known, "classes-linked")
    linked = named.where("sig is not null").join(known, "sig")
    alone = named.where("sig is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    rows = linked.select("vec_id", "n_links", "component_id").union(alone)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return rows.select("*", kept)
