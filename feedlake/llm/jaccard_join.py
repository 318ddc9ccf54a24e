"""Similarity join of documents by the Jaccard similarity of their word shingles.

A prefix join: two sets that are similar enough share a shingle among the first few of each, in
any order of shingles that is the same for all. Documents are grouped first: those with one
set are one class, and classes whose sets have the same size and the same prefix are one group.

1. All shingles are counted in a sketch of fixed size. The order of shingles puts common ones
   last, by the logarithm of their count, so that prefixes hold no shingle of a passage that
   many documents share; among equals it goes by hash, so that a small change leaves most
   prefixes alone.
2. Every document becomes a size, a hash of its whole set and a prefix. Classes and groups are
   aggregates of these; texts are not shuffled.
3. Classes are compared with the leader of their group. In some rounds the groups of prefix
   shingles that many have are then compared with a few leaders: no more pairs than rows,
   however large a family of copies is. Pairs are verified on the whole sets, and components
   are made of the links.
4. Last, all group pairs in different components that share a shingle as early in their prefixes
   as two similar sets of their sizes must are expanded to their classes, and those in different
   components are verified. This completes the links between components. What is left out
   are pairs in one component, which no link could change.

Pairs are compared by histograms of their sets first. Both these and the sets of the few classes
that pass are made again from the texts when they are needed, of one row per class, found by a
bitmap of bounded size, instead of carrying the sets of all documents along.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.components import components
from feedlake.llm.frames import small_batches, written
from feedlake.llm.shingles import shingle_sets, texts_of

#: Counters of the sketch; a byte each, in a task, on the driver and in the broadcast.
SKETCH = 1 << 24
#: Rows the sketch is passed on in.
SKETCH_PARTS = 64
#: Sums are passed on as logarithms, in so many steps a doubling.
STEPS = 8
#: A shingle is common if its counter is above the mean by so many standard deviations of what
#: rare shingles give, and by LEAST_COMMON more.
DEVIATIONS = 4
LEAST_COMMON = 4
#: Groups of one prefix shingle above which they are compared with leaders before each other.
CROWD = 8
#: Rounds of comparing with leaders, and leaders that a large family of copies has in each. More
#: rounds leave fewer pairs for the last step, and each takes a pass over the texts.
ROUNDS, LEADERS = 1, 4
#: Bytes of text a task makes sets of at once.
TEXTS = 500_000
#: Bits of the bitmaps that say which sets or shingles are wanted: some for each, within bounds;
#: 16 MB at most. A fuller bitmap lets more pass that a join then drops.
LEAST_BITS, MOST_BITS, BITS_EACH = 1 << 20, 1 << 27, 8


@dataclass(frozen=True)
class Similarity:
    """Shingles of `words` words; links at a Jaccard similarity of at least num / den."""

    words: int = 5
    num: int = 80
    den: int = 100

    def linked(self, one: int, other: int, both: int) -> bool:
        return both > 0 and self.den * both >= self.num * (one + other - both)

    def prefix(self, size: int) -> int:
        """How many first shingles two similar sets are sure to share one of."""
        return size - -(-self.num * size // self.den) + 1


def jaccard_join(documents: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """Components of similar documents. documents: doc_id, text; other columns are ignored.

    Returns per row doc_id, n_shingles and component_id, the smallest doc_id reachable by links.
    Rows are linked by their texts: rows that repeat a doc_id with another text may be in
    different components. A text that is null, empty or blank has no shingles and links with
    nothing; its component is its own doc_id. A null doc_id is never the smallest; a component
    of only such rows has none. An empty table gives no rows.
    """
    levels = _levels(documents, similarity)
    sets = written(_prefixes(documents, similarity, levels), "prefixes")
    classes = written(_classes(sets), "classes")
    groups = _groups(sets)
    members = classes.join(groups.select("n", "start", "g", "leader"), ["n", "start"])
    members = written(members.select("sig", "g", "leader"), "members")
    shared = _shared_prefixes(groups)
    crowded = written(_crowded(shared), "crowded")
    rooted = members.withColumn("component", F.col("sig"))
    own = members.select(F.col("leader").alias("a"), F.col("sig").alias("b")).where("a <> b")
    links = _verified(written(own, "pairs"), documents, classes, similarity)
    for number in range(ROUNDS):
        leaders = written(_leader_pairs(crowded, rooted, similarity, number), "pairs")
        links = links.union(_verified(leaders, documents, classes, similarity))
        rooted = written(_with_component(members, components(links)), "rooted")
        # All links so far lie within these components: classes linked with the first of theirs.
        links = rooted.where("component <> sig").select(F.col("sig").alias("a"), F.col("component").alias("b"))
    crossing = written(_cross_pairs(shared, rooted, similarity), "pairs")
    links = links.union(_verified(crossing, documents, classes, similarity))
    return _result(sets, classes, components(links))


def _sets(batch: pa.RecordBatch, similarity: Similarity) -> list[np.ndarray]:
    return shingle_sets(texts_of(batch, "text"), similarity.words)


def _digest(data: bytes) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(data)


def _levels(documents: DataFrame, similarity: Similarity) -> np.ndarray:
    """Per counter of the sketch, how common its shingles are: 0, or 1 and up by doublings."""
    part = SKETCH // SKETCH_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, dtype=np.uint8)
        for batch in small_batches(batches, "text", TEXTS):
            for values in _grouped(_sets(batch, similarity)):
                place, more = np.unique(values % np.uint64(SKETCH), return_counts=True)
                counts[place] = np.minimum(counts[place] + more, 255)
        if counts.any():
            for number in range(SKETCH_PARTS):
                yield _part(number, counts[number * part : (number + 1) * part])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(*(column.to_pylist() for column in batch.columns)):
                values = np.frombuffer(zlib.decompress(data), dtype=np.uint8)
                total[number] = total.get(number, 0) + values.astype(np.int64)
        for number, values in total.items():
            yield _part(number, np.minimum(np.round(STEPS * np.log2(1 + values)), 255))

    def _part(number, values):
        data = zlib.compress(values.astype(np.uint8).tobytes(), 1)
        return pa.RecordBatch.from_pydict(
            {"part": pa.array([number], pa.int32()), "counts": pa.array([data], pa.binary())}
        )

    schema = "part int, counts binary"
    summed = documents.select("text").mapInArrow(count, schema).repartition("part")
    codes = np.zeros(SKETCH, dtype=np.uint8)
    for row in summed.mapInArrow(add, schema).collect():  # SKETCH bytes in all, in one job
        values = np.frombuffer(zlib.decompress(row["counts"]), dtype=np.uint8)
        codes[row["part"] * part : (row["part"] + 1) * part] = values
    counts = 2.0 ** (np.arange(256) / STEPS) - 1
    mean = float((np.bincount(codes, minlength=256) * counts).sum() / SKETCH)
    least = mean + DEVIATIONS * mean**0.5 + LEAST_COMMON
    level = np.where(counts > least, 1 + np.log2(np.maximum(counts, 1) / least), 0)
    return level.astype(np.uint8)[codes]


def _grouped(sets: list[np.ndarray], size: int = 500_000):
    """The values of many sets together, about `size` at a time."""
    held, count = [], 0
    for values in sets:
        held.append(values)
        count += len(values)
        if count >= size:
            yield np.concatenate(held)
            held, count = [], 0
    if count:
        yield np.concatenate(held)


def _prefixes(documents: DataFrame, similarity: Similarity, levels: np.ndarray) -> DataFrame:
    """Per row doc_id, n (size of the set), sig (hash of the set), prefix (its hashes) and start
    (a hash of the prefix)."""
    told = documents.sparkSession.sparkContext.broadcast(levels)  # a byte a counter

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", TEXTS):
            sizes, signatures, prefixes = [], [], []
            for values in _sets(batch, similarity):
                sizes.append(len(values))
                signatures.append(_digest(values.tobytes()))
                prefixes.append(_prefix(values))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(signatures, pa.binary()),
                    pa.array(prefixes, pa.binary()),
                    pa.array([_digest(prefix) for prefix in prefixes], pa.binary()),
                ],
                ["doc_id", "n", "sig", "prefix", "start"],
            )

    def _prefix(values: np.ndarray) -> bytes:
        if not len(values):
            return b""
        level = told.value[(values % np.uint64(SKETCH)).astype(np.int64)]
        order = np.argsort(level, kind="stable")  # values are sorted by hash already
        return values[order[: similarity.prefix(len(values))]].tobytes()

    schema = "doc_id long, n long, sig binary, prefix binary, start binary"
    ids = F.col("doc_id").cast("long").alias("doc_id")
    return documents.select(ids, "text").mapInArrow(cut, schema)


def _classes(sets: DataFrame) -> DataFrame:
    """One row per distinct set: sig, doc_id (the smallest), n, start. Copies are summed up before
    they are shuffled."""
    return sets.where("n > 0").groupBy("sig", "n", "start").agg(F.min("doc_id").alias("doc_id"))


def _groups(sets: DataFrame) -> DataFrame:
    """Classes of one size and one prefix: g (a number), n, start, prefix, leader (a class)."""
    groups = sets.where("n > 0").groupBy("n", "start").agg(
        F.min("sig").alias("leader"), F.first("prefix").alias("prefix")
    )
    return written(groups.withColumn("g", F.monotonically_increasing_id()), "groups")


def _shared_prefixes(groups: DataFrame) -> DataFrame:
    """A row per group and prefix shingle that two groups have: t, place (in
    the prefix, from 0), g, n."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                prefixes = batch.column("prefix").slice(at, 500).to_pylist()
                yield pa.RecordBatch.from_pydict({"t": _hashes(b"".join(prefixes))})

    counted = groups.select("prefix").mapInArrow(shingle, "t long").groupBy("t").count()
    repeated = written(counted.where("count > 1").select("t"), "repeated")
    wanted = groups.sparkSession.sparkContext.broadcast(_bitmap(repeated, F.col("t")))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                prefixes = some.column("prefix").to_pylist()
                values = np.frombuffer(b"".join(prefixes), dtype=np.int64)
                sizes = [len(p) // 8 for p in prefixes]
                row = np.repeat(np.arange(len(prefixes)), sizes)
                place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                there = _within(wanted.value, values)
                kept = some.drop_columns(["prefix"]).take(pa.array(row[there]))
                kept = kept.append_column("t", pa.array(values[there]))
                yield kept.append_column("place", pa.array(place[there], pa.int32()))

    fields = groups.select("g", "n", "prefix")
    rows = fields.mapInArrow(keep, "g long, n long, t long, place int")
    return written(rows, "shared")


def _hashes(data: bytes) -> pa.Array:
    return pa.array(np.frombuffer(data, dtype=np.int64))


def _bitmap(rows: DataFrame, value) -> np.ndarray:
    """A bitmap with a bit for each value (long) of `rows`, a written table, by its lowest bits."""
    wanted = min(max(BITS_EACH * rows.count(), LEAST_BITS), MOST_BITS)
    size = 1 << (wanted - 1).bit_length()
    place = F.pmod(value, F.lit(size))
    parts = (
        rows.select(place.alias("place"))
        .groupBy(F.expr("bitmap_bucket_number(place)").alias("part"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"))
    )
    # Spark numbers from 1 the bitmaps of 4096 bytes, and has one for place 0 before them.
    bits = np.zeros(size // 8 + 4096, dtype=np.uint8)
    for row in parts.collect():  # `size` bits, whatever the input, in one job
        data = np.frombuffer(row["bits"], dtype=np.uint8)[: len(bits) - row["part"] * 4096]
        bits[row["part"] * 4096 : row["part"] * 4096 + len(data)] = data
    return bits


def _within(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of `values` have their bit set; some that were never put in may have it too."""
    place = values & np.int64((len(bits) - 4096) * 8 - 1)
    # Place p has number 1 + (p - 1) // 32768 and bit (p - 1) % 32768; place 0 is in bitmap 0.
    before = np.maximum(place - 1, 0)
    byte = np.where(place > 0, 4096 * (1 + before // 32768) + before % 32768 // 8, 0)
    bit = np.where(place > 0, before % 8, 0)
    return (bits[byte] >> bit.astype(np.uint8)) & 1 == 1


def _crowded(shared: DataFrame) -> DataFrame:
    """The rows of `shared` of prefix shingles that CROWD groups have, or more."""
    many = shared.groupBy("t").count().where(F.col("count") >= CROWD).select("t")
    return shared.join(many, "t", "left_semi").drop("place")


def _spanned(shared: DataFrame, rooted: DataFrame) -> DataFrame:
    """The rows of `shared` with the first and last component, low and high, of their group, of
    the prefix shingles that more than one component has."""
    rows = shared.join(_spans(rooted), "g")
    split = rows.groupBy("t").agg(F.min("low").alias("l"), F.max("high").alias("h"))
    return rows.join(split.where("l < h").select("t"), "t", "left_semi")


def _spans(rooted: DataFrame) -> DataFrame:
    return rooted.groupBy("g").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )


def _leader_pairs(
    crowded: DataFrame, rooted: DataFrame, similarity: Similarity, number: int
) -> DataFrame:
    """Pairs of classes (a, b) to verify in this round: each with leaders of another component.

    A leader of a crowded prefix shingle is a group that has most of the crowded shingles: it
    differs little from what its family has in common. Among such groups a hash decides, one of
    LEADERS for shingles of the same family. Pairs share two such shingles at least.
    """
    central = crowded.groupBy("g").agg(F.count("*").alias("shared"))
    rows = _spanned(crowded, rooted).join(central, "g")
    rank = F.xxhash64("g", F.pmod("t", F.lit(LEADERS)), F.lit(number))
    first = F.struct(-F.col("shared"), rank, "g", "n", "low", "high")
    leaders = rows.groupBy("t").agg(F.min(first).alias("x"))
    same = (F.col("low") == F.col("high")) & (F.col("low") == F.col("x.low")) & (
        F.col("x.low") == F.col("x.high")
    )
    fits = F.least("n", "x.n") * similarity.den >= F.greatest("n", "x.n") * similarity.num
    pairs = rows.join(leaders, "t").where((F.col("g") != F.col("x.g")) & ~same & fits)
    counted = pairs.groupBy(F.least("g", "x.g").alias("g"), F.greatest("g", "x.g").alias("h"))
    chosen = counted.count().where("count > 1").select("g", "h")
    named = rooted.select("g", "leader").distinct()
    ones = named.withColumnRenamed("leader", "a")
    others = named.select(F.col("g").alias("h"), F.col("leader").alias("b"))
    return chosen.join(ones, "g").join(others, "h").select("a", "b")


#: Makes a number of the low bits of a signature and of a doc_id, the same in Spark and numpy.
MARK = 40503
DOC_BITS = 1 << 24


def _mark(sig, doc_id) -> F.Column:
    """A number of a class and one of its documents, as `_made` takes it."""
    last = F.conv(F.hex(F.substring(sig, 13, 4)), 16, 10).cast("long")
    return last + F.pmod(F.coalesce(doc_id, F.lit(-1)), F.lit(DOC_BITS)) * MARK


def _made(
    documents: DataFrame,
    classes: DataFrame,
    pairs: DataFrame,
    similarity: Similarity,
    make,
    kind: pa.DataType,
) -> DataFrame:
    """sig and data, which is `make` of the whole set, of that `kind`, of the classes in `pairs`.

    Of each class the row of its smallest doc_id makes it, whatever copies there are. Rows that
    repeat that one are left out within a task, then dropped.
    """
    active = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
    marks = classes.join(active, "sig", "left_semi").select(
        _mark(F.col("sig"), F.col("doc_id")).alias("mark")
    )
    wanted = documents.sparkSession.sparkContext.broadcast(
        _bitmap(written(marks, "marks"), F.col("mark"))
    )

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = set()
        for batch in small_batches(batches, "text", TEXTS):
            ids = batch.column("doc_id").fill_null(-1).to_numpy() % DOC_BITS * MARK
            sets = _sets(batch, similarity)
            signatures = [_digest(values.tobytes()) for values in sets]
            last = [int.from_bytes(sig[12:], "big") for sig in signatures]
            there = _within(wanted.value, np.array(last, dtype=np.int64) + ids)
            found = {}
            for i in np.flatnonzero(there).tolist():
                if len(sets[i]) and signatures[i] not in made:
                    found[signatures[i]] = make(sets[i])
            made.update(found)
            yield pa.RecordBatch.from_pydict(
                {
                    "sig": pa.array(found.keys(), pa.binary(), size=len(found)),
                    "data": pa.array(list(found.values()), kind),
                }
            )

    ids = F.col("doc_id").cast("long").alias("doc_id")
    schema = f"sig binary, data {'binary' if pa.types.is_binary(kind) else 'array<long>'}"
    return documents.select(ids, "text").mapInArrow(some, schema).dropDuplicates(["sig"])


def _histogram(values: np.ndarray) -> bytes:
    """How many hashes of a set start with each byte. Empty if one count is too large."""
    counts = np.bincount((values >> np.uint64(56)).astype(np.int64), minlength=256)
    return b"" if counts.max() > 0xFF else counts.astype(np.uint8).tobytes()


def _verified(
    pairs: DataFrame, documents: DataFrame, classes: DataFrame, similarity: Similarity
) -> DataFrame:
    """The pairs of classes (a, b) whose whole sets are similar.

    Two sets share no more hashes than the smaller counts of their histograms add up to. Only
    pairs for which that is enough have their sets made and brought together.
    """

    def may_be(one: bytes, other: bytes) -> bool:
        if not len(one) or not len(other):
            return True
        one, other = (np.frombuffer(x, dtype=np.uint8).astype(np.int64) for x in (one, other))
        return similarity.linked(one.sum(), other.sum(), np.minimum(one, other).sum())

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("one"), batch.column("other"))
            passed = [bool(may_be(x.as_buffer(), y.as_buffer())) for x, y in both]
            yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))

    histograms = _made(documents, classes, pairs, similarity, _histogram, pa.binary())
    likely = _brought(pairs, histograms).mapInArrow(keep, "a binary, b binary")
    near = written(likely, "near")
    hashes = _made(documents, classes, near, similarity, _signed, pa.list_(pa.int64()))
    # Sets stay in Spark: a batch of them for a worker might be large.
    both = F.size(F.array_intersect("one", "other"))
    counted = _brought(near, hashes).select(
        "a", "b", (F.size("one") + F.size("other")).alias("all"), both.alias("both")
    )
    enough = F.col("both") * similarity.den >= (F.col("all") - F.col("both")) * similarity.num
    return counted.where((F.col("both") > 0) & enough).select("a", "b")


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _brought(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with the data of both classes, one and other."""
    ones = sets.select(F.col("sig").alias("a"), F.col("data").alias("one"))
    others = sets.select(F.col("sig").alias("b"), F.col("data").alias("other"))
    return pairs.join(ones, "a").join(others, "b").select("a", "b", "one", "other")


def _with_component(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with the component of their class, which is the class itself if it has none."""
    roots = found.select(F.col("id").alias("sig"), "component")
    return members.join(roots, "sig", "left").select(
        "sig", "g", "leader", F.coalesce("component", "sig").alias("component")
    )


def _cross_pairs(shared: DataFrame, rooted: DataFrame, similarity: Similarity) -> DataFrame:
    """Pairs of classes (a, b) that may be similar and lie in different components."""
    rows = _spanned(shared, rooted)
    one, other = rows.alias("x"), rows.alias("y")
    apart = ~(
        (F.col("x.low") == F.col("x.high"))
        & (F.col("y.low") == F.col("y.high"))
        & (F.col("x.low") == F.col("y.low"))
    )
    fits = F.least("x.n", "y.n") * similarity.den >= F.greatest("x.n", "y.n") * similarity.num
    # Of two similar sets, these first shingles of each are sure to have one in common.
    asked = F.ceil(
        F.lit(similarity.num) * (F.col("x.n") + F.col("y.n")) / (similarity.num + similarity.den)
    )
    early = (F.col("x.place") <= F.col("x.n") - asked) & (F.col("y.place") <= F.col("y.n") - asked)
    met = (F.col("x.t") == F.col("y.t")) & (F.col("x.g") < F.col("y.g")) & apart & fits & early
    pairs = one.join(other, met).select(F.col("x.g").alias("g"), F.col("y.g").alias("h"))
    groups = pairs.distinct()
    torn = _spans(rooted).where("low < high").select("g", F.col("g").alias("h"))
    left = rooted.select("g", F.col("sig").alias("a"), F.col("component").alias("ca"))
    right = rooted.select(
        F.col("g").alias("h"), F.col("sig").alias("b"), F.col("component").alias("cb")
    )
    pairs = groups.union(torn).join(left, "g").join(right, "h").where("ca <> cb")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _result(sets: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    roots = found.select(F.col("id").alias("sig"), "component")
    placed = classes.select("sig", "doc_id").join(roots, "sig", "left")
    placed = placed.withColumn("component", F.coalesce("component", "sig"))
    smallest = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = written(
        placed.join(smallest, "component").select("sig", "component_id"), "components"
    )
    linked = sets.where("n > 0").join(named, "sig")
    alone = sets.where("n = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return linked.select(*columns).union(alone.select(*columns))
