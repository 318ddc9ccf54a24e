"""Mixing sources to target weights by fitting a subset sum.

Every source has a target in words. Whole passes over the source come first; what is left of
the target, the budget, is smaller than the source. How many documents of each length make it
up is found on the counts of documents by exact length:

1. some words of the budget are left open, at first eight documents of mean length; of the rest
   each length gives its share of documents, rounded down;
2. of the lengths whose share was rounded most, one document more, until the words to be left
   open are what is left;
3. a bounded knapsack on the documents not taken finds the sum nearest to what is left;
4. if that is not the budget itself, four times as many words are left open, up to the whole
   budget: the knapsack then has all documents to choose from, and no sum is nearer.

Which documents of a length are taken is dealt by a seeded hash. Only lengths and counts are
gathered per source, and only numbers are sent over the network, never texts. Rows that repeat a
doc_id and text have one hash; if only some of them are to be taken, these rows are written with a
number of their own that decides.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.frames import fresh, words, written

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: How often a document may be taken.
MOST_PASSES = 3
#: The hashes of one length and source are counted in 2 ** BUCKET_BITS ranges; only those in one
#: range are ranked.
BUCKET_BITS = 12
#: Numbers of rows are counted by task, which their bits from here on tell.
TASK_BITS = 33
#: Rows of quotas, some 40 bytes each, up to which they are sent to all executors.
BROADCAST_ROWS = 100_000
#: Words left open for the knapsack at first, in mean lengths.
LEFT_OPEN = 8
#: Longest budget, in words, that the knapsack is run on; a longer rest is first cut down by
#: taking whole documents. A bit for each word and size of bundle.
KNAPSACK = 200_000


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """Adds target to sources (source, source_size), a table of a row per source.

    Weights go round the names in the order of their code points, null last. All targets
    together are all sizes together. A target stops at `most` times its source's size; the
    excess is dealt to the others by weight until none is above. A source without words has
    the target 0.
    """
    rows = sources.collect()  # a row per source, as few as names in a configuration
    names = sorted(rows, key=lambda row: (row["source"] is None, row["source"] or ""))
    sizes = [row["source_size"] for row in names]
    shares = [weights[i % len(weights)] for i in range(len(names))]
    found = dict(enumerate(fill(sizes, shares, most)))
    columns = {
        "source": pa.array([row["source"] for row in names], pa.string()),
        "source_size": pa.array(sizes, pa.int64()),
        "target": pa.array([found[i] for i in range(len(names))], pa.float64()),
    }
    # Of an Arrow table Spark makes rows by itself; of a list, by Python workers of their own.
    return sources.sparkSession.createDataFrame(pa.table(columns))


def fill(sizes: list[int], weights, most: int) -> list[float]:
    """Shares of sum(sizes) by weight, none above `most` times its size."""
    total, full = float(sum(sizes)), set()
    found = [0.0] * len(sizes)
    while len(full) < len(sizes):
        left = total - sum(most * sizes[i] for i in full)
        weight = sum(weights[i] for i in range(len(sizes)) if i not in full)
        over = set()
        for i in range(len(sizes)):
            if i not in full:
                found[i] = left * weights[i] / weight
                if found[i] > most * sizes[i]:
                    over.add(i)
        if not over:
            break
        for i in over:
            found[i] = float(most * sizes[i])
        full |= over
    return found


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of the `counts` documents of each length to take, to come near `budget` words.

    0 <= budget <= sum(lengths * counts). Documents without words are left to step 1. Up to a
    budget of KNAPSACK words no other choice comes nearer; of a longer one, KNAPSACK words are
    left open at most.
    """
    total = int((lengths * counts).sum())
    if total == 0 or budget <= 0:
        return np.zeros_like(counts)
    best, missed = None, None
    left_open = LEFT_OPEN * -(-total // max(1, int(counts[lengths > 0].sum())))
    while True:
        taken = _shares(lengths, counts, budget, min(left_open, budget, KNAPSACK))
        left = budget - int((lengths * taken).sum())
        taken = taken + knapsack(lengths, counts - taken, left)
        miss = abs(budget - int((lengths * taken).sum()))
        if best is None or miss < missed:
            best, missed = taken, miss
        if missed == 0 or left_open >= min(budget, KNAPSACK):
            return best
        left_open *= 4


def _shares(lengths: np.ndarray, counts: np.ndarray, budget: int, left_open: int) -> np.ndarray:
    """Steps 1 and 2: documents of every length for the budget but `left_open` words or more, of
    which KNAPSACK at most where there are documents to take."""
    total = int((lengths * counts).sum())
    exact = counts * ((budget - left_open) / total)
    taken = np.minimum(np.floor(exact).astype(np.int64), counts)
    left = budget - int((lengths * taken).sum())
    for i in np.argsort(taken - exact, kind="stable").tolist():
        if 0 < lengths[i] <= left - left_open and taken[i] < counts[i]:
            taken[i] += 1
            left -= int(lengths[i])
    for i in np.argsort(-lengths, kind="stable").tolist():
        if left <= KNAPSACK or lengths[i] == 0:
            break
        more = min(int(counts[i] - taken[i]), left // int(lengths[i]))
        taken[i] += more
        left -= more * int(lengths[i])
    return taken


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: how many of each length make the sum nearest to `budget`.

    Counts are taken in bundles of 1, 2, 4, ... documents. Bit s of a bitset says whether sum s
    can be made of the bundles so far; the bitsets before each bundle lead back from the sum
    found to the bundles in it. Sums up to twice the budget are looked at, as one above may be
    nearer than the next below.
    """
    usable = [i for i in range(len(lengths)) if counts[i] > 0 and lengths[i] > 0]
    taken = np.zeros_like(counts)
    if budget <= 0 or not usable:
        return taken
    limit = 2 * budget
    mask = (1 << (limit + 1)) - 1
    reach, steps = 1, []
    for i in sorted(usable, key=lambda i: int(lengths[i])):
        length, left, bundle = int(lengths[i]), min(int(counts[i]), limit // int(lengths[i])), 1
        while left > 0:
            many = min(bundle, left)
            steps.append((i, many, reach))
            reach |= (reach << (many * length)) & mask
            left -= many
            bundle *= 2
        if reach >> budget & 1:
            break
    below = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> (budget + 1)
    best = below
    if above and (up := budget + (above & -above).bit_length()) - budget < budget - below:
        best = up
    for i, many, before in reversed(steps):
        if not before >> best & 1:
            taken[i] += many
            best -= many * int(lengths[i])
    return taken


def _quotas(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per length of one source: passes over all, and how many documents are taken once more."""
    pdf = pdf.sort_values("size", kind="stable")
    lengths, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    source_size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    passes = min(MOST_PASSES, int(target // source_size)) if source_size else 0
    budget = round(target - passes * source_size) if passes < MOST_PASSES else 0
    more = fit(lengths, counts, budget)
    kept = pdf[["source", "size", "source_size", "target"]]
    return kept.assign(passes=passes, more=more)


def mix(documents: DataFrame, seed: int = 0, weights=WEIGHTS) -> DataFrame:
    """Adds size, source_size, target and times (how often a document is taken) to documents.

    documents: doc_id, text, source and any other columns. Columns of those four names are
    replaced, in `mixed` not. times is 0 to MOST_PASSES. A null text has no words, and documents without words
    are taken as often as the source as a whole is passed over. A null source is a source of
    its own. Rows that repeat a doc_id are documents of their own. An empty table gives no rows.

    A run with the same seed takes the same documents, however the rows are dealt to tasks; of rows
    equal in all columns it does not matter which are taken.
    """
    plain = documents.drop("size", "source_size", "target", "times")
    order = fresh(plain, "mix_order")
    hashed = F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(seed)).alias(order)
    sized = plain.select("*", words(F.col("text")).alias("size"), hashed)
    quotas = _cutoffs(sized.select("source", "size", F.col(order).alias("hash")), weights)
    some = not quotas.where("part < ties").isEmpty()
    names = {name: fresh(sized, f"quota_{name}") for name in quotas.columns}
    quotas = quotas.withColumnsRenamed(names)
    quotas = _small(quotas)
    met = F.col("source").eqNullSafe(F.col(names["source"])) & (
        F.col("size") == F.col(names["size"])
    )
    once_more = F.coalesce(F.col(order) <= F.col(names["cutoff"]), F.lit(False)).cast("int")
    matched = sized.join(quotas, met)
    joined = matched.withColumn("times", F.col(names["passes"]) + once_more)
    if some:
        tie = (F.col(order) == F.col(names["cutoff"])) & (F.col(names["part"]) < F.col(names["ties"]))
        tie = F.coalesce(tie, F.lit(False))
        joined = joined.where(~tie).unionByName(_some_of(matched.where(tie), plain, names, seed))
    columns = [F.col(f"`{name}`") for name in plain.columns]
    known = [F.col(names[name]).alias(name) for name in ("source_size", "target")]
    return joined.select(*columns, "size", *known, "times")


def _small(table: DataFrame) -> DataFrame:
    """`table`, a written one, with a broadcast hint if it is short."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _some_of(tied: DataFrame, plain: DataFrame, names: dict[str, str], seed: int) -> DataFrame:
    """Adds times to rows of one hash per source and size, of which `part` are taken once more.

    A hash of all columns decides, and among rows equal in that the number of the row.
    """
    sound = [f"`{f.name}`" for f in plain.schema.fields if "map<" not in f.dataType.simpleString()]
    sound = [name for name in sound if plain.schema[name.strip("`")].dataType.typeName() != "variant"]
    whole, number = fresh(tied, "whole"), fresh(tied, "number")
    rows = tied.withColumn(whole, F.xxhash64(*[F.col(name) for name in sound], F.lit(seed)))
    rows = written(rows.withColumn(number, F.monotonically_increasing_id()), "tied")
    keys = ["source", "size"]
    quotas = rows.groupBy(*keys).agg(F.min(names["part"]).alias("more"))
    named = rows.select(*keys, F.col(whole).alias("hash"), F.col(number).alias("number"))
    first = written(_cut(named.select(*keys, "hash"), quotas, 64 - BUCKET_BITS), "first")
    last = _small(first.select(*keys, "cutoff", "part"))  # a row for each length with ties
    left = _join(named, last, keys).where("hash = cutoff")
    second = left.select(*keys, F.col("number").alias("hash"))
    asked = first.select(*keys, F.col("part").alias("more"))
    second = written(_cut(second, asked, TASK_BITS), "second")
    cuts = _join(first.select(*keys, "cutoff"), second.select(*keys, F.col("cutoff").alias("until")), keys)
    cuts = written(cuts, "cuts")
    cuts = cuts.withColumnsRenamed({name: f"{fresh(rows, 'cut')}_{name}" for name in cuts.columns})
    source, size, cutoff, until = (F.col(name) for name in cuts.columns)
    met = F.col("source").eqNullSafe(source) & (F.col("size") == size)
    taken = (F.col(whole) < cutoff) | ((F.col(whole) == cutoff) & (F.col(number) <= until))
    found = rows.join(_small(cuts), met)
    found = found.withColumn("times", F.col(names["passes"]) + taken.cast("int"))
    return found.drop(whole, number, *cuts.columns)


def _cutoffs(hashes: DataFrame, weights) -> DataFrame:
    """Per source and size: source_size, target, passes, and cutoff, the largest hash of the
    documents taken once more, part, how many of that hash are taken, and ties, how many have it
    (all null if none are taken)."""
    keys = ["source", "size"]
    counted = written(_counted(hashes, 64 - BUCKET_BITS), "lengths")
    by_length = counted.groupBy(*keys).agg(F.sum("n").alias("n"))
    sources = by_length.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    aims = F.broadcast(targets(sources, weights))  # made of rows the driver has
    known = _join(by_length, aims, ["source"])
    quotas = written(
        known.groupBy("source").applyInPandas(
            _quotas,
            "source string, size long, source_size long, target double, passes int, more long",
        ),
        "quotas",
    )
    last = _cut(hashes, quotas.where("more > 0"), 64 - BUCKET_BITS, counted)
    return written(_join(quotas, last, keys, "left").drop("more"), "cutoffs")


def _counted(hashes: DataFrame, shift: int) -> DataFrame:
    bucket = F.shiftright("hash", shift).alias("bucket")
    return hashes.groupBy("source", "size", bucket).agg(F.count("*").alias("n"))


def _cut(
    hashes: DataFrame, quotas: DataFrame, shift: int, counted: DataFrame | None = None
) -> DataFrame:
    """Per source and size of quotas the cutoff below which the first `more` hashes are.

    hashes: source, size, hash, counted in ranges of 2 ** shift. Returns cutoff, the hash of the
    last one, ties, how many have it, and part, how many of them are among the first `more`.
    """
    keys = ["source", "size"]
    counted = _counted(hashes, shift) if counted is None else counted
    earlier = (
        Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    rest = F.col("more") - F.col("before")
    edges = _join(before, quotas.select(*keys, "more"), keys).where(
        (rest > 0) & (rest <= F.col("n"))
    )
    edges = edges.select(*keys, "bucket", rest.alias("rank"))
    bucket = F.shiftright("hash", shift).alias("bucket")
    ranked = _join(hashes.select(*keys, "hash", bucket), edges, [*keys, "bucket"])
    ranked = ranked.groupBy(*keys, "rank", "hash").agg(F.count("*").alias("ties"))
    upto = F.sum("ties").over(Window.partitionBy(*keys).orderBy("hash"))
    ranked = ranked.withColumn("part", F.col("rank") - upto + F.col("ties"))
    last = ranked.where("part between 1 and ties")
    return last.select(*keys, F.col("hash").alias("cutoff"), "part", "ties")


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys that may be null, which are kept once."""
    renamed = right.withColumnsRenamed({key: f"right_{key}" for key in keys})
    met = F.lit(True)
    for key in keys:
        met = met & F.col(key).eqNullSafe(F.col(f"right_{key}"))
    return left.join(renamed, met, how).drop(*[f"right_{key}" for key in keys])


def mixed(documents: DataFrame, seed: int = 0, weights=WEIGHTS) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns only."""
    added = ("size", "source_size", "target", "times")
    own = {name: fresh(documents, f"own_{name}") for name in documents.columns if name.lower() in added}
    found = mix(documents.withColumnsRenamed(own), seed, weights)
    columns = [F.col(f"`{own.get(name, name)}`").alias(name) for name in documents.columns]
    copy = fresh(found, "copy")
    taken = found.where("times > 0").select(
        "*", F.explode(F.sequence(F.lit(1), F.col("times"))).alias(copy)
    )
    return taken.select(*columns)
