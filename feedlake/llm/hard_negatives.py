"""Hard negatives by exact search along lists that whole clusters of anchors share.

Anchors are clustered by direction. For a cluster, each candidate has one bound: its norm times
the cosine of its angle to the cluster's centre less the cluster's spread, for by the triangle
inequality no member is at a smaller angle to it. The candidates of a block are sorted by that
bound once. Every member walks down that list and scores what it meets, until the bound, times
the member's own norm, certifies that no candidate further down can be among its best.

Anchors and candidates meet in groups of bounded size, one for each piece of a cluster and block
of candidates; the best of a member's blocks are merged. Two walks are made: for the positives,
then for the negatives, whose range of scores each positive sets.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.frames import written
from feedlake.llm.vectors import floored, integers, matrix

#: Rows of a block of candidates; anchors a cluster should hold; most in a piece of one.
CANDIDATES, ANCHORS, PIECE = 8192, 256, 1024
#: Clusters at most, and anchors that are looked at to place their centres.
CLUSTERS, SAMPLE = 256, 4096
#: Pieces of clusters that are broadcast at most: three numbers each.
BROADCAST_ROWS = 100_000
#: Candidates scored at a time while walking: few at first, then more.
FIRST_STEP, LAST_STEP = 64, 1024
#: Bounds are raised by this share of the norms, far above what doubles lose in angles.
SLACK = 1e-6
#: Sums up to here are exact in doubles; a score must fit a long.
DOUBLE, LONG = 1 << 53, 1 << 63

GROUP = ["dim", "cluster", "piece", "block"]
POSITIVE = "anchor_row long, positive_id long, positive_row long, positive_score long"
NEGATIVE = (
    "anchor_row long, positive_score long, negative_id long, negative_row long, "
    "negative_score long"
)


def quantized(embeddings: DataFrame, factor: int) -> DataFrame:
    """vec_id, row (a number for each row), label, dim and vector of the rows that take part:
    floor(factor * x) of each component, 4 bytes each where all of a row fit, else 8."""

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, data = floored(batch.column("embedding"), factor)
            kept = batch.select(["vec_id", "row", "label"])
            kept = kept.append_column("dim", pa.array(dims, pa.int32()))
            kept = kept.append_column("vector", pa.array(data, pa.binary()))
            yield kept.filter(kept.column("vector").is_valid())

    named = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).where("vec_id is not null and label is not null")
    return named.mapInArrow(floor, "vec_id long, row long, label long, dim int, vector binary")


def _directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zeros stay) and norms."""
    norms = np.linalg.norm(vectors, axis=1)
    return vectors / np.where(norms > 0, norms, 1.0)[:, None], norms


def centres(units: np.ndarray, count: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means, begun at evenly spaced rows."""
    found = units[np.linspace(0, len(units) - 1, count).astype(int)]
    for _ in range(rounds):
        nearest = np.argmax(units @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, units)
        directions, norms = _directions(sums)
        found = np.where(norms[:, None] > 0, directions, found)
    return found


def clustered(anchors: DataFrame, count: int) -> DataFrame:
    """`anchors` with the cluster each is in and the piece of it, of PIECE rows or so.

    The centres come from a sample of SAMPLE anchors; every anchor goes to the nearest one.
    What the search returns does not depend on the clusters, only how soon a walk ends.
    """
    sample = anchors.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("dim", "vector")
    by_dim: dict[int, list[bytes]] = {}
    for dim, vector in sample.collect():
        by_dim.setdefault(dim, []).append(vector)
    wanted = min(CLUSTERS, -(-count // ANCHORS))
    placed = {}
    for dim, vectors in by_dim.items():
        units, _ = _directions(matrix(vectors, dim))
        placed[dim] = centres(units, min(wanted, len(vectors)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_pylist()
            nearest = [0] * len(dims)
            for i, (dim, data) in enumerate(zip(dims, batch.column("vector").to_pylist())):
                if dim in placed:
                    nearest[i] = int(np.argmax(placed[dim] @ matrix([data], dim)[0]))
            yield batch.append_column("cluster", pa.array(nearest, pa.int32()))

    schema = f"{', '.join(f'{name} {kind}' for name, kind in anchors.dtypes)}, cluster int"
    return written(anchors.mapInArrow(assign, schema), "anchors")


def _pieces(anchors: DataFrame) -> DataFrame:
    sizes = anchors.groupBy("dim", "cluster").agg(F.count(F.lit(1)).alias("n"))
    return written(
        sizes.select("dim", "cluster", F.ceil(F.col("n") / PIECE).cast("int").alias("pieces")),
        "clusters",
    )


class SharedList:
    """The candidates of a block in the order of their bound for a piece of a cluster."""

    def __init__(self, anchors: np.ndarray, candidates: np.ndarray):
        units, self.norms = _directions(anchors)
        directions, sizes = _directions(candidates)
        centre = _directions(units.sum(axis=0, keepdims=True))[0][0]
        if not centre.any():
            centre = units[int(np.argmax(self.norms))]
        apart = np.arccos(np.clip(units @ centre, -1, 1))[self.norms > 0]
        spread = apart.max() if len(apart) else 0.0
        angles = np.arccos(np.clip(directions @ centre, -1, 1))
        bounds = sizes * (np.cos(np.maximum(angles - spread, 0)) + SLACK)
        self.order = np.argsort(-bounds, kind="stable")
        self.bounds = bounds[self.order]
        largest = anchors.shape[1] * np.abs(anchors).max() * np.abs(candidates).max()
        self.exact = largest < DOUBLE
        if not self.exact:  # Python's integers, of any size
            anchors, candidates = (integers(side) for side in (anchors, candidates))
        self.anchors, self.candidates = anchors, candidates

    def walk(self, goals: list[list["Goal"]], usable: np.ndarray) -> None:
        """Offers every anchor's goals what it meets, down to where the bound ends its walk.

        usable: anchor x candidate, which may be offered to which.
        """
        active = np.arange(len(self.anchors))
        at, step = 0, FIRST_STEP
        while at < len(self.order):
            reach = self.bounds[at]
            active = np.array(
                [i for i in active if any(g.open(self.norms[i] * reach) for g in goals[i])],
                dtype=np.int64,
            )
            if not len(active):
                return
            rows = self.order[at : at + step]
            scores = self.anchors[active] @ self.candidates[rows].T
            for i, line in zip(active.tolist(), scores):
                there = np.flatnonzero(usable[i, rows])
                for goal in goals[i]:
                    goal.offer(line[there], rows[there])
            at, step = at + step, min(2 * step, LAST_STEP)


class Goal:
    """The best `k` candidates with scores from `low` to `high` in hundredths (None: any).
    Places of candidates are in the order of their ids, so that the smaller place wins a tie."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.best: list[tuple] = []

    def open(self, bound: float) -> bool:
        """Whether a candidate that scores at most `bound` may still belong to the best."""
        if self.low is not None and (self.low > self.high or 100 * bound < self.low):
            return False
        return len(self.best) < self.k or bound >= -self.best[-1][0]

    def offer(self, scores: np.ndarray, places: np.ndarray) -> None:
        if self.low is not None:
            fits = (100 * scores >= self.low) & (100 * scores <= self.high)
            scores, places = scores[fits.astype(bool)], places[fits.astype(bool)]
        if len(self.best) == self.k and len(scores):
            good = (scores >= -self.best[-1][0]).astype(bool)
            scores, places = scores[good], places[good]
        if len(scores):
            found = [(-int(score), place) for score, place in zip(scores.tolist(), places.tolist())]
            self.best = sorted(self.best + found)[: self.k]


def _long(value: int) -> int:
    if not -LONG <= value < LONG:
        raise ValueError("a score does not fit a long")
    return value


def _prepared(anchors: pd.DataFrame, candidates: pd.DataFrame):
    candidates = candidates.sort_values(["vec_id", "row"], ignore_index=True)
    dim = int(anchors["dim"].iloc[0])
    shared = SharedList(matrix(anchors["vector"], dim), matrix(candidates["vector"], dim))
    same = anchors["label"].to_numpy()[:, None] == candidates["label"].to_numpy()[None, :]
    return shared, same, candidates


def _positives(anchors: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    made = []
    if len(anchors) and len(candidates):
        shared, same, candidates = _prepared(anchors, candidates)
        own = anchors["row"].to_numpy()[:, None] == candidates["row"].to_numpy()[None, :]
        goals = [[Goal(k)] for _ in range(len(anchors))]
        shared.walk(goals, same & ~own)
        ids, rows = candidates["vec_id"].tolist(), candidates["row"].tolist()
        for anchor, (goal,) in zip(anchors["row"].tolist(), goals):
            made += [(anchor, ids[at], rows[at], _long(-score)) for score, at in goal.best]
    return _frame(made, POSITIVE)


def _negatives(
    anchors: pd.DataFrame, candidates: pd.DataFrame, k: int, low: int, high: int
) -> pd.DataFrame:
    made = []
    if len(anchors) and len(candidates):
        shared, same, candidates = _prepared(anchors, candidates)
        asked = [[int(score) for score in scores] for scores in anchors["positive_scores"]]
        goals = [[Goal(k, low * score, high * score) for score in scores] for scores in asked]
        shared.walk(goals, ~same)
        ids, rows = candidates["vec_id"].tolist(), candidates["row"].tolist()
        for anchor, scores, found in zip(anchors["row"].tolist(), asked, goals):
            for positive, goal in zip(scores, found):
                made += [
                    (anchor, positive, ids[at], rows[at], _long(-score)) for score, at in goal.best
                ]
    return _frame(made, NEGATIVE)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [column.split()[0] for column in schema.split(", ")]
    return pd.DataFrame(rows, columns=names, dtype="int64")


def mine(
    embeddings: DataFrame,
    is_anchor,
    factor: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """For every anchor and each of its positives, the hardest negatives within a range.

    embeddings: vec_id, embedding, label (a whole number); other columns are ignored. is_anchor:
    a condition on vec_id. Scores are integer inner products of floor(factor * x). An anchor's
    positives are its best `positives` other rows of the same label; the negatives of both are
    the best `negatives` rows of other labels with
    low * positive_score <= 100 * score <= high * positive_score. Equal scores go to the
    smaller vec_id. Returns anchor_id, positive_id, rank (from 1), negative_id,
    positive_score, negative_score: no row for a positive without such negatives, and fewer
    than asked for where there are fewer. An empty table gives none.

    Rows with a null vec_id or label and vectors that are null, empty or hold null or non-finite
    components take no part; vectors of different lengths do not meet. Rows that repeat a
    vec_id are rows of their own: they may be each other's positives, and each is an anchor if
    the id says so. Scores are exact at any size; one that is returned and does not fit a long
    raises an error.
    """
    rows = written(quantized(embeddings, factor), "vectors")
    asked = rows.where(F.coalesce(is_anchor, F.lit(False)))
    blocks = max(1, -(-rows.count() // CANDIDATES))
    anchors = clustered(asked, max(1, asked.count()))
    pieces = _pieces(anchors)
    if pieces.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        pieces = F.broadcast(pieces)

    in_pieces = anchors.join(pieces, ["dim", "cluster"]).withColumn(
        "piece", F.pmod(F.xxhash64("row"), F.col("pieces")).cast("int")
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    asking = in_pieces.drop("pieces").select("*", every)
    piece = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece")
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    offered = rows.select("*", block).join(pieces, "dim").select("*", piece).drop("pieces")
    candidates = offered.groupBy(*GROUP)

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _positives(left, right, positives)

    def hardest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _negatives(left, right, negatives, low, high)

    found = asking.groupBy(*GROUP).cogroup(candidates).applyInPandas(nearest, POSITIVE)
    best = Window.partitionBy("anchor_row").orderBy(
        F.desc("positive_score"), "positive_id", "positive_row"
    )
    kept = written(
        found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives).drop("n"),
        "positives",
    )
    # At most `positives` scores an anchor; equal ones share their negatives.
    scores = kept.groupBy("anchor_row").agg(F.collect_set("positive_score").alias("positive_scores"))
    ranged = asking.join(scores, F.col("row") == F.col("anchor_row")).drop("anchor_row")
    hard = ranged.groupBy(*GROUP).cogroup(candidates).applyInPandas(hardest, NEGATIVE)
    order = Window.partitionBy("anchor_row", "positive_score").orderBy(
        F.desc("negative_score"), "negative_id", "negative_row"
    )
    ranked = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    pairs = kept.join(named, "anchor_row")
    return pairs.join(ranked, ["anchor_row", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
