"""Exact top-k search by inner product, with Fagin's threshold algorithm.

Candidates are dealt into blocks. A block keeps a list per dimension, sorted by that component.
A query goes down all lists at once, from the end that its own component favours. What it has
not seen at some depth scores at most the threshold, the sum over dimensions of its component
times the value at that depth. It stops where the threshold is below the k-th best score it
has, for then nothing unseen can be among the best; an equal score might still come with a
smaller id. A query whose threshold falls so late that it would meet most rows of a block is scored
against all of them, together with others like it: looking rows up one by one would take longer.

Queries and candidates meet in blocks of bounded size; each pair of blocks is one group, and
the best k of a query's blocks are merged.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.frames import written
from feedlake.llm.vectors import floored, integers, matrix

#: Rows of a block of candidates and of queries.
CANDIDATES = 8192
QUERIES = 2048
#: Depths the threshold is looked at, per block: finer at the top of the lists.
DEPTHS = 64
#: Rows of each list that a query scores before it looks for the depth to stop at.
FIRST_DEPTH = 8
#: Once a query would look up more than one place in SHARE for each row of a block, the whole
#: block is scored, for up to TOGETHER such queries in one product.
SHARE, TOGETHER = 4, 64
#: Scores up to here are exact in double precision; blocks that may have larger ones score in
#: Python's integers. A score that is returned must fit a long.
DOUBLE, LONG = 1 << 53, 1 << 63
#: What doubles may lose of a threshold, as a share of the largest score there could be.
SLACK = 1e-12

RESULT = "query_id long, query_row long, vec_id long, row long, score long"


def quantized(embeddings: DataFrame, factor: int) -> DataFrame:
    """vec_id, row (a number for each row), dim and vector (floor(factor * x) as whole numbers).

    Vectors that are null, empty, or hold null or non-finite components take no part.
    """

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, data = floored(batch.column("embedding"), factor)
            kept = batch.select(["vec_id", "row"]).append_column("dim", pa.array(dims, pa.int32()))
            kept = kept.append_column("vector", pa.array(data, pa.binary()))
            yield kept.filter(kept.column("vector").is_valid())

    named = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return named.mapInArrow(floor, "vec_id long, row long, dim int, vector binary")


class Lists:
    """The sorted lists of a block of candidates, a matrix of integers, by ascending row id."""

    def __init__(self, vectors: np.ndarray, wide: bool = False):
        """wide: scores may not be exact in doubles."""
        self.vectors, self.wide = vectors.astype(np.float64), wide
        self.whole = integers(self.vectors) if wide else self.vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")  # depth x dimension
        self.sorted = np.take_along_axis(self.vectors, self.order, axis=0)
        n = len(vectors)
        grid = np.unique(np.geomspace(1, n, DEPTHS).astype(np.int64)) - 1
        self.grid = np.unique(np.concatenate((grid, [min(FIRST_DEPTH, n) - 1])))

    def thresholds(self, queries: np.ndarray) -> np.ndarray:
        """query x depth of the grid: the most that a row not seen down to there can score."""
        top, bottom = self.sorted[::-1][self.grid], self.sorted[self.grid]
        found = np.maximum(queries, 0) @ top.T + np.minimum(queries, 0) @ bottom.T
        return found + SLACK * _most(self.vectors, queries) if self.wide else found

    def seen(self, query: np.ndarray, depth: int) -> np.ndarray:
        """The rows among the first depth + 1 of any list that the query goes down."""
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        n = len(self.order)
        mask = np.zeros(n, dtype=bool)
        mask[self.order[n - 1 - depth :, up]] = True
        mask[self.order[: depth + 1, down]] = True
        return np.flatnonzero(mask)

    def best(self, queries: np.ndarray, ids: np.ndarray, own: list[int], k: int):
        """Per query the rows of its k best and their scores; ids break ties, and row own[i]
        (-1: none) is left out."""
        bounds = self.thresholds(queries)
        start = int(np.searchsorted(self.grid, min(FIRST_DEPTH, len(ids)) - 1))
        whole = integers(queries) if self.wide else queries
        for at in range(0, len(queries), TOGETHER):
            some = range(at, min(at + TOGETHER, len(queries)))
            found = {i: self._walk(queries[i], whole[i], bounds[i], start, own[i], k) for i in some}
            # Those that would see most rows are scored against all of them at once.
            deep = [i for i in some if found[i] is None]
            scores = dict(zip(deep, whole[deep] @ self.whole.T)) if deep else {}
            for i in some:
                rows, scored = found[i] or self._all_but(own[i], scores[i])
                first = self._first(scored, ids[rows], k)
                yield rows[first], scored[first]

    def _walk(self, query, whole, bounds, start: int, own: int, k: int):
        """The rows that one query sees until its threshold stops it, and their scores; None once
        it would see so many that all may as well be scored."""
        if not query.any():  # it goes down no list: all score 0
            return self._all_but(own, np.zeros(len(self.order)))
        depth, lists = start, np.count_nonzero(query)
        while True:
            if depth > start and SHARE * lists * (int(self.grid[depth]) + 1) > len(self.order):
                return None
            rows = self.seen(query, int(self.grid[depth]))
            rows = rows[rows != own]
            scores = self.whole[rows] @ whole
            if depth == len(self.grid) - 1:
                return rows, scores
            kth = self._kth(scores, k)
            if bounds[depth] < kth:
                return rows, scores
            # The best so far says how deep the threshold must fall; by then it has risen.
            enough = np.flatnonzero(bounds < float(kth))
            deeper = int(enough[0]) if len(enough) else len(self.grid) - 1
            depth = max(depth + 1, deeper)

    def _all_but(self, own: int, scores: np.ndarray):
        rows = np.flatnonzero(np.arange(len(scores)) != own)
        return rows, scores[rows]

    def _kth(self, scores: np.ndarray, k: int):
        if len(scores) < k:
            return -np.inf
        return np.sort(scores)[-k] if self.wide else np.partition(scores, -k)[-k]

    def _first(self, scores: np.ndarray, ids: np.ndarray, k: int) -> list[int] | np.ndarray:
        if self.wide:
            return sorted(range(len(scores)), key=lambda j: (-scores[j], ids[j]))[:k]
        among = np.flatnonzero(scores >= self._kth(scores, k))  # the k best and what ties with the last
        return among[np.lexsort((ids[among], -scores[among]))[:k]]


def top_k(
    embeddings: DataFrame, is_query, k: int = 20, factor: int = 64
) -> DataFrame:
    """The k best candidates of every query by inner product of vectors in integers.

    embeddings: vec_id, embedding; other columns are ignored. is_query: a condition on vec_id.
    Candidates are all rows but the query's own; equal scores go to the smaller vec_id. Returns
    query_id, rank (from 1), vec_id, score, with fewer ranks where there are fewer candidates.

    A row with a null vec_id is neither query nor candidate, as it cannot be named. Rows that
    repeat a vec_id are candidates of each other. Vectors of different lengths do not meet. Scores
    are exact at any size; one among the best that does not fit a long raises an error.
    """
    rows = written(quantized(embeddings.where("vec_id is not null"), factor), "vectors")
    asked = rows.where(F.coalesce(is_query, F.lit(False)))
    blocks = max(1, -(-rows.count() // CANDIDATES))
    query_blocks = max(1, -(-asked.count() // QUERIES))

    def spread(side: DataFrame, role: int, own: str, count: int, other: str, others: int):
        block = F.pmod(F.xxhash64("row", F.lit(role)), F.lit(count)).alias(own)
        numbers = F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))
        every = F.explode(numbers).alias(other)
        return side.select("*", block, F.lit(role).alias("role")).select("*", every)

    candidates = spread(rows, 0, "cb", blocks, "qb", query_blocks)
    queries = spread(asked, 1, "qb", query_blocks, "cb", blocks)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        return _search(pdf, k)

    met = candidates.unionByName(queries).groupBy("dim", "cb", "qb")
    found = met.applyInPandas(search, RESULT)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    candidates = pdf[pdf["role"] == 0].sort_values(["vec_id", "row"])
    queries = pdf[pdf["role"] == 1].sort_values(["vec_id", "row"])
    columns = [name.split()[0] for name in RESULT.split(", ")]
    if candidates.empty or queries.empty:
        return pd.DataFrame({name: pd.Series(dtype=np.int64) for name in columns})
    dim = int(candidates["dim"].iloc[0])
    vectors, asked = matrix(candidates["vector"], dim), matrix(queries["vector"], dim)
    ids, numbers = candidates["vec_id"].to_numpy(), candidates["row"].to_numpy()
    place = {number: i for i, number in enumerate(numbers.tolist())}
    own = [place.get(number, -1) for number in queries["row"].tolist()]
    parts = []
    names = zip(queries["vec_id"].tolist(), queries["row"].tolist())
    # Rows are in the order of ids, so places break ties as ids do, and repeated ids by row.
    lists = Lists(vectors, _most(vectors, asked) > DOUBLE)
    found = lists.best(asked, np.arange(len(ids)), own, k)
    for (query_id, query_row), (rows, scores) in zip(names, found):
        if lists.wide and any(not -LONG <= score < LONG for score in scores):
            raise ValueError("a score does not fit a long")
        parts.append(
            pd.DataFrame(
                {
                    "query_id": query_id,
                    "query_row": query_row,
                    "vec_id": ids[rows],
                    "row": numbers[rows],
                    "score": scores.astype(np.int64),
                }
            )
        )
    return pd.concat(parts)[columns]


def _most(vectors: np.ndarray, queries: np.ndarray) -> float:
    """No score, nor a sum on the way to it, is larger in size."""
    return vectors.shape[1] * float(np.abs(vectors).max()) * float(np.abs(queries).max())
