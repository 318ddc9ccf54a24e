"""A quality classifier: gradient-boosted trees on histograms of document statistics.

The trees are trained on a bounded sample of labelled documents. They are kept as flat arrays, a
row per tree and a column per node, and all documents of a batch walk down all trees at once.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import fresh, small_batches

#: Labelled documents that are learned from, at most; those with the smallest hashes.
SAMPLE = 20_000
#: Bytes of text a task takes the statistics of at once.
TEXTS = 2_000_000
TREES = 150
DEPTH = 4
RATE = 0.1
BINS = 64
LEAST_WEIGHT = 2.0
SHRINK = 1.0
#: Of three parts, by checksum of doc_id, the one that is never learned from.
PARTS = 3
HELD_OUT = 1

#: Classes of bytes that are counted; a byte above 127 belongs to a letter.
LETTERS, CAPITALS, DIGITS, SPACES, LINES, STOPS, BARS, SIGNS = range(8)
CLASS = np.full(256, SIGNS)
CLASS[ord("a") : ord("z") + 1] = LETTERS
CLASS[128:] = LETTERS
CLASS[ord("A") : ord("Z") + 1] = CAPITALS
CLASS[ord("0") : ord("9") + 1] = DIGITS
CLASS[[9, 11, 12, 13, 32]] = SPACES
CLASS[10] = LINES
CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = STOPS
CLASS[ord("|")] = BARS
STATISTICS = 20


def statistics(text: str) -> list[float]:
    """The statistics of one document. An empty text has zeros."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    counts = np.bincount(data, minlength=256)
    classes = np.bincount(CLASS, weights=counts, minlength=8)
    words = text.split()
    size, n = max(len(data), 1), max(len(words), 1)
    lengths = np.fromiter(map(len, words), dtype=np.int32, count=len(words))
    lines = [line for line in text.split("\n") if line]
    seen = set(words)
    again = sum(map(str.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    titles = sum(map(str.istitle, words))
    alpha = sum(map(str.isalpha, words))
    return [
        float(np.log1p(len(data))),
        float(np.log1p(len(words))),
        *(classes / size).tolist(),
        float(lengths.mean()) if words else 0.0,
        float(lengths.std()) if words else 0.0,
        np.count_nonzero(lengths <= 3) / n,
        len(seen) / n,
        again / n,
        pairs / n,
        titles / n,
        alpha / n,
        1.0 - len(set(lines)) / max(len(lines), 1),
        float(counts.max(initial=0)) / size,
    ]


@dataclass(frozen=True)
class Trees:
    """Flat trees. Node i of a tree has its children at 2 i + 1 and 2 i + 2."""

    edges: np.ndarray  # statistic x bin: the upper bounds of the bins
    start: float
    feature: np.ndarray  # tree x inner node
    limit: np.ndarray  # tree x inner node: bins up to it go left
    value: np.ndarray  # tree x leaf

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Per row of statistics a number from 0 to 1."""
        if not len(self.feature):
            return np.full(len(values), _sigmoid(self.start))
        binned = binned_by(self.edges, values)
        rows, trees = np.arange(len(values))[:, None], np.arange(len(self.feature))[None, :]
        node = np.zeros((len(values), len(self.feature)), dtype=np.int64)
        for _ in range(DEPTH):
            right = binned[rows, self.feature[trees, node]] > self.limit[trees, node]
            node = 2 * node + 1 + right
        leaf = node - self.feature.shape[1]
        return _sigmoid(self.start + self.value[trees, leaf].sum(axis=1))


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


def binned_by(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    columns = [np.searchsorted(edges[f], values[:, f], "left") for f in range(len(edges))]
    return np.stack(columns, axis=1).astype(np.uint8)


def train(values: np.ndarray, labels: np.ndarray) -> Trees:
    """Boosts trees on the logistic loss. Labels of one kind only, or none, give no trees: the
    score is then the same for all, the smoothed share of label 1."""
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    start = float(np.log(share / (1 - share)))
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    empty = np.zeros((0, inner), dtype=np.int64)
    if len(np.unique(labels)) < 2:
        return Trees(np.zeros((STATISTICS, 0)), start, empty, empty, np.zeros((0, leaves)))
    ranks = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.stack([np.quantile(values[:, f], ranks) for f in range(values.shape[1])])
    binned = binned_by(edges, values).astype(np.int64)
    margin = np.full(len(labels), start)
    features, limits, outputs = [], [], []
    for _ in range(TREES):
        chance = _sigmoid(margin)
        feature, limit, output, leaf = _grow(binned, labels - chance, chance * (1 - chance))
        margin += output[leaf]
        features.append(feature)
        limits.append(limit)
        outputs.append(output)
    return Trees(edges, start, np.array(features), np.array(limits), np.array(outputs))


def _grow(binned: np.ndarray, pull: np.ndarray, weight: np.ndarray):
    """One tree: per level, the best split of every node by its histograms."""
    inner, n_features = 2**DEPTH - 1, binned.shape[1]
    feature = np.zeros(inner, dtype=np.int64)
    limit = np.full(inner, BINS, dtype=np.int64)  # all go left
    node = np.zeros(len(binned), dtype=np.int64)
    for level in range(DEPTH):
        first, width = 2**level - 1, 2**level
        place = (node - first) * BINS
        pulls, weights = np.empty((2, n_features, width, BINS))
        for f in range(n_features):
            at = place + binned[:, f]
            pulls[f] = np.bincount(at, pull, width * BINS).reshape(width, BINS)
            weights[f] = np.bincount(at, weight, width * BINS).reshape(width, BINS)
        left_pull, left_weight = pulls.cumsum(axis=2), weights.cumsum(axis=2)
        all_pull, all_weight = left_pull[:, :, -1:], left_weight[:, :, -1:]
        right_pull, right_weight = all_pull - left_pull, all_weight - left_weight
        gain = (
            left_pull**2 / (left_weight + SHRINK)
            + right_pull**2 / (right_weight + SHRINK)
            - all_pull**2 / (all_weight + SHRINK)
        )
        gain[(left_weight < LEAST_WEIGHT) | (right_weight < LEAST_WEIGHT)] = 0.0
        by_node = gain.transpose(1, 0, 2).reshape(width, -1)
        best = by_node.argmax(axis=1)
        split = by_node[np.arange(width), best] > 1e-9
        feature[first : first + width][split] = best[split] // BINS
        limit[first : first + width][split] = best[split] % BINS
        node = 2 * node + 1 + (binned[np.arange(len(binned)), feature[node]] > limit[node])
    leaf = node - inner
    pulls = np.bincount(leaf, pull, 2**DEPTH)
    weights = np.bincount(leaf, weight, 2**DEPTH)
    return feature, limit, RATE * pulls / (weights + SHRINK), leaf


def held_out(doc_id) -> F.Column:
    """Whether documents of that id are kept for testing."""
    checksum = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(checksum % PARTS == HELD_OUT, F.lit(False))


def _rows(batch: pa.RecordBatch, text: str = "text") -> np.ndarray:
    texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
    return np.array([statistics(text or "") for text in texts]).reshape(len(texts), STATISTICS)


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees learned from labels (doc_id, quality), from the `sample` labelled documents with
    the smallest hashes that are not held out. Labels that are null or not 0 or 1 are ignored;
    a document labelled 0 and 1 counts as both. Statistics come from the text alone."""
    ranked = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("quality"))
        .distinct()
        .orderBy(F.xxhash64("label_id"), "label_id", "quality")
        .limit(sample)
    )
    kept = documents.select("doc_id", "text").join(
        F.broadcast(ranked), F.col("doc_id") == F.col("label_id")  # `sample` rows at most
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", TEXTS):
            values = pa.array(_rows(batch).tolist(), pa.list_(pa.float64()))
            yield batch.select(["doc_id", "quality"]).append_column("values", values)

    measured = kept.select("doc_id", "quality", "text").mapInArrow(
        measure, "doc_id long, quality int, values array<double>"
    )
    order = [F.xxhash64("doc_id"), "doc_id", "quality", "values"]
    rows = measured.orderBy(*order).limit(sample).collect()  # a doc_id may occur many times
    values = np.array([row["values"] for row in rows]).reshape(len(rows), STATISTICS)
    return train(values, np.array([row["quality"] for row in rows], dtype=np.float64))


def score(
    documents: DataFrame,
    trees: Trees,
    names: tuple[str, str] = ("score", "predicted"),
    columns: list[str] | None = None,
) -> DataFrame:
    """Adds a score (0 to 1) and whether it is 0.5 or more (1, else 0), by `names`, to documents.

    documents: text and any other columns; columns of those two names are replaced. columns:
    those that are returned with the two; all if not given. A text is sent to the workers once,
    and back only if it is among them. A null text is scored like an empty one. An empty table
    gives no rows. Of a text, its words and pairs of words are held at once.
    """
    told = documents.sparkSession.sparkContext.broadcast(trees)
    plain = documents.drop(*names)
    carried = plain if columns is None else plain.select(*[F.col(f"`{name}`") for name in columns])
    text = "text"
    if "text" not in carried.columns:
        text = fresh(carried, "scored_text")
        sent = plain.select(*carried.columns, F.col("text").alias(text))
    else:
        sent = carried
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text, TEXTS):
            scores = told.value.scores(_rows(batch, text))
            yield (
                batch.select(carried_names)
                .append_column(names[0], pa.array(scores))
                .append_column(names[1], pa.array((scores >= 0.5).astype(np.int32)))
            )

    carried_names = carried.columns
    return sent.mapInArrow(judge, ", ".join([*fields, f"`{names[0]}` double, `{names[1]}` int"]))


def classify(
    documents: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    columns: list[str] | None = None,
) -> DataFrame:
    """Adds held_out, score and predicted to documents (doc_id, text, ...), by trees learned
    from the documents that labels name. columns: those returned, doc_id among them; all if
    not given."""
    plain = documents.drop("held_out")
    scored = score(plain, learn(documents, labels, sample), columns=columns)
    return scored.withColumn("held_out", held_out("doc_id"))
