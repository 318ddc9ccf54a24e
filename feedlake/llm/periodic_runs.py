"""Periodic runs of words, found with a run-length grammar made by recompression.

The words of a text become numbers. Two steps alternate on the sequence: block compression gives
each maximal block of one symbol a symbol of its own, pair compression deals the symbols to two
sides and replaces each pair of a left and a right one. Both look at neighbours only, so equal
stretches are cut alike but for their edges, and the levels answer how far two places agree
(the longest common extension, LCE) in a few steps a level: upwards while the places agree and
are at an edge of the next level's symbols, then down to the word that differs.

A run with period q and 4 q words or more holds, on the grid of multiples of 3 q, a place i that
agrees with i + q together with two neighbours in a row. Only such places are extended, forward
and backward, by the grammar. The grids of all periods together are harmonic: n log n places.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import small_batches, split_words

#: A run has so many words, and so many times its period, at least.
LEAST, TIMES = 6, 4
#: Places of the grids looked at, and extensions asked for, at a time.
PLACES, ASKED = 1 << 20, 1 << 18
#: Bytes of text whose words are numbered together.
SLICE = 4_000_000
#: A level of so few symbols is not compressed any more.
TOP = 32

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = (
    "doc_id long, n_words long, "
    "runs array<struct<start: long, length: long, period: long>>, collapsed string"
)


class Grammar:
    """The levels of a sequence whose first and last symbols occur once each."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = [symbols.astype(np.int64)]
        #: By level: the parent of every symbol, and the first child of every symbol above.
        self.parent: list[np.ndarray] = []
        self.child: list[np.ndarray] = []
        sides = np.random.RandomState(7)
        while len(self.symbols[-1]) > TOP:
            self._blocks()
            if not self._pairs(sides):
                break

    def _blocks(self) -> None:
        now = self.symbols[-1]
        first = np.flatnonzero(np.concatenate(([True], now[1:] != now[:-1])))
        if len(first) == len(now):
            return
        lengths = np.diff(first, append=len(now))
        above = now[first]
        self._raise(above, first, lengths > 1, above * np.int64(len(now) + 1) + lengths)

    def _pairs(self, sides: np.random.RandomState) -> bool:
        now = self.symbols[-1]
        count = int(now.max()) + 1
        for _ in range(8):
            left = sides.randint(0, 2, size=count).astype(bool)[now]
            heads = np.flatnonzero(left[:-1] & ~left[1:])
            if 5 * len(heads) >= len(now):
                break
        if not len(heads):
            return False
        first = np.ones(len(now), dtype=bool)
        first[heads + 1] = False
        first = np.flatnonzero(first)
        above = now[first]
        paired = np.zeros(len(now), dtype=bool)
        paired[heads] = True
        nexts = now[np.minimum(first + 1, len(now) - 1)]
        self._raise(above, first, paired[first], above * np.int64(count) + nexts)
        return True

    def _raise(self, above, first, joined, keys) -> None:
        """A new level; symbols that were joined are named by their keys, the others keep theirs."""
        below = len(self.symbols[-1])
        _, names = np.unique(keys[joined], return_inverse=True)
        above = above.copy()
        above[joined] = names + int(self.symbols[-1].max()) + 1
        _, above = np.unique(above, return_inverse=True)  # keeps names small
        lengths = np.diff(first, append=below)
        self.parent.append(np.repeat(np.arange(len(first), dtype=np.int32), lengths))
        self.child.append(np.append(first, below).astype(np.int32))
        self.symbols.append(above.astype(np.int64))

    def agree(self, one: np.ndarray, other: np.ndarray, sign: int) -> np.ndarray:
        """How many symbols agree from the places `one` and `other` on, these included: to the
        right (sign 1) or to the left (-1). Places are in pairs of different ones."""
        x, y = one.astype(np.int64), other.astype(np.int64)
        turned = np.full(len(x), -1, dtype=np.int64)
        going = np.arange(len(x))
        for level in range(len(self.parent)):
            a, b = x[going], y[going]
            same = self.symbols[level][a] == self.symbols[level][b]
            turned[going[~same]] = level
            going, a, b = going[same], a[same], b[same]
            step = ~(self._edge(level, a, sign) & self._edge(level, b, sign))
            a[step], b[step] = self._onward(level, a[step], b[step], sign)
            apart = ~(self._edge(level, a, sign) & self._edge(level, b, sign))
            x[going], y[going] = a, b
            turned[going[apart]] = level
            going, a, b = going[~apart], a[~apart], b[~apart]
            x[going], y[going] = self.parent[level][a], self.parent[level][b]
            if not len(going):
                break
        turned[going] = len(self.parent)
        for level in range(int(turned.max(initial=0)), -1, -1):
            down = np.flatnonzero(turned > level)
            if len(down):
                x[down] = self._outermost(level, x[down], sign)
                y[down] = self._outermost(level, y[down], sign)
            here = np.flatnonzero(turned >= level)
            while len(here):
                same = self.symbols[level][x[here]] == self.symbols[level][y[here]]
                here = here[same]
                x[here], y[here] = self._onward(level, x[here], y[here], sign)
        return (x - one) * sign

    def _edge(self, level: int, at: np.ndarray, sign: int) -> np.ndarray:
        """Whether the places are where a symbol of the next level begins, seen in direction sign."""
        return self._outermost(level, self.parent[level][at], sign) == at

    def _outermost(self, level: int, above: np.ndarray, sign: int) -> np.ndarray:
        children = self.child[level]
        return children[above] if sign > 0 else children[above + 1] - 1

    def _onward(self, level: int, a: np.ndarray, b: np.ndarray, sign: int):
        """Past symbols that agree: one, or as many of a block as both still have."""
        if level == len(self.parent):
            return a + sign, b + sign
        left = [
            np.abs(self._outermost(level, self.parent[level][at], -sign) - at) + 1 for at in (a, b)
        ]
        now = self.symbols[level]
        block = (left[0] > 1) & (left[1] > 1)
        inner = np.flatnonzero(block)
        block[inner] = now[a[inner]] == now[a[inner] + sign]
        steps = np.where(block, np.minimum(*left), 1)
        return a + sign * steps, b + sign * steps


def _grid(lengths: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, period, place) of the grids of periods from low to high - 1, in portions."""
    texts, most = np.arange(len(lengths)), lengths // TIMES
    texts = texts[most >= low]
    periods = np.minimum(most[texts], high - 1) - low + 1
    done = 0
    ends = np.cumsum(periods)
    while done < (int(ends[-1]) if len(ends) else 0):
        # So many pairs of text and period that their places are some PLACES.
        pairs = np.arange(done, min(done + max(1, PLACES // _most(lengths, low)), int(ends[-1])))
        at = np.searchsorted(ends, pairs, "right")
        text = texts[at]
        period = low + pairs - (ends[at] - periods[at])
        places = -(-(lengths[text] - period) // (3 * period))
        first = np.cumsum(places) - places
        number = np.arange(int(places.sum())) - np.repeat(first, places)
        period = np.repeat(period, places)
        yield np.repeat(text, places), period, number * 3 * period
        done += len(pairs)


def _most(lengths: np.ndarray, low: int) -> int:
    return max(1, int(lengths.max()) // (3 * low))


def _alike(words: np.ndarray, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which places agree with those a period on, as two neighbours in a row do with theirs."""
    found = np.flatnonzero(words[at] == words[at + period])
    at, period = at[found], period[found]
    last = len(words) - 1

    def agrees(shift):
        here, there = np.maximum(at + shift, 0), np.minimum(at + period + shift, last)
        return words[here] == words[there]

    left, right = agrees(-1), agrees(1)
    return found[(left & right) | (left & agrees(-2)) | (right & agrees(2))]


def _doublings(most: int) -> Iterator[tuple[int, int]]:
    low = 1
    while low <= most:
        yield low, 2 * low
        low *= 2


def _sequence(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' words one after another between numbers that occur once, with where each text
    begins and its length."""
    lengths = np.array([len(code) for code in codes], dtype=np.int64)
    starts = np.cumsum(lengths + 1) - lengths
    words = np.empty(int(lengths.sum()) + len(codes) + 1, dtype=np.int64)
    parts, least = [np.array([0])], len(codes) + 1
    for i, code in enumerate(codes):
        parts += [code.astype(np.int64) + least, np.array([i + 1])]
    np.concatenate(parts, out=words)
    return words, starts, lengths


def find(codes: list[np.ndarray]) -> list[np.ndarray]:
    """Per text, given as numbers of its words, the runs: rows of start, length, period, by
    start and period."""
    runs = [np.empty((0, 3), dtype=np.int64) for _ in codes]
    words, starts, lengths = _sequence(codes)
    if not len(codes) or lengths.max() < LEAST:
        return runs
    likely = np.zeros(len(codes), dtype=bool)
    for low, high in _doublings(int(lengths.max()) // TIMES):
        for text, period, place in _grid(np.where(likely, 0, lengths), low, high):
            likely[text[_alike(words, starts[text] + place, period)]] = True
    some = np.flatnonzero(likely)
    if len(some):
        for i, found in zip(some.tolist(), _extended([codes[i] for i in some])):
            runs[i] = found
    return runs


def _extended(codes: list[np.ndarray]) -> list[np.ndarray]:
    words, starts, lengths = _sequence(codes)
    grammar = Grammar(words)
    # By place, the end and the period of a run that holds it: what a multiple of that period
    # would find there is the same run.
    end, held = np.zeros(len(words), dtype=np.int64), np.ones(len(words), dtype=np.int64)
    found = []

    def open_places(at, period):
        known = (at + period < end[at]) & (period % held[at] == 0)
        return np.flatnonzero(~known)

    def extend(at, period):
        for begin in range(0, len(at), ASKED):
            a, q = at[begin : begin + ASKED], period[begin : begin + ASKED]
            right = grammar.agree(a, a + q, 1)
            left = grammar.agree(a - 1, a + q - 1, -1)
            rows = np.stack((a - left, left + right + q, q), axis=1)
            rows = rows[rows[:, 1] >= np.maximum(LEAST, TIMES * rows[:, 2])]
            rows = np.unique(rows, axis=0)
            found.append(rows)
            for start, length, q in rows.tolist():
                end[start : start + length] = start + length
                held[start : start + length] = q

    for low, high in _doublings(int(lengths.max()) // TIMES):
        for text, period, place in _grid(lengths, low, high):
            at = starts[text] + place
            chosen = _alike(words, at, period)
            at, period = at[chosen], period[chosen]
            chosen = open_places(at, period)
            at, period = at[chosen], period[chosen]
            # The first of a row of places first: a run of many places is then found once.
            follows = (period[1:] == period[:-1]) & (at[1:] == at[:-1] + 3 * period[1:])
            ahead = np.concatenate(([True], ~follows))[: len(at)]
            extend(at[ahead], period[ahead])
            at, period = at[~ahead], period[~ahead]
            chosen = open_places(at, period)
            extend(at[chosen], period[chosen])
    rows = np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # One stretch found with several periods has the smallest; the others are its multiples.
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    text = np.searchsorted(starts, rows[:, 0], "right") - 1
    rows[:, 0] -= starts[text]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0], text))]
    return np.split(rows, np.cumsum(np.bincount(text, minlength=len(codes)))[:-1])


def dropped(runs: np.ndarray, words: int) -> np.ndarray:
    """Which words a run holds after its first period."""
    change = np.zeros(words + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def periodic_runs(documents: DataFrame) -> DataFrame:
    """The periodic runs of every whole text, and the text without its repetitions.

    documents: doc_id, text; other columns are ignored. Words are what stands between ASCII
    white space, numbered from 0. A run is a stretch of words with smallest period q, of 6 words
    and 4 q at least, that no neighbouring word extends; runs may overlap. Returns for every row
    doc_id, n_words, runs (start, length, period; by start, then period) and collapsed: the words
    but those that a run holds after its first q words, joined by one space.

    Null and empty texts have no words, no runs and an empty text; a null doc_id is kept, and
    rows that repeat are rows of their own. Texts are worked on whole: one of n words looks at
    n log n places and holds some 200 bytes a word, and only where a word recurs at a fixed
    distance. Nothing is shuffled.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", SLICE):
            words, offsets = split_words(batch.column("text"))
            codes = words.dictionary_encode().indices.to_numpy()
            texts = np.split(codes, offsets[1:-1])
            found = find(texts)
            kept = np.concatenate([~dropped(runs, len(code)) for runs, code in zip(found, texts)])
            left = np.concatenate(([0], np.cumsum(kept)))[offsets]
            joined = pa.LargeListArray.from_arrays(
                pa.array(left), words.filter(pa.array(kept)).cast(pa.large_string())
            )
            rows = np.concatenate(found)
            columns = [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)]
            ends = np.cumsum([0] + [len(runs) for runs in found])
            structs = pa.StructArray.from_arrays(columns, fields=list(RUN))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(offsets)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                    pc.binary_join(joined, pa.scalar(" ", pa.large_string())).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(search, RESULT)
