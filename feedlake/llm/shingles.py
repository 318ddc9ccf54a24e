"""Sets of word shingles as sorted arrays of 64-bit hashes, made for many texts at once.

Words are what stands between ASCII white space, A-Z lower-cased. White space is one byte long
in UTF-8, so texts are cut as bytes.
"""

import numpy as np
import pyarrow as pa

_rules = np.random.RandomState(20240607)
#: A random number for each byte, equal for a letter in either case.
BYTE = _rules.randint(0, 2**63, size=256, dtype=np.int64).astype(np.uint64) * np.uint64(2)
BYTE += np.uint64(1)
BYTE[65:91] = BYTE[97:123]
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit of the input changes half of the output's."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a column as bytes; a null text is an empty one."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [text or b"" for text in texts.to_pylist()]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of all texts in turn, and the index of the text it is in."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    inside = np.flatnonzero(~SPACE[data])
    if not len(inside):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    first = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
    lengths = np.diff(first, append=len(inside))
    place = np.arange(len(inside)) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), BASE, dtype=np.uint64))
    hashes = np.add.reduceat(BYTE[data[inside]] * powers[place], first)
    ends = np.cumsum([len(text) + 1 for text in texts])
    return mixed(hashes + lengths.astype(np.uint64)), np.searchsorted(ends, inside[first], "right")


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of `words` words.

    A text of fewer words has one shingle, all of it; a text without words has none.
    """
    hashes, text = word_hashes(texts)
    if not len(hashes):
        return [hashes] * len(texts)
    start = np.searchsorted(text, np.arange(len(texts) + 1))
    shingles = hashes.copy()
    for step in range(1, words):
        shingles[: len(hashes) - step] = mixed(shingles[: len(hashes) - step] + BASE) + hashes[step:]
    shingles = mixed(shingles)
    sets = []
    for first, end in zip(start[:-1].tolist(), start[1:].tolist()):
        if end - first >= words:
            sets.append(_distinct(shingles[first : end - words + 1]))
        elif end > first:
            whole = hashes[first : first + 1] + np.uint64(end - first)
            for other in hashes[first + 1 : end]:
                whole = mixed(whole + BASE) + other
            sets.append(mixed(whole))
        else:
            sets.append(hashes[:0])
    return sets


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))]
