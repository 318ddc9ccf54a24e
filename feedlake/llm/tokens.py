"""Token ids of whole texts.

The tokenizer drops white space and never joins characters across it, so the ids of a text
are the ids of its white-space separated pieces in turn. Pieces repeat far more often than
texts do: Arrow numbers those of a batch, parts them into a word and the signs after it, and
puts the ids together; only words that are new to a worker meet the tokenizer.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from feedlake.llm.frames import give_back, split_words

#: Words a worker remembers; some 200 bytes each.
REMEMBERED = 1_000_000
#: Bytes of text that are encoded together. The words of a slice are looked up once for all of it.
TEXTS = 6_000_000
#: The same for workers that share an executor's memory with what other stages left in it.
FEW_REMEMBERED, FEW_TEXTS = 300_000, 3_000_000
#: How such vocabularies mark the token that ends a word.
WORD_END = "</w>"
#: Words encoded in one call.
TOGETHER = 5_000
#: A word of Latin letters and ASCII signs without an apostrophe, which may start an ending.
WORD_AND_SIGNS = (
    "^(?P<word>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+)"
    r"(?P<signs>[!-&(-/:-@\[-`{-~]+)$"
)

_encoders: dict[str, "Encoder"] = {}


def encoder(path: str, remembered: int | None = None) -> "Encoder":
    """The worker's encoder for the vocabulary file at `path`. remembered: how many words it
    remembers from now on; REMEMBERED if not given."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    _encoders[path].remembered = remembered or REMEMBERED
    return _encoders[path]


def forget(path: str) -> None:
    """Frees the worker's encoder for the vocabulary file at `path`, if nothing else holds it."""
    _encoders.pop(path, None)
    give_back()


class Encoder:
    """Texts to token ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: By id: whether the token ends a word, in vocabularies that mark this.
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[number] = token.endswith(WORD_END)
        self.remembered = REMEMBERED
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """The ids of every text; none for a null one."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        words, offsets = split_words(texts)
        coded = words.dictionary_encode()
        word, signs = (part.dictionary_encode() for part in _parts(coded.dictionary))
        parts = word.dictionary.to_pylist() + signs.dictionary.to_pylist()
        self._learn(set(parts))
        ids = pa.array(map(self.known.__getitem__, parts), pa.large_binary(), size=len(parts))
        # The word of every piece and the signs after it, often none, in turn.
        codes = coded.indices.to_numpy()
        turns = np.empty(2 * len(codes), dtype=np.int64)
        turns[::2] = word.indices.to_numpy()[codes]
        turns[1::2] = signs.indices.to_numpy()[codes] + len(word.dictionary)
        taken = ids.take(pa.array(turns))
        _, ends, data = taken.buffers()
        bounds = np.frombuffer(ends, np.int64)[2 * offsets].tolist()
        data = memoryview(data or b"")
        return [bytes(data[start:end]) for start, end in zip(bounds[:-1], bounds[1:])]

    def _learn(self, parts: set[str]) -> None:
        """Finds the ids of parts that are new."""
        if len(self.known) > self.remembered // 2:
            self.known, self.older = {}, self.known
        self._encode(parts - self._recall(parts).keys())

    def _recall(self, parts: set[str]) -> dict[str, bytes]:
        """The younger half, after those of `parts` that only the older half has moved to it."""
        older = (parts - self.known.keys()) & self.older.keys()
        self.known.update((part, self.older[part]) for part in older)
        return self.known

    def _encode(self, parts: set[str]) -> None:
        """Words of Latin letters are encoded many at a time and told apart by their ends."""
        plain, alone = [], []
        marked = bool(self.ends.any())
        for part in parts:
            (plain if marked and part.isalpha() and part.islower() else alone).append(part)
        for at in range(0, len(plain), TOGETHER):
            some = plain[at : at + TOGETHER]
            found = np.asarray(self._encode_each([" ".join(some)])[0].ids)
            ends = np.flatnonzero(self.ends[found]) + 1
            if len(ends) != len(some):
                alone += some
                continue
            ids, start = little_endian(found), 0
            for part, end in zip(some, (4 * ends).tolist()):
                self.known[part] = ids[start:end]
                start = end
        for part, found in zip(alone, self._encode_each(alone)):
            self.known[part] = little_endian(found.ids)

    def _encode_each(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)


def _parts(pieces: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The word of each piece, in lower case, and the signs after it. A piece that is not a word
    and signs is its own word, in lower case if it is ASCII, as the tokenizer lowers it."""
    found = pc.extract_regex(pieces, WORD_AND_SIGNS)
    there = found.is_valid()
    word, signs = found.flatten()
    ascii_ = pc.if_else(pc.string_is_ascii(pieces), pc.ascii_lower(pieces), pieces)
    return pc.if_else(there, pc.utf8_lower(word), ascii_), pc.fill_null(signs, "")


def little_endian(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def default_vocabulary() -> str:
    """The place of the tokenizer file that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
