import random
import shutil
import zlib
from collections import defaultdict

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedlake.llm import packing, tokens

PLAIN = Tokenizer.from_file(tokens.default_vocabulary())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60), st.integers(1, 5))
def test_places_are_those_of_bounded_best_fit(lengths, limit):
    bins, slow, opened = packing.OpenBins(16, limit), {}, 0
    for length in lengths:
        number, place = bins.place(length)
        fitting = [free for free in slow.values() if free >= length]
        if fitting:
            assert 16 - place == min(fitting) == slow[number]
        else:
            assert (number, place) == (opened, 0)
            opened += 1
            if length < 16 and len(slow) == limit:
                # Of equally full sequences any may be the one that is closed.
                tightest = min(slow.values())
                held = {n for free in bins.by_space for n in free}
                closed = [n for n, free in slow.items() if n not in held and free == tightest]
                del slow[closed[0]]
            slow[number] = 16
        slow[number] -= length
        if not slow[number]:
            del slow[number]
        assert bins.open == len(slow) <= limit


def test_few_sequences():
    rule = random.Random(1)
    lengths = [min(4096, int(rule.expovariate(1 / 800)) + 1) for _ in range(20_000)]
    bins = packing.OpenBins(4096, 1024)
    for length in lengths:
        bins.place(length)
    assert bins.opened <= 1.01 * sum(lengths) / 4096 + 1


def _check(rows, documents, capacity):
    bins, pieces = defaultdict(list), defaultdict(list)
    for row in rows:
        bins[row.sequence_id].append((row.offset, row.length))
        pieces[row.doc_id, row.copy].append(row)
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    expected = []
    for doc_id, text in documents:
        ids = PLAIN.encode(text or "", add_special_tokens=False).ids + [1]
        expected.append((doc_id, [tokens.little_endian(ids[i : i + capacity]) for i in range(0, len(ids), capacity)]))
    found = []
    for (doc_id, _), parts in pieces.items():
        parts.sort(key=lambda row: row.piece)
        assert [row.piece for row in parts] == list(range(len(parts)))
        assert [row.start for row in parts] == [i * capacity for i in range(len(parts))]
        found.append((doc_id, [(row.length, row.ids_crc32) for row in parts]))
    key = str
    assert sorted(found, key=key) == sorted(
        ((d, [(len(p) // 4, zlib.crc32(p)) for p in parts]) for d, parts in expected), key=key
    )


def test_documents(spark):
    rows = [(i, "word " * (i % 7)) for i in range(40)]
    rows += [(50, "long, " * 5000), (51, None), (52, ""), (53, "same"), (53, "same"), (None, "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    documents = documents.selectExpr("*", "1 AS copy", "2 AS offset", "3 AS length")
    packed = packing.pack_documents(documents, tokens.default_vocabulary(), 1, 64).collect()
    _check(packed, rows, 64)
    alike = packing.pack_documents(documents, tokens.default_vocabulary(), 1, 64).collect()
    assert sorted(map(str, packed)) == sorted(map(str, alike))


def test_sequences_can_be_read(spark):
    rows = [(1, "one two"), (2, "three"), (3, "many words " * 40)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    packed = packing.pack_documents(documents, tokens.default_vocabulary(), 1, 32)
    read = packing.sequence_tokens(packed, documents, tokens.default_vocabulary(), 1).collect()
    assert sum(row.length for row in read) == sum(row.length for row in packed.collect())
    assert all(len(row.ids) == 4 * row.length <= 128 for row in read)


def test_empty_table(spark):
    documents = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(documents, tokens.default_vocabulary(), 1).collect() == []


def test_encoder_is_freed_if_asked(spark, tmp_path):
    path = str(shutil.copy(tokens.default_vocabulary(), tmp_path / "vocabulary.json"))

    def known(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [int(path in tokens._encoders)]})

    def holders():
        found = spark.range(0, 64, 1, 64).mapInArrow(known, "n long").collect()
        return sum(row.n for row in found)

    rows = [(i, f"word {i}") for i in range(64)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    packed = packing.pack_documents(documents, path, 1, 64, lasting=False)
    assert holders() == 0
    kept = packing.pack_documents(documents, path, 1, 64)
    assert holders() > 0
    named = ("doc_id", "start", "length", "ids_crc32")
    assert sorted(packed.select(*named).collect()) == sorted(kept.select(*named).collect())
