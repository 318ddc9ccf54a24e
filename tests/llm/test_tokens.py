import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedlake.llm import token_files, tokens
from feedlake.workspace import work_folder

PLAIN = Tokenizer.from_file(tokens.default_vocabulary())


def plain(text):
    return tokens.little_endian(PLAIN.encode(text or "", add_special_tokens=False).ids)


ODD = [
    "It's'a I'm.. x'm, a\x1cb don't!<|endoftext|>z",
    "É. ́, Å Σας. ΣΑΣ, x́. ı İx. ﬁ, ǅ.",
    " ,, .. word<|endoftext|> <|startoftext|>, ",
    "a\x85b\xa0c　d 12,3. a_b. _. ªa. º, ĳ.",
    "",
    None,
    "%%% $$$ wort%%% | wort| -- (a)",
]


def test_encoder_equals_the_tokenizer():
    encode = tokens.Encoder(tokens.default_vocabulary())
    assert encode(ODD) == [plain(text) for text in ODD]
    assert encode(ODD[::-1]) == [plain(text) for text in ODD[::-1]]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aBéİ .,'%\n\t\x1c\xa0<|0́", max_size=30))
def test_encoder_on_any_text(text):
    assert tokens.encoder(tokens.default_vocabulary())([text]) == [plain(text)]


def test_encoder_forgets_within_bounds(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    encode = tokens.Encoder(tokens.default_vocabulary())
    texts = [f"some words {chr(97 + i)}{chr(98 + i)} again" for i in range(20)]
    for text in texts + texts:
        assert encode([text]) == [plain(text)]
    assert len(encode.known) < 30


def test_words_of_many_slices_are_encoded_once(monkeypatch):
    encode, met = tokens.Encoder(tokens.default_vocabulary()), []
    monkeypatch.setattr(encode, "_encode", lambda parts: met.append(len(parts)) or learn(encode, parts))
    learn = lambda encode, parts: encode.known.update(dict.fromkeys(parts, b"1234"))
    slices = [[" ".join(f"w{i}q" for i in range(at, at + 50_000))] for at in range(0, 500_000, 50_000)]
    for _ in range(2):
        for texts in slices:
            encode(texts)
    assert sum(met[10:]) == 0


def test_an_encoder_remembers_what_its_task_asks():
    path = tokens.default_vocabulary()
    assert tokens.encoder(path, 5).remembered == 5
    assert tokens.encoder(path).remembered == tokens.REMEMBERED


def test_files_are_common_zstandard_and_checked(tmp_path):
    path = str(tmp_path / "x.zst")
    documents = [(None, b""), (1, b"abcd"), (7, b"efgh" * 1000)]
    assert token_files.write_file(path, documents) == (3, 1001)
    with open(path, "rb") as file:
        reader = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True)
        assert reader.read() == b"".join(data for _, data in documents)
    source = token_files.TokenFile(path)
    assert source.doc_ids == [None, 1, 7]
    assert [source.tokens(i) for i in range(3)] == [data for _, data in documents]
    assert source.find(7) == [2]
    source.close()
    data = bytearray(open(path, "rb").read())
    place = source.frames[2][0] + source.frames[2][1] - 1
    data[place] ^= 255
    open(path, "wb").write(data)
    damaged = token_files.TokenFile(path)
    assert damaged.tokens(1) == b"abcd"
    with pytest.raises((ValueError, zstandard.ZstdError)):
        damaged.tokens(2)


def test_round_trip(spark):
    rows = [(None, "no id", 1), (5, "zwei Wörter", 1), (3, None, 1), (5, "zwei Wörter", 1)]
    rows += [(9, "", 2), (4, "long text, " * 30_000, 2), (-1, "first", 3)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    documents = documents.selectExpr("*", "1 AS tie", "2 AS start", "3 AS file")
    folder = work_folder(spark, "tokens")
    manifest = token_files.write_token_files(documents, folder, tokens.default_vocabulary(), 2, 3)
    found = sorted(token_files.token_positions(manifest).collect(), key=lambda row: row.start)
    expected, start = [], 0
    for doc_id, text, _ in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0)):
        ids = plain(text) + tokens.little_endian([2])
        expected.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert [tuple(row) for row in found] == expected
    wanted = spark.createDataFrame([(5,), (9,), (77,), (None,)], "doc_id long")
    read = sorted((r.doc_id, bytes(r.ids)) for r in token_files.read_documents(manifest, wanted).collect())
    two = plain("zwei Wörter") + tokens.little_endian([2])
    assert read == [(5, two), (5, two), (9, np.array([2], "<u4").tobytes())]


def test_empty_table(spark):
    documents = spark.createDataFrame([], "doc_id long, text string")
    manifest = token_files.write_token_files(
        documents, work_folder(spark, "tokens"), tokens.default_vocabulary(), 2
    )
    assert token_files.token_positions(manifest).collect() == []


def test_copies_of_one_document_are_dealt_to_many_files(spark):
    rows = [(7, "the same text")] * 4000 + [(i, f"text {i}") for i in range(2000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    manifest = token_files.write_token_files(
        documents, work_folder(spark, "tokens"), tokens.default_vocabulary(), 2, 8
    )
    assert max(row.n_docs for row in manifest.collect()) < 1500
    found = token_files.token_positions(manifest).select("doc_id", "start", "n_tokens").collect()
    at = 0
    for doc_id, start, n in sorted(found, key=lambda row: row.start):
        assert start == at
        at += n
    assert [row.doc_id for row in sorted(found, key=lambda row: row.start)] == sorted(i for i, _ in rows)


def test_folders_are_resolved_as_spark_does(spark, tmp_path):
    assert token_files.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    _, place = token_files._filesystem(f"file:{tmp_path}/a")
    assert place == f"{tmp_path}/a"


def test_a_very_long_text():
    text = "Wort, und " * 200_000 + "x" * 50_000
    assert tokens.Encoder(tokens.default_vocabulary())([text, None, ""]) == [plain(text), b"", b""]
