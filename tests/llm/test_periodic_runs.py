import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedlake.llm import periodic_runs, queries


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def by_hand(words):
    """Every stretch that agrees with itself q words on, as far as it does."""
    n, made = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and smallest_period(words[i : i + length]) == q:
                made.add((i, length, q))
            i = j + 1
    return sorted(made, key=lambda run: (run[0], run[2]))


def found(texts):
    codes = {}
    numbered = [np.array([codes.setdefault(w, len(codes)) for w in t], dtype=np.int64) for t in texts]
    return [[tuple(row) for row in runs.tolist()] for runs in periodic_runs.find(numbered)]


def periodic(rule, n, letters):
    words = []
    while len(words) < n:
        unit = [int(x) for x in rule.integers(0, letters, rule.integers(1, 12))]
        words += (unit * int(rule.integers(1, 9)))[: int(rule.integers(1, 60))]
    return words


@pytest.mark.parametrize("letters", [1, 2, 3, 40])
def test_like_brute_force(letters):
    rule = np.random.default_rng(letters)
    texts = [periodic(rule, int(rule.integers(0, 300)), letters) for _ in range(40)]
    assert found(texts) == [by_hand(text) for text in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=5))
def test_small_words(texts):
    assert found(texts) == [by_hand(text) for text in texts]


def test_runs_in_runs():
    inner = [0] * 8 + [1]
    text = inner * 9 + [2] + [3, 4] * 5 + [3]
    assert found([text, text[::-1]]) == [by_hand(text), by_hand(text[::-1])]
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 600:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    assert found(fibonacci) == [by_hand(text) for text in fibonacci]


@pytest.mark.parametrize("portion", [1, 50])
def test_portions(monkeypatch, portion):
    monkeypatch.setattr(periodic_runs, "PLACES", portion)
    monkeypatch.setattr(periodic_runs, "ASKED", portion)
    monkeypatch.setattr(periodic_runs, "TOP", 2)
    rule = np.random.default_rng(6)
    texts = [periodic(rule, 120, 3) for _ in range(4)]
    assert found(texts) == [by_hand(text) for text in texts]


def test_extensions_of_the_grammar():
    rule = np.random.default_rng(11)
    words = np.array([10_000, *periodic(rule, 3000, 3), 10_001])
    grammar = periodic_runs.Grammar(words)
    one = rule.integers(1, len(words) - 1, 4000)
    other = rule.integers(1, len(words) - 1, 4000)
    one, other = one[one != other], other[one != other]
    for sign in (1, -1):
        made = grammar.agree(one, other, sign).tolist()
        for i, j, n in zip(one.tolist(), other.tolist(), made):
            k = 0
            while words[i + sign * k] == words[j + sign * k]:
                k += 1
            assert n == k


def test_long_texts():
    same = np.zeros(400_000, dtype=np.int64)
    assert found([same.tolist()]) == [[(0, 400_000, 1)]]
    rule = np.random.default_rng(1)
    unit = rule.integers(0, 1000, 50_000).tolist()
    assert found([[5000, *(unit * 5), 5001]]) == [[(1, 250_000, 50_000)]]
    assert found([rule.integers(0, 100_000, 300_000).tolist()]) == [[]]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = by_hand(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * longest[1] // longest[2] if runs else None
    listed = digest("".join(f"{s},{length},{q}\n" for s, length, q in runs))
    kept = digest(" ".join(w for i, w in enumerate(words) if i not in gone))
    return (doc_id, len(runs), *longest, milli, listed, kept)


COLUMNS = [
    "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
    "collapsed_sha256",
]


def test_query_on_awkward_texts(spark, tmp_path):
    rule = np.random.default_rng(2)
    texts = [None, "", " \t\n", "a", "no no no no no no", "é é é é x\x0by\x0cz\r\n",
             "x " * 50, "\x1c \x1c \x1c \x1c \x1c \x1c \x85", "a b\n" * 9 + "a"]
    texts += [" ".join(f"w{x}" for x in periodic(rule, 200, 4)) for _ in range(120)]
    rows = list(enumerate(texts)) + [(None, texts[6]), (None, None), (-5, texts[20]), (4, texts[30])]
    schema = "doc_id long, text string"
    table = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS runs", "2 AS n_words", "3 AS H")
    table.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    made = queries.op13_periodic_runs(spark, str(tmp_path)).select(*COLUMNS).collect()
    key = repr
    assert sorted(map(tuple, made), key=key) == sorted((expected_row(*row) for row in rows), key=key)


def test_query_on_the_test_table(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = documents.where("n_chars < 6000").select("doc_id", "text").collect()
    made = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op13_periodic_runs(spark, sf_dir).collect()}
    assert len(made) == documents.count()
    for row in rows:
        if zlib.crc32(str(row.doc_id).encode()) % 10 == 0 or row.doc_id % 5 == 0:
            assert made[row.doc_id] == expected_row(*row)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op13_periodic_runs(spark, str(tmp_path)).collect() == []
