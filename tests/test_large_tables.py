"""What keeps uneven tables workable: running sums, rows by bytes, salted joins, indexes, lists of
files and states of tables. Each against the plain way to say it."""

import json
import os
import random
from datetime import datetime
from pathlib import Path

import pytest
from helpers import multiset
from pyspark.sql import functions as F

from feedlake.operators import nest, running, skew
from feedlake.plans import maintenance
from feedlake.sources import documents, listing, tables


# --- running sums --------------------------------------------------------------------


def summed_by_hand(rows):
    made, sums = [], {}
    for g, i, tie, n in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2])):
        made.append((g, i, tie, n, sums.get(g, 0)))
        sums[g] = sums.get(g, 0) + (n or 0)
    return made


@pytest.mark.parametrize("bucket_rows,broadcast", [(10**6, 50), (20, 50), (20, 0), (1, 50)])
def test_running_sums(spark, monkeypatch, bucket_rows, broadcast):
    monkeypatch.setattr(running, "BROADCAST_GROUPS", broadcast)
    monkeypatch.setattr(running, "BUCKETS", 8)
    rule = random.Random(1)
    sizes = {"hot": 900, "warm": 60, "cold": 3, "one": 1, None: 30}
    rows = [
        (g, rule.choice([None, *range(n // 3 + 1)]), tie, rule.choice([None, 0, 5, 7, 1000]))
        for g, n in sizes.items()
        for tie in range(n)
    ]
    df = spark.createDataFrame(rows, "g string, i int, tie int, n long").repartition(5)
    made = running.running_sum(df, "g", ["i", "tie"], F.col("n"), "before", bucket_rows)
    assert made.columns == ["g", "i", "tie", "n", "before"]
    assert sorted(map(tuple, made.collect()), key=str) == sorted(summed_by_hand(rows), key=str)


def test_running_sums_of_nothing(spark):
    df = spark.createDataFrame([], "g string, i int")
    assert running.running_sum(df, "g", ["i"], F.lit(1), "n").collect() == []


# --- rows by bytes -------------------------------------------------------------------


@pytest.mark.parametrize("bucket_rows", [10**6, 30])
def test_rows_are_cut_by_bytes(spark, bucket_rows):
    rule = random.Random(2)
    rows = [("hot", i, "é" * rule.randint(0, 40), 1.0) for i in range(500)]
    rows += [("long", 1, "x" * 5000, None), ("long", 2, None, 2.0), ("few", 7, "a", None), ("none", None, "b", None)]
    df = spark.createDataFrame(rows, "g string, id bigint, text string, score double")
    fields = ["id", "text", "score"]
    dealt = nest.deal_by_bytes(df.repartition(4), "g", "id", fields, 600, bucket_rows)
    nested = nest.with_totals_by_part(nest.nest(dealt, ["g", "part"], fields, "id"), "g").collect()
    parts = {}
    for row in sorted(nested, key=lambda r: (r.g, r.part)):
        parts.setdefault(row.g, []).append(row)
    size = lambda r: 8 + len((r.text or "").encode()) + (0 if r.score is None else 8)
    for row in nested:
        assert sum(map(size, row.reviews[:-1])) < 600
        assert row.parts == len(parts[row.g])
        assert row.total_reviews == sum(len(p.reviews) for p in parts[row.g])
    assert [r.id for row in parts["hot"] for r in row.reviews] == list(range(500))
    assert len(parts["hot"]) > 20 and len(parts["few"]) == len(parts["none"]) == 1
    assert [[r.id for r in row.reviews] for row in parts["long"]] == [[1], [2]]
    assert [row.reviews for row in parts["none"]] == [[]]


# --- salted joins --------------------------------------------------------------------


def test_salted_join_keeps_all_pairs(spark):
    rule = random.Random(3)
    keys = ["hot"] * 400 + ["left"] * 300 + ["x", "y", None, None]
    left = [(k, i, rule.random()) for i, k in enumerate(keys)]
    left += left[:5]
    keys = ["hot"] * 90 + ["right"] * 500 + ["x", "x", "z", None]
    right = [(k, i, f"t{i}") for i, k in enumerate(keys)] + [("right", 1, "t"), ("left", 2, "u")]
    a = spark.createDataFrame(left, "k string, n int, v double").repartition(3)
    b = spark.createDataFrame(right, "r string, m int, t string").repartition(3)
    heavy = skew.heavy_keys(a, b, "k", "r", share_rows=100, share_pairs=5000)
    found = {r._key: (r._shares, r._left_dealt) for r in heavy.collect()}
    assert found == {"hot": (8, True), "left": (3, True), "right": (6, False)}
    joined = skew.salted_join(a, b, "k", "r", heavy)
    assert joined.columns == [*a.columns, *b.columns]
    assert multiset(joined) == multiset(a.join(b, F.col("k") == F.col("r")))


def test_no_heavy_keys(spark):
    a = spark.createDataFrame([("x", 1)], "k string, n int")
    b = spark.createDataFrame([("x", 2), (None, 3)], "r string, m int")
    none = skew.heavy_keys(a, b, "k", "r")
    assert none.count() == 0
    assert [tuple(r) for r in skew.salted_join(a, b, "k", "r", none).collect()] == [("x", 1, "x", 2)]
    assert skew.heavy_keys(a.limit(0), b, "k", "r").count() == 0


def test_no_task_gets_a_hot_key_whole(spark):
    a = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("n"))
    b = spark.range(20).select(F.lit("hot").alias("r"), F.col("id").alias("m"))
    heavy = skew.heavy_keys(a, b, "k", "r", share_rows=100)
    shared = skew._shared_out(a, "k", heavy, F.col("_left_dealt"))
    assert max(r["count"] for r in shared.groupBy("k", "_share").count().collect()) < 300


# --- indexed documents ---------------------------------------------------------------


@pytest.mark.parametrize("shard_bytes", [300, 1 << 20])
def test_documents_by_index(spark, tmp_path, shard_bytes):
    rows = [(f"k{i}", json.dumps({"n": i, "t": "é\U0001f600" * (i % 7)}, ensure_ascii=False)) for i in range(200)]
    rows += [("k3", "{}"), ("k4", rows[4][1]), ("pretty", '{\n  "a" : 1\n}'), ("", "x")]
    docs = spark.createDataFrame(rows, "doc_key string, document string").repartition(4)
    path = str(tmp_path / "docs")
    index = documents.write_indexed(docs, path, str(tmp_path / "index"), shard_bytes)
    assert multiset(documents.fetch(index, index)) == multiset(docs)
    for row in index.collect():
        data = Path("/" + row.file[5:].lstrip("/")).read_bytes()
        assert (row.doc_key, data[row.offset : row.offset + row.length].decode()) in rows
    wanted = spark.createDataFrame([("k3",), ("k3",), ("none",), (None,), ("",)], "doc_key string")
    found = documents.fetch(index, wanted)
    assert multiset(found) == multiset(docs.where("doc_key IN ('k3', '')"))
    files = [p for p in Path(path).rglob("part-*")]
    assert (len(files) > 10) == (shard_bytes == 300)
    # Every file is whole lines, as from the plain writer.
    if "\n" not in rows[0][1]:
        text = "".join(p.read_text("utf-8") for p in files)
        assert text.count("\n") == len(rows) + 2


def test_damaged_documents_are_noticed(spark, tmp_path):
    docs = spark.createDataFrame([("a", "{}"), ("b", "[]")], "doc_key string, document string")
    index = documents.write_indexed(docs, str(tmp_path / "d"), str(tmp_path / "i"))
    file = next((tmp_path / "d").rglob("part-*"))
    file.write_text(file.read_text().replace("[]", "{]"))
    with pytest.raises(Exception, match="does not hold b"):
        documents.fetch(index, docs).collect()


def test_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_key string, document string")
    index = documents.write_indexed(docs, str(tmp_path / "d"), str(tmp_path / "i"))
    assert index.count() == 0 and documents.fetch(index, docs).count() == 0


# --- files ---------------------------------------------------------------------------


def test_files_are_listed_level_by_level(spark, tmp_path):
    names = ["a.bin", "x/b.bin", "x/y/z/c d%20é.bin", "x/y/.hidden", "_SUCCESS", "_tmp/e.bin", "k=1/f"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    (tmp_path / "empty" / "deep").mkdir(parents=True)
    os.utime(tmp_path / "a.bin", (0, 0))
    shown = {r.path: r for r in listing.list_files(spark, str(tmp_path)).collect()}
    root = f"file:{tmp_path}"
    assert set(shown) == {f"{root}/{n}" for n in ("a.bin", "x/b.bin", "x/y/z/c d%20é.bin", "k=1/f")}
    assert shown[f"{root}/a.bin"].size == 5
    assert shown[f"{root}/a.bin"].modified_at == datetime(1970, 1, 1)
    every = listing.list_files(spark, f"file:{tmp_path}/", hidden=True)
    assert every.count() == len(names)
    assert listing.list_files(spark, str(tmp_path / "not there")).count() == 0


def test_orphans_of_a_written_table(spark, tmp_path):
    path = str(tmp_path / "t")
    odd = F.concat(F.lit("a+b %20/é"), F.col("id") % 4)
    df = spark.range(40).select("id", (F.col("id") % 4).alias("p"), odd.alias("q"))
    tables.write_table(df, path, ["p", "q"])
    first = listing.referenced_files(spark.read.parquet(path)).collect()
    tables.write_table(df.where("p = 1"), path, ["p", "q"])
    noted = spark.createDataFrame(listing.referenced_files(spark.read.parquet(path)).collect())
    assert noted.count() == len(first) == 4
    df.where("p = 2").coalesce(1).write.mode("append").partitionBy("p", "q").parquet(path)
    (tmp_path / "t" / "p=3" / "stray.tmp").write_text("x")
    os.utime(tmp_path / "t" / "p=3" / "stray.tmp", (0, 0))
    found = listing.list_files(spark, path)
    assert maintenance.orphan_files(found, noted, "9999-01-01").count() == 2
    old = maintenance.orphan_files(found, noted, "2001-01-01").collect()
    assert [r.path for r in old] == [f"file:{path}/p=3/stray.tmp"]


def test_files_that_go_with_snapshots(spark):
    at = datetime(2020, 1, 1)
    snapshots = spark.createDataFrame(
        [("t", 1, at), ("t", 2, at.replace(month=2)), ("t", 3, at.replace(month=3)), ("u", 1, at)],
        "table_name string, snapshot_id int, committed_at timestamp_ntz",
    )
    manifests = spark.createDataFrame(
        [("t", 1, "m1"), ("t", 1, "shared"), ("t", 2, "m2"), ("t", 2, "shared"), ("t", 3, "shared"),
         ("t", 3, "m3"), ("u", 1, "u1"), ("t", 9, "unlisted"), ("t", 1, None), ("t", 1, "unlisted")],
        "table_name string, snapshot_id int, manifest string",
    )
    entries = spark.createDataFrame(
        [("m1", "a"), ("m1", "b"), ("m1", "of u"), ("shared", "c"), ("m2", "b"), ("m2", "c"), ("m2", "d"),
         ("m3", "d"), ("u1", "of u"), ("unknown", "a2"), ("m1", "a2"), ("m1", None), ("unlisted", "e"), ("m1", "e")],
        "manifest string, path string",
    )
    gone = maintenance.files_to_expire(snapshots, manifests, entries, "2021-01-01")
    assert sorted(map(tuple, gone.collect())) == [
        ("t", "file", "a"), ("t", "file", "b"), ("t", "manifest", "m1"), ("t", "manifest", "m2"),
    ]
    assert maintenance.files_to_expire(snapshots, manifests, entries, "2019-01-01").count() == 0


# --- states of a table ---------------------------------------------------------------


def test_changed_partitions(spark):
    schema = "n int, p string, t string"
    old = [(1, "same", "a"), (2, "same", "b"), (1, "copies", "a"), (1, "copies", "a"), (2, "copies", "b"),
           (1, "gone", None), (1, None, "x"), (5, "swap", "x"), (6, "swap", "y")]
    new = [(2, "same", "b"), (1, "same", "a"), (1, "copies", "a"), (2, "copies", "b"), (2, "copies", "b"),
           (1, "new", None), (1, None, "x"), (5, "swap", "y"), (6, "swap", "x"), (1, "", "x")]
    made = tables.changed_partitions(
        spark.createDataFrame(old, schema), spark.createDataFrame(new, schema).select("t", "p", "n"), ["p"]
    )
    assert {r.p: (r.rows_before, r.rows_after, r.change) for r in made.collect()} == {
        "same": (2, 2, "same"), "copies": (3, 3, "changed"), "gone": (1, 0, "gone"), "new": (0, 1, "new"),
        None: (1, 1, "same"), "swap": (2, 2, "changed"), "": (0, 1, "new"),
    }
    with pytest.raises(ValueError, match="different columns"):
        tables.changed_partitions(made, made.drop("change"), ["p"])


def test_only_changed_partitions_are_written(spark, tmp_path):
    path, partitions = str(tmp_path / "t"), ["p"]
    df = spark.range(40).select(F.col("id").cast("int").alias("n"), (F.col("id") % 4).cast("string").alias("p"))
    tables.write_table(df, path, partitions)
    files = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    later = df.where("n <> 5 AND p <> '3'").unionAll(spark.createDataFrame([(1, "9")], "n int, p string"))
    changes = tables.rewrite_changed(spark, path, later, partitions)
    assert {r.p: r.change for r in changes.collect()} == {
        "0": "same", "1": "changed", "2": "same", "3": "gone", "9": "new",
    }
    now = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    kept = {p.parent.name for p in files if now.get(p) == files[p]}
    assert kept == {"p=0", "p=2", "p=3"}
    back = tables.read_table(spark, path, "n int, p string", partitions)
    assert multiset(back) == multiset(later.unionAll(df.where("p = '3'")))
    again = tables.rewrite_changed(spark, path, back, partitions)
    assert {r.change for r in again.collect()} == {"same"}
