"""Schemas told by the files, and column profiles merged from partitions."""

import pytest
from helpers import multiset
from pyspark.sql import functions as F

from feedlake.operators import profile
from feedlake.sources import discovery


def test_types_are_joined_whatever_the_order(spark, tmp_path):
    path = str(tmp_path / "t")
    made = [
        "CAST(1 AS TINYINT) AS a, CAST(1 AS INT) AS b, 1.5D AS c, 'x' AS d, DATE'2020-01-01' AS e",
        "CAST(2 AS BIGINT) AS a, CAST(2 AS FLOAT) AS b, CAST(2 AS INT) AS c, 'y' AS d, 5 AS e",
        "CAST(3 AS INT) AS a, CAST(3 AS INT) AS f, TRUE AS g",
    ]
    for i, columns in enumerate(made):
        spark.sql(f"SELECT {columns}, 'p{i % 2}' AS p").write.mode("append").partitionBy("p").parquet(path)
    found = discovery.discovered_schema(discovery.footers(spark, path)).collect()
    assert {r.name: (r.type, r.conflict, r.files) for r in found} == {
        "a": ("bigint", False, 3), "b": ("double", False, 2), "c": ("double", False, 2),
        "d": ("string", False, 2), "e": ("string", True, 2), "f": ("int", False, 1), "g": ("boolean", False, 1),
    }
    read = discovery.read_discovered(spark, path, ["p"])
    assert sorted(map(str, map(tuple, read.select("a", "b", "c", "d", "e", "f", "g", "p").collect()))) == [
        "(1, 1.0, 1.5, 'x', '2020-01-01', None, None, 'p0')",
        "(2, 2.0, 2.0, 'y', '5', None, None, 'p1')",
        "(3, None, None, None, None, 3, True, 'p0')",
    ]
    plan = read.where("p = 'p1' AND a > 1").select("a")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and "ReadSchema: struct<a:bigint>" in plan


def test_tables_that_cannot_be_told(spark, tmp_path):
    with pytest.raises(ValueError, match="no file"):
        discovery.read_discovered(spark, str(tmp_path / "none"))
    path = str(tmp_path / "t")
    spark.sql("SELECT 1 AS a").write.parquet(f"{path}/x")
    spark.sql("SELECT 1 AS A").write.parquet(f"{path}/y")
    with pytest.raises(ValueError, match="case only"):
        discovery.read_discovered(spark, path)


def test_profiles_of_partitions_merge(spark):
    rows = [(i % 3, i if i % 5 else None, f"v{i % 7}", float(i)) for i in range(900)]
    df = spark.createDataFrame(rows, "p int, n int, t string, x double").repartition(4)
    parts = profile.partition_profiles(df, ["p"])
    assert parts.count() == 9
    merged = {r.name: r for r in profile.merged_profile(parts).collect()}
    n, t, x = merged["n"], merged["t"], merged["x"]
    assert (n.rows, n.nulls, n.least, n.most, n.first) == (900, 180, 1.0, 899.0, None)
    assert (t.rows, t.nulls, t.least, t.first, t.last, t.quartiles) == (900, 0, None, "v0", "v6", [None] * 3)
    assert abs(x.distinct - 900) < 60 and t.distinct == 7
    assert all(abs(q - e) < 30 for q, e in zip(x.quartiles, (225, 450, 675)))
    assert {r.item: r["count"] for r in t.frequent}.items() <= {f"v{i}": 129 if i < 4 else 128 for i in range(7)}.items()
    # A partition made anew leaves the others as they are.
    again = parts.where("p <> 1").unionAll(profile.partition_profiles(df.where("p = 1"), ["p"]))
    exact = ["name", "rows", "nulls", "least", "most", "first", "last"]
    assert multiset(profile.merged_profile(again), *exact) == multiset(profile.merged_profile(parts), *exact)


def test_profile_of_columns_without_values(spark):
    df = spark.createDataFrame([(1, None, None)], "p int, n double, t string")
    merged = {r.name: r for r in profile.merged_profile(profile.partition_profiles(df, ["p"])).collect()}
    assert (merged["n"].nulls, merged["n"].least, merged["n"].quartiles) == (1, None, [None] * 3)
    assert (merged["t"].nulls, merged["t"].first, merged["t"].distinct) == (1, None, 0)
    empty = profile.partition_profiles(df.limit(0), ["p"])
    assert profile.merged_profile(empty).count() == 0


def test_profile_is_checked_without_repeating_rows(spark, tmp_path):
    from feedlake.testbed.queries import all_queries

    rows = spark.range(2000).selectExpr(
        "id % 400 AS l_orderkey", "id % 50 / 10 AS l_tax",
        "IF(id % 3 = 0, -0.0D, id % 2 + 0.0D) AS l_quantity",
        "concat('A', id % 2) AS l_returnflag", "'F' AS l_linestatus",
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    profiled = all_queries()["column_profile"](spark, str(tmp_path))
    assert "Expand" not in profiled._jdf.queryExecution().toString()
    found = {r.name: r for r in profiled.collect()}
    assert set(found) == {"l_orderkey", "l_tax", "l_quantity"}
    near = {n: (r.distinct_near, r.quartiles_near, r.frequent_near) for n, r in found.items()}
    assert near == dict.fromkeys(found, (True, True, True))
    assert {(r.rows, r.nulls) for r in found.values()} == {(2000, 0)}
