"""Every registered query against its SQL, row for row."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from feedlake.operators import joins
from feedlake.plans import builds
from feedlake.testbed import feeds
from feedlake.testbed.oracle import _with_parts, expected
from feedlake.testbed.queries import all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = {name: entry_points.queries()[name] for name in all_queries()}
ORACLE = expected()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else v + 0.0
        return v

    return Counter(tuple(value(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def assert_agree(df, result):
    assert sorted(df.columns) == sorted(result.columns)
    types = dict(zip(result.columns, map(str, result.types), strict=True))
    assert {c: KINDS[t] for c, t in df.dtypes} == types
    ours = canonical([tuple(r) for r in df.collect()], df.columns)
    theirs = canonical(result.fetchall(), result.columns)
    missing, surplus = theirs - ours, ours - theirs
    assert not missing and not surplus, (list(missing)[:3], list(surplus)[:3])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    assert_agree(QUERIES[name](spark, sf_dir), duck.sql(ORACLE[name]))


def test_pairs_of_repeated_listings_and_offers(spark, sf_dir, duck):
    """The view pairs all listings with all offers."""
    root = feeds.built_tables(spark, sf_dir)
    made = joins.combined_view(builds.read_rental(spark, root), builds.read_reviews(spark, root))
    assert_agree(made, duck.sql(_with_parts("SELECT * FROM combined", ("combined",))))


@pytest.mark.parametrize("name", ["top_properties", "most_expensive", "review_density"])
def test_order_of_rows(spark, sf_dir, duck, name):
    made, result = QUERIES[name](spark, sf_dir), duck.sql(ORACLE[name])
    rows = [tuple(row[c] for c in result.columns) for row in made.collect()]
    assert rows == result.fetchall()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_gives_rows(spark):
    assert entry_points.entry(spark).count() > 0
