from datetime import UTC, datetime, timedelta, timezone

import pytest

from feedlake.plans import maintenance as m


def at(day):
    return datetime(2024, 1, day)


def snapshots(spark, dtype="timestamp"):
    rows = [("t", 1, 1), ("t", 2, 2), ("t", 3, 9), ("u", 4, 1), ("v", 5, 1), ("v", 6, 1)]
    rows = [(table, snapshot, at(day)) for table, snapshot, day in rows]
    return spark.createDataFrame(
        rows, f"table_name string, snapshot_id bigint, committed_at {dtype}"
    )


def ids(df):
    return sorted(r.snapshot_id for r in df.collect())


@pytest.mark.parametrize("dtype", ["timestamp", "timestamp_ntz"])
def test_expiry_keeps_the_newest(spark, dtype):
    df = snapshots(spark, dtype)
    assert ids(m.snapshots_to_expire(df, "2024-01-05")) == [1, 2, 5]
    assert ids(m.snapshots_to_expire(df, "2024-01-05", retain_last=2)) == [1]
    assert ids(m.snapshots_to_expire(df, "2024-01-02")) == [1, 5]
    assert ids(m.snapshots_to_expire(df, "2023-01-01")) == []
    assert ids(m.snapshots_to_expire(df)) == [1, 2, 5]


def test_cutoff():
    assert m.cutoff_time(datetime(2024, 1, 1)) == datetime(2024, 1, 1, tzinfo=UTC)
    east = timezone(timedelta(hours=2))
    assert m.cutoff_time(datetime(2024, 1, 1, 2, tzinfo=east)) == datetime(2024, 1, 1, tzinfo=UTC)
    assert m.cutoff_time("2024-01-01 00:00:00") == datetime(2024, 1, 1, tzinfo=UTC)
    age = datetime.now(UTC) - m.cutoff_time()
    assert timedelta(hours=23) < age < timedelta(hours=25)


def test_orphans_and_plan(spark):
    listing = spark.createDataFrame(
        [("t", "a", at(1)), ("t", "b", at(1)), ("u", "c", at(9)), ("u", "d", at(2))],
        "table_name string, path string, modified_at timestamp",
    )
    referenced = spark.createDataFrame([("b",), ("b",), ("zz",), (None,)], "path string")
    orphans = m.orphan_files(listing, referenced, "2024-01-05")
    assert sorted(r.path for r in orphans.collect()) == ["a", "d"]
    plan = m.maintenance_plan(snapshots(spark), listing, referenced, "2024-01-05")
    assert sorted(tuple(r) for r in plan.collect()) == [
        ("t", "expire_snapshot", "1"),
        ("t", "expire_snapshot", "2"),
        ("t", "remove_orphan_file", "a"),
        ("u", "remove_orphan_file", "d"),
        ("v", "expire_snapshot", "5"),
    ]


def test_table_health(spark):
    tables = spark.createDataFrame(
        [
            ("fine", "w/fine/", "w/fine", 1),
            ("moved", "x/moved", "w/moved", 2),
            ("lost", "w/lost", "w/lost", 9),
            ("bare", "w/bare", "w/bare", 3),
            ("new", None, "w/new", None),
            ("unlisted", "", "w/unlisted", 4),
            ("both", "x/both", "w/both", 9),
        ],
        "table_name string, location string, expected_location string, current_snapshot_id bigint",
    )
    known = spark.createDataFrame(
        [
            ("fine", 1, "m1"),
            ("moved", 2, "m2"),
            ("bare", 3, "gone"),
            ("unlisted", 4, None),
            ("fine", 9, "m9"),
        ],
        "table_name string, snapshot_id bigint, manifest_list string",
    )
    files = spark.createDataFrame([("m1",), ("m1",), ("m2",)], "path string")
    health = {r.table_name: r.reasons for r in m.table_health(tables, known, files).collect()}
    assert health == {
        "fine": [],
        "moved": ["metadata location points to x/moved, expected w/moved"],
        "lost": ["current snapshot 9 is missing from metadata"],
        "bare": ["manifest list is missing: gone"],
        "new": [],
        "unlisted": [],
        "both": [
            "metadata location points to x/both, expected w/both",
            "current snapshot 9 is missing from metadata",
        ],
    }
