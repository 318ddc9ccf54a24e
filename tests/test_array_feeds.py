"""Files of one JSON array, read in many splits."""

import json
import random

import pytest

from feedlake.sources import array_feeds, feeds

SCHEMA = "id bigint, text string, more array<struct<a: string, b: array<int>>>, m map<string, string>"
ODD = ["", "}", "{", "]", "[", '"', "\\", '\\"', "},{", '"}]', "é}ü", "\n}\t", "\\\\", "x" * 70, "{}" * 30,
       "\U0001f600}", " }", ",", ": [", "}]\n"]


@pytest.fixture
def small_splits(spark, request):
    """Splits of a few bytes, so that records, strings and letters cross them."""
    names = {
        "spark.sql.files.maxPartitionBytes": str(request.param),
        "spark.sql.files.openCostInBytes": "1",
        "spark.sql.files.minPartitionNum": "1",
    }
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield request.param
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def records(seed, count):
    rule = random.Random(seed)

    def text():
        return "".join(rule.choice(ODD) for _ in range(rule.randint(0, 5)))

    return [
        {
            "id": i,
            "text": rule.choice([None, text()]),
            "more": [{"a": text(), "b": [1] * rule.randint(0, 3)} for _ in range(rule.randint(0, 3))],
            "m": {text() + str(k): text() for k in range(rule.randint(0, 2))},
        }
        for i in range(count)
    ]


def plain(row):
    return json.dumps(
        {"id": row.id, "text": row.text, "more": [x.asDict() for x in row.more], "m": row.m},
        sort_keys=True,
    )


LAYOUTS = [{}, {"indent": 2}, {"ensure_ascii": False}, {"separators": (",", ":"), "ensure_ascii": False}]


@pytest.mark.parametrize("small_splits", [37, 300, 100_000], indirect=True)
def test_like_the_records(spark, tmp_path, small_splits):
    expected = []
    for i, layout in enumerate(LAYOUTS):
        made = records(i, 40)
        expected += made
        (tmp_path / f"{i}.json").write_text(json.dumps(made, **layout), "utf-8")
    (tmp_path / "none.json").write_text("[]\n")
    (tmp_path / "blank.json").write_text(" [ \n ] ")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "one.json").write_text("﻿[\n" + json.dumps(records(9, 1)[0]) + "\n]\n", "utf-8")
    expected += records(9, 1)
    read = array_feeds.read_array(spark, str(tmp_path), SCHEMA, "bad").collect()
    assert [row.bad for row in read if row.bad is not None] == []
    assert sorted(map(plain, read)) == sorted(json.dumps(r, sort_keys=True) for r in expected)


@pytest.mark.parametrize("small_splits", [64], indirect=True)
def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text(json.dumps(records(1, 100)))
    tasks = array_feeds._pieces(spark, str(tmp_path)).rdd.getNumPartitions()
    assert tasks >= (tmp_path / "a.json").stat().st_size / 64 - 1


@pytest.mark.parametrize("small_splits", [50, 100_000], indirect=True)
def test_what_cannot_be_read_is_told(spark, tmp_path, small_splits):
    def read(text):
        folder = tmp_path / str(len(list(tmp_path.iterdir())))
        folder.mkdir()
        (folder / "a.json").write_text(text)
        rows = array_feeds.read_array(spark, str(folder), SCHEMA, "bad").collect()
        return sorted(r.id for r in rows if r.bad is None), sum(r.bad is not None for r in rows)

    made = records(5, 12)
    whole = json.dumps(made)
    ids = list(range(12))
    assert read(whole) == (ids, 0)
    assert read(whole[:-1])[0] == ids and read(whole[:-1])[1] >= 1
    assert read(whole[:-2])[0] == ids[:-1] and read(whole[:-2])[1] >= 1
    lines = "\n".join(map(json.dumps, made))
    assert read(lines)[0] == [] and read(lines)[1] >= 1
    assert read(json.dumps(made[0]))[0] == [] and read(json.dumps(made[0]))[1] >= 1
    mixed = json.dumps([made[0], 5, made[1], [made[2]], made[3]])
    good, bad = read(mixed)
    assert set(good) <= {0, 1, 3} and 0 in good and bad >= 1
    assert read('[{"id": 1}, {"id": "x"}]') == ([1], 1)
    assert read("no json")[1] >= 1


def test_bad_feeds_are_not_staged(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('[{"id": "1"}, {"id": "2"')
    read = feeds.read_details(spark, str(tmp_path / "in"), json_lines=False)
    with pytest.raises(ValueError, match="cannot be read"):
        feeds.staged(read, str(tmp_path / "staged"))
    kept = feeds.staged(read, str(tmp_path / "staged"), allow_bad=True)
    assert [row.id for row in kept.collect()] == ["1"]
