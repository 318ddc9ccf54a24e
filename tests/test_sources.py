"""Feeds, tables and documents on disk."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from helpers import details_feed, multiset, review, reviews_feed, search_feed
from pyspark.sql import functions as F

from feedlake import fixed_values as V
from feedlake import schemas
from feedlake.__main__ import main
from feedlake.operators import audit
from feedlake.plans import builds
from feedlake.sources import documents, feeds, tables
from feedlake.workspace import work_folder

RECORDS = [
    {
        "id": 12,
        "name": {"de": "Haus", "xx": "X"},
        "location": {"country": "de", "city": "Ulm"},
        "rating": {"stars": 4, "review_score": 8.5},
        "unknown": {"a": 1},
    },
    {"id": "13", "name": {}, "location": None},
]


@pytest.mark.parametrize("json_lines", [True, False])
def test_feed_layouts(spark, tmp_path, json_lines):
    text = (
        "\n".join(json.dumps(r) for r in RECORDS) if json_lines else json.dumps(RECORDS, indent=1)
    )
    (tmp_path / "details.json").write_text(text, "utf-8")
    df = feeds.read_details(spark, str(tmp_path), json_lines=json_lines)
    rows = {r.id: r for r in df.collect()}
    assert rows["12"].name == {"de": "Haus", "xx": "X"}
    assert (rows["12"].rating.stars, rows["12"].rating.review_score) == ("4", "8.5")
    assert (rows["12"].currency, rows["13"].location) == (None, None)


def test_partition_values_keep_their_type(spark, tmp_path):
    values = ["01", "1", "", None, "a/b", "A B", "__EMPTY", "__EMPTY__", "__EMPTY____EMPTY__"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, code string")
    path = str(tmp_path / "t")
    tables.write_table(df, path, ["code"])
    back = tables.read_table(spark, path, "n int, code string", ["code"])
    assert {r.n: r.code for r in back.collect()} == dict(enumerate(values))
    assert [r.n for r in back.where("code = ''").collect()] == [2]


def test_overwrite_touches_only_the_partitions_of_the_batch(spark, tmp_path):
    schema = "n int, country string, year int"
    path, partitions = str(tmp_path / "t"), ["country", "year"]
    first = [(1, "GB", 2024), (2, "GB", 2023), (3, "HR", 2024), (4, None, None)]
    tables.write_table(spark.createDataFrame(first, schema), path, partitions)
    tables.write_table(spark.createDataFrame([(9, "GB", 2024)], schema), path, partitions)
    back = tables.read_table(spark, path, schema, partitions)
    assert sorted(r.n for r in back.collect()) == [2, 3, 4, 9]
    tables.write_table(spark.createDataFrame([(7, None, None)], schema), path, partitions)
    back = tables.read_table(spark, path, schema, partitions)
    assert sorted(tuple(r) for r in back.collect()) == [
        (2, "GB", 2023),
        (3, "HR", 2024),
        (7, None, None),
        (9, "GB", 2024),
    ]
    tables.write_table(
        spark.createDataFrame([(8, "US", 2020)], schema), path, partitions, mode="full"
    )
    back = tables.read_table(spark, path, schema, partitions)
    assert [tuple(r) for r in back.collect()] == [(8, "US", 2020)]


def test_write_modes_are_checked(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "n int")
    with pytest.raises(ValueError, match="mode"):
        tables.write_table(df, str(tmp_path / "a"), ["n"], mode="append")
    with pytest.raises(ValueError, match="partition"):
        tables.write_table(df, str(tmp_path / "b"))


def test_table_inspection(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert tuple(tables.row_count(df).first()) == (2, 2)
    assert [tuple(r) for r in tables.schema_table(df).collect()] == [
        ("a", "int", 2),
        ("b", "string", 1),
    ]


def test_listing_names_files_without_reading_them(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.bin").write_bytes(b"12")
    df = tables.list_files(spark, str(tmp_path))
    assert [Path(r.path).name for r in df.collect()] == ["a.bin"]
    read = df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    assert "content" not in read


def test_observed_counts_come_from_the_write(spark, tmp_path):
    df = spark.range(100).withColumn("part", F.col("id") % 3)
    rows, counts = audit.observed(
        tables.spread_for_write(df, ["part"]), "t", even=F.count_if(F.col("id") % 2 == 0)
    )
    tables.write_table(rows, str(tmp_path / "t"), ["part"], spread=False)
    assert counts.get == {"rows": 100, "even": 50}


def test_work_folder_is_below_the_shared_folder(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert work_folder(spark, "x") != work_folder(spark, "x")
    if before:
        assert work_folder(spark, "x").startswith(before.rstrip("/") + "/x-")


def feeds_for_build(spark):
    details = details_feed(
        spark,
        [
            dict(id="1", name={"en": "One"}, country="gb", currency="GBP", stars=3.0, score=8.0),
            dict(id="2", name={"en": "Two"}, country="hr", stars=2.0, score=1.0),
            dict(id="3", name={"en": "Three"}, country="hr"),
        ],
    )
    search = search_feed(
        spark, [dict(id="1", book=10.0), dict(id="1", book=8.0), dict(id="2", meals=["a"])]
    )
    reviews = reviews_feed(
        spark,
        [
            ("1", [review(12, "2024-05-01", 9.0, "Ann"), review(11, "2023-05-01", 8.0, "Bo")]),
            ("1", [review(12, "2024-05-01", 7.0, "Ann")]),
            ("2", []),
        ],
    )
    return details, search, reviews


def read_lines(spark, path):
    rows = spark.read.option("recursiveFileLookup", "true").text(path).collect()
    return [json.loads(r.value) for r in rows]


def test_build_all(spark, tmp_path):
    root = str(tmp_path / "lake")
    counts = builds.build_all(*feeds_for_build(spark), root)
    assert counts["rental_property"] == {
        "rows": 3,
        "needs_review": 0,
        "missing_commission": 3,
        **counts["rental_property"],
    }
    assert counts["rental_property"]["matched_rows"] == 3
    assert counts["property_reviews"] == {"rows": 5, "reviews": 3, "needs_review": 1}
    assert counts["rentals_reviews"] == {"rows": 2, "reviews": 2, "listings": 2}
    final = {d["id"]: d for d in read_lines(spark, f"{root}/final_data")}
    assert set(final) == {"GEN-1", "GEN-2"}
    one = final["GEN-1"]
    assert list(one) == [*V.RENTAL_COLUMNS, "total_reviews", "reviews"]
    assert (one["usd_price"], one["country_code"], one["commission"]) == (8.0, "GB", None)
    assert [(r["review_id"], r["score"], r["review_year"]) for r in one["reviews"]] == [
        (11, 8.0, 2023),
        (12, 7.0, 2024),
    ]
    assert (final["GEN-2"]["total_reviews"], final["GEN-2"]["reviews"]) == (0, [])
    per_property = {d["gen_id"]: d for d in read_lines(spark, f"{root}/property_data")}
    assert {k: d["total_reviews"] for k, d in per_property.items()} == {
        "GEN-1": 2,
        "GEN-2": 0,
        "GEN-3": 0,
    }
    backup = spark.read.schema(schemas.RENTAL_PROPERTY).parquet(f"{root}/final_output")
    assert multiset(backup) == multiset(builds.read_rental(spark, root))
    stamps = builds.read_final(spark, root).select("created_time").distinct().collect()
    assert len(stamps) == 1 and stamps[0].created_time is not None

    builds.register_combined_view(spark, root)
    assert spark.sql("SELECT count(*) FROM property_combined").first()[0] == 7
    assert len(spark.table("property_combined").columns) == 26


def test_builds_on_feeds_that_do_not_meet(spark, tmp_path):
    root = str(tmp_path / "lake")
    details = details_feed(spark, [dict(id="1", name={"en": "One"})])
    counts = builds.build_all(
        details, search_feed(spark, [dict(id="2")]), reviews_feed(spark, []), root
    )
    rental = counts["rental_property"]
    assert (rental["rows"], rental["details_rows"], rental["unmatched_rows"]) == (0, 1, 1)
    assert counts["property_reviews"] == {"rows": 1, "reviews": 0, "needs_review": 1}
    assert counts["rentals_reviews"] == {"rows": 0, "reviews": 0, "listings": 0}
    assert builds.read_final(spark, root).count() == 0
    assert [d["gen_id"] for d in read_lines(spark, f"{root}/property_data")] == ["GEN-1"]


def test_one_pretty_file_per_listing(spark, tmp_path):
    lines, files = str(tmp_path / "lines"), str(tmp_path / "files")
    for root in (lines, files):
        details, search, reviews = feeds_for_build(spark)
        builds.build_rental(details, search, root)
        builds.build_reviews(details, reviews, root)
        builds.build_final(spark, root, per_key=root == files)
        builds.build_review_documents(spark, root, per_key=root == files)
    folders = {p.name for p in (tmp_path / "files" / "final_data").glob("doc_key=*")}
    assert folders == {"doc_key=GEN-1", "doc_key=GEN-2"}
    for folder, schema in (
        ("final_data", schemas.FINAL_DOCUMENT),
        ("property_data", schemas.REVIEW_DOCUMENT),
    ):
        one = documents.read_documents(spark, f"{lines}/{folder}", schema)
        other = documents.read_documents(spark, f"{files}/{folder}", schema, pretty=True)
        assert multiset(one) == multiset(other)
    text = (tmp_path / "files" / "final_data" / "doc_key=GEN-1").glob("part-*")
    assert len(next(text).read_text("utf-8").splitlines()) > 20


@pytest.mark.parametrize("layout", ["lines", "arrays"])
def test_build_from_files(spark, tmp_path, capsys, layout):
    """The command line on JSON files: the same documents as from frames."""
    details, search, reviews = feeds_for_build(spark)
    given = ["--root", str(tmp_path / "lake")]
    for name, df in (("details", details), ("search", search), ("reviews", reviews)):
        records = [json.loads(line) for line in df.toJSON().collect()]
        (tmp_path / name).mkdir()
        lines = "\n".join(json.dumps(r) for r in records)
        text = lines if layout == "lines" else json.dumps(records)
        (tmp_path / name / "feed.json").write_text(text, "utf-8")
        given += [f"--{name}", str(tmp_path / name)]
    main(given + (["--arrays"] if layout == "arrays" else []))
    assert json.loads(capsys.readouterr().out)["rentals_reviews"] == {
        "rows": 2,
        "reviews": 2,
        "listings": 2,
    }
    builds.build_all(details, search, reviews, str(tmp_path / "frames"))
    for folder in ("final_data", "property_data"):
        made = read_lines(spark, str(tmp_path / "lake" / folder))
        expected = read_lines(spark, str(tmp_path / "frames" / folder))
        key = ["id", "gen_id"][folder == "property_data"]
        assert sorted(made, key=lambda d: d[key]) == sorted(expected, key=lambda d: d[key])


def test_second_build_replaces_its_countries_only(spark, tmp_path):
    root = str(tmp_path / "lake")
    details, search, reviews = feeds_for_build(spark)
    builds.build_rental(details, search, root)
    builds.build_reviews(details, reviews, root)
    builds.build_final(spark, root, created_at=datetime(2024, 1, 1))
    british = details.where("location.country = 'gb'").withColumn("currency", F.lit("EUR"))
    builds.build_rental(british, search, root)
    rental = {r.id: r.currency for r in builds.read_rental(spark, root).collect()}
    assert rental == {"GEN-1": "EUR", "GEN-2": "USD"}
    builds.build_rental(british, search, root, mode="full")
    assert {r.id for r in builds.read_rental(spark, root).collect()} == {"GEN-1"}
    # The second final build is about one country; the documents of the other stay.
    builds.build_final(spark, root)
    docs = {d["id"]: d["currency"] for d in read_lines(spark, f"{root}/final_data")}
    assert docs == {"GEN-1": "EUR", "GEN-2": "USD"}


def nested_docs(spark, ids):
    rows = [(i, "GB", [(1, "t")], p) for i, p in ids]
    df = spark.createDataFrame(
        rows,
        "id string, country_code string, reviews array<struct<review_id:bigint,t:string>>, "
        "part int",
    )
    fields = F.transform(
        "reviews",
        lambda r: F.struct(
            r.review_id.alias("review_id"),
            *[F.lit(None).cast("string").alias(name) for name in V.REVIEW_FIELDS[1:]],
        ),
    )
    return documents.documents(df.withColumn("reviews", fields), ["id", "country_code"], "id")


def test_one_file_per_key(spark, tmp_path):
    docs = nested_docs(spark, [("a/1", 0), ("b", 0), ("b", 1)])
    path = tmp_path / "docs"
    documents.write_document_files(docs, str(path))
    folders = {p.name: list(p.glob("part-*")) for p in path.glob("doc_key=*")}
    assert {name: len(files) for name, files in folders.items()} == {
        "doc_key=a_1": 1,
        "doc_key=b": 1,
        "doc_key=b.1": 1,
    }
    made = json.loads(folders["doc_key=a_1"][0].read_text("utf-8"))
    assert (made["id"], made["total_reviews"], made["reviews"][0]["summary"]) == ("a/1", 1, None)


def test_two_documents_with_one_key_are_an_error(spark, tmp_path):
    docs = nested_docs(spark, [("a/1", 0), ("a_1", 0)])
    with pytest.raises(ValueError, match="a_1"):
        documents.write_document_files(docs, str(tmp_path / "docs"))


def test_null_reviews_become_an_empty_list(spark):
    df = nested_docs(spark, [("a", 0)])
    assert '"reviews":[{' in df.first().document
    rows = spark.createDataFrame([("a", "GB", None)], "id string, country_code string, x int")
    nested = rows.drop("x").withColumn("reviews", F.lit(None).cast(nested_type(spark)))
    made = documents.documents(nested, ["id", "country_code"], "id").first()
    assert json.loads(made.document)["reviews"] == []
    assert json.loads(made.document)["total_reviews"] == 0


def nested_type(spark):
    empty = spark.createDataFrame([], schemas.RENTALS_REVIEWS)
    return empty.schema["reviews"].dataType


def test_reviews_of_a_property_lie_together(spark, tmp_path):
    ids = [str(i) for i in range(40)]
    details = details_feed(spark, [dict(id=i, country="gb") for i in ids])
    records = [(i, [review(n * 100 + int(i), "2024-05-01")]) for n in range(5) for i in ids]
    builds.build_reviews(details, reviews_feed(spark, records), str(tmp_path))
    df = builds.read_reviews(spark, str(tmp_path))
    assert df.count() == 200
    for file in df.inputFiles():
        found = [r.gen_id for r in spark.read.parquet(file).select("gen_id").coalesce(1).collect()]
        assert found == sorted(found)


class FakeSession:
    def __init__(self, **conf):
        settings = {key.replace("_", "."): value for key, value in conf.items()}
        self.conf = type("Conf", (), {"get": staticmethod(settings.get)})
        folder = settings.get("checkpoint.folder")
        self.sparkContext = type("Context", (), {"getCheckpointDir": lambda self: folder})()


def test_shared_folder():
    named = FakeSession(spark_master="yarn", spark_checkpoint_dir="hdfs://nn/shared/")
    assert work_folder(named, "x").startswith("hdfs://nn/shared/x-")
    unnamed = FakeSession(spark_master="yarn")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(unnamed, "x")
    set_later = FakeSession(spark_master="local[2]", checkpoint_folder="/shared")
    assert work_folder(set_later, "x").startswith("/shared/x-")


def test_bad_records_stop_a_build_unless_allowed(spark, tmp_path):
    records = "\n".join(json.dumps(r) for r in RECORDS) + '\n{"id": "14", "na'
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "details.json").write_text(records, "utf-8")
    df = feeds.read_details(spark, str(tmp_path / "feed"))
    with pytest.raises(ValueError, match="1 of 3 records"):
        feeds.staged(df, str(tmp_path / "out"))
    kept = feeds.staged(df, str(tmp_path / "out"), allow_bad=True)
    assert {r.id for r in kept.collect()} == {"12", "13"}
    assert [r.value for p in (tmp_path / "out").glob("*-bad") for r in spark.read.text(str(p)).collect()] == [
        '{"id": "14", "na'
    ]


def test_an_array_feed_read_as_lines_is_refused(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "details.json").write_text(json.dumps(RECORDS, indent=1), "utf-8")
    df = feeds.read_details(spark, str(tmp_path / "feed"))
    with pytest.raises(ValueError, match="layout"):
        feeds.staged(df, str(tmp_path / "out"))
    with pytest.raises(ValueError, match="cannot be staged"):
        feeds.staged(df, str(tmp_path / "feed" / "x"), sources=[str(tmp_path / "feed")])
    assert (tmp_path / "feed" / "details.json").exists()


def test_a_full_build_does_not_empty_the_table(spark, tmp_path):
    details, search, reviews = feeds_for_build(spark)
    root = str(tmp_path)
    builds.build_rental(details, search, root)
    before = multiset(builds.read_rental(spark, root))
    for build in (
        lambda: builds.build_rental(details.limit(0), search, root, mode="full"),
        lambda: builds.build_reviews(details.limit(0), reviews, root, mode="full"),
    ):
        with pytest.raises(ValueError, match="left as it is"):
            build()
    assert multiset(builds.read_rental(spark, root)) == before


def test_small_shards_share_tasks(spark):
    docs = spark.range(400).selectExpr(
        "concat('k', id) AS doc_key", "concat(repeat('x', 90), id) AS document"
    )
    path = work_folder(spark, "shards")
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("indexed", "")
    index = documents.write_indexed(docs, path, f"{path}-index", shard_bytes=2_000)
    context.setJobGroup("fetched", "")
    fetched = multiset(documents.fetch(index, index))
    context._jsc.clearJobGroup()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stages = [s for j in tracker.getJobIdsForGroup("indexed") for s in tracker.getJobInfo(j).stageIds]
    sizes = [info.numTasks for s in stages if (info := tracker.getStageInfo(s))]
    assert index.select("file").distinct().count() > partitions
    assert max(sizes) <= max(partitions, docs.rdd.getNumPartitions())
    stages = [s for j in tracker.getJobIdsForGroup("fetched") for s in tracker.getJobInfo(j).stageIds]
    assert partitions in [info.numTasks for s in stages if (info := tracker.getStageInfo(s))]
    assert fetched == multiset(docs)
