"""What the plans look like, and that hot keys are split, with results left whole.

The thresholds that adaptive execution compares partitions with are set low, so that a
small table with a third of all rows on one key behaves like a large one.
"""

import re
from contextlib import contextmanager

import pytest
from helpers import multiset
from pyspark.sql import functions as F

from feedlake import fixed_values as V
from feedlake.operators import dedup, joins
from feedlake.plans import builds, reports
from feedlake.sources import tables
from feedlake.testbed import feeds
from feedlake.testbed.queries import all_queries

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@contextmanager
def conf(spark, **settings):
    old = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan as run, after adaptive execution has changed it."""
    df.collect()
    text = plan(df)
    assert "isFinalPlan=true" in text
    return text


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(all_queries()[name](spark, sf_dir))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert word not in text, word


def shuffles(text):
    """What is shuffled by what: the keys of each hash exchange, sorted."""
    found = []
    for keys, origin in re.findall(r"Exchange hashpartitioning\((.*), \d+\), (\w+),", text):
        plain = re.sub(r"#\d+L?", "", keys)
        found.append(plain + (" REPARTITION" if origin.startswith("REPARTITION") else ""))
    return sorted(found)


def hot_properties(spark, n=30_000):
    """Reviews of which a third are for property 7; some properties have none, some no id."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 300)
    reviews = spark.range(0, n, 1, 16).select(
        key.alias("source_id_r"),
        F.col("id").alias("review_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    properties = spark.range(0, 350, 1, 4).select(
        F.when(F.col("id") < 345, F.col("id")).alias("source_id"),
        F.concat(F.lit("p"), "id").alias("name"),
    )
    return properties, reviews


def joins_split(df):
    """For each join of the plan as run: whether adaptive execution split a hot key."""
    lines = [line for line in final_plan(df).split("== Initial Plan ==")[0].split("\n")]
    return ["skew=true" in line for line in lines if "SortMergeJoin" in line]


def test_hot_property_is_split_in_the_left_join(spark):
    properties, reviews = hot_properties(spark)
    key = F.col("source_id") == F.col("source_id_r")
    with conf(spark, **SMALL):
        plain = properties.join(reviews, key, "left")
        assert joins_split(plain) == [False]
        made = joins.properties_left_reviews(properties, reviews)
        assert joins_split(made) == [True, False]
        assert multiset(made) == multiset(plain)


@pytest.mark.parametrize("hot", [7, 999, None])
def test_hot_copies_of_a_property_are_split_in_the_left_join(spark, hot):
    """A third of the listings has one id: with reviews, without, or no id at all."""
    _, reviews = hot_properties(spark)
    properties = spark.range(0, 30_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot).cast("bigint"))
        .otherwise(F.col("id"))
        .alias("source_id"),
        F.sha2((F.col("id") % 999).cast("string"), 256).alias("name"),
    )
    few = reviews.where("review_id % 600 < 3")
    key = F.col("source_id") == F.col("source_id_r")
    with conf(spark, **SMALL):
        made = joins.properties_left_reviews(properties, few)
        # A null id matches nothing and is not shuffled at all.
        assert any(joins_split(made)) == (hot is not None)
        assert multiset(made) == multiset(properties.join(few, key, "left"))


def hot_offers(spark):
    """Details, each listed twice, and offers of which a third are for listing 7."""
    properties, reviews = hot_properties(spark)
    details = properties.where("source_id IS NOT NULL").select(
        F.col("source_id").cast("string"),
        F.col("name").alias("property_name"),
    )
    offers = reviews.select(
        F.col("source_id_r").cast("string").alias("search_id"),
        F.col("review_id").cast("double").alias("usd_price"),
        "text",
    )
    return details.unionAll(details), offers


def test_hot_offer_is_split_in_the_inner_join(spark):
    details, offers = hot_offers(spark)
    with conf(spark, **SMALL):
        listed = dedup.dedup(details, ["source_id"], for_join=True)
        made = joins.rental_matched(listed, offers)
        assert joins_split(made) == [True]
        assert made.count() == 30_000
        unmatched = joins.rental_unmatched(listed, offers)
        offered = {7 if i % 3 == 0 else i % 300 for i in range(30_000)}
        assert unmatched.count() == 345 - len(offered)


def test_hot_property_is_split_when_tables_are_joined_without_copies(spark):
    details, offers = hot_offers(spark)
    rental = details.select(
        F.col("source_id").alias("id"),
        *[F.lit(None).cast("string").alias(c) for c in V.RENTAL_COLUMNS[1:]],
    )
    reviews = offers.select(
        F.col("search_id").alias("gen_id"),
        F.col("usd_price").cast("bigint").alias("review_id"),
        *[F.col("text").alias(c) for c in V.REVIEW_FIELDS[1:]],
    )
    with conf(spark, **SMALL):
        made = joins.join_tables_deduplicated(rental, reviews)
        assert joins_split(made) == [True]
        assert made.count() == 30_000


def test_hot_id_is_split_in_the_property_base(spark):
    _, offers = hot_offers(spark)
    rental = offers.select(F.col("search_id").alias("id"), "usd_price", "text")
    reviews = rental.select(F.col("id").alias("gen_id")).where("id = '7'")
    with conf(spark, **SMALL):
        made = joins.property_base(rental, reviews, ["id", "usd_price", "text"])
        assert joins_split(made) == [True]
        assert made.count() == 10_000 + 100


def test_partial_sums_come_before_every_shuffle_of_reviews(spark, sf_dir):
    root = feeds.built_tables(spark, sf_dir)
    tables_ = builds.read_rental(spark, root), builds.read_reviews(spark, root)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for name, report in reports.ALL.items():
            if name in ("filtered_reviews", "sample_rows"):
                continue
            lines = plan(report(*tables_)).split("\n")
            scans = [i for i, line in enumerate(lines) if "FileScan" in line]
            for i in scans:
                above = [lines[j].split("+- ")[-1].split(":- ")[-1] for j in range(i, -1, -1)]
                exchange = next(j for j, line in enumerate(above) if line.startswith("Exchange"))
                assert any("Aggregate" in line for line in above[:exchange]), (name, lines[i])


def test_dedup_reduces_before_the_shuffle(spark):
    _, reviews = hot_properties(spark)
    with conf(spark, **SMALL):
        text = plan(dedup.dedup(reviews, ["source_id_r"]))
    assert text.count("Exchange") == 1
    assert "WindowGroupLimit" in text.split("Exchange")[1]


def test_reviews_are_shuffled_once_when_nothing_is_hot(spark, sf_dir):
    """One shuffle of the reviews serves dedup, nesting and join; one more is the rentals'."""
    root = feeds.built_tables(spark, sf_dir)
    with conf(spark, **SMALL):
        df = builds.final_frame(builds.read_rental(spark, root), builds.read_reviews(spark, root))
        text = plan(df)
    assert shuffles(text) == ["gen_id REPARTITION", "id"]
    assert text.count("Exchange ") == 2


def test_reviews_are_shuffled_once_when_a_property_is_hot(spark, sf_dir):
    """The join on property and part needs no further shuffle of the nested rows."""
    root = feeds.built_tables(spark, sf_dir, unique=True)
    with conf(spark, **SMALL):
        df = builds.final_frame(
            builds.read_rental(spark, root), builds.read_reviews(spark, root), limit=20
        )
        text = plan(df)
    assert shuffles(text) == [
        "gen_id, part",  # the rentals, one row per property and part
        "gen_id, part REPARTITION",  # the reviews
        "id",  # the rentals, to drop copies
    ]


def test_rows_without_an_id_are_reduced_before_they_move(spark, sf_dir):
    reviews = builds.read_reviews(spark, feeds.built_tables(spark, sf_dir))
    with conf(spark, **SMALL):
        text = plan(builds.review_documents_frame(reviews))
    # The first and the last are of rows without an id, reduced before the last already.
    assert shuffles(text) == ["gen_id", "gen_id REPARTITION", "gen_id, review_id"]
    without_id = text.split("Exchange hashpartitioning(gen_id#")[-1]
    assert "review_id" in without_id.split("\n")[0]
    assert "WindowGroupLimit" in without_id and "isnull(gen_id" in without_id


def single_reviews(df):
    return df.select(*V.RENTAL_COLUMNS, F.explode("reviews").alias("r")).select(
        *V.RENTAL_COLUMNS, "r.*"
    )


def with_copies(reviews):
    """Reviews of 7 properties, one of which has 500 copies of one review."""
    ids = [f"GEN-{i}" for i in range(3, 10)]
    few = reviews.where(F.col("gen_id").isin(ids))
    one = few.where("review_id IS NOT NULL").orderBy("review_id").limit(1)
    copies = F.explode(F.sequence(F.lit(1), F.lit(500))).alias("copy")
    return few, few.unionAll(one.select("*", copies).drop("copy"))


@pytest.mark.parametrize(("limit", "split"), [(100, False), (20, True)])
def test_copies_of_a_review_are_dropped_before_they_move(spark, sf_dir, limit, split):
    root = feeds.built_tables(spark, sf_dir)
    few, crowded = with_copies(builds.read_reviews(spark, root))
    with conf(spark, **SMALL):
        rental = builds.read_rental(spark, root)
        whole = builds.final_frame(rental, few)
        df = builds.final_frame(rental, crowded, limit=limit)
        text = plan(df)
        assert multiset(single_reviews(df)) == multiset(single_reviews(whole))
        # Copies do not make parts, reviews do.
        assert (df.count() > whole.count()) == split
        assert (df.where("part > 0").count() > 0) == split
    by = "gen_id, part, review_id" if split else "gen_id, review_id"
    assert by in shuffles(text)
    assert not any("REPARTITION" in keys for keys in shuffles(text))
    below = text.split("Exchange hashpartitioning(gen_id#")
    assert any("review_id" in t.split("\n")[0] and "WindowGroupLimit" in t for t in below)


def test_report_on_one_country_and_year_prunes_partitions(spark, sf_dir):
    root = feeds.built_tables(spark, sf_dir)
    rental, reviews = builds.read_rental(spark, root), builds.read_reviews(spark, root)
    with conf(spark, **{"spark.sql.maxMetadataStringLength": "2000"}):
        text = plan(reports.filtered_reviews(rental, reviews))
    scans = [line for line in text.split("\n") if "FileScan" in line]
    filters = [line.split("PartitionFilters: [")[1] for line in scans]
    assert any("GB" in f.split("], PushedFilters")[0] for f in filters)
    assert any("2024" in f.split("], PushedFilters")[0] for f in filters)
    for column in V.RENTAL_COLUMNS:
        if column not in ("id", "property_name", "country_code"):
            assert f"{column}#" not in text, column


def test_reports_read_only_the_columns_they_need(spark, sf_dir):
    root = feeds.built_tables(spark, sf_dir)
    rental, reviews = builds.read_rental(spark, root), builds.read_reviews(spark, root)
    text = plan(reports.reviews_per_country(rental, reviews))
    assert "review_summary#" not in text and "property_name#" not in text


def test_hot_country_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "GB")
        .otherwise(F.concat(F.lit("C"), F.col("id") % 40))
        .alias("country_code"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    with conf(spark, **SMALL):
        tables.write_table(rows, str(tmp_path / "t"), ["country_code"])
    folders = (tmp_path / "t").glob("country_code=*")
    files = {folder.name: len(list(folder.glob("*.parquet"))) for folder in folders}
    assert files["country_code=GB"] > 3
    back = tables.read_table(spark, str(tmp_path / "t"), "country_code string, text string")
    assert back.count() == 60_000


def test_rows_by_bytes_deduplicate_once(spark, monkeypatch):
    from feedlake import schemas
    from feedlake.operators import nest

    given, deal = [], nest.deal_by_bytes
    monkeypatch.setattr(nest, "deal_by_bytes", lambda df, *a: given.append(df) or deal(df, *a))
    rental = spark.createDataFrame([], schemas.RENTAL_PROPERTY)
    reviews = spark.createDataFrame([], schemas.PROPERTY_REVIEWS)
    assert builds.final_frame(rental, reviews, max_bytes=100).count() == 0
    # Dealing uses its rows several times; they come from a written table.
    assert "Window" not in given[0]._jdf.queryExecution().toString()


def test_rows_are_dressed_by_many_tasks(spark, tmp_path):
    spark.sql(
        "SELECT id AS event_id, TIMESTAMP'2024-01-02 00:00:00' AS ts, id % 7 AS user_id,"
        " 'view' AS event_type, 4.0D AS value, '{\"k\": 3}' AS props FROM range(64)"
    ).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    rows = feeds.reviews(spark, str(tmp_path))
    assert rows.count() == 64 and len(rows.inputFiles()) > 1
