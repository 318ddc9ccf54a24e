"""Edge rows of the operators."""

import pytest
from helpers import details_feed, multiset, review, reviews_feed, search_feed
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake import fixed_values as V
from feedlake.functions import names
from feedlake.operators import audit, dedup, extract, joins, nest, standardize
from feedlake.plans import builds


def one_column(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


@pytest.mark.parametrize(
    ("text", "ascii_slug", "word_slug"),
    [
        ("-- A -- B --", "-a-b-", "a-b"),
        (" Café  du_Nord! ", "caf-du-nord-", "caf-du-nord"),
        ("!!!", "-", ""),
        ("3 분", "3-", "3"),
        (None, None, None),
        ("", "", ""),
        ("\tTab\n", "-tab-", "tab"),
    ],
)
def test_slugs(spark, text, ascii_slug, word_slug):
    made = one_column(spark, [text]).select(
        names.slug_ascii(F.col("v")), names.slug_word(F.col("v"))
    )
    assert tuple(made.first()) == (ascii_slug, word_slug)


@pytest.mark.parametrize(
    ("given_names", "expected"),
    [
        ({"en-us": "A", "de": "B"}, "A"),
        ({"fr": "F", "en": "E"}, "E"),
        ({"en-us": None, "es": "S", "aa": "X"}, "S"),
        ({"zz": "Z", "aa": "A"}, "A"),
        ({"zz": "Z", "aa": None}, "Z"),
        ({"en-us": "", "de": "B"}, ""),
        ({"en-us": None}, None),
        ({}, None),
        (None, None),
    ],
)
def test_preferred_name(spark, given_names, expected):
    df = one_column(spark, [given_names], "map<string,string>")
    assert df.select(names.preferred_name(F.col("v"))).first()[0] == expected


def test_raw_view_looks_no_further_than_its_languages(spark):
    feed = details_feed(
        spark,
        [dict(id="1", name={"en": "E", "fr": "F"}), dict(id="2", name={"en": "E", "it": "I"})],
    )
    view = extract.raw_property_view(feed)
    assert {r["id"]: r["name"] for r in view.collect()} == {"1": "F", "2": None}


def test_document_key(spark):
    made = one_column(spark, ["a/b\\c", "GEN-1"]).select(names.document_key(F.col("v")))
    assert [r[0] for r in made.collect()] == ["a_b_c", "GEN-1"]


def details_and_offers(spark):
    details = details_feed(
        spark,
        [
            dict(id="1", name={"en": "One"}, country=None, currency="EUR", stars=3.0, score=8.0),
            dict(id="2", name={"en": "Two"}, country="GBR"),
            dict(id="3", name={"en": "Three"}, country=" gb ", currency=" "),
            dict(id="4", name={"en-us": ""}, city="Rovinj", country="hr", stars=1.0, score=1.0),
            dict(id="x7", name={"en": "Odd"}, country="gb"),
            dict(id="", name={"en": "Blank id"}, country="gb"),
            dict(id=None, name={"en": "No id"}, country="gb"),
            dict(id="9", name={"en": "Lonely"}, country="gb"),
        ],
    )
    search = search_feed(
        spark,
        [
            dict(id="1", book=10.0, meals=["breakfast"]),
            dict(id="2", book=None, meals=[]),
            dict(id="3", book=5.0, products=[]),
            dict(id="3", book=6.0, products=None),
            dict(id="4", book=7.0, meals=["a", "b"]),
            dict(id="x7", book=1.0),
            dict(id=None, book=1.0),
        ],
    )
    return details, search


def test_rental_rows(spark):
    rows, unmatched = builds.rental_frames(*details_and_offers(spark))
    assert rows.columns == list(V.RENTAL_COLUMNS)
    made = [r.asDict() for r in rows.orderBy("id", "usd_price").collect()]
    assert [r["id"] for r in made] == ["GEN-1", "GEN-2", "GEN-3", "GEN-3", "GEN-4", "GEN-x7"]
    one, two, three, again, four, odd = made
    assert (one["country_code"], one["data_quality_flag"]) == (None, "GOOD")
    assert (one["meal_plan"], one["usd_price"], one["published"]) == ("[breakfast]", 10.0, True)
    assert (two["country_code"], two["data_quality_flag"]) == ("GBR", "NEEDS_REVIEW")
    assert (two["usd_price"], two["meal_plan"], two["currency"]) == (0.0, "[]", "USD")
    assert (three["country_code"], three["currency"]) == ("GB", " ")
    assert (three["meal_plan"], three["usd_price"], again["usd_price"]) == (None, 5.0, 6.0)
    assert (four["property_name"], four["property_slug"]) == ("", "")
    assert four["meal_plan"] == "[a, b]"
    assert (odd["star_rating"], odd["review_score"]) == (0.0, 0.0)
    assert [r.source_id for r in unmatched.collect()] == ["9"]


def test_rental_rows_with_one_offer_each(spark):
    rows, _ = builds.rental_frames(*details_and_offers(spark), dedup_search=True)
    assert [r.usd_price for r in rows.where("id = 'GEN-3'").collect()] == [5.0]


def test_reviews_rows_with_one_listing_each(spark):
    details, _ = details_and_offers(spark)
    reviews = reviews_of_all_kinds(spark)
    once = builds.reviews_frame(details, reviews).where("property_id IS NOT NULL")
    twice = builds.reviews_frame(details.unionAll(details), reviews, dedup_properties=True)
    assert multiset(twice.where("property_id IS NOT NULL")) == multiset(once)
    assert twice.where("property_id IS NULL").count() == 4


def reviews_of_all_kinds(spark):
    return reviews_feed(
        spark,
        [
            (
                "1",
                [review(11, "2024-05-01", 9.0), review(12, "2024-13-01"), review(13, "2024-6-1")],
            ),
            ("1", [review(11, "2023-05-01", 7.0)]),
            ("2", []),
            ("3", None),
            ("77", [review(99, "2024-01-01")]),
            ("x7", [review(98, "2024-01-01")]),
        ],
    )


def test_property_reviews(spark):
    details, _ = details_and_offers(spark)
    rows = builds.reviews_frame(details, reviews_of_all_kinds(spark))
    assert rows.columns == [*V.REVIEWED_PROPERTY_COLUMNS, *V.REVIEW_FIELDS]
    made = rows.orderBy("property_id", "review_id", "review_date").collect()
    found = [(r.property_id, r.gen_id, r.review_id, r.review_year) for r in made]
    assert found == [
        (None, None, None, None),
        (None, None, None, None),
        (1, "GEN-1", 11, 2023),
        (1, "GEN-1", 11, 2024),
        (1, "GEN-1", 12, None),
        (1, "GEN-1", 13, None),
        (2, "GEN-2", None, None),
        (3, "GEN-3", None, None),
        (4, "GEN-4", None, None),
        (9, "GEN-9", None, None),
    ]
    by_id = {r.property_id: r for r in made}
    assert (by_id[1].country_code, by_id[1].data_quality_flag) == (None, "NEEDS_REVIEW")
    assert by_id[2].data_quality_flag == "NEEDS_REVIEW"
    assert (by_id[3].country_code, by_id[3].currency) == (" GB ", "USD")
    assert (by_id[4].property_name, by_id[4].data_quality_flag) == ("Rovinj", "GOOD")


def test_left_join_equals_plain_left_join(spark):
    details, _ = details_and_offers(spark)
    properties = extract.flatten_properties(details.unionAll(details))
    reviews = extract.explode_reviews(reviews_of_all_kinds(spark))
    plain = properties.join(reviews, F.col("source_id") == F.col("source_id_r"), "left")
    made = joins.properties_left_reviews(properties, reviews)
    assert made.columns == plain.columns
    expected = multiset(plain)
    assert multiset(made) == expected
    keys = extract.review_keys(reviews_of_all_kinds(spark))
    assert multiset(joins.properties_left_reviews(properties, reviews, keys)) == expected


def test_dedup_takes_the_smallest_row_and_groups_nulls(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "q"), (None, None, "r")],
        "k string, n int, s string",
    )
    smallest = multiset(dedup.dedup(df, ["k"]), "k", "n", "s")
    assert smallest == {("a", 1, "y"): 1, (None, None, "r"): 1}
    by_text = dedup.dedup(df, ["k"], order=["s"])
    assert by_text.columns == ["k", "n", "s"]
    assert multiset(by_text, "k", "n", "s") == {("a", 2, "x"): 1, (None, 5, "q"): 1}
    assert dedup.dedup(df, ["k", "n", "s"]).count() == 5


def test_joined_dedup_equals_dedup_of_the_join(spark):
    details, search = details_and_offers(spark)
    rental, _ = builds.rental_frames(details, search)
    reviews = builds.reviews_frame(details.unionAll(details), reviews_of_all_kinds(spark))
    joined = joins.join_tables(rental, reviews)
    long_way = dedup.dedup(
        joined, ["id", "review_id"], order=[*V.RENTAL_COLUMNS, *V.REVIEW_FIELDS]
    )
    made = joins.join_tables_deduplicated(rental, reviews)
    assert made.columns == long_way.columns
    assert multiset(made) == multiset(long_way)


def test_enriched_null_id(spark):
    df = spark.createDataFrame(
        [(None, "n", "gb", None, None, None)],
        "source_id bigint, property_name string, raw_country string, raw_currency string, "
        "star_rating_raw double, review_score_raw double",
    )
    row = standardize.enrich_reviews(df).first()
    assert (row.gen_id, row.feed_provider_id, row.country_code) == (None, None, "GB")


def test_raw_reviews_view_drops_empty_records(spark):
    view = extract.raw_reviews_view(reviews_of_all_kinds(spark))
    assert sorted(r.review_id for r in view.collect()) == [11, 11, 12, 13, 98, 99]


def test_raw_search_view_counts_products(spark):
    _, search = details_and_offers(spark)
    counts = [r.products_count for r in extract.raw_search_view(search).collect()]
    assert counts == [1, 1, 0, None, 1, 1, 1]


def nested_input(spark, sizes):
    rows = [(g, i, f"t{i}") for g, n in sizes.items() for i in range(n)] + [("none", None, "x")]
    return spark.createDataFrame(rows, "g string, id bigint, text string")


def test_nest_sorts_and_keeps_empty_groups(spark):
    df = nested_input(spark, {"a": 30, "b": 1})
    nested = nest.nest(df, ["g"], fields=["id", "text"], present="id")
    made = {r.g: [x.id for x in r.reviews] for r in nested.collect()}
    assert made == {"a": list(range(30)), "b": [0], "none": []}


@pytest.mark.parametrize("broadcast_keys", [50, 0])
def test_hot_groups_are_split_whole(spark, broadcast_keys):
    df = nested_input(spark, {"hot": 1000, "warm": 100, "cold": 3})
    hot = nest.hot_groups(df, "g", limit=100, broadcast_keys=broadcast_keys)
    assert {tuple(r) for r in hot.collect()} == {("hot", 10)}
    rows = nest.deal(df, "g", "id", hot)
    nested = nest.nest(rows, ["g", "part"], fields=["id", "text"], present="id").collect()
    parts = {}
    for row in nested:
        parts.setdefault(row.g, []).append([x.id for x in row.reviews])
    assert {g: len(p) for g, p in parts.items()} == {"hot": 10, "warm": 1, "cold": 1, "none": 1}
    assert sorted(i for part in parts["hot"] for i in part) == list(range(1000))
    assert max(map(len, parts["hot"])) < 200
    assert all(part == sorted(part) for part in parts["hot"])


def test_no_hot_group_means_no_parts(spark):
    df = nested_input(spark, {"a": 100})
    assert nest.hot_groups(df, "g", limit=100) is None
    assert nest.has_more(df, ["g"], 99) and not nest.has_more(df, ["g"], 100)


def test_rows_are_repeated_for_the_parts(spark):
    hot = nest.hot_groups(nested_input(spark, {"hot": 25, "cold": 3}), "g", limit=10)
    df = spark.createDataFrame([("hot", 1), ("cold", 2), (None, 3)], "g string, n int")
    made = multiset(nest.repeat(df, "g", hot), "g", "n", "part")
    expected = [("hot", 1, 0), ("hot", 1, 1), ("hot", 1, 2), ("cold", 2, 0), (None, 3, 0)]
    assert made == dict.fromkeys(expected, 1)


def test_final_frame_in_parts_is_whole(spark, sf_dir):
    from feedlake.testbed.queries import _tables

    rental, reviews = _tables(spark, sf_dir)
    whole = builds.final_frame(rental, reviews)
    split = builds.final_frame(rental, reviews, limit=10)
    assert split.where("part > 0").count() > 0

    def exploded(df):
        return df.select(*V.RENTAL_COLUMNS, F.explode_outer("reviews").alias("r")).select(
            *V.RENTAL_COLUMNS, "r.*"
        )

    reviewed = F.col("review_id").isNotNull()
    assert multiset(exploded(whole).where(reviewed)) == multiset(exploded(split).where(reviewed))
    assert split.select("id").distinct().count() == whole.count()


def test_audit_counts(spark):
    details, search = details_and_offers(spark)
    row = audit.audit_counts(
        extract.extract_details(details.unionAll(details)), extract.extract_search(search)
    ).first()
    assert row.asDict() == {
        "details_rows": 16,
        "dropped_missing_key": 4,
        "removed_duplicates": 6,
        "matched_rows": 6,
        "unmatched_rows": 1,
        "defaulted_prices": 1,
    }


texts = st.text(alphabet="aB9 -_é!\t\n分\u2028\u212a😀", max_size=20)


@settings(max_examples=10, deadline=None)
@given(st.lists(texts, min_size=50, max_size=100))
def test_slugs_equal_their_plain_rules(spark, values):
    """The rules as one would say them, character class by character class."""
    text = F.col("v")
    plain = F.lower(F.regexp_replace(F.trim(text), "[^a-zA-Z0-9]+", "-"))
    df = one_column(spark, values)
    assert df.where(names.slug_ascii(text) != plain).count() == 0
    plain = F.trim(F.lower(text))
    for pattern, by in ((r"[^\w\s-]", ""), (r"[\s_]+", "-"), ("-{2,}", "-"), ("^-|-$", "")):
        plain = F.regexp_replace(plain, pattern, by)
    assert df.where(names.slug_word(text) != plain).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(texts, min_size=20, max_size=60))
def test_ascii_slug_is_stable(spark, values):
    slug = names.slug_ascii(F.col("v"))
    df = one_column(spark, values).select(slug.alias("v")).withColumn("again", slug)
    assert df.where("v <> again").count() == 0


groups = st.lists(
    st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 5))), max_size=30
)


@settings(max_examples=5, deadline=None)
@given(groups)
def test_nest_after_dedup_is_undone_by_explode(spark, rows):
    df = spark.createDataFrame(rows, "g string, id bigint").distinct()
    nested = nest.nest(df, ["g"], fields=["id"], present="id")
    back = nested.select("g", F.explode_outer("reviews").alias("r")).select("g", "r.id")
    expected = set(rows)
    has_reviews = {g for g, i in expected if i is not None}
    expected -= {(g, None) for g in has_reviews}
    assert {tuple(r) for r in back.collect()} == expected


rental_rows = st.lists(
    st.tuples(st.sampled_from(["GEN-0", "GEN-1", "GEN-2"]), st.sampled_from([1.0, 2.0, None])),
    max_size=8,
)
review_rows = st.lists(
    st.tuples(
        st.sampled_from([None, "GEN-0", "GEN-1", "GEN-9"]),
        st.one_of(st.none(), st.integers(0, 6)),
        st.sampled_from([1.0, 2.0, None]),
    ),
    max_size=40,
)


def filled(df, columns):
    """`df` with the columns it lacks as nulls, in order."""
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    )


@settings(max_examples=12, deadline=None)
@given(rental_rows, review_rows, st.sampled_from([2, 100]))
def test_final_frame_equals_the_long_way(spark, rentals, written, limit):
    """Join, drop copies, group by all property columns; parts put together again."""
    rental = filled(spark.createDataFrame(rentals, "id string, usd_price double"), V.RENTAL_COLUMNS)
    reviews = filled(
        spark.createDataFrame(
            written, "gen_id string, review_id bigint, review_individual_score double"
        ),
        [*V.REVIEWED_PROPERTY_COLUMNS, *V.REVIEW_FIELDS],
    )
    joined = joins.join_tables(rental, reviews)
    unique = dedup.dedup(
        joined, ["id", "review_id"], order=[*V.RENTAL_COLUMNS, *V.REVIEW_FIELDS]
    )
    expected = {r.id: r for r in nest.nest(unique, V.RENTAL_COLUMNS).collect()}
    made = {}
    for row in builds.final_frame(rental, reviews, limit=limit).collect():
        one = made.setdefault(row.id, {"usd_price": row.usd_price, "reviews": []})
        assert one["usd_price"] == row.usd_price
        one["reviews"] += row.reviews
    assert set(made) == set(expected)
    for key, one in made.items():
        assert one["usd_price"] == expected[key].usd_price
        assert sorted(one["reviews"], key=lambda r: r.review_id) == expected[key].reviews
