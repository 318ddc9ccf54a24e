"""Read schemas as DDL. Feeds and tables are always read with one of these, never inferred.

Numbers of the feeds that are cast later are read as text: feeds quote some of them, and a
reader that expects a number makes null of those.
"""

DETAILS_FEED = """
    id string,
    name map<string,string>,
    location struct<country:string,city:string>,
    currency string,
    rating struct<stars:string,review_score:string>,
    accommodation_type string,
    number_of_rooms string,
    is_genius string,
    is_work_friendly string,
    url string
"""

SEARCH_FEED = """
    id string,
    currency string,
    price struct<book:string>,
    commission struct<percentage:string>,
    products array<struct<policies:struct<meal_plan:struct<meals:array<string>>>>>,
    deep_link_url string,
    url string
"""

REVIEWS_FEED = """
    id string,
    reviews array<struct<
        id:string, date:string, score:string, language:string,
        summary:string, positive:string, negative:string,
        reviewer:struct<name:string,country:string,travel_purpose:string,type:string>>>
"""

RENTAL_PROPERTY = """
    id string,
    feed_provider_id string,
    property_name string,
    property_slug string,
    country_code string,
    currency string,
    usd_price double,
    star_rating double,
    review_score double,
    commission double,
    meal_plan string,
    published boolean,
    data_quality_flag string
"""

_REVIEWED_PROPERTY = """
    property_id bigint,
    gen_id string,
    property_name string,
    property_slug string,
    country_code string,
    currency string,
    star_rating double,
    review_score double,
    published boolean,
    data_quality_flag string
"""

PROPERTY_REVIEWS = _REVIEWED_PROPERTY + """,
    review_id bigint,
    review_date string,
    review_year int,
    review_individual_score double,
    review_language string,
    review_summary string,
    review_positive string,
    review_negative string,
    reviewer_name string,
    reviewer_country string,
    reviewer_travel_purpose string,
    reviewer_type string
"""

_NESTED_REVIEWS = """
    reviews array<struct<
        review_id:bigint, review_date:string, review_year:int,
        review_individual_score:double, review_language:string, review_summary:string,
        review_positive:string, review_negative:string, reviewer_name:string,
        reviewer_country:string, reviewer_travel_purpose:string, reviewer_type:string>>
"""

# `part` is 0 and `parts` 1 but for properties whose reviews are too many for one row
# (operators.nest); total_reviews is of the whole property.
RENTALS_REVIEWS = (
    RENTAL_PROPERTY
    + ","
    + _NESTED_REVIEWS
    + ", total_reviews int, part int, parts int, created_time timestamp"
)

_DOCUMENT_REVIEWS = """
    total_reviews int,
    part int,
    parts int,
    reviews array<struct<
        review_id:bigint, review_date:string, review_year:int, score:double,
        language:string, summary:string, positive:string, negative:string,
        reviewer_name:string, reviewer_country:string, reviewer_travel_purpose:string,
        reviewer_type:string>>
"""

FINAL_DOCUMENT = RENTAL_PROPERTY + "," + _DOCUMENT_REVIEWS
REVIEW_DOCUMENT = _REVIEWED_PROPERTY + "," + _DOCUMENT_REVIEWS
