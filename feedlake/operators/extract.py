"""Nested feed rows to flat rows.

Casts from feed text are try_casts: a bad value becomes null, it does not end the job.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import fixed_values as V
from feedlake.functions.names import is_blank, preferred_name


def whole_number(text) -> Column:
    """A number as bigint, its fraction cut off; null if `text` is no number of that range."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,6)").try_cast("bigint"))


def extract_details(details: DataFrame) -> DataFrame:
    """Details feed for the rental table; the key stays text."""
    return details.select(
        F.col("id").try_cast("string").alias("source_id"),
        preferred_name(F.col("name")).alias("property_name"),
        F.trim(F.upper("location.country")).alias("country_code"),
        "currency",
        F.col("rating.stars").try_cast("double").alias("star_rating"),
        F.col("rating.review_score").try_cast("double").alias("review_score"),
    )


def extract_search(search: DataFrame) -> DataFrame:
    """Search feed: price, commission and the meals of the first product as text."""
    first_product = F.get("products", F.lit(0))
    return search.select(
        F.col("id").try_cast("string").alias("search_id"),
        F.col("price.book").try_cast("double").alias("usd_price"),
        F.col("commission.percentage").try_cast("double").alias("commission_pct"),
        first_product["policies"]["meal_plan"]["meals"].cast("string").alias("meal_plan"),
        "deep_link_url",
        F.col("currency").alias("search_currency"),
    )


def clean_missing_key(df: DataFrame, key: str = "source_id") -> DataFrame:
    """Drop rows whose key is null or empty; a key of spaces is kept."""
    return df.where(F.col(key).isNotNull() & (F.col(key) != ""))


def flatten_properties(details: DataFrame) -> DataFrame:
    """Details feed for the reviews table; the key is a number, null if it is not one."""
    flat = details.where(F.col("id").isNotNull()).select(
        F.col("id").try_cast("bigint").alias("source_id"),
        preferred_name(F.col("name")).alias("raw_name"),
        F.col("location.city").alias("raw_city"),
        F.col("currency").alias("raw_currency"),
        F.col("location.country").alias("raw_country"),
        F.col("rating.stars").try_cast("double").alias("star_rating_raw"),
        F.col("rating.review_score").try_cast("double").alias("review_score_raw"),
    )
    name, city = F.col("raw_name"), F.col("raw_city")
    return flat.withColumn(
        "property_name", F.trim(F.when(is_blank(name), city).otherwise(name))
    )


def explode_reviews(reviews: DataFrame) -> DataFrame:
    """One row per review; a record with no reviews gives one row of nulls."""
    exploded = reviews.select("id", F.explode_outer("reviews").alias("review"))
    return exploded.select(
        F.col("id").try_cast("bigint").alias("source_id_r"),
        whole_number(F.col("review.id")).alias("review_id"),
        F.col("review.date").alias("review_date"),
        F.col("review.score").try_cast("double").alias("review_individual_score"),
        *[
            F.col(f"review.{name}").alias(f"review_{name}")
            for name in ("language", "summary", "positive", "negative")
        ],
        *[
            F.col(f"review.reviewer.{name}").alias(f"reviewer_{name}")
            for name in ("name", "country", "travel_purpose", "type")
        ],
    )


def review_keys(reviews: DataFrame) -> DataFrame:
    """The source_id_r of `explode_reviews`, once per record, reading nothing else."""
    return reviews.select(F.col("id").try_cast("bigint").alias("source_id_r"))


def raw_property_view(details: DataFrame) -> DataFrame:
    """The details feed as a table, values as they came."""
    return details.select(
        "id",
        preferred_name(F.col("name"), V.RAW_VIEW_NAMES, others=False).alias("name"),
        F.col("location.country").alias("country"),
        F.col("location.city").alias("city_id"),
        "currency",
        F.col("rating.stars").try_cast("double").alias("stars"),
        F.col("rating.review_score").try_cast("double").alias("review_score"),
        "accommodation_type",
        whole_number(F.col("number_of_rooms")).alias("number_of_rooms"),
        F.col("is_genius").try_cast("boolean").alias("is_genius"),
        F.col("is_work_friendly").try_cast("boolean").alias("is_work_friendly"),
        "url",
    )


def raw_reviews_view(reviews: DataFrame) -> DataFrame:
    """The reviews feed as a table; records with no reviews are left out."""
    rows = reviews.select(F.col("id").alias("property_id"), F.explode("reviews").alias("review"))
    return rows.select(
        "property_id",
        whole_number(F.col("review.id")).alias("review_id"),
        F.col("review.date").alias("review_date"),
        F.col("review.score").try_cast("double").alias("review_score"),
        F.col("review.language").alias("review_language"),
        *[F.col(f"review.reviewer.{n}").alias(f"reviewer_{n}") for n in ("name", "country")],
        F.col("review.summary").alias("review_summary"),
    )


def raw_search_view(search: DataFrame) -> DataFrame:
    """The search feed as a table; products are only counted."""
    return search.select(
        "id",
        "currency",
        F.col("price.book").try_cast("double").alias("price_book"),
        F.col("commission.percentage").try_cast("double").alias("commission_pct"),
        "deep_link_url",
        "url",
        F.size("products").alias("products_count"),
    )
