"""Joined feed rows to table rows: ids, slugs, defaults, labels."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import fixed_values as V
from feedlake.functions.names import is_blank, slug_ascii, slug_word
from feedlake.functions.quality import rental_quality, reviews_quality


def _or(name: str, default) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def rental_property(matched: DataFrame) -> DataFrame:
    """The 13 columns of rental_property. Only a null currency is defaulted here."""
    made = {
        "id": F.concat_ws("-", F.lit(V.ID_PREFIX), F.col("source_id")),
        "feed_provider_id": F.col("source_id"),
        "property_slug": slug_ascii(F.col("property_name")),
        "currency": _or("currency", V.DEFAULT_CURRENCY),
        "usd_price": _or("usd_price", V.DEFAULT_USD_PRICE),
        "star_rating": _or("star_rating", V.DEFAULT_STAR_RATING),
        "review_score": _or("review_score", V.DEFAULT_REVIEW_SCORE),
        "commission": F.col("commission_pct"),
        "published": F.lit(V.DEFAULT_PUBLISHED),
        "data_quality_flag": rental_quality(F.col("property_name"), F.col("country_code")),
    }
    return matched.select(*[made.get(c, F.col(c)).alias(c) for c in V.RENTAL_COLUMNS])


def enrich_reviews(joined: DataFrame) -> DataFrame:
    """Ids, slug, upper-case country, defaults and label. A blank currency is defaulted."""
    source_id = F.col("source_id").cast("string")
    with_values = joined.withColumns(
        {
            "gen_id": F.concat(F.lit(V.ID_PREFIX + "-"), source_id),
            "feed_provider_id": source_id,
            "property_slug": slug_word(F.col("property_name")),
            "country_code": F.upper("raw_country"),
            "currency": F.when(is_blank(F.col("raw_currency")), V.DEFAULT_CURRENCY).otherwise(
                F.col("raw_currency")
            ),
            "star_rating": _or("star_rating_raw", V.DEFAULT_STAR_RATING),
            "review_score": _or("review_score_raw", V.DEFAULT_REVIEW_SCORE),
            "published": F.lit(V.DEFAULT_PUBLISHED),
        }
    )
    label = reviews_quality(
        *[F.col(c) for c in ("property_name", "country_code", "star_rating", "review_score")]
    )
    return with_values.withColumn("data_quality_flag", label)


def property_reviews(enriched: DataFrame) -> DataFrame:
    """The 22 columns of property_reviews; a date that is not one has no year."""
    made = {
        "property_id": F.col("source_id"),
        "review_year": F.year(F.try_to_date("review_date", V.REVIEW_DATE_FORMAT)),
    }
    columns = (*V.REVIEWED_PROPERTY_COLUMNS, *V.REVIEW_FIELDS)
    return enriched.select(*[made.get(c, F.col(c)).alias(c) for c in columns])


def with_created_time(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Add the load time: one value for the whole query, or `at`."""
    return df.withColumn("created_time", F.current_timestamp() if at is None else at)
