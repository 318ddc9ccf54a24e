"""Results are only right when these are exactly as written.

They are data, not logic: column lists, defaults, language order, labels and patterns.
"""

# Language order of a listing's name; any other language follows in alphabetical order.
NAME_PREFERENCE = ("en-us", "en", "de", "fr", "es")

# Language order of the raw feed view, which never looks further.
RAW_VIEW_NAMES = ("en-us", "de", "fr", "es")

# Defaults for missing values.
DEFAULT_CURRENCY = "USD"
DEFAULT_USD_PRICE = 0.0
DEFAULT_STAR_RATING = 0.0
DEFAULT_REVIEW_SCORE = 0.0
DEFAULT_PUBLISHED = True

# Generated ids look like GEN-123.
ID_PREFIX = "GEN"

# Quality labels.
GOOD = "GOOD"
NEEDS_REVIEW = "NEEDS_REVIEW"

# Date format of a review.
REVIEW_DATE_FORMAT = "yyyy-MM-dd"

# Characters of a document key that cannot stand in a file name.
UNSAFE_KEY_PATTERN = r"[/\\]"

# Partition columns.
RENTAL_PARTITIONS = ("country_code",)
REVIEWS_PARTITIONS = ("country_code", "review_year")
FINAL_PARTITIONS = ("country_code",)

# Columns of the rental_property table.
RENTAL_COLUMNS = (
    "id",
    "feed_provider_id",
    "property_name",
    "property_slug",
    "country_code",
    "currency",
    "usd_price",
    "star_rating",
    "review_score",
    "commission",
    "meal_plan",
    "published",
    "data_quality_flag",
)

# Columns that describe the property in the property_reviews table.
REVIEWED_PROPERTY_COLUMNS = (
    "property_id",
    "gen_id",
    "property_name",
    "property_slug",
    "country_code",
    "currency",
    "star_rating",
    "review_score",
    "published",
    "data_quality_flag",
)

# Columns that describe one review; together with the above, the property_reviews table.
REVIEW_FIELDS = (
    "review_id",
    "review_date",
    "review_year",
    "review_individual_score",
    "review_language",
    "review_summary",
    "review_positive",
    "review_negative",
    "reviewer_name",
    "reviewer_country",
    "reviewer_travel_purpose",
    "reviewer_type",
)

# Those of them that are no text.
REVIEW_NUMBERS = ("review_id", "review_year", "review_individual_score")

# Names that review fields take inside a document, where they differ.
DOCUMENT_REVIEW_NAMES = {
    "review_individual_score": "score",
    "review_language": "language",
    "review_summary": "summary",
    "review_positive": "positive",
    "review_negative": "negative",
}

# Columns both tables have; the reviews side gets the prefix when the tables are joined.
SHARED_COLUMNS = (
    "property_name",
    "property_slug",
    "country_code",
    "currency",
    "star_rating",
    "review_score",
    "published",
    "data_quality_flag",
)
SHARED_PREFIX = "r_"

# Columns of the sample report.
SAMPLE_COLUMNS = (
    "id",
    "property_name",
    "country_code",
    "star_rating",
    "review_score",
    "review_year",
    "reviewer_name",
    "review_individual_score",
    "data_quality_flag",
)

# Maintenance.
RETENTION_DAYS = 1
RETAIN_LAST = 1
