"""The 13 reports.

Each answers a question about the combined view (every rental_property row paired with
every property_reviews row of the same id) but takes the two tables. Reviews are summed up per
property and equal rental rows are counted before the join, both in part before any
shuffle. So the join meets about one row per property and side, however many reviews or
offers the property has, and the counts make each row weigh what it does in the view.

Ties in a top-k report are broken by id.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import fixed_values as V
from feedlake.operators.dedup import first_rows
from feedlake.operators.joins import combined_view, property_base
from feedlake.workspace import kept

TOP = 10


def _rounded_mean(total: Column, count: Column, digits: int = 2) -> Column:
    """Null where there is nothing to average."""
    return F.round(F.try_divide(total, count), digits)


def _summed_reviews(reviews: DataFrame, *split_by: str) -> DataFrame:
    """Per property (and `split_by`): rows, reviews, and sum and count of their scores."""
    score = F.col("review_individual_score")
    return reviews.groupBy("gen_id", *split_by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("review_id").alias("reviews"),
        F.sum(score).alias("score_sum"),
        F.count(score).alias("score_count"),
    )


def _times_listed(rental: DataFrame, *columns: str) -> DataFrame:
    """Per id (and `columns`), the number of rental rows: how often the view repeats each
    of the property's reviews."""
    return rental.groupBy("id", *columns).agg(F.count(F.lit(1)).alias("times"))


def _weighted(listed: DataFrame, summed: DataFrame) -> DataFrame:
    """The two joined on id, with the sums weighing what they do in the view."""
    sums = ("rows", "reviews", "score_sum", "score_count")
    return listed.join(summed, F.col("id") == F.col("gen_id"), "inner").withColumns(
        {name: F.col(name) * F.col("times") for name in sums}
    )


def _mean_score() -> Column:
    return _rounded_mean(F.sum("score_sum"), F.sum("score_count"))


def _mean_stars() -> Column:
    """Mean star rating over the rows of the view, so weighted by rows per property."""
    stars, rows = F.col("star_rating"), F.col("rows")
    return _rounded_mean(F.sum(stars * rows), F.sum(F.when(stars.isNotNull(), rows)))


def sample_rows(rental: DataFrame, reviews: DataFrame, count: int = TOP) -> DataFrame:
    """The first rows of the view by id, review and then all columns.

    They belong to the first `count` ids, and within an id to its first `count` rows on
    either side, so no more than those are paired.
    """
    first_ids = property_base(rental, reviews, ["id"]).orderBy("id").limit(count)
    few = F.broadcast(first_ids.withColumnRenamed("id", "_first"))  # `count` rows at most
    listed = rental.join(few, F.col("id") == F.col("_first"), "left_semi")
    written = reviews.select("gen_id", "property_id", *V.REVIEW_FIELDS).join(
        few, F.col("gen_id") == F.col("_first"), "left_semi"
    )
    view = combined_view(
        first_rows(listed, ["id"], count, order=V.RENTAL_COLUMNS),
        first_rows(written, ["gen_id"], count, order=["review_id"]),
    )
    order = ("id", "review_id", *V.RENTAL_COLUMNS[1:], "property_id", *V.REVIEW_FIELDS[1:])
    return view.orderBy(*order).limit(count).select(*V.SAMPLE_COLUMNS)


def reviews_per_country(rental: DataFrame, reviews: DataFrame) -> DataFrame:
    joined = _weighted(
        _times_listed(rental, "country_code", "star_rating"), _summed_reviews(reviews)
    )
    return (
        joined.groupBy("country_code")
        .agg(
            F.count_distinct("id").alias("properties"),
            F.sum("reviews").alias("total_reviews"),
            _mean_score().alias("avg_review_score"),
            _mean_stars().alias("avg_stars"),
        )
        .orderBy(F.desc("total_reviews"), "country_code")
    )


def reviews_by_year(rental: DataFrame, reviews: DataFrame) -> DataFrame:
    dated = reviews.where(F.col("review_year").isNotNull())
    joined = _weighted(
        _times_listed(rental, "country_code"), _summed_reviews(dated, "review_year")
    )
    return (
        joined.groupBy("review_year")
        .agg(
            F.sum("rows").alias("total_review_rows"),
            _mean_score().alias("avg_score"),
            F.count_distinct("country_code").alias("countries_active"),
        )
        .orderBy("review_year")
    )


def top_properties(rental: DataFrame, reviews: DataFrame, count: int = TOP) -> DataFrame:
    """Best mean score among properties with at least two reviews in the view."""
    per_property = _summed_reviews(reviews.where(F.col("review_id").isNotNull()))
    listed = rental.groupBy("id").agg(
        F.min("property_name").alias("name"),
        F.min("country_code").alias("country"),
        F.min("star_rating").alias("stars"),
        F.count(F.lit(1)).alias("times"),
    )
    return (
        _weighted(listed, per_property)
        .select(
            "id",
            "name",
            "country",
            "stars",
            _rounded_mean(F.col("score_sum"), F.col("score_count")).alias("avg_score"),
            F.col("reviews").alias("num_reviews"),
        )
        .where(F.col("num_reviews") >= 2)
        .orderBy(F.desc("avg_score"), "id")
        .limit(count)
    )


def quality_distribution(rental: DataFrame, reviews: DataFrame) -> DataFrame:
    joined = _weighted(_times_listed(rental, "data_quality_flag"), _summed_reviews(reviews))
    return joined.groupBy("data_quality_flag").agg(
        F.count_distinct("id").alias("properties"), F.sum("rows").alias("rows")
    )


def pricing_by_country(rental: DataFrame, reviews: DataFrame) -> DataFrame:
    base = property_base(
        rental,
        reviews,
        (
            "id",
            "property_name",
            "country_code",
            "currency",
            "usd_price",
            "commission",
            "meal_plan",
            "published",
        ),
    )
    price = F.col("usd_price")
    return (
        base.groupBy("country_code", "currency")
        .agg(
            F.count(F.lit(1)).alias("properties"),
            F.round(F.avg(price), 2).alias("avg_usd_price"),
            F.round(F.min(price), 2).alias("min_usd_price"),
            F.round(F.max(price), 2).alias("max_usd_price"),
        )
        .orderBy(F.desc("properties"), "country_code", "currency")
    )


def pricing_by_meal(rental: DataFrame, reviews: DataFrame) -> DataFrame:
    base = property_base(
        rental, reviews, ("id", "usd_price", "commission", "meal_plan", "published")
    )
    return (
        base.groupBy("meal_plan")
        .agg(
            F.count(F.lit(1)).alias("properties"),
            F.round(F.avg("usd_price"), 2).alias("avg_usd_price"),
            F.round(F.avg("commission"), 4).alias("avg_commission"),
            F.count_if(F.col("commission").isNull()).alias("missing_commission"),
        )
        .orderBy(F.desc("properties"), "meal_plan")
    )


def most_expensive(rental: DataFrame, reviews: DataFrame, count: int = TOP) -> DataFrame:
    columns = ("id", "property_name", "usd_price", "commission", "published")
    base = property_base(rental, reviews, columns)
    return base.orderBy(F.desc("usd_price"), *columns).limit(count)


def by_purpose(rental: DataFrame, reviews: DataFrame) -> DataFrame:
    stated = reviews.where(F.col("reviewer_travel_purpose").isNotNull())
    joined = _weighted(
        _times_listed(rental), _summed_reviews(stated, "reviewer_travel_purpose")
    )
    return (
        joined.groupBy("reviewer_travel_purpose")
        .agg(F.sum("rows").alias("reviews"), _mean_score().alias("avg_score"))
        .orderBy(F.desc("reviews"), "reviewer_travel_purpose")
    )


def join_coverage(rental: DataFrame, reviews: DataFrame) -> DataFrame:
    """Ids are counted after reduction to one row each, so no distinct count is needed."""
    joined = _weighted(_times_listed(rental), _summed_reviews(reviews))
    count = F.col("reviews")
    return joined.agg(
        F.count("id").alias("properties_total"),
        F.count_if(count > 0).alias("properties_with_reviews"),
        F.count_if(F.col("rows") > count).alias("properties_without_reviews"),
        F.coalesce(F.sum(count), F.lit(0)).alias("total_reviews"),
    )


def review_density(rental: DataFrame, reviews: DataFrame, count: int = TOP) -> DataFrame:
    joined = _weighted(_times_listed(rental), _summed_reviews(reviews))
    return (
        joined.select("id", F.col("reviews").alias("reviews_per_property"))
        .orderBy(F.desc("reviews_per_property"), "id")
        .limit(count)
    )


def filtered_reviews(
    rental: DataFrame, reviews: DataFrame, country: str = "GB", year: int = 2024
) -> DataFrame:
    """Reviews of one country and year, best first. Both filters prune partitions."""
    listed = rental.where(F.col("country_code") == country).select("id", "property_name")
    dated = reviews.where(F.col("review_year") == year).select("gen_id", *V.REVIEW_FIELDS)
    chosen = listed.join(dated, F.col("id") == F.col("gen_id"), "inner")
    columns = (
        "property_name",
        "reviewer_name",
        "review_date",
        "review_individual_score",
        "review_summary",
    )
    # Equal scores are common; the further columns keep them from meeting in one task.
    return chosen.orderBy(F.desc("review_individual_score"), "id", "review_id").select(*columns)


def by_type(rental: DataFrame, reviews: DataFrame) -> DataFrame:
    stated = reviews.where(F.col("reviewer_type").isNotNull())
    joined = _weighted(
        _times_listed(rental, "star_rating"), _summed_reviews(stated, "reviewer_type")
    )
    return (
        joined.groupBy("reviewer_type")
        .agg(
            _mean_stars().alias("avg_stars"),
            _mean_score().alias("avg_review_score"),
            F.sum("rows").alias("total_reviews"),
        )
        .orderBy(F.desc("avg_review_score"), "reviewer_type")
    )


#: The reports that `report_cube` holds: the column each is by, what it counts, and which of
#: its columns it has besides.
CUBE = {
    "reviews_per_country": ("country_code", "reviews", ("properties", "avg_score", "avg_stars")),
    "reviews_by_year": ("review_year", "rows", ("avg_score", "countries")),
    "quality_distribution": ("data_quality_flag", "rows", ("properties",)),
    "by_purpose": ("reviewer_travel_purpose", "rows", ("avg_score",)),
    "by_type": ("reviewer_type", "rows", ("avg_score", "avg_stars")),
}


def report_cube(rental: DataFrame, reviews: DataFrame) -> DataFrame:
    """Five reports from one pass over each table: report, key (as text), total (rows or reviews),
    properties, avg_score, avg_stars and countries, null where a report does not have them.

    Both tables are summed up by all columns that any report is by, then joined, and the result
    is grouped by each of them at once. Distinct properties are counted exactly by bitmaps,
    which unlike distinct counts are merged from partial ones: properties are numbered, and a
    bitmap holds 32,768 of them, so no group is one task's. Countries are few. Of the reports
    by year, purpose and type, reviews without any are left out, as there.
    """
    by_review = ("review_year", "reviewer_travel_purpose", "reviewer_type")
    listed = kept(_times_listed(rental, "country_code", "star_rating", "data_quality_flag"), "listed")
    numbers = listed.select("id").distinct().withColumn("number", F.monotonically_increasing_id())
    numbers = kept(numbers, "numbers").withColumnRenamed("id", "numbered")
    joined = _weighted(listed, _summed_reviews(reviews, *by_review))
    joined = joined.join(numbers, F.col("id") == F.col("numbered")).withColumn(
        "part", F.bitmap_bucket_number("number")
    )
    stars, rows = F.col("star_rating"), F.col("rows")
    keys = [key for key, _, _ in CUBE.values()]
    counted = [key for key, _, has in CUBE.values() if "properties" in has]
    sets = [["part", key] if key in counted else [key] for key in keys]
    grouped = joined.groupingSets(sets, "part", *keys).agg(
        *[F.sum(name).alias(name) for name in ("rows", "reviews", "score_sum", "score_count")],
        F.sum(stars * rows).alias("stars_sum"),
        F.sum(F.when(stars.isNotNull(), rows)).alias("stars_count"),
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("numbers"),
        F.collect_set("country_code").alias("codes"),
        *[F.grouping(key).alias(f"not_{key}") for key in keys],
    )
    report, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (column, _, _) in CUBE.items():
        its_own = F.col(f"not_{column}") == 0
        report = F.when(its_own, name).otherwise(report)
        key = F.when(its_own, F.col(column).cast("string")).otherwise(key)
    named = grouped.withColumns({"report": report, "key": key})
    named = named.where(F.col("key").isNotNull() | ~F.col("report").isin(*[
        name for name, (column, _, _) in CUBE.items() if column in by_review
    ]))
    merged = named.groupBy("report", "key").agg(
        F.sum("rows").alias("rows"),
        F.sum("reviews").alias("reviews"),
        F.sum(F.bitmap_count("numbers")).alias("properties"),
        _mean_score().alias("avg_score"),
        _rounded_mean(F.sum("stars_sum"), F.sum("stars_count")).alias("avg_stars"),
        # A report with countries has one row a key before this.
        F.max(F.size("codes")).cast("long").alias("countries"),
    )

    def having(column: str) -> Column:
        reports = [name for name, (_, _, has) in CUBE.items() if column in has]
        return F.when(F.col("report").isin(*reports), F.col(column)).alias(column)

    in_reviews = [name for name, (_, counts, _) in CUBE.items() if counts == "reviews"]
    total = F.when(F.col("report").isin(*in_reviews), F.col("reviews")).otherwise(F.col("rows"))
    shown = [having(name) for name in ("properties", "avg_score", "avg_stars", "countries")]
    return merged.select("report", "key", total.alias("total"), *shown)


ALL = {
    report.__name__: report
    for report in (
        sample_rows,
        reviews_per_country,
        reviews_by_year,
        top_properties,
        quality_distribution,
        pricing_by_country,
        pricing_by_meal,
        most_expensive,
        by_purpose,
        join_coverage,
        review_density,
        filtered_reviews,
        by_type,
    )
}
