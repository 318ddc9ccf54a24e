"""The builds. Each reads feeds or tables and writes one table or one set of documents.

They hand over through written tables: a build that fails can be run again by itself, and
documents are made from the table as written, so the two always agree.
"""

from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import fixed_values as V
from feedlake import schemas
from feedlake.operators import extract, joins, nest, standardize
from feedlake.operators.audit import audit_counts, observed
from feedlake.operators.dedup import dedup
from feedlake.operators.running import BUCKET_ROWS
from feedlake.operators.skew import heavy_keys
from feedlake.sources import documents as docs
from feedlake.sources import tables
from feedlake.workspace import kept

RENTAL = "rental_property"
REVIEWS = "property_reviews"
FINAL = "rentals_reviews"
BACKUP = "final_output"
REVIEW_DOCUMENTS = "property_data"
FINAL_DOCUMENTS = "final_data"


# --- the tables as frames ------------------------------------------------------------


def rental_frames(
    details: DataFrame, search: DataFrame, dedup_search: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rental_property rows, unmatched details rows).

    Several search rows for one id give several rental rows; `dedup_search` keeps one.
    """
    keyed = extract.clean_missing_key(extract.extract_details(details))
    listed = dedup(keyed, ["source_id"], for_join=True)
    offers = extract.extract_search(search)
    if dedup_search:
        offers = dedup(offers, ["search_id"])
    matched = joins.rental_matched(listed, offers)
    return standardize.rental_property(matched), joins.rental_unmatched(listed, offers)


def reviews_frame(
    details: DataFrame, reviews: DataFrame, dedup_properties: bool = False
) -> DataFrame:
    """property_reviews rows.

    A property listed several times has its reviews once per listing; `dedup_properties`
    keeps one listing per id. Properties without a usable id are all kept.
    """
    properties = extract.flatten_properties(details)
    if dedup_properties:
        key = F.col("source_id")
        listed = dedup(properties.where(key.isNotNull()), ["source_id"], for_join=True)
        properties = listed.unionAll(properties.where(key.isNull()))
    joined = joins.properties_left_reviews(
        properties, extract.explode_reviews(reviews), extract.review_keys(reviews)
    )
    return standardize.property_reviews(standardize.enrich_reviews(joined))


def _unique_reviews(
    reviews: DataFrame, columns: list[str], order: list[str], limit: int
) -> tuple[DataFrame, list[str], DataFrame | None]:
    """One row per (gen_id, review_id), the columns that make up a nested row, and the
    properties that need more than one such row, having more than `limit` reviews.

    The rows are shuffled once, by property and part, which serves the dedup, the nesting
    and a join on the same columns. Only if that would crowd a property or part with copies
    are these dropped in a shuffle of their own, by review: there they are reduced to one
    row per task before they move.
    """
    rows, group = reviews.select(*columns), ["gen_id"]
    hot, crowded = None, False
    long = nest.hot_groups(reviews, "gen_id", limit)
    if long is not None:
        # Many rows need not be many reviews: only the latter make parts.
        listed = reviews.join(long, F.col("gen_id") == F.col("_hot"), "left_semi")
        distinct = listed.select("gen_id", "review_id").distinct()
        hot = nest.hot_groups(distinct, "gen_id", limit, member="review_id")
        if hot is not None:
            rows, group = nest.deal(rows, "gen_id", "review_id", hot), ["gen_id", "part"]
        crowded = nest.has_more(rows, group, 4 * limit)
    if not crowded:
        rows = rows.repartition(*group)
    return dedup(rows, [*group, "review_id"], order=order), group, hot


def final_frame(
    rental: DataFrame,
    reviews: DataFrame,
    limit: int = nest.ROW_LIMIT,
    max_bytes: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per property of both tables with its reviews nested, total_reviews, part, parts.

    A property with more than `limit` reviews has several rows, numbered in `part`.

    Same rows as joining the tables, dropping duplicate (id, review_id) and grouping by
    all property columns, but the reviews are nested by their key alone before the join:
    property columns are never copied onto reviews, and the join is one row to one row.

    With `max_bytes`, rows are bounded by the bytes of their reviews instead of by their number,
    and hold them in the order of their ids (operators.nest.deal_by_bytes).
    """
    if max_bytes is not None:
        return _final_by_bytes(rental, reviews, max_bytes, bucket_rows)
    unique, group, hot = _unique_reviews(
        reviews.where(F.col("gen_id").isNotNull()),
        ["gen_id", *V.REVIEW_FIELDS],
        list(V.REVIEW_FIELDS),
        limit,
    )
    nested = nest.with_totals(nest.nest(unique, group), "gen_id", hot)
    property_rows = dedup(rental, ["id"])
    if hot is None:
        joined = property_rows.join(nested, F.col("id") == F.col("gen_id"), "inner")
        joined = joined.withColumn("part", F.lit(0))
    else:
        property_rows = nest.repeat(property_rows, "id", hot).withColumnRenamed("id", "gen_id")
        joined = property_rows.join(nested, group, "inner").withColumnRenamed("gen_id", "id")
    return joined.select(*V.RENTAL_COLUMNS, "reviews", "total_reviews", "part", "parts")


def _final_by_bytes(
    rental: DataFrame, reviews: DataFrame, max_bytes: int, bucket_rows: int
) -> DataFrame:
    rows = reviews.where(F.col("gen_id").isNotNull()).select("gen_id", *V.REVIEW_FIELDS)
    # Used for the sizes of the groups, their ranges, the sums of these, and the rows.
    unique = kept(dedup(rows, ["gen_id", "review_id"], order=list(V.REVIEW_FIELDS)), "unique")
    dealt = nest.deal_by_bytes(
        unique, "gen_id", "review_id", V.REVIEW_FIELDS, max_bytes, bucket_rows
    )
    # Used for its rows and for their counts.
    nested = kept(nest.nest(dealt, ["gen_id", "part"]), "nested")
    counted = nest.with_totals_by_part(nested, "gen_id")
    joined = dedup(rental, ["id"]).join(counted, F.col("id") == F.col("gen_id"), "inner")
    return joined.select(*V.RENTAL_COLUMNS, "reviews", "total_reviews", "part", "parts")


def review_documents_frame(reviews: DataFrame, limit: int = nest.ROW_LIMIT) -> DataFrame:
    """One row per property of property_reviews, as `final_frame` makes them.

    Rows without an id make one property, as null keys compare equal. However many they
    are, they are reduced by the dedup before they move, apart from the rest.
    """
    property_columns = list(V.REVIEWED_PROPERTY_COLUMNS)
    columns = [*property_columns, *V.REVIEW_FIELDS]

    def nested(unique: DataFrame, group: list[str], hot: DataFrame | None) -> DataFrame:
        described = F.min(F.struct(*[c for c in property_columns if c != "gen_id"]))
        rows = nest.nest(unique, group, extra=[described.alias("_property")])
        if "part" not in group:
            rows = rows.withColumn("part", F.lit(0))
        rows = nest.with_totals(rows, "gen_id", hot)
        counted = ("reviews", "total_reviews", "part", "parts")
        return rows.select("gen_id", "_property.*", *counted).select(*property_columns, *counted)

    has_id = F.col("gen_id").isNotNull()
    unique, group, hot = _unique_reviews(reviews.where(has_id), columns, columns, limit)
    without_id = dedup(
        reviews.where(~has_id).select(*columns), ["gen_id", "review_id"], order=columns
    )
    return nested(unique, group, hot).unionAll(nested(without_id, ["gen_id"], None))


# --- the builds ----------------------------------------------------------------------


def _write(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    mode: str,
    name: str,
    cluster_by: Sequence[str] = (),
    options: Mapping[str, object] | None = None,
    **metrics: Column,
) -> dict:
    """Write a table; returns the counts observed. `cluster_by` orders rows within files."""
    rows = tables.spread_for_write(tables.encode_partitions(df, partitions), partitions)
    if cluster_by:
        # The write sorts by partition anyway; this only adds to what it sorts by.
        rows = rows.sortWithinPartitions(*partitions, *cluster_by)
    counted, observation = observed(rows, name, **metrics)
    tables.write_table(counted, path, partitions, mode=mode, spread=False, options=options)
    return observation.get


def build_rental(
    details: DataFrame,
    search: DataFrame,
    root: str,
    mode: str = "dynamic",
    dedup_search: bool = False,
    backup: bool = False,
) -> dict:
    """Write rental_property; returns the counts observed by the write, and those of the feeds.

    The latter (operators.audit.audit_counts) read the keys of both feeds once more. Mode
    "full" refuses to replace the table if no listing has an id.
    """
    spark = details.sparkSession
    _refuse_empty(details, mode)
    rows, _ = rental_frames(details, search, dedup_search)
    path = f"{root}/{RENTAL}"
    counts = _write(
        rows,
        path,
        V.RENTAL_PARTITIONS,
        mode,
        RENTAL,
        needs_review=F.count_if(F.col("data_quality_flag") == V.NEEDS_REVIEW),
        missing_commission=F.count_if(F.col("commission").isNull()),
    )
    if backup:
        tables.write_backup(read_rental(spark, root), f"{root}/{BACKUP}")
    offers = extract.extract_search(search)
    if dedup_search:
        offers = dedup(offers, ["search_id"])
    return counts | audit_counts(extract.extract_details(details), offers).first().asDict()


def _refuse_empty(details: DataFrame, mode: str) -> None:
    if mode == "full" and extract.clean_missing_key(extract.extract_details(details)).isEmpty():
        raise ValueError("the details feed has no listing with an id; the table is left as it is")


def build_reviews(
    details: DataFrame,
    reviews: DataFrame,
    root: str,
    mode: str = "dynamic",
    dedup_properties: bool = False,
) -> dict:
    """Write property_reviews; returns the counts observed by the write.

    Rows of a property lie together, which makes its repeated columns small. Mode "full"
    refuses to replace the table if no listing has an id.
    """
    _refuse_empty(details, mode)
    return _write(
        reviews_frame(details, reviews, dedup_properties),
        f"{root}/{REVIEWS}",
        V.REVIEWS_PARTITIONS,
        mode,
        REVIEWS,
        cluster_by=["gen_id"],
        reviews=F.count("review_id"),
        needs_review=F.count_if(F.col("data_quality_flag") == V.NEEDS_REVIEW),
    )


def build_review_documents(
    spark: SparkSession, root: str, per_key: bool = False, limit: int = nest.ROW_LIMIT
) -> None:
    """Write the documents made from property_reviews alone, of up to `limit` reviews each."""
    nested = review_documents_frame(read_reviews(spark, root), limit)
    made = docs.documents(nested, V.REVIEWED_PROPERTY_COLUMNS, "gen_id", pretty=per_key)
    write = docs.write_document_files if per_key else docs.write_documents
    write(made, f"{root}/{REVIEW_DOCUMENTS}", "full")


def build_final(
    spark: SparkSession,
    root: str,
    mode: str = "dynamic",
    per_key: bool = False,
    created_at: datetime | None = None,
    limit: int = nest.ROW_LIMIT,
    max_bytes: int | None = None,
) -> dict:
    """Write rentals_reviews from the two tables, then its documents from what was written.

    Rows and documents hold up to `limit` reviews, or `max_bytes` of them. The documents are read from the countries
    just written, no others.
    """
    # One stamp for the batch, so that the rows of this build can be told from older ones.
    stamp = F.lit(created_at or datetime.now(UTC))
    nested = final_frame(read_rental(spark, root), read_reviews(spark, root), limit, max_bytes)
    stamped = standardize.with_created_time(nested, stamp)
    counts = _write(
        stamped,
        f"{root}/{FINAL}",
        V.FINAL_PARTITIONS,
        mode,
        FINAL,
        options=tables.LONG_ROWS,
        reviews=F.coalesce(F.sum(nest.total_reviews()), F.lit(0)),
        listings=F.count_if(F.col("part") == 0),
        countries=F.collect_set("country_code"),
    )
    countries = counts.pop("countries")  # as many as the table has partitions, at most
    country = F.col("country_code")
    batch = country.isin(countries) if countries else F.lit(False)
    written = read_final(spark, root).where(batch | country.isNull())
    written = written.where(F.col("created_time") == stamp)
    made = docs.documents(written, V.RENTAL_COLUMNS, "id", pretty=per_key)
    if per_key:
        docs.write_document_files(made, f"{root}/{FINAL_DOCUMENTS}", mode)
    else:
        # The table lies by country already: no task meets more than a few of them.
        docs.write_documents(made, f"{root}/{FINAL_DOCUMENTS}", mode, spread=False)
    return counts


def build_all(
    details: DataFrame,
    search: DataFrame,
    reviews: DataFrame,
    root: str,
    mode: str = "dynamic",
    unique: bool = False,
    limit: int = nest.ROW_LIMIT,
) -> dict:
    """All tables and documents; returns the counts of each build.

    `unique` keeps one offer and one listing per id in the tables. `limit`: reviews of a
    listing in one row or document. The feeds are read several times: stage them first.
    """
    spark = details.sparkSession
    counts = {
        RENTAL: build_rental(details, search, root, mode, dedup_search=unique, backup=True),
        REVIEWS: build_reviews(details, reviews, root, mode, dedup_properties=unique),
    }
    build_review_documents(spark, root, limit=limit)
    counts[FINAL] = build_final(spark, root, mode, limit=limit)
    return counts


# --- the tables as written -----------------------------------------------------------


def read_rental(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_table(
        spark, f"{root}/{RENTAL}", schemas.RENTAL_PROPERTY, V.RENTAL_PARTITIONS
    )


def read_reviews(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_table(
        spark, f"{root}/{REVIEWS}", schemas.PROPERTY_REVIEWS, V.REVIEWS_PARTITIONS
    )


def read_final(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_table(
        spark, f"{root}/{FINAL}", schemas.RENTALS_REVIEWS, V.FINAL_PARTITIONS
    )


def register_combined_view(spark: SparkSession, root: str, name: str = "property_combined") -> None:
    """Make the combined view available to spark.sql.

    Ids that are hot in both tables are looked for now; the view shares out their rows.
    """
    rental, reviews = read_rental(spark, root), read_reviews(spark, root)
    heavy = heavy_keys(rental, reviews, "id", "gen_id")
    joins.combined_view(rental, reviews, heavy).createOrReplaceTempView(name)
