"""The joins. All are equi-joins on one key; Spark picks the physical strategy.

None carries a broadcast hint, as every side grows with the data. A join may meet a hot key
on either side: adaptive execution splits such a partition. The shapes it cannot split (the
right side of an outer join, a side that is not shuffled for the join, null keys) are
written so that they do not occur. The joins that pair all rows of two tables, where a key
may be hot on both sides, are salted for the keys that operators.skew finds heavy.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake import fixed_values as V
from feedlake.operators.dedup import dedup, distinct_keys
from feedlake.operators.skew import salted_join


def rental_matched(details: DataFrame, search: DataFrame) -> DataFrame:
    """Details with their search rows. Several search rows for one id multiply the row."""
    return details.join(search, details["source_id"] == search["search_id"], "inner")


def rental_unmatched(details: DataFrame, search: DataFrame) -> DataFrame:
    """Details that no search row names. Only the distinct ids of search are shuffled."""
    ids = distinct_keys(search, "search_id")
    return details.join(ids, details["source_id"] == ids["search_id"], "left_anti")


def properties_left_reviews(
    properties: DataFrame, reviews: DataFrame, review_keys: DataFrame | None = None
) -> DataFrame:
    """Every property with its reviews, or with nulls if it has none.

    A left join sends all reviews of one property to one task, and adaptive execution may
    not split the right side of it. So it is put together from an inner join, which may be
    split (and lets a small properties side be broadcast), and from the properties that
    are in no review. Properties with a null key match nothing and skip the join.
    `review_keys` may give the source_id_r of the reviews from a cheaper source.
    """
    key, key_r = F.col("source_id"), F.col("source_id_r")
    keyed = properties.where(key.isNotNull())
    keys = reviews if review_keys is None else review_keys
    reviewed = distinct_keys(keys.where(key_r.isNotNull()), "source_id_r")
    matched = keyed.join(reviews, key == key_r, "inner")
    lonely = keyed.join(reviewed, key == key_r, "left_anti")
    keyless = properties.where(key.isNull())
    return matched.unionByName(lonely, allowMissingColumns=True).unionByName(
        keyless, allowMissingColumns=True
    )


def join_tables(
    rental: DataFrame, reviews: DataFrame, heavy: DataFrame | None = None
) -> DataFrame:
    """rental_property with property_reviews; shared columns of the latter get a prefix.

    heavy: the ids that are hot (`skew.heavy_keys`), whose rows are then shared out.
    """
    renamed = reviews.withColumnsRenamed(
        {name: V.SHARED_PREFIX + name for name in V.SHARED_COLUMNS}
    )
    if heavy is None:
        joined = rental.join(renamed, rental["id"] == renamed["gen_id"], "inner")
    else:
        joined = salted_join(rental, renamed, "id", "gen_id", heavy)
    return joined.drop("gen_id", "source_id_r")


def join_tables_deduplicated(rental: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per (id, review_id) of `join_tables`.

    Within one (id, review_id) the join gives every pair of a rental row and a review row,
    so the smallest pair is the smallest rental row with the smallest review row. Taking
    both before the join gives the same rows and never builds the pairs.
    """
    return join_tables(
        dedup(rental, ["id"], for_join=True),
        dedup(reviews, ["gen_id", "review_id"], order=V.REVIEW_FIELDS),
    )


def combined_view(
    rental: DataFrame, reviews: DataFrame, heavy: DataFrame | None = None
) -> DataFrame:
    """The 26 columns that ad-hoc queries run on: one row per pair of the two tables.

    heavy: as in `join_tables`.
    """
    if heavy is not None:
        described = reviews.select("gen_id", "property_id", *V.REVIEW_FIELDS)
        return salted_join(rental, described, "id", "gen_id", heavy).drop("gen_id")
    r, v = rental.alias("r"), reviews.alias("v")
    return r.join(v, F.col("r.id") == F.col("v.gen_id"), "inner").select(
        *[F.col(f"r.{name}") for name in V.RENTAL_COLUMNS],
        "v.property_id",
        *[F.col(f"v.{name}") for name in V.REVIEW_FIELDS],
    )


def property_base(rental: DataFrame, reviews: DataFrame, columns) -> DataFrame:
    """Distinct `columns` of the properties that have a row in reviews.

    Equals a distinct over the combined view, without joining the reviews themselves.
    """
    present = distinct_keys(reviews, "gen_id")
    unique = rental.select(*columns).distinct()
    return unique.join(present, F.col("id") == F.col("gen_id"), "left_semi")
