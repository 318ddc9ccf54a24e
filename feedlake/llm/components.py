"""Connected components of links between ids of any type that has an order."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import written


def components(links: DataFrame) -> DataFrame:
    """The component of every id in `links` (a, b): id, component (its smallest id).

    Alternates two steps until only stars are left: every id gives its larger neighbours, then its
    smaller ones, to the smallest id it sees. Stars grow until each component is one. Both
    steps keep at most one link for each link before, and the number of rounds grows with the
    logarithm of the longest path. Smallest ids are found by partial sums, so an id with very
    many links is no burden to one task; the join that follows meets a written table, both
    sides are shuffled for it, and adaptive execution splits such an id.

    Links with a null side and links of an id to itself are left out. No links, no rows.
    """
    links = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    stars = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "links")
    while not _are_stars(stars):
        stars = written(_small_star(_large_star(stars)), "stars")
    roots = stars.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _are_stars(links: DataFrame) -> bool:
    """Whether every id has one link to a smaller id, or links to larger ones only. Of links (u, v)
    with u > v, the middle of a star is then the smallest id of its component."""
    ends = links.select(F.col("u").alias("id"), F.lit(1).alias("smaller"), F.lit(0).alias("larger"))
    ends = ends.union(links.select("v", F.lit(0), F.lit(1)))
    counted = ends.groupBy("id").agg(F.sum("smaller").alias("s"), F.max("larger").alias("l"))
    return counted.where("s + l > 1").isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of an id to the smallest of the id and its neighbours."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    larger = both.where("v > u")
    return (
        larger.join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Links every smaller neighbour of an id, and the id, to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, "u")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
