"""Quality labels of the two tables. They differ on purpose."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import fixed_values as V
from feedlake.functions.names import is_blank


def _label(problem: Column) -> Column:
    return F.when(problem, V.NEEDS_REVIEW).otherwise(V.GOOD)


def rental_quality(name: Column, country: Column) -> Column:
    """A null country is GOOD: its length is null, so the comparison never fires.

    The price takes no part, as it is defaulted before the label is given.
    """
    return _label(name.isNull() | (F.length(country) != 2))


def reviews_quality(name: Column, country: Column, stars: Column, score: Column) -> Column:
    """Zero stars or score count as problems, whether defaulted or given."""
    return _label(is_blank(name) | country.isNull() | (score == 0.0) | (stars == 0.0))
