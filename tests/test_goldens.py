"""The committed documents are reproduced from their own fields. They are read in place."""

import json

import pytest
from helpers import GOLDENS
from pyspark.sql import functions as F

from feedlake import fixed_values as V
from feedlake import schemas
from feedlake.functions import names, quality
from feedlake.operators import dedup, joins, nest
from feedlake.plans import builds, reports
from feedlake.sources import documents

pytestmark = pytest.mark.skipif(
    not (GOLDENS / "final_data").is_dir(), reason="golden documents are not there"
)


def golden(spark, folder, schema):
    files = str(GOLDENS / folder / "*.json")
    return spark.read.schema(schema).option("multiLine", True).json(files)


@pytest.fixture(scope="module")
def final(spark):
    return golden(spark, "final_data", schemas.FINAL_DOCUMENT).cache()


@pytest.fixture(scope="module")
def per_property(spark):
    return golden(spark, "property_data", schemas.REVIEW_DOCUMENT).cache()


@pytest.fixture(scope="module")
def rental(final):
    return final.select(*V.RENTAL_COLUMNS)


@pytest.fixture(scope="module")
def reviews(per_property):
    """property_reviews, one row per review of the documents."""
    review = F.explode_outer("reviews").alias("r")
    fields = [
        F.col(f"r.{V.DOCUMENT_REVIEW_NAMES.get(name, name)}").alias(name)
        for name in V.REVIEW_FIELDS
    ]
    scalars = V.REVIEWED_PROPERTY_COLUMNS
    return per_property.select(*scalars, review).select(*scalars, *fields).cache()


def read_golden(folder):
    docs = [json.loads(p.read_text("utf-8")) for p in (GOLDENS / folder).glob("*.json")]
    key = "id" if folder == "final_data" else "gen_id"
    return {doc[key]: doc for doc in docs}


def as_written(docs):
    rows = docs.select("doc_key", "document").collect()
    made = {row.doc_key: json.loads(row.document) for row in rows}
    assert len(made) == len(rows)
    return made


def test_final_documents(rental, reviews):
    made = as_written(
        documents.documents(builds.final_frame(rental, reviews), V.RENTAL_COLUMNS, "id")
    )
    expected = read_golden("final_data")
    assert made == expected
    sample = next(iter(expected))
    assert list(made[sample]) == list(expected[sample])


def test_final_documents_by_the_long_way(rental, reviews):
    """Join, drop copies, group by all property columns: the same documents."""
    joined = joins.join_tables(rental, reviews)
    assert joined.count() == 98
    unique = dedup.dedup(joined, ["id", "review_id"])
    nested = nest.nest(unique, V.RENTAL_COLUMNS)
    made = as_written(documents.documents(nested, V.RENTAL_COLUMNS, "id"))
    assert made == read_golden("final_data")


def test_review_documents(reviews):
    nested = builds.review_documents_frame(reviews)
    made = as_written(documents.documents(nested, V.REVIEWED_PROPERTY_COLUMNS, "gen_id"))
    assert made == read_golden("property_data")


def test_slugs_and_labels(final, per_property):
    wrong = final.where(names.slug_ascii(F.col("property_name")) != F.col("property_slug"))
    assert wrong.count() == 0
    label = quality.rental_quality(F.col("property_name"), F.col("country_code"))
    assert final.where(label != F.col("data_quality_flag")).count() == 0
    wrong = per_property.where(names.slug_word(F.col("property_name")) != F.col("property_slug"))
    assert wrong.count() == 0
    columns = ("property_name", "country_code", "star_rating", "review_score")
    label = quality.reviews_quality(*[F.col(c) for c in columns])
    assert per_property.where(label != F.col("data_quality_flag")).count() == 0


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_reports(rental, reviews):
    made = {name: rows(report(rental, reviews)) for name, report in reports.ALL.items()}
    assert len(made["sample_rows"]) == 10
    assert len(made["reviews_per_country"]) == 24
    assert made["reviews_per_country"][:2] == [("GB", 6, 16, 9.5, 3.0), ("ID", 3, 15, 7.27, 2.33)]
    assert set(made["reviews_per_country"]) > {
        ("HR", 2, 8, 9.0, 3.63), ("US", 2, 6, 7.67, 3.83), ("BE", 1, 5, 9.6, 4.0),
        ("DE", 3, 5, 7.4, 3.17), ("FI", 1, 5, 9.8, 3.0), ("JP", 1, 5, 8.4, 3.0),
        ("MX", 3, 5, 8.4, 2.57), ("AL", 2, 3, 10.0, 0.0),
    }
    assert made["reviews_by_year"] == [
        (2023, 8, 8.38, 4), (2024, 11, 8.82, 5), (2025, 20, 7.4, 7), (2026, 39, 8.72, 10),
    ]
    assert [(r[0], r[4], r[5]) for r in made["top_properties"]] == [
        ("GEN-15814192", 10.0, 3), ("GEN-3138009", 10.0, 3), ("GEN-7013181", 10.0, 2),
        ("GEN-10521952", 9.8, 5), ("GEN-174022", 9.8, 5), ("GEN-8719233", 9.8, 5),
        ("GEN-2254251", 9.6, 5), ("GEN-5989584", 9.0, 5), ("GEN-1509823", 8.8, 5),
        ("GEN-6831651", 8.6, 5),
    ]
    assert made["quality_distribution"] == [("GOOD", 42, 98)]
    assert len(made["pricing_by_country"]) == 24
    assert made["pricing_by_country"][0] == ("GB", "GBP", 6, 613.62, 384.43, 781.54)
    assert made["pricing_by_meal"] == [
        ("[]", 37, 523.55, 7.6216, 0),
        ("[breakfast]", 5, 287.59, 8.472, 0),
    ]
    expensive = [(r[0], r[2]) for r in made["most_expensive"]]
    assert len(expensive) == 10
    assert expensive[:3] == [
        ("GEN-12929721", 1547.9), ("GEN-15890644", 1210.47), ("GEN-14690442", 1114.66),
    ]
    assert expensive[9] == ("GEN-15234132", 724.35)
    assert made["by_purpose"] == [("leisure", 65, 8.48), ("business", 13, 7.77)]
    assert made["join_coverage"] == [(42, 22, 20, 78)]
    density = made["review_density"]
    assert [r[1] for r in density] == [5] * 10
    assert (density[0][0], density[9][0]) == ("GEN-10521952", "GEN-8719233")
    assert [(r[2], r[3]) for r in made["filtered_reviews"]] == [
        ("2024-02-15", 10.0), ("2024-05-09", 10.0), ("2024-09-14", 10.0),
    ]
    assert {(r[0], r[1], r[2], r[3]) for r in made["by_type"]} == {
        ("couple", 2.74, 8.82, 34), ("family_with_children", 3.47, 8.74, 19),
        ("extended_group", 2.63, 8.25, 8), ("solo_traveller", 3.06, 7.06, 17),
    }
