"""Build everything from feed files: spark-submit or python -m feedlake --help."""

import argparse
import json

from pyspark.sql import SparkSession

from feedlake.operators import nest
from feedlake.plans import builds
from feedlake.sources import feeds


def arguments(given=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="feedlake", description=__doc__)
    parser.add_argument("--details", required=True, help="folder or file of the details feed")
    parser.add_argument("--search", required=True, help="folder or file of the search feed")
    parser.add_argument("--reviews", required=True, help="folder or file of the reviews feed")
    parser.add_argument("--root", required=True, help="folder of tables and documents")
    parser.add_argument(
        "--arrays", action="store_true", help="each feed file is one JSON array, not JSON Lines"
    )
    parser.add_argument("--mode", choices=("dynamic", "full"), default="dynamic")
    parser.add_argument(
        "--unique", action="store_true", help="keep one offer and one listing per id"
    )
    parser.add_argument(
        "--allow-bad", action="store_true", help="set records aside that cannot be read"
    )
    parser.add_argument(
        "--row-limit", type=int, default=nest.ROW_LIMIT, help="reviews of a listing in one row"
    )
    return parser.parse_args(given)


def main(given=None) -> None:
    options = arguments(given)
    spark = SparkSession.builder.appName("feedlake").getOrCreate()
    lines = not options.arrays
    parsed = {
        "details": feeds.read_details(spark, options.details, lines),
        "search": feeds.read_search(spark, options.search, lines),
        "reviews": feeds.read_reviews(spark, options.reviews, lines),
    }
    sources = [options.details, options.search, options.reviews]
    staged = {
        name: feeds.staged(feed, f"{options.root}/_staged/{name}", options.allow_bad, sources)
        for name, feed in parsed.items()
    }
    counts = builds.build_all(
        **staged,
        root=options.root,
        mode=options.mode,
        unique=options.unique,
        limit=options.row_limit,
    )
    print(json.dumps(counts))


if __name__ == "__main__":
    main()
