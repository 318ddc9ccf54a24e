"""The test tables dressed as the three feeds.

Customers are the listed properties, orders the search offers, events the review records.
The tables hold no nulls, so conditions on their values make the gaps, bad ids, blank texts,
copies and malformed dates that feeds come with. Prices, commissions and scores are square
roots, whose averages do not fall on the edge between two rounded values. Each feed is a
projection of whole tables, staged as files on first use in a session, since feeds are
files; queries read those.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake import schemas
from feedlake.plans import builds
from feedlake.workspace import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a table in as many tasks as a shuffle has: files of few bytes are read by few
    tasks, but dressing a row takes long."""
    return table(spark, sf_dir, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def _dressed_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation. Accounts of 9000 and more are listed a second time."""
    balance, segment, key = F.col("c_acctbal"), F.col("c_mktsegment"), F.col("c_custkey")
    region = F.col("n_regionkey")
    code = F.concat(F.char(F.col("n_nationkey") + 97), F.lit("b"))
    machinery = segment == "MACHINERY"
    listed = (
        _spread(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(balance < -900, None)
            .when(balance < -800, "")
            .when(balance < -700, F.concat(F.lit("x"), key))
            .otherwise(key.cast("string"))
            .alias("id"),
            F.create_map(
                F.lit("en-us"),
                F.when((segment == "HOUSEHOLD") & (balance > 8000), "  ").when(
                    ~machinery, F.concat(F.col("c_name"), F.lit(" "))
                ),
                F.lit("de"),
                F.when(
                    machinery & (balance > 5000), F.concat(F.lit("Kunde Süd_"), key, F.lit("!"))
                ),
                F.lit("pt"),
                F.when(machinery & (balance > 3000), F.concat(F.lit("Cliente "), key)),
                F.lit("it"),
                F.when(machinery & (balance > 4000), F.concat(F.lit("Clienti "), key)),
            ).alias("name"),
            F.struct(
                F.when(balance < 0, None)
                .when((segment == "HOUSEHOLD") & (region == 2), F.col("n_name"))
                .when(region == 4, F.concat(F.lit(" "), code, F.lit(" ")))
                .otherwise(code)
                .alias("country"),
                F.col("n_name").alias("city"),
            ).alias("location"),
            F.when(segment == "FURNITURE", None)
            .when(segment == "BUILDING", " ")
            .otherwise("EUR")
            .alias("currency"),
            F.struct(
                F.when(segment != "AUTOMOBILE", region.cast("double")).alias("stars"),
                F.when(balance >= -500, balance / 1000).alias("review_score"),
            ).alias("rating"),
            segment.alias("accommodation_type"),
            F.col("n_nationkey").cast("bigint").alias("number_of_rooms"),
            (balance > 5000).alias("is_genius"),
            (region > 1).alias("is_work_friendly"),
            F.concat(F.lit("https://listing.example/"), key).alias("url"),
            balance.alias("_balance"),
        )
    )
    again = listed.where(F.col("_balance") >= 9000).withColumns(
        {
            "currency": F.lit("GBP"),
            "rating": F.struct(F.lit(5.0).alias("stars"), F.lit(9.5).alias("review_score")),
        }
    )
    return listed.unionAll(again).drop("_balance")


def _dressed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders: offers for the ordering customer, for unknown ids and for none."""
    priority, price = F.col("o_orderpriority"), F.sqrt("o_totalprice")

    def product(*meals) -> Column:
        # No meals at all is an empty array of text.
        offered = F.array(*meals) if meals else F.array().cast("array<string>")
        return F.struct(
            F.struct(F.struct(offered.alias("meals")).alias("meal_plan")).alias("policies")
        )

    products = "array<struct<policies:struct<meal_plan:struct<meals:array<string>>>>>"
    return _spread(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string"))
        .when(F.col("o_orderstatus") == "P", F.concat(F.lit("P-"), "o_custkey"))
        .alias("id"),
        F.lit("USD").alias("currency"),
        F.when(priority != "5-LOW", F.struct(price.alias("book"))).alias("price"),
        F.struct(
            F.when(priority != "4-NOT SPECIFIED", price / 100).alias("percentage")
        ).alias("commission"),
        F.when(priority == "1-URGENT", F.array(product()))
        .when(priority == "2-HIGH", F.array().cast(products))
        .when(
            priority == "4-NOT SPECIFIED",
            F.array(product(F.lit("breakfast"), F.lit("dinner")), product(F.lit("lunch"))),
        )
        .when(priority == "5-LOW", F.array(product(F.lower(priority))))
        .alias("products"),
        F.concat(F.lit("https://search.example/"), "o_orderkey").alias("deep_link_url"),
        F.concat(F.lit("https://offer.example/"), "o_orderkey").alias("url"),
    )


def _dressed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events: records with no, one or two reviews; two share one review id."""
    kind, k, value = F.col("event_type"), F.col("k"), F.sqrt("value")

    def review(score: Column) -> Column:
        return F.struct(
            F.col("event_id").alias("id"),
            F.when(kind == "error", F.date_format("ts", "yyyy/MM/dd"))
            .otherwise(
                F.concat((2024 - F.floor(k / 25)).cast("string"), F.date_format("ts", "-MM-dd"))
            )
            .alias("date"),
            score.alias("score"),
            F.when(k < 50, "en-gb").when(k < 80, "de").alias("language"),
            F.concat_ws(" ", kind, k).alias("summary"),
            F.when(k >= 50, F.concat(F.lit("good "), k)).alias("positive"),
            F.when(k < 30, F.concat(F.lit("bad "), k)).alias("negative"),
            F.struct(
                F.concat(F.lit("Guest "), "user_id").alias("name"),
                F.concat(F.lit("c"), F.floor(k / 10)).alias("country"),
                F.when(kind.isin("click", "purchase"), "leisure")
                .when(kind == "view", "business")
                .alias("travel_purpose"),
                F.when(k < 25, "couple")
                .when(k < 50, "solo_traveller")
                .when(k < 75, "family_with_children")
                .when(k < 90, "extended_group")
                .alias("type"),
            ).alias("reviewer"),
        )

    score = F.when((kind != "view") | (k >= 20), value)
    one, two = F.array(review(score)), F.array(review(score), review(score + 1))
    return (
        _spread(spark, sf_dir, "events")
        .withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        .select(
            F.when((kind == "view") & (k >= 90), F.concat(F.lit("v"), "user_id"))
            .otherwise(F.col("user_id").cast("string"))
            .alias("id"),
            F.when(kind == "signup", F.slice(one, 1, 0))
            .when((kind == "error") & (k < 10), None)
            .when(kind == "purchase", two)
            .otherwise(one)
            .alias("reviews"),
        )
    )


_folders: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make) -> str:
    """Folder that `make` has filled, once per session and set of test tables."""
    made_by = (spark.sparkContext.applicationId, sf_dir, name)
    if made_by not in _folders:
        path = work_folder(spark, name)
        make(path)
        _folders[made_by] = path
    return _folders[made_by]


def _staged(spark: SparkSession, sf_dir: str, name: str, dressed, schema: str) -> DataFrame:
    """The dressed rows with the types of the feed, numbers as text."""
    fields = T.StructType.fromDDL(schema).fields

    def make(path: str) -> None:
        rows = dressed(spark, sf_dir)
        rows.select(*[F.col(f.name).cast(f.dataType) for f in fields]).write.parquet(path)

    path = _once(spark, sf_dir, name, make)
    return spark.read.schema(schema).parquet(path)


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "details", _dressed_details, schemas.DETAILS_FEED)


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "search", _dressed_search, schemas.SEARCH_FEED)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "reviews", _dressed_reviews, schemas.REVIEWS_FEED)


def built_tables(spark: SparkSession, sf_dir: str, unique: bool = False) -> str:
    """Folder of the tables built from the feeds: rental_property and property_reviews.

    Built on first use in a session, then read by every query on tables, as reports are.
    They hold all listings and offers; `unique` ones, which only tests of plans read, hold one
    listing and one offer per id.
    """

    def build(root: str) -> None:
        listing = details(spark, sf_dir)
        builds.build_rental(listing, search(spark, sf_dir), root, dedup_search=unique)
        builds.build_reviews(listing, reviews(spark, sf_dir), root, dedup_properties=unique)

    return _once(spark, sf_dir, "unique_tables" if unique else "tables", build)
