"""Every operator as a query on the test tables: name to function of (spark, sf_dir)."""

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from feedlake import fixed_values as V
from feedlake import schemas
from feedlake.functions import names, quality
from feedlake.operators import audit, dedup, extract, joins, nest, profile, skew, standardize
from feedlake.plans import builds, maintenance, reports
from feedlake.sources import discovery, documents, listing, tables
from feedlake.sources import feeds as sources
from feedlake.testbed import feeds
from feedlake.testbed.feeds import table
from feedlake.workspace import kept, work_folder

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- sources and sinks ---------------------------------------------------------------


def _json_lines(df: DataFrame, name: str) -> str:
    path = work_folder(df.sparkSession, name)
    df.write.json(path)
    return path


@query
def scan_feed(spark, sf_dir):
    """JSON text with quoted numbers; some ratings are no numbers."""
    rows = feeds.details(spark, sf_dir)
    stars = F.when(F.col("rating.stars") == "2.0", "two").otherwise(F.col("rating.stars"))
    rows = rows.withColumn("rating", F.col("rating").withField("stars", stars))
    return _scanned_details(sources.read_details(spark, _json_lines(rows, "details")))


def _scanned_details(read: DataFrame) -> DataFrame:
    return read.select(
        "id",
        names.preferred_name(F.col("name")).alias("name"),
        "location.country",
        "location.city",
        "currency",
        F.col("rating.stars").try_cast("double").alias("stars"),
        F.col("rating.review_score").try_cast("double").alias("review_score"),
        "accommodation_type",
        extract.whole_number(F.col("number_of_rooms")).alias("number_of_rooms"),
        F.col("is_genius").try_cast("boolean").alias("is_genius"),
        F.col("is_work_friendly").try_cast("boolean").alias("is_work_friendly"),
        "url",
    )


@query
def scan_feed_search(spark, sf_dir):
    """JSON text with quoted numbers; some prices are no numbers."""
    rows = feeds.search(spark, sf_dir)
    odd = F.col("url").endswith("7")
    price = F.col("price").withField("book", F.when(odd, "free").otherwise(F.col("price.book")))
    path = _json_lines(rows.withColumn("price", price), "search")
    return extract.extract_search(sources.read_search(spark, path))


@query
def scan_feed_reviews(spark, sf_dir):
    """JSON text with quoted numbers; ids as fractions, and some ids and scores no numbers."""

    def written(review: Column) -> Column:
        number = review["id"].try_cast("bigint")
        id = F.when(number % 10 == 3, F.concat(review["id"], F.lit(".0"))).when(
            number % 100 == 99, F.concat(F.lit("x"), review["id"])
        )
        score = F.when(number % 10 == 7, "n/a").otherwise(review["score"])
        return review.withField("id", F.coalesce(id, review["id"])).withField("score", score)

    rows = feeds.reviews(spark, sf_dir).withColumn("reviews", F.transform("reviews", written))
    path = _json_lines(rows, "reviews")
    return extract.explode_reviews(sources.read_reviews(spark, path))


#: What a listing's address may hold that looks like the end of a record, or of the feed.
ODD_TEXT = '?q={"a":["}]},{\\"'


def _array_files(df: DataFrame, name: str, files: int = 8) -> str:
    """Files of one JSON array each, every other one with a line for each value."""
    path = work_folder(df.sparkSession, name)
    body = F.struct(*df.columns)
    dealt = df.select(
        F.pmod(F.crc32(F.to_json(body)), F.lit(files)).cast("int").alias("file"),
        F.to_json(body).alias("line"),
        F.to_json(body, {"pretty": "true"}).alias("lines"),
    )
    within = Window.partitionBy("file").orderBy("line")
    count = F.count(F.lit(1)).over(Window.partitionBy("file"))
    placed = dealt.withColumns({"n": F.row_number().over(within), "count": count})
    text = F.concat(
        F.when(F.col("n") == 1, "[").otherwise(","),
        F.when(F.col("file") % 2 == 0, F.col("lines")).otherwise(F.col("line")),
        F.when(F.col("n") == F.col("count"), "]").otherwise(""),
    )
    rows = placed.repartition("file").sortWithinPartitions("file", "n")
    rows.select("file", text.alias("text")).write.partitionBy("file").text(path)
    return path


@query
def scan_array_feed(spark, sf_dir):
    """Files of one array each; addresses hold quotes, escapes, brackets and braces."""
    rows = feeds.details(spark, sf_dir)
    path = _array_files(rows.withColumn("url", F.concat("url", F.lit(ODD_TEXT))), "array")
    read = sources.read_details(spark, path, json_lines=False)
    return _scanned_details(read)


@query
def feed_problems(spark, sf_dir):
    """Feeds with every tenth line cut short: how many records could not be read."""
    found = []
    for name, read in (("details", sources.read_details), ("reviews", sources.read_reviews)):
        lines = spark.read.text(_json_lines(getattr(feeds, name)(spark, sf_dir), name))
        tenth = F.crc32("value") % 10 == 0
        path = work_folder(spark, f"cut-{name}")
        short = F.substring(F.col("value"), F.lit(1), F.length("value") - 1)
        lines.select(F.when(tenth, short).otherwise(F.col("value"))).write.text(path)
        counts = sources.problems(kept(read(spark, path), "read"))
        cut = lines.agg(F.count_if(tenth).alias("cut"))
        found.append(counts.select(F.lit(name).alias("feed"), "records", F.col("bad").alias("missed")))
        found.append(cut.select(F.lit(name), F.lit(0).cast("long"), -F.col("cut")))
    rows = reduce(DataFrame.unionAll, found).groupBy("feed")
    return rows.agg(F.sum("records").alias("records"), F.sum("missed").alias("missed"))


@query
def table_scan(spark, sf_dir):
    return builds.read_rental(spark, feeds.built_tables(spark, sf_dir))


def _ddl(df: DataFrame, *more: str) -> str:
    return ", ".join([*[f"{name} {dtype}" for name, dtype in df.dtypes], *more])


@query
def write_partitioned(spark, sf_dir):
    rows, path = table(spark, sf_dir, "lineitem"), work_folder(spark, "by_flag")
    tables.write_table(rows, path, ["l_returnflag"])
    return tables.read_table(spark, path, _ddl(rows), ["l_returnflag"])


@query
def write_partitioned_2level(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    path, partitions = work_folder(spark, "by_flag_year"), ["l_returnflag", "ship_year"]
    tables.write_table(rows, path, partitions)
    return tables.read_table(spark, path, _ddl(rows), partitions)


def _returned_open(df: DataFrame) -> DataFrame:
    return df.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"))


@query
def overwrite_partitions(spark, sf_dir):
    """A later batch for one partition replaces that partition and no other."""
    rows = table(spark, sf_dir, "lineitem")
    path, partitions = work_folder(spark, "overwritten"), ["l_returnflag", "l_linestatus"]
    tables.write_table(rows, path, partitions)
    batch = _returned_open(rows).where("l_discount > 0")
    batch = batch.withColumn("l_quantity", F.col("l_quantity") + 1000)
    tables.write_table(batch, path, partitions)
    return tables.read_table(spark, path, _ddl(rows), partitions)


@query
def overwrite_full(spark, sf_dir):
    """A later full write leaves nothing of the earlier partitions."""
    rows, path = table(spark, sf_dir, "lineitem"), work_folder(spark, "replaced")
    tables.write_table(rows, path, ["l_returnflag"])
    tables.write_table(rows.where("l_returnflag = 'R'"), path, ["l_returnflag"], mode="full")
    return tables.read_table(spark, path, _ddl(rows), ["l_returnflag"])


@query
def read_evolved(spark, sf_dir):
    """Partitions written before and after a column was added, read with the new schema."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    path = work_folder(spark, "evolved")
    tables.write_table(rows, path, ["o_orderstatus"])
    later = orders.where("o_orderstatus = 'P'").select(
        *rows.columns, F.col("o_orderdate").alias("created_time")
    )
    tables.write_table(later, path, ["o_orderstatus"])
    schema = _ddl(rows, f"created_time {dict(later.dtypes)['created_time']}")
    return tables.read_table(spark, path, schema, ["o_orderstatus"])


def _generations(spark, sf_dir) -> str:
    """Folder of orders written by three generations of a writer: totals were whole numbers
    once, keys became longer, a column was added, customers got names in place of numbers."""
    orders, path = table(spark, sf_dir, "orders"), work_folder(spark, "generations")
    age = F.pmod("o_orderkey", F.lit(3))
    common = ("o_orderpriority", "o_orderstatus")
    first = orders.where(age == 0).select(
        F.col("o_orderkey").cast("int"), F.col("o_totalprice").cast("int"), "o_custkey", *common
    )
    second = orders.where(age == 1).select(
        F.col("o_totalprice"), F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"),
        (F.col("o_totalprice") > 100_000).alias("large"), *common,
    )
    third = orders.where(age == 2).select(
        F.col("o_orderkey").cast("bigint"), F.concat(F.lit("c"), "o_custkey").alias("o_custkey"),
        F.col("o_totalprice").cast("bigint"), *common,
    )
    for rows in (first, second, third):
        rows.write.mode("append").partitionBy("o_orderstatus").parquet(path)
    return path


@query
def read_discovered(spark, sf_dir):
    return discovery.read_discovered(spark, _generations(spark, sf_dir), ["o_orderstatus"])


@query
def discovered_schema(spark, sf_dir):
    found = discovery.discovered_schema(discovery.footers(spark, _generations(spark, sf_dir)))
    return found.select("name", "type", F.array_join("types", ",").alias("types"), "conflict")


def _profile_check(rows: DataFrame, c: Row) -> DataFrame:
    """One row: whether what the merged profile `c` of a column says is near the exact values."""
    text, n = F.col("text"), F.col("n")
    value = F.col(f"`{c['name']}`")
    counted = rows.groupBy(value.cast("string").alias("text")).agg(
        # Rows of one text have one number, and only numbers have quartiles.
        F.count(F.lit(1)).alias("n"), F.min(value).alias("value")
    )

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    exact = F.count(text)
    distinct = F.abs(F.lit(c["distinct"]) - exact) <= F.greatest(
        4 * profile.DISTINCT_ERROR * exact, F.lit(1)
    )
    quartiles, shares = F.lit(True), (0.25, 0.5, 0.75)
    there = rows_where(F.col("value").isNotNull())
    for share, quartile in zip(shares, c["quartiles"]):
        if quartile is not None:
            below = rows_where(F.col("value") < quartile) / there
            upto = rows_where(F.col("value") <= quartile) / there
            near = 1.5 * profile.RANK_ERROR
            quartiles = quartiles & (below <= share + near) & (upto >= share - near)
    frequent = F.lit(True)
    for item in c["frequent"]:
        off = F.abs(rows_where(text == item["item"]) - item["count"])
        frequent = frequent & (off <= F.sum(n) / profile.TRACKED)
    return counted.agg(
        F.lit(c["name"]).alias("checked"),
        distinct.alias("distinct_near"),
        quartiles.alias("quartiles_near"),
        frequent.alias("frequent_near"),
    )


@query
def column_profile(spark, sf_dir):
    """Exact counts and bounds of line items, and whether what the merged sketches say of distinct,
    middle and frequent values is as near to the exact values as they promise."""
    rows = table(spark, sf_dir, "lineitem")
    parts = kept(profile.partition_profiles(rows, ["l_returnflag", "l_linestatus"]), "profiles")
    merged = kept(profile.merged_profile(parts), "profile")
    # A row a column. Values are counted first, each column by itself: what is exact about them
    # is told by the counts, and no row is repeated for another column.
    checks = [_profile_check(rows, c) for c in merged.collect()]
    checked = reduce(DataFrame.unionAll, checks)
    told = merged.select("name", "rows", "nulls", "least", "most", "first", "last")
    return told.join(checked, F.col("name") == F.col("checked")).drop("checked")


@query
def backup_parquet(spark, sf_dir):
    path = work_folder(spark, "backup")
    tables.write_backup(builds.read_rental(spark, feeds.built_tables(spark, sf_dir)), path)
    return spark.read.schema(schemas.RENTAL_PROPERTY).parquet(path)


def _flat(df: DataFrame, *scalars: str | Column) -> DataFrame:
    """Nested reviews as text, which both engines can compare."""
    ids = F.transform("reviews", lambda r: r["review_id"].cast("string"))

    def describe(review: Column) -> Column:
        named = {field: V.DOCUMENT_REVIEW_NAMES.get(field, field) for field in V.REVIEW_FIELDS}
        fields = df.schema["reviews"].dataType.elementType.fieldNames()
        return F.concat_ws(
            "|",
            *[
                review[named[field] if named[field] in fields else field]
                for field in (
                    "review_date",
                    "review_year",
                    "review_summary",
                    "review_positive",
                    "reviewer_name",
                    "reviewer_type",
                )
            ],
        )

    return df.select(
        *scalars,
        "total_reviews",
        F.array_join(ids, ",").alias("review_ids"),
        F.array_join(F.transform("reviews", describe), ";").alias("review_texts"),
    )


def _documents_back(made: DataFrame, schema: str, name: str) -> DataFrame:
    path = work_folder(made.sparkSession, name)
    documents.write_documents(made, path)
    back = documents.read_documents(made.sparkSession, path, schema)
    whole = {"part": 0, "parts": 1}  # what a document need not say
    return back.withColumns({name: F.coalesce(name, F.lit(n)) for name, n in whole.items()})


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    root = feeds.built_tables(spark, sf_dir)
    return builds.read_rental(spark, root), builds.read_reviews(spark, root)


#: Reviews of a row in the queries that show how long listings are split.
LOW_LIMIT = 5


def _property_documents(spark, sf_dir, limit: int) -> DataFrame:
    nested = builds.final_frame(*_tables(spark, sf_dir), limit)
    made = documents.documents(nested, V.RENTAL_COLUMNS, "id")
    back = _documents_back(made, schemas.FINAL_DOCUMENT, "final_data")
    return _flat(back, *V.RENTAL_COLUMNS, "part", "parts")


def _review_documents(spark, sf_dir, limit: int) -> DataFrame:
    nested = builds.review_documents_frame(_tables(spark, sf_dir)[1], limit)
    made = documents.documents(nested, V.REVIEWED_PROPERTY_COLUMNS, "gen_id")
    back = _documents_back(made, schemas.REVIEW_DOCUMENT, "property_data")
    return _flat(back, *V.REVIEWED_PROPERTY_COLUMNS, "part", "parts")


@query
def property_documents(spark, sf_dir):
    return _property_documents(spark, sf_dir, nest.ROW_LIMIT)


@query
def nest_by_bytes(spark, sf_dir):
    """Rows of 400 bytes of reviews or so; listings of more than 25 reviews are summed up in
    ranges."""
    nested = builds.final_frame(*_tables(spark, sf_dir), max_bytes=400, bucket_rows=25)
    return _flat(nested, *V.RENTAL_COLUMNS, "part", "parts")


@query
def document_index(spark, sf_dir):
    """All documents, fetched one by one from files of many by their place in the index."""
    nested = builds.final_frame(*_tables(spark, sf_dir))
    made = documents.documents(nested, V.RENTAL_COLUMNS, "id")
    path = work_folder(spark, "indexed")
    index = documents.write_indexed(made, path, f"{path}-index", shard_bytes=100_000)
    fetched = documents.fetch(index, index)
    read = fetched.select(F.from_json("document", schemas.FINAL_DOCUMENT).alias("d")).select("d.*")
    whole = {"part": 0, "parts": 1}
    read = read.withColumns({name: F.coalesce(name, F.lit(n)) for name, n in whole.items()})
    return _flat(read, *V.RENTAL_COLUMNS, "part", "parts")


@query
def review_documents(spark, sf_dir):
    return _review_documents(spark, sf_dir, nest.ROW_LIMIT)


@query
def property_documents_in_parts(spark, sf_dir):
    return _property_documents(spark, sf_dir, LOW_LIMIT)


@query
def review_documents_in_parts(spark, sf_dir):
    return _review_documents(spark, sf_dir, LOW_LIMIT)


@query
def doc_key(spark, sf_dir):
    key = names.document_key(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", key.alias("doc_key"))


def _heavy(rental: DataFrame, reviews: DataFrame) -> DataFrame:
    """With bounds so low that some ids of the test tables are heavy."""
    return skew.heavy_keys(rental, reviews, "id", "gen_id", share_rows=40, share_pairs=200)


@query
def combined_view(spark, sf_dir):
    both = _tables(spark, sf_dir)
    return joins.combined_view(*both, _heavy(*both))


@query
def combined_sql(spark, sf_dir):
    """Free SQL over the registered view."""
    builds.register_combined_view(spark, feeds.built_tables(spark, sf_dir))
    return spark.sql(
        "SELECT meal_plan, review_language, count(*) AS rows,"
        " round(avg(review_individual_score), 2) AS avg_score"
        " FROM property_combined GROUP BY meal_plan, review_language"
    )


@query
def row_count(spark, sf_dir):
    return tables.row_count(table(spark, sf_dir, "lineitem"))


@query
def schema_table(spark, sf_dir):
    return tables.schema_table(table(spark, sf_dir, "lineitem"))


# --- extraction and derivation -------------------------------------------------------


@query
def extract_details(spark, sf_dir):
    return extract.extract_details(feeds.details(spark, sf_dir))


@query
def extract_search(spark, sf_dir):
    return extract.extract_search(feeds.search(spark, sf_dir))


@query
def flatten_properties(spark, sf_dir):
    return extract.flatten_properties(feeds.details(spark, sf_dir))


@query
def explode_reviews_outer(spark, sf_dir):
    return extract.explode_reviews(feeds.reviews(spark, sf_dir))


@query
def preferred_name(spark, sf_dir):
    name = names.preferred_name(F.col("name"))
    return feeds.details(spark, sf_dir).select("url", name.alias("name"))


@query
def slug_ascii(spark, sf_dir):
    slug = names.slug_ascii(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", slug.alias("slug"))


@query
def slug_word(spark, sf_dir):
    slug = names.slug_word(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", slug.alias("slug"))


@query
def quality_flag_rental(spark, sf_dir):
    label = quality.rental_quality(F.col("property_name"), F.col("country_code"))
    return extract_details(spark, sf_dir).select("source_id", "country_code", label.alias("flag"))


@query
def quality_flag_reviews(spark, sf_dir):
    columns = ("property_name", "raw_country", "star_rating_raw", "review_score_raw")
    label = quality.reviews_quality(*[F.col(c) for c in columns])
    return flatten_properties(spark, sf_dir).select("source_id", label.alias("flag"))


@query
def rental_property(spark, sf_dir):
    return builds.rental_frames(feeds.details(spark, sf_dir), feeds.search(spark, sf_dir))[0]


@query
def enrich_reviews(spark, sf_dir):
    joined = joins.properties_left_reviews(
        flatten_properties(spark, sf_dir), explode_reviews_outer(spark, sf_dir)
    )
    return standardize.enrich_reviews(joined).select(
        "source_id",
        "gen_id",
        "feed_provider_id",
        "property_slug",
        "country_code",
        "currency",
        "star_rating",
        "review_score",
        "published",
        "data_quality_flag",
        "review_id",
    )


@query
def property_reviews(spark, sf_dir):
    return builds.reviews_frame(feeds.details(spark, sf_dir), feeds.reviews(spark, sf_dir))


@query
def with_created_time(spark, sf_dir):
    at = F.lit("2024-06-01 12:00:00").cast("timestamp_ntz")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return standardize.with_created_time(orders, at)


@query
def raw_property_view(spark, sf_dir):
    return extract.raw_property_view(feeds.details(spark, sf_dir))


@query
def raw_reviews_view(spark, sf_dir):
    return extract.raw_reviews_view(feeds.reviews(spark, sf_dir))


@query
def raw_search_view(spark, sf_dir):
    return extract.raw_search_view(feeds.search(spark, sf_dir))


# --- filters, joins, copies ----------------------------------------------------------


@query
def clean_missing_key(spark, sf_dir):
    return extract.clean_missing_key(extract_details(spark, sf_dir))


@query
def dedup_key(spark, sf_dir):
    return dedup.dedup(clean_missing_key(spark, sf_dir), ["source_id"], for_join=True)


@query
def rental_matched(spark, sf_dir):
    return joins.rental_matched(dedup_key(spark, sf_dir), extract_search(spark, sf_dir))


@query
def rental_unmatched(spark, sf_dir):
    return joins.rental_unmatched(dedup_key(spark, sf_dir), extract_search(spark, sf_dir))


@query
def properties_left_reviews(spark, sf_dir):
    """Orders as properties, line items as reviews."""
    properties = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("source_id"), "o_custkey"
    )
    reviews = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("source_id_r"), "l_linenumber", "l_quantity"
    )
    return joins.properties_left_reviews(properties, reviews)


@query
def join_tables(spark, sf_dir):
    both = _tables(spark, sf_dir)
    return joins.join_tables(*both, _heavy(*both))


@query
def dedup_reviews(spark, sf_dir):
    return dedup.dedup(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dedup_joined(spark, sf_dir):
    return joins.join_tables_deduplicated(*_tables(spark, sf_dir))


@query
def property_base(spark, sf_dir):
    columns = (
        "id",
        "property_name",
        "country_code",
        "currency",
        "usd_price",
        "commission",
        "meal_plan",
        "published",
    )
    return joins.property_base(*_tables(spark, sf_dir), columns)


# --- nesting and counts --------------------------------------------------------------


@query
def nest_reviews(spark, sf_dir):
    nested = builds.final_frame(*_tables(spark, sf_dir))
    return _flat(nested, *V.RENTAL_COLUMNS, "part", "parts")


@query
def nest_orders(spark, sf_dir):
    """Orders nested per customer, hot customers split if there were any."""
    orders = table(spark, sf_dir, "orders")
    hot = nest.hot_groups(orders, "o_custkey")
    if hot is None:
        orders = orders.withColumn("part", F.lit(0))
    else:
        orders = nest.deal(orders, "o_custkey", "o_orderkey", hot)
    nested = nest.nest(
        orders, ["o_custkey", "part"], fields=["o_orderkey", "o_orderdate", "o_totalprice"], present="o_orderkey"
    )
    keys = F.transform("reviews", lambda r: r["o_orderkey"].cast("string"))
    return nested.select(
        "o_custkey",
        "part",
        nest.total_reviews().alias("total"),
        F.array_join(keys, ",").alias("order_keys"),
    )


@query
def audit_counts(spark, sf_dir):
    return audit.audit_counts(extract_details(spark, sf_dir), extract_search(spark, sf_dir))


@query
def build_counts(spark, sf_dir):
    """The counts that the rental build returns."""
    root = work_folder(spark, "counted")
    counts = builds.build_rental(feeds.details(spark, sf_dir), feeds.search(spark, sf_dir), root)
    rows = [
        F.struct(F.lit(name).alias("name"), F.lit(n).cast("long").alias("n"))
        for name, n in counts.items()
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


# --- reports -------------------------------------------------------------------------


def _report(report) -> Query:
    return lambda spark, sf_dir: report(*_tables(spark, sf_dir))


_QUERIES.update({name: _report(report) for name, report in reports.ALL.items()})


_QUERIES["report_cube"] = _report(reports.report_cube)


# --- upkeep --------------------------------------------------------------------------

CUTOFF = datetime(1998, 1, 1)


def _snapshots(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("table_name"),
        F.col("o_orderkey").alias("snapshot_id"),
        F.col("o_orderdate").alias("committed_at"),
        F.concat(F.lit("manifest/"), "o_orderkey").alias("manifest_list"),
    )


def _listing(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("data/"), "o_orderkey").alias("path"),
        F.col("o_custkey").cast("string").alias("table_name"),
        F.col("o_orderdate").alias("modified_at"),
    )


def _referenced(spark, sf_dir, folder="data/"):
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit(folder), "l_orderkey").alias("path")
    )


@query
def snapshots_to_expire(spark, sf_dir):
    return maintenance.snapshots_to_expire(_snapshots(spark, sf_dir), CUTOFF).drop("manifest_list")


@query
def orphan_files(spark, sf_dir):
    return maintenance.orphan_files(_listing(spark, sf_dir), _referenced(spark, sf_dir), CUTOFF)


@query
def orphan_files_of_table(spark, sf_dir):
    """What the files hold that a written table does not name: a table is written, a partition
    replaced, its files noted, and stray files added. Rows of the strays by partition."""
    rows = table(spark, sf_dir, "lineitem")
    path, partitions = work_folder(spark, "upkept"), ["l_returnflag", "l_linestatus"]
    tables.write_table(rows, path, partitions)
    tables.write_table(_returned_open(rows).where("l_discount > 0"), path, partitions)
    stored = tables.read_table(spark, path, _ddl(rows), partitions)
    noted = kept(listing.referenced_files(stored), "noted")
    strays = rows.where("l_quantity > 40 AND l_tax > 0.05")
    strays.write.mode("append").partitionBy(*partitions).parquet(path)
    orphans = maintenance.orphan_files(
        listing.list_files(spark, path), noted, datetime(9999, 1, 1)
    )
    held = spark.read.schema(_ddl(rows)).parquet(path).withColumn("path", F.input_file_name())
    held = held.withColumn("path", F.regexp_replace(F.url_decode("path"), "^file:/+", "file:/"))
    return (
        held.join(orphans, "path", "left_semi")
        .groupBy(*partitions)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("orders"))
    )


@query
def files_to_expire(spark, sf_dir):
    """Orders as snapshots, line items as the entries of their manifests; the parts of a
    customer are files that its snapshots share."""
    snapshots = _snapshots(spark, sf_dir)
    manifests = snapshots.select("table_name", "snapshot_id", F.col("manifest_list").alias("manifest"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    file = F.concat(F.lit("data/"), "o_custkey", F.lit("/"), F.col("l_partkey") % 20)
    entries = lines.select(
        F.concat(F.lit("manifest/"), "l_orderkey").alias("manifest"), file.alias("path")
    )
    return maintenance.files_to_expire(snapshots, manifests, entries, CUTOFF)


@query
def changed_partitions(spark, sf_dir):
    """Line items, and a later state of them: a partition changed in one column, one that lost a
    copy of its rows, one gone, one new, one merely dealt anew."""
    rows, partitions = _states(spark, sf_dir)
    old, new = rows
    return tables.changed_partitions(old, new, partitions)


def _states(spark, sf_dir):
    month = F.date_format("l_shipdate", "yyyy-MM").alias("month")
    rows = table(spark, sf_dir, "lineitem").select("*", month)
    twice = rows.where("l_linenumber = 1").unionAll(rows)
    n = F.month("l_shipdate") % 5
    raised = F.when((n == 0) & (F.col("l_partkey") % 7 == 0), F.col("l_tax") + 1)
    later = twice.where(~n.isin(1, 2)).unionAll(rows.where(n == 1))
    later = later.withColumn("l_tax", F.coalesce(raised, F.col("l_tax")))
    return (twice.where(n != 3), later.repartition("l_partkey")), ["month"]


@query
def rewrite_changed(spark, sf_dir):
    """Only the partitions that are new or changed are written."""
    (old, new), partitions = _states(spark, sf_dir)
    path = work_folder(spark, "rebuilt")
    tables.write_table(old, path, partitions)
    before = kept(listing.referenced_files(tables.read_table(spark, path, _ddl(old), partitions)), "before")
    tables.rewrite_changed(spark, path, new, partitions)
    file = F.col("_metadata.file_path")
    stored = spark.read.schema(_ddl(old)).parquet(path).withColumn("path", file)
    same = before.withColumn("untouched", F.lit(1))
    counted = stored.join(same, "path", "left").groupBy("month").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_tax").cast("decimal(12,2)")).cast("double").alias("tax"),
        (F.count("untouched") == F.count(F.lit(1))).alias("untouched"),
    )
    return counted


@query
def maintenance_plan(spark, sf_dir):
    return maintenance.maintenance_plan(
        _snapshots(spark, sf_dir), _listing(spark, sf_dir), _referenced(spark, sf_dir), CUTOFF
    )


@query
def table_health(spark, sf_dir):
    newest = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.max("o_orderkey").alias("newest"))
    )
    segment, home = F.col("c_mktsegment"), F.concat(F.lit("warehouse/"), "c_custkey")
    customers = table(spark, sf_dir, "customer").join(
        newest, F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    stored = customers.select(
        F.col("c_custkey").cast("string").alias("table_name"),
        home.alias("expected_location"),
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("old/"), "c_custkey"))
        .otherwise(home)
        .alias("location"),
        F.when(segment == "MACHINERY", None)
        .when(segment == "BUILDING", -F.col("newest"))
        .otherwise(F.col("newest"))
        .alias("current_snapshot_id"),
    )
    health = maintenance.table_health(
        stored, _snapshots(spark, sf_dir), _referenced(spark, sf_dir, "manifest/")
    )
    return health.select("table_name", F.concat_ws(" | ", "reasons").alias("reasons"))
