"""Feeds whose files hold one JSON array each, read by many tasks a file.

A file is read as text that ends at every closing brace, so Spark splits it like any other. What
a brace means depends on all text before it: how deep it is nested, and whether it stands in a
string. Both are prefix sums, of brackets and of quotes without escapes, made on two levels:
within each split from either possible start, and over the splits of a file, a few numbers
each. A record ends where a closing brace leads back to depth 1. Its pieces are put together
within the split; only the records at the edges of splits, two a split, are gathered across.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlake.workspace import kept

#: Splits whose numbers are broadcast at most: a path and six numbers each.
BROADCAST_SPLITS = 100_000
#: How much of what cannot be read is kept as text.
SHOWN = 1000

# Longest first: an escape hides what follows it, and quotes hide brackets.
ESCAPED = r"(?s)\\."
STRING = r'"[^"]*(?:"|\z)'
BEFORE_RECORD = r"^\x{FEFF}?\s*[\[,]?\s*"
REST_OF_ARRAY = r"^\x{FEFF}?\s*(?:\[\s*)?\]?\s*\}?$"

SPLIT = ["file", "block"]


def _pieces(spark: SparkSession, path) -> DataFrame:
    """The text up to each closing brace, which is left out, with its place: file, block (where
    its split begins) and number (grows within the split). A file may end without a brace."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("number"),
        "value",
    )


def _opened(text: Column) -> Column:
    """How much deeper the brackets of a text without strings lead."""
    up, down = F.regexp_count(text, F.lit(r"[\[{]")), F.regexp_count(text, F.lit(r"[\]}]"))
    return up - down


def _numbered(pieces: DataFrame) -> DataFrame:
    """quotes: parity; step and step_in: how the depth changes over a piece and the brace after
    it, if the split begins outside or within a string; parity before the piece in the first
    case. All are of the split alone."""
    plain = F.regexp_replace("value", ESCAPED, "")
    counted = pieces.withColumn("plain", plain).withColumns(
        {
            "quotes": F.regexp_count("plain", F.lit('"')) % 2,
            "bare": F.regexp_replace("plain", STRING, ""),
            "bare_in": F.regexp_replace(F.concat(F.lit('"'), "plain"), STRING, ""),
        }
    )
    # The brace counts if it is outside a string.
    outside = _opened(F.col("bare")) - F.when(F.col("quotes") == 0, 1).otherwise(0)
    within = _opened(F.col("bare_in")) - F.when(F.col("quotes") == 1, 1).otherwise(0)
    counted = counted.withColumns({"outside": outside, "within": within})
    counted = counted.drop("plain", "bare", "bare_in")
    parity = F.coalesce(F.sum("quotes").over(_earlier()), F.lit(0)) % 2
    even = F.col("parity") == 0
    return counted.withColumn("parity", parity).withColumns(
        {
            "step": F.when(even, F.col("outside")).otherwise(F.col("within")),
            "step_in": F.when(even, F.col("within")).otherwise(F.col("outside")),
        }
    )


def _earlier():
    order = Window.partitionBy(*SPLIT).orderBy("number")
    return order.rowsBetween(Window.unboundedPreceding, -1)


def _splits(numbered: DataFrame) -> DataFrame:
    """Per split: whether it begins within a string (1 or 0), its depth at the start, the depth
    its file ends at, and whether it holds the end of a file that no brace ends. A window over
    the splits of a file holds a row for each."""
    totals = numbered.groupBy(*SPLIT).agg(
        (F.sum("quotes") % 2).alias("quotes"),
        F.sum("step").alias("step"),
        F.sum("step_in").alias("step_in"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.max("file_size").alias("file_size"),
    )
    whole = Window.partitionBy("file")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    began = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2
    steps = F.when(F.col("began") == 0, F.col("step")).otherwise(F.col("step_in"))
    return (
        totals.withColumn("began", began)
        .withColumn("steps", steps)
        .withColumn("depth", F.coalesce(F.sum("steps").over(earlier), F.lit(0)))
        .withColumn("last_depth", F.sum("steps").over(whole))
        # Of a compressed file the bytes say nothing; an array does not end with a brace.
        .withColumn("open", F.sum("bytes").over(whole) != F.col("file_size"))
        .withColumn("open", F.col("open") & (F.col("block") == F.max("block").over(whole)))
        .select(*SPLIT, "began", "depth", "last_depth", "open")
    )


def _small(table: DataFrame) -> DataFrame:
    """`table`, a written one, with a broadcast hint if it is short."""
    if table.limit(BROADCAST_SPLITS + 1).count() <= BROADCAST_SPLITS:
        return F.broadcast(table)
    return table


def _joined_pieces(numbered: DataFrame, splits: DataFrame) -> DataFrame:
    """(file, block, record, finished, text): the pieces of each record within a split put
    together. record counts the records that end before it in the split."""
    placed = numbered.join(splits, SPLIT)
    here = Window.partitionBy(*SPLIT).orderBy("number")
    step = F.when(F.col("began") == 0, F.col("step")).otherwise(F.col("step_in"))
    outside = (F.col("began") + F.col("parity") + F.col("quotes")) % 2 == 0
    braced = ~(F.col("open") & F.lead("number").over(here).isNull())
    ends = braced & outside & (F.col("depth") + F.sum("moved").over(here) == 1)
    marked = placed.withColumn("moved", step).withColumn("ends", ends.cast("int"))
    counted = marked.withColumn("record", F.coalesce(F.sum("ends").over(_earlier()), F.lit(0)))
    # Grouped as the window dealt the rows, so they are not shuffled again.
    grouped = counted.groupBy(*SPLIT, "record").agg(
        F.max("ends").alias("finished"),
        F.sort_array(F.collect_list(F.struct("number", "value"))).alias("parts"),
    )
    text = F.array_join(F.transform("parts", lambda part: F.concat(part["value"], F.lit("}"))), "")
    return grouped.select(*SPLIT, "record", "finished", text.alias("text"))


def array_records(spark: SparkSession, path) -> DataFrame:
    """(text, whole) for each record of the array files at `path`: its JSON text, without what
    separates records. Where whole is false, the text is what cannot be read as a record, such
    as the end of a file that is cut short or of one that is no array; its first letters."""
    splits = _small(kept(_splits(_numbered(_pieces(spark, path))), "splits"))
    pieces = kept(_joined_pieces(_numbered(_pieces(spark, path)), splits), "pieces")
    inner = (F.col("finished") == 1) & (F.col("record") > 0)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = pieces.groupBy(*SPLIT).agg(F.sum("finished").alias("ends"))
    ends = ends.select(
        *SPLIT,
        F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("ended"),
        F.sum("ends").over(Window.partitionBy("file")).alias("all"),
    )
    ends = _small(kept(ends, "ends"))
    edges = pieces.where(~inner).join(ends, SPLIT).withColumn("record", F.col("record") + F.col("ended"))
    of_records = edges.where(F.col("record") < F.col("all"))
    across = of_records.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts")
    )
    across = across.select(F.array_join("parts.text", "").alias("text"))
    whole = pieces.where(inner).select("text").unionAll(across).select(
        F.regexp_replace("text", BEFORE_RECORD, "").alias("text"), F.lit(True).alias("whole")
    )
    # What follows the last record of a file; a whole array ends there at depth 0, and one
    # brace further, which is not in the file, at -1.
    rest = edges.where(F.col("record") == F.col("all")).select("text", F.lit(False).alias("whole"))
    rest = rest.where(~F.col("text").rlike(REST_OF_ARRAY))
    cut = splits.where("last_depth <> -1").select("file").distinct()
    cut = cut.select(F.lit("").alias("text"), F.lit(False).alias("whole"))
    shown = F.substring("text", 1, SHOWN).alias("text")
    return whole.unionAll(rest.unionAll(cut).select(shown, "whole"))


def read_array(spark: SparkSession, path, schema: str, bad: str) -> DataFrame:
    """The records of the array files at `path` with `schema`, and the column `bad`: the text
    of what does not fit it, else null.

    Files are split like JSON Lines are; compressed ones are read by a task each. Files may be
    of any layout, on one line or many. A file that is cut short or holds no array gives, besides
    the records that can be told, one row or two with `bad` alone. An empty file gives none. The
    pieces are written to a work folder, as much text as the feed has.
    """
    records = array_records(spark, path)
    options = {"columnNameOfCorruptRecord": bad}
    parsed = F.from_json("text", f"{schema}, {bad} string", options)
    text = F.when(~F.col("whole"), F.col("text")).otherwise(F.col(f"read.{bad}")).alias(bad)
    read = records.withColumn("read", F.when(F.col("whole"), parsed))
    names = [name for name in read.schema["read"].dataType.fieldNames() if name != bad]
    return read.select(*[F.col(f"read.{name}").alias(name) for name in names], text)
