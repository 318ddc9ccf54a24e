"""Chat formatting of logged conversations, after cumulative snapshots are collapsed.

A log often holds a conversation again each time it has grown. Every turn gets a hash of its
position, role and text, and every prefix of a conversation the sum of the hashes of its turns.
A conversation whose own sum is that of a shorter prefix of another is a snapshot of it and goes.

All turns are sorted once, in ranges, and written with their place. What a conversation has in one
range is a block: running sums are made within each block, then over the blocks of a
conversation. A conversation that holds a third of all turns is so dealt to many tasks, also if
its turns have no numbers. Only ids, places and hashes take part in that; texts are joined last.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.frames import written

#: Turns that are one part when rendered.
BLOCK = 4096
#: The bits of a place from here on tell the range.
RANGE_BITS = 33
#: How a turn is rendered, in the order of the text.
BEFORE_ROLE, AFTER_ROLE, AFTER_TEXT = "<|im_start|>", "\n", "<|im_end|>\n"


def prefixes(turns: DataFrame) -> DataFrame:
    """Adds position (from 1), n_turns and prefix (a hash of all turns up to this one).

    turns: conv_id, turn, role, text; other columns are dropped. Turns are in the order of turn,
    null first, then of role and text. Null roles and texts are empty ones. Turns without
    conv_id are one conversation. Rows that repeat a turn are turns of their own.
    """
    said = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),  # parts even equal turns
    )
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "row"]
    ranges = said.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    digest = F.md5(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"))
    rows = ranges.withColumns({"place": F.monotonically_increasing_id(), "digest": digest})
    rows = written(rows, "turns")
    block = ["conv_id", "block"]
    rows = rows.withColumn("block", F.shiftright("place", RANGE_BITS))
    sizes = rows.groupBy(*block).agg(F.count("*").alias("size"), F.min("place").alias("first"))
    # Positions first, as the hash of a turn holds its position.
    rows = _before(rows, sizes, "earlier_turns", "long", "first").withColumn(
        "position", F.col("earlier_turns") + F.col("place") - F.col("first") + 1
    )
    rows = rows.withColumn("hash", _hash(F.col("position"), F.col("digest")))
    sums = rows.groupBy(*block).agg(F.sum("hash").alias("size"))
    within = F.sum("hash").over(
        Window.partitionBy(*block).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    )
    rows = _before(rows, sums, "earlier_hashes", "decimal(38,0)").withColumn(
        "prefix", F.col("earlier_hashes") + within
    )
    lengths = sizes.groupBy("conv_id").agg(F.sum("size").alias("n_turns"))
    rows = _same(rows, lengths, ["conv_id"])
    return rows.select("conv_id", "turn", "role", "text", "position", "n_turns", "prefix")


def _hash(position: Column, digest: Column) -> Column:
    """96 bits of an MD5 sum as a number; a billion of them add up without overflow."""
    digits = F.md5(F.concat_ws("\n", position.cast("string"), digest))
    high, low = (
        F.conv(F.substring(digits, at, 12), 16, 10).cast("decimal(15,0)") for at in (1, 13)
    )
    return high * F.lit(16**12).cast("decimal(15,0)") + low


def _before(rows: DataFrame, blocks: DataFrame, name: str, kind: str, *more: str) -> DataFrame:
    """Adds the sum of `size` over the earlier blocks of each row's conversation, and `more`
    columns of its block."""
    earlier = (
        Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    total = F.coalesce(F.sum("size").over(earlier), F.lit(0)).cast(kind)
    offsets = blocks.select("conv_id", "block", total.alias(name), *more)
    return _same(rows, offsets, ["conv_id", "block"])


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys that may be null, which are kept once."""
    renamed = right.withColumnsRenamed({key: f"same_{key}" for key in keys})
    met = F.lit(True)
    for key in keys:
        met = met & F.col(key).eqNullSafe(F.col(f"same_{key}"))
    return left.join(renamed, met, how).drop(*[f"same_{key}" for key in keys])


def maximal(turns: DataFrame) -> DataFrame:
    """The turns, as `prefixes` gives them, of the conversations that no longer one begins with.

    Of equal conversations the one with the smallest conv_id stays, null last.
    """
    rows = prefixes(turns)
    begins = written(rows.select("conv_id", "position", "n_turns", "prefix"), "prefixes")
    whole = (
        begins.where(F.col("position") == F.col("n_turns"))
        .groupBy("n_turns", "prefix")
        .agg(F.min("conv_id").alias("conv_id"))
    )
    begun = begins.where(F.col("position") < F.col("n_turns")).select(
        F.col("position").alias("n_turns"), "prefix"
    )
    kept = whole.join(begun.distinct(), ["n_turns", "prefix"], "left_anti").select("conv_id")
    return _same(rows, kept, ["conv_id"])


def rendered(turns: DataFrame) -> DataFrame:
    """The maximal conversations as text for training.

    Returns conv_id, part, n_turns (of the part) and text. A conversation of up to BLOCK turns
    has one part, 0; a longer one has a part for every BLOCK turns, so that no row grows without
    bound. An empty table gives no rows. For null and repeated values see `prefixes`.
    """
    said = F.concat(
        F.lit(BEFORE_ROLE), "role", F.lit(AFTER_ROLE), "text", F.lit(AFTER_TEXT)
    ).alias("said")
    part = F.floor((F.col("position") - 1) / BLOCK).cast("int").alias("part")
    pieces = maximal(turns).select("conv_id", part, F.struct("position", said).alias("piece"))
    parts = pieces.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    return parts.select(
        "conv_id",
        "part",
        F.size("pieces").cast("long").alias("n_turns"),
        F.array_join(F.col("pieces.said"), "").alias("text"),
    )
