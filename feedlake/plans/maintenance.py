"""Table upkeep as queries over metadata tables: what to expire, remove or repair.

They name what should go; nothing is deleted here.
"""

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake import fixed_values as V
from feedlake.operators.dedup import distinct_keys
from feedlake.workspace import kept


def cutoff_time(older_than: datetime | str | None = None) -> datetime:
    """`older_than` in UTC, a time without zone being UTC; by default one day ago."""
    if older_than is None:
        return datetime.now(UTC) - timedelta(days=V.RETENTION_DAYS)
    moment = datetime.fromisoformat(older_than) if isinstance(older_than, str) else older_than
    return moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)


def _before(df: DataFrame, column: str, older_than: datetime | str | None) -> Column:
    """`column` is earlier than the cutoff. A column without zone is taken to hold UTC."""
    cutoff = cutoff_time(older_than)
    if dict(df.dtypes)[column] == "timestamp_ntz":
        return F.col(column) < F.lit(f"{cutoff:%Y-%m-%d %H:%M:%S.%f}").cast("timestamp_ntz")
    return F.col(column) < F.lit(cutoff)


def snapshots_to_expire(
    snapshots: DataFrame,
    older_than: datetime | str | None = None,
    retain_last: int = V.RETAIN_LAST,
) -> DataFrame:
    """Snapshots (table_name, snapshot_id, committed_at) older than the cutoff, without the
    newest `retain_last` of each table.

    The newest ones are found with a top-k per table, which Spark already applies before the
    shuffle, so a table with a third of all snapshots sends only k of them per task.
    """
    newest_first = Window.partitionBy("table_name").orderBy(
        F.desc("committed_at"), F.desc("snapshot_id")
    )
    retained = (
        snapshots.withColumn("_age", F.row_number().over(newest_first))
        .where(F.col("_age") <= retain_last)
        .select(F.col("table_name").alias("_table"), F.col("snapshot_id").alias("_snapshot"))
    )
    old = snapshots.where(_before(snapshots, "committed_at", older_than))
    kept = F.col("table_name").eqNullSafe(F.col("_table")) & F.col("snapshot_id").eqNullSafe(
        F.col("_snapshot")
    )
    return old.join(retained, kept, "left_anti")


def files_to_expire(
    snapshots: DataFrame,
    manifests: DataFrame,
    entries: DataFrame,
    older_than: datetime | str | None = None,
    retain_last: int = V.RETAIN_LAST,
) -> DataFrame:
    """What goes with the snapshots that `snapshots_to_expire` names: (table_name, kind, target),
    a row for each manifest and each file that no other snapshot reaches.

    manifests: table_name, snapshot_id, manifest; entries: manifest, path. Snapshots share
    manifests, and manifests share files, also between tables. What any snapshot reaches that
    does not expire is kept, even one that `snapshots` does not list; so are the files of a
    manifest that none is known to hold. A manifest that several tables hold is named for
    each. Nulls reach nothing.
    """
    expired = snapshots_to_expire(snapshots, older_than, retain_last).select(
        F.col("table_name").alias("_table"), F.col("snapshot_id").alias("_snapshot")
    )
    of_expired = F.col("table_name").eqNullSafe(F.col("_table")) & F.col(
        "snapshot_id"
    ).eqNullSafe(F.col("_snapshot"))
    held = manifests.where(F.col("manifest").isNotNull())
    # Each side is made distinct in part before it moves: a manifest may be in all snapshots.
    still = distinct_keys(held.join(expired, of_expired, "left_anti"), "manifest")
    named = held.join(expired, of_expired, "left_semi").select("table_name", "manifest").distinct()
    gone = kept(named.join(still, "manifest", "left_anti"), "gone")
    listed = entries.where(F.col("path").isNotNull()).select("manifest", "path")
    used = distinct_keys(
        listed.join(distinct_keys(gone, "manifest"), "manifest", "left_anti"), "path"
    )
    files = listed.join(gone, "manifest").select("table_name", "path").distinct()
    files = files.join(used, "path", "left_anti")
    return gone.select("table_name", F.lit("manifest").alias("kind"), F.col("manifest").alias("target")).unionAll(
        files.select("table_name", F.lit("file"), "path")
    )


def orphan_files(
    listing: DataFrame, referenced: DataFrame, older_than: datetime | str | None = None
) -> DataFrame:
    """Files (path, modified_at, ...) older than the cutoff that no `referenced` path names."""
    old = listing.where(_before(listing, "modified_at", older_than))
    return old.join(referenced.select("path").distinct(), "path", "left_anti")


def maintenance_plan(
    snapshots: DataFrame,
    listing: DataFrame,
    referenced: DataFrame,
    older_than: datetime | str | None = None,
    retain_last: int = V.RETAIN_LAST,
) -> DataFrame:
    """(table_name, action, target) for all tables at once, from metadata of all tables."""
    cutoff = cutoff_time(older_than)

    def actions(df: DataFrame, action: str, target: str) -> DataFrame:
        named = F.col(target).cast("string").alias("target")
        return df.select("table_name", F.lit(action).alias("action"), named)

    expire = snapshots_to_expire(snapshots, cutoff, retain_last)
    orphans = orphan_files(listing, referenced, cutoff)
    return actions(expire, "expire_snapshot", "snapshot_id").unionAll(
        actions(orphans, "remove_orphan_file", "path")
    )


def _without_edge_slash(path: Column) -> Column:
    return F.regexp_replace(path, r"(?<=.)/+$", "")


def table_health(tables: DataFrame, snapshots: DataFrame, files: DataFrame) -> DataFrame:
    """Each table with the `reasons` (an array, empty if healthy) for which it needs repair.

    tables: table_name, location, expected_location, current_snapshot_id;
    snapshots: table_name, snapshot_id, manifest_list; files: path.
    """
    known = snapshots.groupBy("table_name", "snapshot_id").agg(
        F.min("manifest_list").alias("manifest_list")
    )
    present = distinct_keys(files, "path").withColumnRenamed("path", "_path")
    current = tables.join(
        known.withColumnsRenamed({"table_name": "_table", "snapshot_id": "_snapshot"}),
        (F.col("table_name") == F.col("_table"))
        & (F.col("current_snapshot_id") == F.col("_snapshot")),
        "left",
    )
    checked = current.join(present, F.col("manifest_list") == F.col("_path"), "left")

    actual = _without_edge_slash(F.col("location"))
    expected = _without_edge_slash(F.col("expected_location"))
    snapshot, manifest = F.col("current_snapshot_id"), F.col("manifest_list")
    reasons = F.array_compact(
        F.array(
            F.when(
                (actual != "") & (actual != expected),
                F.concat(
                    F.lit("metadata location points to "), actual, F.lit(", expected "), expected
                ),
            ),
            F.when(
                snapshot.isNotNull() & F.col("_snapshot").isNull(),
                F.concat(
                    F.lit("current snapshot "),
                    snapshot.cast("string"),
                    F.lit(" is missing from metadata"),
                ),
            ),
            F.when(
                (manifest != "") & F.col("_path").isNull(),
                F.concat(F.lit("manifest list is missing: "), manifest),
            ),
        )
    )
    return checked.select("table_name", reasons.alias("reasons"))
