"""Change logs and versions: apply changes, keep history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import content_key
from sievework.operators.dedup import latest_by
from sievework.operators.frames import _placed, as_of_join
from sievework.operators.joins import one_row_per_key
from sievework.operators.order import SortKey
from sievework.session import through_storage
from sievework.sinks.publish import null_safe, read_table, replace_partitions


def apply_changes(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str], sequence: str, kind: str,
                  delete: str = "D") -> DataFrame:
    """Snapshot plus change log: the newest change per key wins, deletions remove the key.

    ``sequence`` has to be unique per key within the log.
    """
    cols = snapshot.columns
    base = snapshot.withColumns({"_seq": F.lit(None).cast(changes.schema[sequence].dataType), "_kind": F.lit("S")})
    log = changes.select(*cols, F.col(sequence).alias("_seq"), F.col(kind).alias("_kind"))
    newest = latest_by(base.unionByName(log), keys, "_seq", [SortKey("_kind")])
    return newest.filter(F.col("_kind") != delete).select(*cols)


def version_history(log: DataFrame, keys: Sequence[str], stamp: str, attributes: Sequence[str], ended: str | None = None,
                    slices: int | None = None) -> DataFrame:
    """Validity periods per key: valid_from, valid_to (NULL while current), is_current, version_key.

    Consecutive entries without a change of the attributes are one version.  ``stamp`` is unique per key.  Where the boolean
    ``ended`` is true, the key ends: its version closes and no other begins.

    The log is put in order once.  A slice knows the state before its first row and the first change after its last one from one row
    per (key, slice).
    """
    state = F.struct(*attributes)
    if ended is not None:
        state = F.when(~F.coalesce(F.col(ended), F.lit(False)), state)
    # A struct around the state tells an ended key from no row at all.
    rows = log.select(*keys, F.col(stamp), F.struct(state.alias("v")).alias("_state"))
    placed = _placed(rows, keys, [F.col(stamp)], slices)
    here = Window.partitionBy("_group", "_slice").orderBy("_id")
    inner = placed.withColumn("_lag", F.lag("_state").over(here))
    changes = F.col("_lag").isNotNull() & ~F.col("_lag").eqNullSafe(F.col("_state"))
    summary = inner.groupBy("_group", "_slice").agg(
        F.min_by(F.struct("_state", F.col(stamp).alias("at")), "_id").alias("_first"), F.max_by("_state", "_id").alias("_last"),
        F.min(F.when(changes, F.col(stamp))).alias("_change"))
    along = Window.partitionBy("_group").orderBy("_slice")
    summary = summary.withColumn("_before", F.lag("_last").over(along))
    # Does the first row of the slice change something?  If so it is the slice's first change.
    opens = F.coalesce(~F.col("_before").eqNullSafe(F.col("_first._state")), F.lit(True))
    summary = summary.withColumn("_change", F.when(opens, F.col("_first.at")).otherwise(F.col("_change")))
    # What follows is looked for in the opposite order: Spark computes a frame up to the last row anew for every row.
    back = Window.partitionBy("_group").orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select("_group", "_slice", "_before", F.last("_change", True).over(back).alias("_after"))
    known = placed.join(summary, ["_group", "_slice"]).withColumn("_lag", F.coalesce(F.lag("_state").over(here), F.col("_before")))
    known = known.withColumn("_new", F.col("_lag").isNull() | ~F.col("_lag").eqNullSafe(F.col("_state")))
    upwards = Window.partitionBy("_group", "_slice").orderBy(F.desc("_id")).rowsBetween(Window.unboundedPreceding, -1)
    following = F.min(F.when(F.col("_new"), F.col(stamp))).over(upwards)
    dated = known.withColumn("valid_to", F.coalesce(following, F.col("_after"))).where(F.col("_new") & F.col("_state.v").isNotNull())
    return dated.select(
        *keys, *[F.col(f"_state.v.{a}").alias(a) for a in attributes], F.col(stamp).alias("valid_from"), "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
        content_key(*[F.col(k) for k in keys], F.col(stamp)).alias("version_key"))


def with_versions(fact: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, slices: int | None = None) -> DataFrame:
    """Each fact with the version of its key that is valid at its time; NULLs where none is.

    ``versions`` are as ``version_history`` gives them: of a key, one at a time is valid, from valid_from up to before valid_to.
    """
    payload = [c for c in versions.columns if c not in keys]
    found = as_of_join(fact, versions, keys, at, "valid_from", slices=slices)
    valid = F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to"))
    return found.withColumns({c: F.when(valid, F.col(c)) for c in payload if c != "valid_to"}).withColumn("valid_to", F.when(valid, F.col("valid_to")))


#: Column of a version table that names the folder a key lies in.
BUCKET = "bucket"


def versions_path(path: str) -> str:
    """Where ``merge_versions`` keeps the versions; the entries they are made from lie beside them."""
    return f"{path.rstrip('/')}/versions"


def _changed_folders(versions: DataFrame, old: DataFrame) -> DataFrame:
    """Folders whose rows differ, by their number and 128 bits of hashes, so that no version is shuffled.

    A version occurs once, so hashes that are combined by XOR do not cancel.  NULLs leave a hash alone and are told apart by a list of their own.
    """
    values = [F.array(*[F.col(c).isNull() for c in versions.columns]), *[F.col(c) for c in versions.columns]]
    marks = [F.count(F.lit(1)).alias("rows"), *[F.bit_xor(F.xxhash64(F.lit(k), *values)).alias(f"hash{k}") for k in (1, 2)]]
    told = versions.groupBy(BUCKET).agg(*marks).unionByName(old.groupBy(BUCKET).agg(*marks))
    return told.groupBy(BUCKET, "rows", "hash1", "hash2").agg(F.count(F.lit(1)).alias("sides")).where("sides < 2").select(BUCKET).distinct()


def merge_versions(batch: DataFrame, path: str, keys: Sequence[str], stamp: str, attributes: Sequence[str], buckets: int, ended: str | None = None) -> int:
    """Merge a batch of entries into the dimension at ``path``; returns how many folders of versions were rewritten.

    Keys are dealt to ``buckets`` folders by a hash; take so many that a folder is one task's work.  Only folders with an entry that
    is new are read and rewritten.  Entries may be older than what is known: all entries are kept, also those
    that changed nothing when they came, because a late entry before them turns them into changes.  An entry for a time that is known
    replaces it; two entries of a key for one time in one batch stop the job.  The same batch again rewrites nothing.
    Versions are written before the entries that explain them, so a run that stops is repeated as a whole.
    """
    spark = batch.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)
    gone = (F.coalesce(F.col(ended), F.lit(False)) if ended else F.lit(False)).alias("_ended")
    news = one_row_per_key(batch.select(*keys, stamp, *attributes, gone), [*keys, stamp], "batch of versions").select(*keys, stamp, *attributes, "_ended", bucket)
    news = through_storage(news, "version-batch")
    known = read_table(spark, f"{path.rstrip('/')}/entries", news.schema).select(*news.columns)
    known = null_safe(known, news.select(BUCKET).distinct(), [BUCKET], "left_semi")
    fresh = through_storage(null_safe(news, known, news.columns, "left_anti"), "versions-fresh")
    folders = through_storage(fresh.select(BUCKET).distinct(), "versions-folders")
    if folders.isEmpty():
        return 0
    mine = null_safe(null_safe(known, folders, [BUCKET], "left_semi"), fresh, [*keys, stamp], "left_anti").unionByName(fresh)
    entries = through_storage(mine, "versions-entries")
    versions = version_history(entries, keys, stamp, attributes, "_ended").withColumn(BUCKET, bucket)
    versions = through_storage(versions, "versions-merged")
    old = read_table(spark, versions_path(path), versions.schema).select(*versions.columns)
    changed = through_storage(_changed_folders(versions, null_safe(old, folders, [BUCKET], "left_semi")), "versions-changed")
    replace_partitions(null_safe(versions, changed, [BUCKET], "left_semi"), versions_path(path), [BUCKET], rerun=changed, stored=True)
    replace_partitions(entries, f"{path.rstrip('/')}/entries", [BUCKET])
    return changed.count()
