"""Increments that find every changed day without reading history, however late its rows are.

Deliveries land in partitions by day and batch.  With each batch goes a small ledger: rows and a sum of row hashes per day.  A day has
to be rebuilt when what has landed for it differs from what was published of it, so rows that come years late are
found from the ledger, and a batch that lands again changes nothing.  Only the partitions of changed days are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.session import through_storage
from sievework.sinks.publish import _partition_dir, null_safe, read_table, replace_partitions
from sievework.streaming.streams import last_delivery

_FILES = T.StructType([T.StructField("file", T.StringType()), T.StructField("batch", T.LongType())])
_DAYS = T.StructType([T.StructField("day", T.DateType()), T.StructField("rows", T.LongType()), T.StructField("hashes", T.DecimalType(38, 0)),
                      T.StructField("high", T.TimestampNTZType()), T.StructField("too_late", T.LongType()), T.StructField("batch", T.LongType())])
_PUBLISHED = T.StructType([T.StructField("run", T.LongType()), T.StructField("day", T.DateType()), T.StructField("rows", T.LongType()),
                           T.StructField("hashes", T.DecimalType(38, 0))])
#: Folders of changed days that are named one by one; more of them are found by a join with all that landed.
LISTED_FOLDERS = 4000


@dataclass(frozen=True)
class Landing:
    """What has arrived and what has been published of it, below ``root``.  ``schema`` is that of the rows; they have no columns day and batch."""

    spark: SparkSession
    root: str
    schema: T.StructType
    event_time: str
    lateness: timedelta = timedelta(0)

    # --- arrival ---

    def land(self, rows: DataFrame, batch: int) -> None:
        """Store a batch; the same batch again replaces itself.  Rows without an event time have the day NULL.

        Rows whose day ends before ``lateness`` behind all that arrived in earlier batches are counted as too late; they land like others.
        """
        high = self.days().where(F.col("batch") < batch).agg(F.max("high")).first()[0]
        kept = rows.select(*self.schema.fieldNames(), F.to_date(self.event_time).alias("day"))
        path = f"{self._path('landed')}/batch={batch}"
        kept.hint("rebalance", F.col("day")).write.mode("overwrite").partitionBy("day").parquet(path)
        kept = self.spark.read.schema(kept.schema).parquet(path)
        hashed = F.pmod(F.xxhash64(*self.schema.fieldNames()), F.lit(1 << 31))
        late = F.col("day") < F.to_date(F.lit(high - self.lateness)) if high is not None else F.lit(False)
        told = kept.groupBy("day").agg(F.count(F.lit(1)).alias("rows"), F.sum(hashed).cast("decimal(38,0)").alias("hashes"),
                                       F.max(F.col(self.event_time).cast("timestamp_ntz")).alias("high"),
                                       F.count_if(F.coalesce(late, F.lit(False))).alias("too_late"))
        told.select(*[f for f in _DAYS.fieldNames() if f != "batch"]).coalesce(1).write.mode("overwrite").parquet(f"{self._path('days')}/batch={batch}")

    def land_new_files(self, folder: str) -> int | None:
        """Land the Parquet files below ``folder`` that no batch has landed yet, as one batch; None if there are none.

        Which files are new comes from their names, so no row of an old file is read.  The names are noted
        last: a run that stops before that lands the same files again, as the same batch.
        """
        known = self._read("files", _FILES)
        listed = self.spark.createDataFrame([(f,) for f in self.spark.read.schema(self.schema).parquet(folder).inputFiles()], "file string")
        new = [r.file for r in listed.join(known, "file", "left_anti").orderBy("file").collect()]
        if not new:
            return None
        batch = (known.agg(F.max("batch")).first()[0] or 0) + 1
        self.land(self.spark.read.schema(self.schema).parquet(*new), batch)
        self.spark.createDataFrame([(f, batch) for f in new], _FILES).coalesce(1).write.mode("append").parquet(self._path("files"))
        return batch

    # --- publication ---

    def changed_days(self) -> DataFrame:
        """(day, rows, hashes) of the days whose landed rows differ from those published."""
        landed = self.days().groupBy("day").agg(F.sum("rows").alias("rows"), F.sum("hashes").cast("decimal(38,0)").alias("hashes"))
        newest = F.max_by(F.struct("rows", "hashes"), "run")
        done = self._read("published", _PUBLISHED).groupBy("day").agg(newest.alias("p")).select("day", "p.*")
        gone = null_safe(done.where("rows > 0"), landed, ["day"], "left_anti").select("day", F.lit(0).cast("long").alias("rows"), F.lit(0).cast("decimal(38,0)").alias("hashes"))
        return null_safe(landed, done, ["day", "rows", "hashes"], "left_anti").unionByName(gone)

    def publish(self, summarise: Callable[[DataFrame], DataFrame], path: str, keys: Sequence[str] = ()) -> int:
        """Rebuild every changed day at ``path`` from all its landed rows; returns how many days that were.

        With ``keys``, a row delivered in several batches counts once, as its last batch has it.  Days are noted
        after they have been published, so a run that stops repeats them.
        """
        changed = through_storage(self.changed_days(), "changed-days")
        n = changed.count()
        if not n:
            return 0
        # The ledger says in which folders rows of the changed days lie, so no other folder is even listed.
        parts = null_safe(self.days(), changed, ["day"], "left_semi").select("batch", "day").limit(LISTED_FOLDERS + 1).collect()
        if not parts:  # nothing is left of these days
            rows = self.spark.createDataFrame([], self._layout())
        elif len(parts) <= LISTED_FOLDERS:
            top = self._path("landed")
            rows = (self.spark.read.schema(self._layout()).option("basePath", top)
                    .parquet(*[_partition_dir(top, {"batch": r.batch, "day": r.day}) for r in parts]).select(*self._layout().fieldNames()))
        else:
            rows = null_safe(self._read("landed", self._layout()), changed, ["day"], "left_semi")
        if keys:
            rows = last_delivery(rows, keys)
        replace_partitions(summarise(rows.drop("batch")), path, ["day"], rerun=changed.select("day"))
        run = (self._read("published", _PUBLISHED).agg(F.max("run")).first()[0] or 0) + 1
        changed.select(F.lit(run).cast("long").alias("run"), "day", "rows", "hashes").coalesce(1).write.mode("append").parquet(self._path("published"))
        return n

    def days(self) -> DataFrame:
        """The ledger: a row per day and batch."""
        return self._read("days", _DAYS)

    def _layout(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("batch", T.LongType()), T.StructField("day", T.DateType())])

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        return read_table(self.spark, self._path(name), schema).select(*schema.fieldNames())
