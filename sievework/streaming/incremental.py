"""Batch increments: read what is new since last time, tolerating late arrivals."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.session import through_storage
from sievework.sinks.publish import null_safe, read_table, replace_partitions

WATERMARKS = T.StructType([
    T.StructField("run", T.LongType(), False),
    T.StructField("high", T.TimestampNTZType(), False),
    # Rows too old for the next run to read again, and how many of these arrived after the run that could read them.
    T.StructField("settled", T.LongType(), True),
    T.StructField("too_late", T.LongType(), True),
])


def last_watermark(spark: SparkSession, path: str) -> tuple[int, datetime | None]:
    """Number of the last recorded run and how far it read; (0, None) before the first."""
    row = read_table(spark, path, WATERMARKS).agg(F.max_by("high", "run").alias("high"), F.max("run").alias("run")).first()
    return (row.run or 0), row.high


def last_settled(spark: SparkSession, path: str) -> int | None:
    """Settled rows as the last recorded run counted them."""
    return read_table(spark, path, WATERMARKS).agg(F.max_by("settled", "run").alias("settled")).first().settled


def rows_since(df: DataFrame, event_time: str, high: datetime | None, lateness: timedelta) -> DataFrame:
    """Rows after ``high - lateness``, and all rows without an event time.

    Rows inside the allowance are read again, so the result has to be written by
    replacing or merging, never by appending.
    """
    if high is None:
        return df
    return df.filter(F.col(event_time).isNull() | (F.col(event_time) > _instant(df, event_time, high - lateness)))


def _instant(df: DataFrame, event_time: str, value: datetime):
    return F.lit(value).cast(df.schema[event_time].dataType)


def settled_rows(df: DataFrame, event_time: str, high: datetime, lateness: timedelta) -> int:
    """Rows at or before ``high - lateness``: no later run reads them, so this number may only change by rows that came too late."""
    return df.filter(F.col(event_time) <= _instant(df, event_time, high - lateness)).count()


def record_watermark(spark: SparkSession, path: str, run: int, high: datetime, settled: int | None = None,
                     too_late: int | None = None) -> None:
    """Note how far a run has read.  Called after the data has been published."""
    spark.createDataFrame([(run, high, settled, too_late)], WATERMARKS).write.mode("append").parquet(path)


def days_to_rebuild(recent: DataFrame, event_time: str, day: str) -> DataFrame:
    """Calendar days with at least one recent row; NULL for rows without an event time."""
    return recent.select(F.to_date(event_time).alias(day)).distinct()


def rebuild_days(everything: DataFrame, recent: DataFrame, event_time: str, day: str, summarise, path: str) -> None:
    """Recompute, from all rows, each day that received a row, and swap those days in.

    Rows without an event time are published under the day NULL.

    The first and last of these days limit the scan of ``everything``.
    """
    touched = through_storage(days_to_rebuild(recent, event_time, day), "days")
    span = touched.agg(F.min(day).alias("since"), F.date_add(F.max(day), 1).alias("after")).first()
    kind = everything.schema[event_time].dataType
    nearby = everything.filter(F.col(event_time).isNull() | (F.col(event_time) >= F.lit(span.since).cast(kind))
                               & (F.col(event_time) < F.lit(span.after).cast(kind)))
    affected = null_safe(nearby.withColumn(day, F.to_date(event_time)), touched, [day], "left_semi")
    replace_partitions(summarise(affected), path, [day])


def run_increment(source: DataFrame, event_time: str, lateness: timedelta, watermarks: str, day: str, summarise,
                  path: str, count_late: bool = False) -> int:
    """One incremental run; running it again without new rows changes nothing.  Returns the run number.

    Rows without an event time are read by every run.  Rows that are older than the allowance when they arrive are
    not published.  ``count_late`` records their number with the run, for which the whole source is counted twice; where late
    rows matter, use ``landing.Landing``, which finds and publishes them from a ledger.
    """
    spark = source.sparkSession
    run, high = last_watermark(spark, watermarks)
    recent = rows_since(source, event_time, high, lateness)
    found = recent.agg(F.max(F.col(event_time).cast("timestamp_ntz")).alias("m"), F.count(F.lit(1)).alias("n")).first()
    if found.n == 0:
        return run
    reached = max(x for x in (found.m, high) if x is not None) if found.m or high else None
    rebuild_days(source, recent, event_time, day, summarise, path)
    if reached is None:  # no row has an event time yet, so there is no mark to record
        return run
    settled = too_late = None
    if count_late:
        before = last_settled(spark, watermarks) if high else None
        too_late = settled_rows(source, event_time, high, lateness) - before if before is not None else 0
        settled = settled_rows(source, event_time, reached, lateness)
    record_watermark(spark, watermarks, run + 1, reached, settled, too_late)
    return run + 1
