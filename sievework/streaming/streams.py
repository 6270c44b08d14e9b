"""Structured Streaming: file source in, idempotent tables out.

Delivery is at least once.  Every sink here gives the same table when a
micro-batch is repeated: a batch lands in a partition named after its id, and
published days or keys are replaced, not added to.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sievework.operators.dedup import latest_by
from sievework.operators.order import SortKey
from sievework.session import through_storage
from sievework.sinks.publish import read_table, replace_partitions


def open_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files below ``path`` (a folder or a glob) as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def with_event_time(df: DataFrame, column: str, lateness: str) -> DataFrame:
    """Watermark on a column, cast to an instant first (a zone-less one cannot carry a watermark)."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, lateness)


def run_available(df: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None]) -> None:
    """Process what is there, batch by batch, then stop; continues where the last call ended."""
    query: StreamingQuery = (df.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
                             .trigger(availableNow=True).start())
    query.awaitTermination()


def append_available(df: DataFrame, checkpoint: str, path: str) -> None:
    """Append results as they become final (windows behind the watermark) to a Parquet folder."""
    query = (df.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def window_counts(df: DataFrame, ts: str, length: str, slide: str | None, keys: Sequence[str]) -> DataFrame:
    """Rows per tumbling or sliding window and key."""
    span = F.window(ts, length, slide) if slide else F.window(ts, length)
    return (df.groupBy(span.alias("_w"), *keys).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, "n"))


def sessions(df: DataFrame, ts: str, gap: str, keys: Sequence[str]) -> DataFrame:
    """Activity sessions per key: closed once nothing happens for ``gap``."""
    return (df.groupBy(F.session_window(ts, gap).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"), *keys, "n"))


def whole_at_the_end(df: DataFrame, checkpoint: str, landed: str, ts: str, summarise: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Windows or sessions of everything that has arrived, also those that the watermark has not closed.

    A stream in append mode delivers what is closed, and the end of the input closes nothing.  Here the rows of
    ``df`` land first; after the stream has ended the summary is made from all landed rows by a batch aggregation,
    rows too late for the watermark included.  Rows without an event time belong to no window.
    """
    run_available(df, checkpoint, land_batches(landed))
    rows = read_table(df.sparkSession, landed, T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())]))
    return summarise(rows.drop("batch").withColumn(ts, F.col(ts).cast("timestamp")))


def first_deliveries(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows delivered again within the watermark's lateness; state is bounded by it."""
    return df.dropDuplicatesWithinWatermark(list(keys))


def land_batches(path: str, by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Sink: each batch in partitions of its own; a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        replace_partitions(batch.withColumn("batch", F.lit(batch_id)), path, [*by, "batch"])
    return write


def rebuild_touched_days(landed: str, path: str, ts: str, day: str, keys: Sequence[str],
                         summarise: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Sink: land the batch by day, then recompute every day it touches from all landed rows.

    Late rows reach back to the day they belong to.  Rows delivered twice (equal
    ``keys``) count once, as their last batch has them.  Only the touched days are read back; their number is
    bounded by the calendar.
    """
    land = land_batches(landed, [day])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = through_storage(batch.withColumn(day, F.to_date(ts)), "batch")
        touched = [r[0] for r in dated.select(day).distinct().collect()]
        if not touched:
            return
        land(dated, batch_id)
        layout = dated.schema.add("batch", T.LongType())
        stored = spark.read.schema(layout).parquet(landed).filter(_one_of(F.col(day), touched))
        replace_partitions(summarise(last_delivery(stored, keys).drop("batch")), path, [day])
    return write


def last_delivery(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: of the last ``batch``; of several in it the one with the greatest columns, so that every run picks the same."""
    payload = [c for c in rows.columns if c not in (*keys, "batch")]
    return latest_by(rows, keys, "batch", [SortKey(c, descending=True) for c in payload])


def _one_of(c: Column, values: Sequence) -> Column:
    """Membership that also finds the missing value, if it is among the values."""
    known = [v for v in values if v is not None]
    return c.isin(known) | c.isNull() if len(known) < len(values) else c.isin(known)


def keep_latest(path: str, keys: Sequence[str], stamp: str, tie_break: Sequence[SortKey],
                by: str) -> Callable[[DataFrame, int], None]:
    """Sink: the newest row per key over everything seen so far.

    ``by`` is a partition column computed from the key, so a key never moves; only
    the partitions a batch touches are read and rewritten.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = through_storage(latest_by(batch, keys, stamp, tie_break), "batch")
        touched = [r[0] for r in fresh.select(by).distinct().collect()]
        if not touched:
            return
        known = read_table(spark, path, batch.schema).filter(_one_of(F.col(by), touched))
        merged = fresh.unionByName(known.select(*fresh.columns))
        replace_partitions(latest_by(merged, keys, stamp, tie_break), path, [by])
    return write
