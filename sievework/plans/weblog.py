"""Access-log lines as text -> typed requests and page reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.parse import parse_instant, parse_integer, parse_number, wall_clock
from sievework.functions.text import remove_suffix

RAW_COLUMNS = ("ts", "path", "status", "dur", "bytes", "user_id")
LOCAL_ZONE = "Asia/Tokyo"


def seconds(dur):
    """'1.2s' as 1.2"""
    return parse_number(remove_suffix(dur, "s"), on_error="raise")


def typed_requests(raw: DataFrame) -> DataFrame:
    """All columns with their types: UTC and local time, status, seconds, bytes.

    A status that is no number is missing; any other unreadable text stops the job.
    """
    instant = parse_instant(F.col("ts"), on_error="raise")
    return raw.select(
        instant.alias("ts"), wall_clock(instant, LOCAL_ZONE).alias("ts_jst"), "path",
        parse_integer(F.col("status")).alias("status"),
        seconds(F.col("dur")).alias("dur_sec"),
        parse_integer(F.col("bytes"), marks=",", on_error="raise").alias("bytes"),
        "user_id")


def page_report(raw: DataFrame) -> DataFrame:
    """Requests and mean seconds per path."""
    return (raw.withColumn("sec", seconds(F.col("dur"))).groupBy("path")
            .agg(F.count(F.lit(1)).alias("requests"), F.avg("sec").alias("mean_sec")))
