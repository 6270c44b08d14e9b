"""Landing with a ledger per day: late rows, repeats, replacements."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.streaming import landing
from sievework.streaming.landing import Landing

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("v", T.LongType())])


def at(day, month=1):
    return datetime(2024, month, day, 12)


@pytest.fixture
def place(spark, tmp_path):
    return Landing(spark, str(tmp_path / "landing"), SCHEMA, "ts", timedelta(days=2)), str(tmp_path / "daily"), str(tmp_path / "inbox")


def deliver(spark, inbox, *rows):
    spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(inbox)


def per_day(df):
    return df.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))


def published(spark, path):
    return {str(r.day): (r.n, r.v) for r in spark.read.parquet(path).collect()}


@pytest.mark.parametrize("listed", [4000, 0])
def test_rows_of_any_age_are_published_once(spark, place, monkeypatch, listed):
    land, daily, inbox = place
    monkeypatch.setattr(landing, "LISTED_FOLDERS", listed)
    assert land.publish(per_day, daily) == 0
    deliver(spark, inbox, (1, at(1), 1), (2, at(20), 2), (3, None, 5))
    assert land.land_new_files(inbox) == 1 and land.publish(per_day, daily) == 3
    assert land.land_new_files(inbox) is None and land.publish(per_day, daily) == 0
    deliver(spark, inbox, (4, at(1), 10), (5, at(19), 1), (6, None, 7))
    assert land.land_new_files(inbox) == 2
    assert {str(r.day) for r in land.changed_days().collect()} == {"2024-01-01", "2024-01-19", "None"}
    assert land.publish(per_day, daily) == 3
    assert published(spark, daily) == {"2024-01-01": (2, 11), "2024-01-20": (1, 2), "2024-01-19": (1, 1), "None": (2, 12)}
    assert {(str(r.day), r.batch): r.too_late for r in land.days().collect()} == {
        ("2024-01-01", 1): 0, ("2024-01-20", 1): 0, ("None", 1): 0, ("2024-01-01", 2): 1, ("2024-01-19", 2): 0, ("None", 2): 0}


def test_batch_again_changes_nothing_and_a_corrected_batch_replaces(spark, place):
    land, daily, _ = place
    rows = spark.createDataFrame([(1, at(1), 1), (2, at(2), 2)], SCHEMA)
    land.land(rows, 1)
    land.land(spark.createDataFrame([(3, at(2), 4)], SCHEMA), 2)
    assert land.publish(per_day, daily) == 2
    land.land(rows, 1)  # the run stopped before it was noted, and lands the batch again
    assert land.publish(per_day, daily) == 0
    land.land(spark.createDataFrame([(2, at(3), 2)], SCHEMA), 1)  # days 1 and 2 lose rows, day 3 gains one
    assert land.publish(per_day, daily) == 3
    assert published(spark, daily) == {"2024-01-02": (1, 4), "2024-01-03": (1, 2)}
    land.land(rows.limit(0), 1)
    assert land.publish(per_day, daily) == 1 and published(spark, daily) == {"2024-01-02": (1, 4)}


def test_same_number_of_other_rows_is_a_change(spark, place):
    land, daily, _ = place
    land.land(spark.createDataFrame([(1, at(1), 1)], SCHEMA), 1)
    land.publish(per_day, daily)
    land.land(spark.createDataFrame([(1, at(1), 9)], SCHEMA), 1)
    assert land.publish(per_day, daily) == 1 and published(spark, daily) == {"2024-01-01": (1, 9)}


def test_rows_delivered_again_count_as_their_last_delivery(spark, place):
    land, daily, _ = place
    land.land(spark.createDataFrame([(1, at(1), 1), (1, at(1), 3), (2, at(1), 5)], SCHEMA), 1)
    land.publish(per_day, daily, ["id"])
    assert published(spark, daily) == {"2024-01-01": (2, 8)}
    land.land(spark.createDataFrame([(1, at(1), 2)], SCHEMA), 2)
    land.publish(per_day, daily, ["id"])
    assert published(spark, daily) == {"2024-01-01": (2, 7)}


def test_a_run_that_stops_while_publishing_is_repeated(spark, place):
    land, daily, inbox = place
    deliver(spark, inbox, (1, at(1), 1))
    land.land_new_files(inbox)

    def fails(df):
        raise RuntimeError("stop")
    with pytest.raises(RuntimeError):
        land.publish(fails, daily)
    assert land.publish(per_day, daily) == 1 and published(spark, daily) == {"2024-01-01": (1, 1)}
