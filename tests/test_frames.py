"""Frames and as-of lookups against plain Python, with slices far smaller than keys and frames."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sievework.operators.frames import as_of_join, with_range_frame, with_row_frame
from sievework.operators.order import asc, desc

SCHEMA = "id long, k string, at long, v long"


def table():
    rng = random.Random(4)
    return [(i, "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None]), rng.choice([None, *range(60), 7, 7, 7]), rng.choice([None, 1, 2, 3, 50, -4])) for i in range(400)]


def known(values):
    return [v for v in values if v is not None]


@pytest.mark.parametrize("rows, slices", [(1, 7), (2, 40), (5, 7), (90, 40), (1000, 16)])
def test_row_frames(spark, rows, slices):
    data = table()
    got = with_row_frame(spark.createDataFrame(data, SCHEMA), ["k"], [desc("at"), asc("id")],
                         {"total": F.sum("v"), "top": F.max("v"), "low": F.min("v"), "n": F.count(F.lit(1))}, rows, slices).collect()
    assert len(got) == len(data)
    by_id = {r.id: r for r in got}
    for key in {r[1] for r in data}:
        ordered = sorted((r for r in data if r[1] == key), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        for j, r in enumerate(ordered):
            frame = ordered[max(0, j - rows + 1):j + 1]
            v = known(x[3] for x in frame)
            assert (by_id[r[0]].total, by_id[r[0]].top, by_id[r[0]].low, by_id[r[0]].n) == (sum(v) if v else None, max(v, default=None), min(v, default=None), len(frame))


@pytest.mark.parametrize("reach, slices", [(0, 7), (1, 40), (6, 12), (30, 40), (10**6, 9)])
def test_range_frames(spark, reach, slices):
    data = table()
    got = with_range_frame(spark.createDataFrame(data, SCHEMA), ["k"], F.col("at"),
                           {"total": ("sum", "v"), "top": ("max", "v"), "low": ("min", "v"), "n": ("count", "v"), "mean": ("mean", "v")}, reach, slices).collect()
    assert len(got) == len(data)
    for r in got:
        v = known(x[3] for x in data if x[1] == r.k and x[2] is not None and r.at is not None and r.at - reach <= x[2] <= r.at)
        assert (r.total, r.top, r.low, r.n) == (sum(v) if v else None, max(v, default=None), min(v, default=None), len(v))
        assert (r.mean is None) if not v else abs(r.mean - sum(v) / len(v)) < 1e-9


def test_wide_range_frames_cost_no_more_than_narrow_ones(spark):
    """Every frame has all rows before it: a frame that is computed row by row would visit 2 * 10**9 rows."""
    n = 64_000
    rows = spark.range(n).select(F.col("id").alias("at"), (F.pmod(F.xxhash64("id"), F.lit(1000)) - 500).alias("v"), (F.col("id") / 8).cast("decimal(12,3)").alias("d"))
    df = with_range_frame(rows, [], F.col("at"), {"total": ("sum", "v"), "low": ("min", "d"), "sum": ("sum", "d")}, n, 3)
    assert not [f for f in str(df._jdf.queryExecution().optimizedPlan().toString()).lower().split("specifiedwindowframe")[1:] if f.startswith("(rangeframe")]
    last = df.where(F.col("at") == n - 1).collect()
    assert [(r.total, r.low, r.sum) for r in last] == [tuple(rows.agg(F.sum("v"), F.min("d"), F.sum("d")).first())]


def test_frames_of_nothing_and_without_keys(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert with_row_frame(none, ["k"], [asc("at")], {"n": F.count("v")}, 3).count() == 0
    assert with_range_frame(none, ["k"], F.col("at"), {"n": ("count", "v")}, 3).count() == 0
    whole = with_row_frame(spark.range(50).withColumnRenamed("id", "at"), [], [asc("at")], {"n": F.sum("at")}, 3, 8).collect()
    assert sorted((r.at, r.n) for r in whole) == [(k, sum(range(max(0, k - 2), k + 1))) for k in range(50)]
    same = spark.createDataFrame([(1, "a", 5, 2)] * 30, SCHEMA)  # repeated rows are rows of their own
    assert sorted(r.n for r in with_row_frame(same, ["k"], [asc("at")], {"n": F.sum("v")}, 4, 8).collect()) == [2, 4, 6] + [8] * 27
    with pytest.raises(ValueError):
        with_row_frame(none, ["k"], [asc("at")], {"n": F.count("v")}, 0)
    with pytest.raises(ValueError):
        with_range_frame(none, ["k"], F.col("at"), {"n": ("median", "v")}, 1)


DAY = datetime(2024, 1, 1)


@pytest.mark.parametrize("direction, strict, tolerance, slices", [("backward", False, None, 40), ("backward", True, 3, 9), ("forward", False, 5, 40), ("forward", True, None, 9)])
def test_as_of(spark, direction, strict, tolerance, slices):
    rng = random.Random(9)

    def key(i):
        return "hot" if i % 3 == 0 else rng.choice(["a", "b", None, "left only"])
    left = [(i, key(i), rng.choice([None, DAY + timedelta(hours=rng.randrange(200))])) for i in range(300)]
    right = [(i, "right only" if i % 17 == 0 else key(i) if i % 5 else "hot", rng.choice([None, DAY + timedelta(hours=rng.randrange(200))] * 3 + [DAY])) for i in range(120)]
    right = [r for r in right if r[1] != "left only"]
    got = as_of_join(spark.createDataFrame(left, "id long, k string, at timestamp_ntz"), spark.createDataFrame(right, "rid long, k string, r_at timestamp_ntz"), ["k"], "at", "r_at",
                     direction=direction, strict=strict, tolerance=tolerance and f"{tolerance} hours", tie_break=[desc("rid")], slices=slices).collect()
    assert len(got) == len(left)
    found = {r.id: (r.rid, r.r_at) for r in got}
    for i, k, at in left:
        hits = [r for r in right if k is not None and at is not None and r[1] == k and r[2] is not None
                and ((r[2] < at or r[2] == at and not strict) if direction == "backward" else (r[2] > at or r[2] == at and not strict))]
        hits.sort(key=lambda r: (abs(at - r[2]), -r[0]))
        best = hits[0] if hits and (tolerance is None or abs(at - hits[0][2]) <= timedelta(hours=tolerance)) else None
        assert found[i] == ((best[0], best[2]) if best else (None, None))


def test_as_of_refuses_what_is_unclear(spark):
    left, right = spark.createDataFrame([(1, "a", 5)], "id long, k string, at long"), spark.createDataFrame([("a", 3, 1), ("a", 3, 2)], "k string, r_at long, v long")
    with pytest.raises(PySparkException, match="more than one row for key a, 3"):
        as_of_join(left, right, ["k"], "at", "r_at").collect()
    assert as_of_join(left, right, ["k"], "at", "r_at", tie_break=[asc("v")]).first().v == 1
    assert as_of_join(left, right.limit(0), ["k"], "at", "r_at").first().v is None
    assert as_of_join(left.limit(0), right.limit(1), ["k"], "at", "r_at").count() == 0
    with pytest.raises(ValueError, match="both sides have"):
        as_of_join(left, right.withColumnRenamed("v", "id"), ["k"], "at", "r_at")


def test_many_rows_of_a_key_are_numbered_in_slices(spark):
    from sievework.operators.dedup import head_by, nth_rows
    df = spark.range(5000).selectExpr("id", "id % 7 as v", "'hot' as k")
    want = sorted((i % 7, i) for i in range(5000))
    assert sorted((r.v, r.id) for r in head_by(df, ["k"], [asc("v"), asc("id")], 1500).collect()) == want[:1500]
    assert sorted((r.v, r.id) for r in nth_rows(df, ["k"], [asc("v"), asc("id")], 1400, 1410).collect()) == want[1399:1410]
