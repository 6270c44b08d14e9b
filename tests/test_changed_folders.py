"""Which folders of versions differ, and how they are swapped in."""

from pyspark.sql import functions as F

from sievework.operators import history
from sievework.sinks import publish

SHAPE = f"k string, v string, valid_from long, valid_to long, {history.BUCKET} int"


def test_folders_that_differ(spark):
    old = [("a", "x", 1, 2, 0), ("a", None, 2, None, 0), ("b", "x", 1, None, 1), ("c", None, 5, None, 2), (None, "c", 5, None, 3), ("e", "x", 1, None, 5), ("f", "x", 1, 7, 6)]
    new = [("a", None, 2, None, 0), ("a", "x", 1, 2, 0), ("b", "y", 1, None, 1), (None, "c", 5, None, 2), (None, "c", 5, None, 3), ("d", "x", 1, None, 4), ("f", "x", 1, None, 6), ("f", "x", 7, None, 6)]
    frames = [spark.createDataFrame(r, SHAPE) for r in (new, old)]
    assert sorted(r[0] for r in history._changed_folders(*frames).collect()) == [1, 2, 4, 5, 6]
    assert history._changed_folders(frames[0], frames[0]).isEmpty()
    assert history._changed_folders(frames[0], frames[1].limit(0)).count() == 7 - 1


def test_comparing_shuffles_no_version(spark):
    frame = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v"), F.col("id").alias("valid_from"), F.col("id").alias("valid_to"),
                                     (F.col("id") % 4).cast("int").alias(history.BUCKET))
    plan = history._changed_folders(frame, frame.limit(500))._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.split("\n") if "hashpartitioning(" in line]
    assert dealt and not any(c in line for line in dealt for c in ("valid_from", "k#", "v#"))


def test_stored_rows_are_not_staged_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "through_storage", lambda *a: (_ for _ in ()).throw(AssertionError("staged again")))
    path, seen = str(tmp_path / "t"), lambda: sorted(map(tuple, spark.read.parquet(path).select("n", "p").collect()))
    publish.replace_partitions(spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "n int, p int"), path, ["p"])
    publish.replace_partitions(spark.createDataFrame([(9, 1)], "n int, p int"), path, ["p"], rerun=spark.createDataFrame([(1,), (2,)], "p int"), stored=True)
    assert seen() == [(1, 0), (9, 1)]
