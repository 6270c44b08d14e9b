"""Recorded history: a profile of every run in an append log, and what has drifted from it.

A profile row is small and mergeable: counts, totals, extremes and a KLL sketch per group and measure.  Comparing a run with all
runs before it merges their sketches; no row of an old run is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.sinks.publish import read_table

#: Items a sketch keeps.  Up to this many values its quantiles are exact; beyond, ranks are off by about 0.1 %.
SKETCH_K = 4096
PROFILE = "run long, part string, measure string, n long, missing long, total double, low double, high double, sketch binary"
#: A run drifts where its median lies more than this many quartile distances outside the quartiles of the runs before it.
FENCE = 1.5


def profile_of(df: DataFrame, run: int, part: str, measures: Sequence[str]) -> DataFrame:
    """One row per value of ``part`` and measure (numbers; NULLs are counted as missing); one aggregation over one scan."""
    wide = df.groupBy(F.col(part).cast("string").alias("part")).agg(*[e for m in measures for e in (
        F.count(m).alias(f"n_{m}"), F.count_if(F.col(m).isNull()).alias(f"missing_{m}"), F.sum(F.col(m).cast("double")).alias(f"total_{m}"),
        F.min(F.col(m).cast("double")).alias(f"low_{m}"), F.max(F.col(m).cast("double")).alias(f"high_{m}"),
        F.kll_sketch_agg_double(F.col(m).cast("double"), F.lit(SKETCH_K)).alias(f"sketch_{m}"))])
    told = F.array(*[F.struct(F.lit(m).alias("measure"), *[F.col(f"{c}_{m}").alias(c) for c in ("n", "missing", "total", "low", "high", "sketch")]) for m in measures])
    return wide.select(F.lit(run).cast("long").alias("run"), "part", F.inline(told))


def record_profile(profile: DataFrame, path: str) -> None:
    """Add a run's profile to the log.  A run that is recorded again counts as its last record."""
    profile.write.mode("append").parquet(path)


def _recorded(spark: SparkSession, path: str) -> DataFrame:
    schema = spark.createDataFrame([], PROFILE).schema
    log = read_table(spark, path, schema)
    # A few rows per run; of repeated records of a run, which are made from the same rows, any one will do.
    return log.dropDuplicates(["run", "part", "measure"])


def drift_report(spark: SparkSession, path: str, run: int, fence: float = FENCE) -> DataFrame:
    """A run against all runs recorded before it: per part and measure numbers of both, quartiles of the history, and ``verdict``.

    The verdict is new (nothing before it), gone (nothing in the run any more), median (outside the fences),
    missing (a share of missing values more than twice and one per cent above that of the history), or NULL.
    """
    log = _recorded(spark, path)
    now = log.where(F.col("run") == run).select("part", "measure", "n", "missing", "total", "sketch")
    before = log.where(F.col("run") < run).groupBy("part", "measure").agg(
        F.countDistinct("run").alias("runs"), F.sum("n").alias("n_before"), F.sum("missing").alias("missing_before"), F.sum("total").alias("total_before"),
        F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch_before"))
    q = {name: F.when(F.col("n_before") > 0, F.kll_sketch_get_quantile_double("sketch_before", F.lit(f))) for name, f in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))}
    mine = before.select(F.col("part").alias("_part"), F.col("measure").alias("_measure"), "runs", "n_before", "missing_before", "total_before", *[c.alias(n) for n, c in q.items()])
    same = F.col("part").eqNullSafe(F.col("_part")) & (F.col("measure") == F.col("_measure"))
    both = now.withColumn("median", F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)))).join(mine, same, "full")
    reach = (F.col("q75") - F.col("q25")) * fence
    share, usual = F.col("missing") / (F.col("n") + F.col("missing")), F.col("missing_before") / (F.col("n_before") + F.col("missing_before"))
    verdict = (F.when(F.col("n_before").isNull(), "new").when(F.col("n").isNull(), "gone")
               .when((F.col("median") < F.col("q25") - reach) | (F.col("median") > F.col("q75") + reach), "median")
               .when((share > 2 * usual) & (share > usual + 0.01), "missing"))
    return both.select(F.coalesce("part", "_part").alias("part"), F.coalesce("measure", "_measure").alias("measure"), "runs", "n", "n_before", "missing", "missing_before",
                       "total", "total_before", "median", "q25", "q50", "q75", verdict.alias("verdict"))
