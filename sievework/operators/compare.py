"""Comparing two tables: key sets, row sets, values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_difference(actual: DataFrame, expected: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys on one side only, labelled extra or missing."""
    a, e = actual.select(*key).distinct(), expected.select(*key).distinct()
    return (a.join(e, list(key), "left_anti").withColumn("side", F.lit("extra"))
            .unionByName(e.join(a, list(key), "left_anti").withColumn("side", F.lit("missing"))))


def row_difference(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows with their multiplicity where the two bags differ; empty means equal.

    One aggregation over both sides instead of two EXCEPT ALL passes.
    """
    cols = actual.columns
    both = (actual.withColumn("_d", F.lit(1)).unionByName(expected.select(*cols).withColumn("_d", F.lit(-1))))
    return both.groupBy(*cols).agg(F.sum("_d").alias("surplus")).filter(F.col("surplus") != 0)


def _differs(column: str, kind: T.DataType, tolerance: float) -> Column:
    a, e = F.col(f"_a_{column}"), F.col(f"_e_{column}")
    if isinstance(kind, (T.DoubleType, T.FloatType)) and tolerance:
        scale = F.greatest(F.lit(1.0), F.abs(a), F.abs(e))
        close = F.coalesce(F.abs(a - e) <= F.lit(tolerance) * scale, a.isNull() & e.isNull(), F.lit(False))
        return ~close
    return ~a.eqNullSafe(e)


def _paired(actual: DataFrame, expected: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    a = actual.select(*key, *[F.col(c).alias(f"_a_{c}") for c in columns], F.lit(True).alias("_in_a"))
    e = expected.select(*key, *[F.col(c).alias(f"_e_{c}") for c in columns], F.lit(True).alias("_in_e"))
    return a.join(e, list(key), "full")


def value_difference(actual: DataFrame, expected: DataFrame, key: Sequence[str], columns: Sequence[str],
                     tolerance: float = 0.0) -> DataFrame:
    """One row per differing cell: key, column, actual, expected (as text); rows on both sides only."""
    paired = _paired(actual, expected, key, columns).filter(F.col("_in_a") & F.col("_in_e"))
    cells = [F.when(_differs(c, actual.schema[c].dataType, tolerance),
                    F.struct(F.lit(c).alias("column"), F.col(f"_a_{c}").cast("string").alias("actual"),
                             F.col(f"_e_{c}").cast("string").alias("expected"))) for c in columns]
    return paired.select(*key, F.inline(F.filter(F.array(*cells), lambda x: x.isNotNull())))


def difference_counts(actual: DataFrame, expected: DataFrame, key: Sequence[str], columns: Sequence[str],
                      tolerance: float = 0.0) -> DataFrame:
    """One row: extra keys, missing keys and, per column, differing values.  A single full join."""
    paired = _paired(actual, expected, key, columns)
    on_both = F.col("_in_a") & F.col("_in_e")
    return paired.agg(
        F.count_if(F.col("_in_e").isNull()).alias("extra"),
        F.count_if(F.col("_in_a").isNull()).alias("missing"),
        *[F.count_if(on_both & _differs(c, actual.schema[c].dataType, tolerance)).alias(f"differs_{c}")
          for c in columns])


def same_rows(actual: DataFrame, expected: DataFrame) -> bool:
    """Are both tables equal as bags of rows?"""
    return row_difference(actual, expected).isEmpty()


