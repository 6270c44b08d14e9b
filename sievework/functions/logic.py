"""Conditions and row-wise choices (Column -> Column)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_where(value: Column, condition: Column, other: Column) -> Column:
    """The value where the condition holds, ``other`` where it does not or is unknown."""
    return F.when(condition, value).otherwise(other)


def mask_where(value: Column, condition: Column, other: Column) -> Column:
    """The value unless the condition holds."""
    return F.when(condition, other).otherwise(value)


def bands(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the half-open band (low, high] a number falls in, else NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per band")
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (c > F.lit(low)) & (c <= F.lit(high))
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def graded(c: Column, threshold: float, high: str, low: str, unknown: str) -> Column:
    """Two classes and a third one for missing values, tested first."""
    return F.when(c.isNull(), unknown).when(c > F.lit(threshold), high).otherwise(low)


def any_null(columns: Sequence[str]) -> Column:
    """True for a row with at least one missing value among the columns."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def or_missing(condition: Column, c: Column) -> Column:
    """A filter that also lets rows pass where the tested value is missing."""
    return condition | c.isNull()


def truth_of(condition: Column) -> Column:
    """'true', 'false' or 'unknown': all three outcomes of a predicate, by name."""
    return F.when(condition.isNull(), "unknown").when(condition, "true").otherwise("false")


def split_three_ways(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows for which a predicate is true, false, and unknown; together they are ``df``."""
    return df.filter(condition), df.filter(~condition), df.filter(condition.isNull())


def after_date(day: Column, limit: Column, inclusive: bool = False) -> Column:
    """Is ``day`` past ``limit``?  A missing limit means no limit: the answer is false."""
    late = (day >= limit) if inclusive else (day > limit)
    return limit.isNotNull() & F.coalesce(late, F.lit(False))
