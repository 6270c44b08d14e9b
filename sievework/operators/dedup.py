"""Duplicates and corrections: which row of a key is the one that counts.

Picking rows uses ``row_number() <= n``, which Spark evaluates with a group limit
before the shuffle: each task sends at most n rows per key, so a key holding a
third of the table costs no more than any other.  Marking rows compares each row
with a per-key aggregate, which is combined before the shuffle as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.operators.aggregate import joined_on_key
from sievework.operators.order import SortKey, columns_of
from sievework.operators.sliced import with_ranks


#: Rows per key up to which Spark limits groups before the shuffle (``spark.sql.optimizer.windowGroupLimitThreshold``).
GROUP_LIMIT = 1000


def nth_rows(df: DataFrame, keys: Sequence[str], order: Sequence[SortKey], first: int, last: int) -> DataFrame:
    """Rows number ``first`` to ``last`` (1-based) of each key in the given order."""
    if not order:
        raise ValueError("rows of a group have no order of their own: name the sort keys")
    if last > GROUP_LIMIT and len(order) > 1:
        # Beyond Spark's group limit a window would sort a whole key in one task: number the rows in slices instead.
        return with_ranks(df, keys, order, row_number="_row").filter(F.col("_row").between(first, last)).drop("_row")
    w = Window.partitionBy(*keys).orderBy(*columns_of(order))
    numbered = df.withColumn("_row", F.row_number().over(w)).filter(F.col("_row") <= last)
    if first > 1:
        numbered = numbered.filter(F.col("_row") >= first)
    return numbered.drop("_row")


def latest_by(df: DataFrame, keys: Sequence[str], stamp: str, tie_break: Sequence[SortKey]) -> DataFrame:
    """The whole row with the greatest ``stamp`` per key; ``tie_break`` settles equal stamps."""
    return nth_rows(df, keys, [SortKey(stamp, descending=True), *tie_break], 1, 1)


def oldest_by(df: DataFrame, keys: Sequence[str], stamp: str, tie_break: Sequence[SortKey]) -> DataFrame:
    """The whole row with the smallest ``stamp`` per key."""
    return nth_rows(df, keys, [SortKey(stamp), *tie_break], 1, 1)


def head_by(df: DataFrame, keys: Sequence[str], order: Sequence[SortKey], n: int) -> DataFrame:
    """The first ``n`` rows of each key."""
    return nth_rows(df, keys, order, 1, n)


def tail_by(df: DataFrame, keys: Sequence[str], order: Sequence[SortKey], n: int) -> DataFrame:
    """The last ``n`` rows of each key."""
    return nth_rows(df, keys, [k.reversed() for k in order], 1, n)


def order_ties(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keys whose sort keys do not decide between rows, with the number of rows involved."""
    return (df.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1))


def without_accidents(df: DataFrame, keys: Sequence[str], stamp: str, tie_break: Sequence[SortKey]) -> DataFrame:
    """Rows delivered twice collapse; of the rest, the newest correction per key stays.

    Equal rows are removed first, so that a repeated delivery can never be taken
    for a correction.
    """
    return latest_by(df.distinct(), keys, stamp, tie_break)


def mark_all_duplicates(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Flag every row whose key occurs more than once."""
    repeated = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
                .select(F.struct(*keys).alias("_key")))
    joined = df.withColumn("_key", F.struct(*keys)).join(
        repeated.withColumn("_hit", F.lit(True)), "_key", "left")
    return joined.withColumn(name, F.coalesce("_hit", F.lit(False))).drop("_key", "_hit")


def mark_later_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str,
                          keep: str = "first") -> DataFrame:
    """Flag every row of a key except its first (or last) in ascending ``order``.

    ``order`` has to be unique within a key.
    """
    pick = F.min if keep == "first" else F.max
    position = F.struct(*order)
    kept = df.groupBy(F.struct(*keys).alias("_key")).agg(pick(position).alias("_kept"))
    joined = joined_on_key(df, keys, kept, "left")
    return joined.withColumn(name, position != F.col("_kept")).drop("_kept")


def coalesce_history(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key and column, the latest value that is not missing.

    The result mixes values of several rows and may equal none of them.  It is not
    the latest row; use latest_by for that.
    """
    position = F.struct(*order)
    picks = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), position)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*picks)
