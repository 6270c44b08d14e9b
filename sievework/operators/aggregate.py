"""Aggregations that need more than one ``groupBy``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.session import through_storage


#: Buckets of a time axis that are generated from one row.
AXIS_PIECE = 10_000


def group(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], drop_null_keys: bool = False) -> DataFrame:
    """``groupBy().agg()`` with an explicit policy for missing keys: kept unless told otherwise."""
    if drop_null_keys:
        df = df.na.drop(subset=list(keys))
    return df.groupBy(*keys).agg(*aggregates)


def grain_counts(df: DataFrame, grains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Number of groups at each candidate grain, all in one pass over the data."""
    sizes = [F.countDistinct(F.struct(*cols)).alias(name) for name, cols in grains.items()]
    row = df.agg(*sizes)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("grain"), F.col(n).alias("groups")) for n in grains])))


def calendar_grid(entities: DataFrame, day: str, first: Column, last: Column, step: str = "interval 1 day") -> DataFrame:
    """Every entity on every calendar step from first to last, both included.

    The calendar is generated row by row from each entity; there is no product of
    two tables.
    """
    return entities.withColumn(day, F.explode(F.sequence(first, last, F.expr(step))))


def zero_fill(summary: DataFrame, day: str, entities: DataFrame, measures: Sequence[str],
              step: str = "interval 1 day") -> DataFrame:
    """Put a zero row where an entity has none, over the period the summary covers.

    Rows of entities that are not in ``entities`` are kept: a summary total must not
    change by filling gaps.  The summary is needed twice, for its period and its
    rows, and is written once for that, so the facts below it are read only once.
    """
    keys = [*entities.columns, day]
    summary = through_storage(summary, "summary")
    bounds = summary.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    grid = calendar_grid(entities, day, bounds.select("first").scalar(), bounds.select("last").scalar(), step)
    zeros = grid.select(*keys, *[F.lit(0).cast(summary.schema[m].dataType).alias(m) for m in measures])
    stacked = summary.select(*keys, *measures).unionByName(zeros)
    filled = stacked.groupBy(*keys).agg(*[F.sum(m).cast(summary.schema[m].dataType).alias(m) for m in measures])
    return filled.select(*[c for c in summary.columns if c in {*keys, *measures}])


def zero_fill_within(summary: DataFrame, within: str, day: str, entities: DataFrame, measures: Sequence[str],
                     step: str = "interval 1 day") -> DataFrame:
    """``zero_fill`` for each value of ``within`` on its own, over the days that value covers.

    The values and their first and last days are one array, looked up once per entity: no product of two
    tables.  The array has one element per value, so ``within`` is something like a month.
    """
    keys = [within, *entities.columns, day]
    summary = through_storage(summary, "summary")
    spans = summary.groupBy(within).agg(F.min(day).alias("first"), F.max(day).alias("last"))
    listed = spans.agg(F.collect_list(F.struct(within, "first", "last")).alias("spans")).select("spans").scalar()
    spread = entities.withColumn("_span", F.explode(listed)).select(*entities.columns, F.col("_span.*"))
    grid = calendar_grid(spread, day, F.col("first"), F.col("last"), step)
    zeros = grid.select(*keys, *[F.lit(0).cast(summary.schema[m].dataType).alias(m) for m in measures])
    filled = (summary.select(*keys, *measures).unionByName(zeros).groupBy(*keys)
              .agg(*[F.sum(m).cast(summary.schema[m].dataType).alias(m) for m in measures]))
    return filled.select(*[c for c in summary.columns if c in {*keys, *measures}])


def bucket_counts(df: DataFrame, ts: str, step: str, name: str = "bucket", count: str = "n") -> DataFrame:
    """Rows per time bucket, empty buckets between the first and the last included as 0."""
    start = F.window(F.col(ts).cast("timestamp"), step).getField("start")
    counted = through_storage(
        df.filter(F.col(ts).isNotNull()).groupBy(start.alias(name)).agg(F.count(F.lit(1)).alias(count)), "buckets")
    # The axis grows day by day from one row per day, which Spark spreads, so no array holds all of it.
    bounds = counted.agg(F.min(name).alias("first"), F.max(name).alias("last"))
    width = F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00' + interval {step})")
    pieces = bounds.select("first", "last", width.alias("width")).withColumn(
        "steps", F.floor((F.unix_micros("last") - F.unix_micros("first")) / F.col("width")))
    starts = pieces.select("first", "width", "steps", F.explode(F.sequence(F.lit(0), F.col("steps"), F.lit(AXIS_PIECE))).alias("from"))
    axis = (starts.repartition("from")
            .select("first", "width", F.explode(F.sequence("from", F.least(F.col("from") + AXIS_PIECE - 1, "steps"))).alias("k"))
            .select(F.timestamp_micros(F.unix_micros("first") + F.col("k") * F.col("width")).alias(name)))
    stacked = counted.unionByName(axis.withColumn(count, F.lit(0).cast("bigint")))
    return stacked.groupBy(name).agg(F.sum(count).alias(count))


def with_group_value(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """A group's aggregates on each of its rows: aggregate (combined before the shuffle), then join back.

    The join has a key expression of its own, so both sides are exchanged for it and
    Spark can split a hot key; on the aggregate's own key it could not.
    """
    per_key = df.groupBy(F.struct(*keys).alias("_key")).agg(*aggregates)
    return joined_on_key(df, keys, per_key, "inner")


def joined_on_key(df: DataFrame, keys: Sequence[str], per_key: DataFrame, how: str) -> DataFrame:
    """Join ``per_key`` (one row per struct ``_key``) to the rows of ``df``, NULL keys included, with an exchange on each side."""
    named = per_key.withColumn("_hash", F.xxhash64("_key")).withColumnRenamed("_key", "_theirs")
    mine = df.withColumn("_key", F.struct(*keys)).withColumn("_hash", F.xxhash64("_key"))
    same = (F.col("_mine") == F.col("_hash")) & (F.col("_key") == F.col("_theirs"))
    return mine.withColumnRenamed("_hash", "_mine").join(named, same, how).drop("_key", "_theirs", "_hash", "_mine")


def pivot_sum(df: DataFrame, index: Sequence[str], column: str, values: Sequence, measure: str) -> DataFrame:
    """Cross table of sums; the column values are given, so no extra pass is needed to find them."""
    return df.groupBy(*index).pivot(column, list(values)).agg(F.sum(measure))
