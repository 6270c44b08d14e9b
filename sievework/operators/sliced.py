"""Window results over groups of any size.

A plain window function puts a whole group into one task.  Here all rows are range-partitioned
once by key, all sort columns and a hash of the row, and stored with the number of
their partition, the slice.  The window runs inside a (key, slice); one row per (key, slice)
carries what is needed from slice to slice.  A slice ends where Spark's range partitioning puts its
bounds, whatever the values look like, so neither a crowded value nor a long common
prefix makes a large slice, and results do not depend on the bounds.

Range partitioning reads its input twice, once for a sample of the sort columns.  Put
``through_storage`` in front of anything costly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.operators.aggregate import joined_on_key
from sievework.operators.frames import with_row_frame
from sievework.operators.order import SortKey, columns_of
from sievework.session import through_storage

_HELPERS = ("_group", "_slice")
_BEFORE = (Window.unboundedPreceding, -1)


def _slices(df: DataFrame, keys: Sequence[str], order: Sequence[SortKey], slices: int | None = None) -> DataFrame:
    """``df`` stored with its group (_group) and slice (_slice, rising in sort order)."""
    group = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    by = [F.col("_group"), *columns_of(order), F.xxhash64(*df.columns)]
    named = df.withColumn("_group", group)
    placed = named.repartitionByRange(slices, *by) if slices else named.repartitionByRange(*by)
    return through_storage(placed.withColumn("_slice", F.spark_partition_id()), "slices")


def _ranked_values(sliced: DataFrame, key: SortKey, slices: int | None) -> DataFrame:
    """(_key, _before, _nth, _n) per group and value of the sort key: rows before it, its number, rows that have it.

    The rows are counted per value first, so values are what is put in order here, however many rows share one.
    """
    counts = sliced.groupBy("_group", key.name).agg(F.count(F.lit(1)).alias("_n"))
    values = _slices(counts, ["_group"], [key], slices)
    summary = values.groupBy(*_HELPERS).agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
    along = Window.partitionBy("_group").orderBy("_slice").rowsBetween(*_BEFORE)
    summary = summary.select(*_HELPERS, *[F.coalesce(F.sum(c).over(along), F.lit(0)).alias(f"{c}_before") for c in ("_rows", "_values")])
    here = Window.partitionBy(*_HELPERS).orderBy(key.column())
    return values.join(summary, list(_HELPERS)).select(
        F.struct(F.col("_group.*"), F.col(key.name)).alias("_key"),
        (F.col("_rows_before") + F.sum("_n").over(here.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
        (F.col("_values_before") + F.row_number().over(here)).alias("_nth"), "_n")


def with_ranks(df: DataFrame, keys: Sequence[str], order: Sequence[SortKey], *, row_number: str | None = None,
               rank: str | None = None, dense_rank: str | None = None, average_rank: str | None = None,
               slices: int | None = None) -> DataFrame:
    """Any of the four ranks of each row within its key.

    ``row_number`` follows all sort keys; the other three rank by the first sort
    key alone and treat equal values as ties.
    """
    if row_number and len(order) < 2:
        raise ValueError("row numbers need a tie-break after the leading sort key")
    out = sliced = _slices(df, keys, order, slices)
    if row_number:
        summary = sliced.groupBy(*_HELPERS).agg(F.count(F.lit(1)).alias("_n"))
        along = Window.partitionBy("_group").orderBy("_slice").rowsBetween(*_BEFORE)
        summary = summary.select(*_HELPERS, F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_rows_before"))
        here = Window.partitionBy(*_HELPERS).orderBy(*columns_of(order))
        out = sliced.join(summary, list(_HELPERS)).withColumn(row_number, F.col("_rows_before") + F.row_number().over(here))
    if rank or dense_rank or average_rank:
        # One row per value comes back to all rows that have it; Spark can split a crowded value.
        out = joined_on_key(out, ["_group", order[0].name], _ranked_values(sliced, order[0], slices), "inner")
        made = {rank: F.col("_before") + 1, dense_rank: F.col("_nth"),
                average_rank: F.col("_before") + 1 + (F.col("_n") - 1) / F.lit(2.0)}
        out = out.withColumns({name: c for name, c in made.items() if name})
    return out.select(*df.columns, *[c for c in (row_number, rank, dense_rank, average_rank) if c])


def with_rolling_sum(df: DataFrame, keys: Sequence[str], order: Sequence[SortKey], value: str, name: str, rows: int,
                     slices: int | None = None) -> DataFrame:
    """Sum over the last ``rows`` rows of the key, this one included; NULL if all of them are NULL."""
    return with_row_frame(df, keys, order, {name: F.sum(value)}, rows, slices)


def with_running_total(df: DataFrame, keys: Sequence[str], order: Sequence[SortKey], value: str, name: str,
                       slices: int | None = None) -> DataFrame:
    """Sum of ``value`` over the rows of the key up to and including this one."""
    sliced = _slices(df, keys, order, slices)
    along = Window.partitionBy("_group").orderBy("_slice").rowsBetween(*_BEFORE)
    summary = sliced.groupBy(*_HELPERS).agg(F.sum(value).alias("_sum"))
    summary = summary.select(*_HELPERS, F.sum("_sum").over(along).alias("_carried"))
    here = Window.partitionBy(*_HELPERS).orderBy(*columns_of(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = F.sum(value).over(here)
    total = F.when(F.col("_carried").isNull(), local).otherwise(F.col("_carried") + F.coalesce(local, F.lit(0)))
    return sliced.join(summary, list(_HELPERS)).withColumn(name, total).select(*df.columns, name)


def _fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], slices: int | None,
          forward: bool) -> DataFrame:
    sort = [SortKey(c) for c in order]
    sliced = _slices(df, keys, sort, slices)
    position = F.struct(*order)
    pick = F.max_by if forward else F.min_by
    summary = sliced.groupBy(*_HELPERS).agg(
        *[pick(F.col(c), F.when(F.col(c).isNotNull(), position)).alias(f"_edge_{c}") for c in columns])
    # Backward is forward in the opposite order: Spark computes a frame up to the last row anew for every row.
    along = Window.partitionBy("_group").orderBy("_slice" if forward else F.desc("_slice")).rowsBetween(*_BEFORE)
    summary = summary.select(*_HELPERS, *[F.last(f"_edge_{c}", True).over(along).alias(f"_from_{c}") for c in columns])
    towards = columns_of(sort if forward else [k.reversed() for k in sort])
    here = Window.partitionBy(*_HELPERS).orderBy(*towards).rowsBetween(Window.unboundedPreceding, 0)
    joined = sliced.join(summary, list(_HELPERS))
    filled = {c: F.coalesce(F.last(c, True).over(here), F.col(f"_from_{c}")) for c in columns}
    return joined.withColumns(filled).select(*df.columns)


def fill_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
                 slices: int | None = None) -> DataFrame:
    """Missing values take the last known value before them; ``order`` is ascending and not null."""
    return _fill(df, keys, order, columns, slices, True)


def fill_backward(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
                  slices: int | None = None) -> DataFrame:
    """Missing values take the next known value after them."""
    return _fill(df, keys, order, columns, slices, False)


def with_neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, name: str, *,
                   following: bool = False, slices: int | None = None) -> DataFrame:
    """The column's value in the row before (or after) this one; ``order`` is ascending, unique per key."""
    sort = [SortKey(c) for c in order]
    sliced = _slices(df, keys, sort, slices)
    value = F.struct(F.col(column).alias("v"))
    edge = (F.min_by if following else F.max_by)(value, F.struct(*order))
    along = Window.partitionBy("_group").orderBy("_slice")
    shift = F.lead if following else F.lag
    summary = (sliced.groupBy(*_HELPERS).agg(edge.alias("_edge"))
               .select(*_HELPERS, shift("_edge").over(along).alias("_across")))
    here = Window.partitionBy(*_HELPERS).orderBy(*columns_of(sort))
    joined = sliced.join(summary, list(_HELPERS))
    return (joined.withColumn(name, F.coalesce(shift(value).over(here), F.col("_across")).getField("v"))
            .select(*df.columns, name))


def exact_quantiles(df: DataFrame, column: str, fractions: Sequence[float], slices: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: one row (fraction, value) each.

    Equal values are counted first.  Slice totals (one row per partition) tell
    in which slices the wanted positions lie; only those slices are sorted.
    """
    counts = (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_n")))
    sliced = _slices(counts, [], [SortKey("_v")], slices)
    totals = sorted((r._slice, r.n) for r in sliced.groupBy("_slice").agg(F.sum("_n").alias("n")).collect())
    whole = sum(n for _, n in totals)
    positions = {f: (whole - 1) * f for f in fractions}
    wanted = {int(p) for p in positions.values()} | {min(int(p) + 1, whole - 1) for p in positions.values()}
    before, base, needed = 0, {}, []
    for lead, n in totals:
        if any(before <= p < before + n for p in wanted):
            base[lead] = before
            needed.append(lead)
        before += n
    schema = "fraction double, value double"
    if not whole:
        return df.sparkSession.createDataFrame([(float(f), None) for f in fractions], schema)
    start = F.lit(0)
    for lead in needed:
        start = F.when(F.col("_slice") == lead, F.lit(base[lead])).otherwise(start)
    running = Window.partitionBy("_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = (sliced.filter(F.col("_slice").isin(*needed))
              .withColumn("_end", start + F.sum("_n").over(running))
              .withColumn("_start", F.col("_end") - F.col("_n")))

    def at(p: int) -> Column:
        return F.max(F.when((F.col("_start") <= p) & (F.lit(p) < F.col("_end")), F.col("_v").cast("double")))

    row = placed.agg(*[at(int(p)).alias(f"lo{i}") for i, p in enumerate(positions.values())],
                     *[at(min(int(p) + 1, whole - 1)).alias(f"hi{i}") for i, p in enumerate(positions.values())])
    pairs = [F.struct(F.lit(float(f)).alias("fraction"),
                      (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.lit(p - int(p))).alias("value"))
             for i, (f, p) in enumerate(positions.items())]
    return row.select(F.inline(F.array(*pairs)))
