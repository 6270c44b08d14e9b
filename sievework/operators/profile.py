"""Looking at a table before touching it; every report reads the table once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.session import through_storage


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and how many values are present."""
    present = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                     F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("present"))
            for i, f in enumerate(df.schema.fields)]
    return present.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of missing values."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns])))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, the missing value included, most frequent first."""
    return (df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("value").asc_nulls_last()))


def unparsed_values(df: DataFrame, column: str, parsed) -> DataFrame:
    """Values present as text that a parser cannot read, with their counts."""
    c = F.col(column)
    return (df.filter(c.isNotNull() & parsed(c).isNull()).groupBy(c.alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def token_hits(df: DataFrame, columns: Sequence[str], tokens: Sequence[str]) -> DataFrame:
    """How often each spelling of "missing" occurs in each column."""
    wide = df.agg(*[F.count_if(F.col(c) == F.lit(t)).alias(f"h{i}_{j}")
                    for i, c in enumerate(columns) for j, t in enumerate(tokens)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("token"), F.col(f"h{i}_{j}").alias("hits"))
        for i, c in enumerate(columns) for j, t in enumerate(tokens)])))


def change_report(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """For each (before, after) column pair: rows changed and distinct values on both sides."""
    wide = df.agg(*[e for i, (b, a) in enumerate(pairs) for e in (
        F.count_if(~F.col(b).eqNullSafe(F.col(a))).alias(f"c{i}"),
        F.countDistinct(b).alias(f"b{i}"), F.countDistinct(a).alias(f"a{i}"))])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(b).alias("column"), F.col(f"c{i}").alias("changed"),
                 F.col(f"b{i}").alias("distinct_before"), F.col(f"a{i}").alias("distinct_after"))
        for i, (b, _) in enumerate(pairs)])))


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for a candidate key: rows, distinct keys, keys with several rows, surplus rows."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"),
                       F.count_if(F.col("n") > 1).alias("repeated_keys"),
                       F.sum(F.col("n") - 1).alias("surplus_rows"))


#: The fractions of the quartiles that ``describe`` gives.
_QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per numeric column.

    ``df`` is read once: while it is counted by (column, value), the other numbers are observed.  The counts of all columns are put
    in one order; only the slices that hold a quartile are looked into.  A row per column and slice comes to the driver.
    """
    for c in columns:
        if not isinstance(df.schema[c].dataType, T.NumericType):
            raise TypeError(f"{c} is not numeric")
    seen = Observation()
    basic = {"count": F.count, "mean": lambda c: F.avg(c.cast("double")), "std": F.stddev_samp, "min": lambda c: F.min(c.cast("double")), "max": lambda c: F.max(c.cast("double"))}
    watched = df.select(*columns).observe(seen, *[f(F.col(c)).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, f in basic.items()])
    pairs = F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(columns)])
    counts = watched.select(F.inline(pairs)).where("_v is not null").groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    placed = through_storage(counts.repartitionByRange("_c", "_v").withColumn("_slice", F.spark_partition_id()), "described")
    totals = sorted(map(tuple, placed.groupBy("_c", "_slice").agg(F.sum("_n")).collect()))
    # Of a table without any value nothing may have been observed.
    numbers = seen.get if totals else {f"{name}_{i}": 0 if name == "count" else None for i in range(len(columns)) for name in basic}
    before, wanted, bases = {}, {}, []
    for c, part, n in totals:
        if c not in wanted:
            at = {q: (numbers[f"count_{c}"] - 1) * q for q in _QUARTILES}
            wanted[c] = {q: (int(p), min(int(p) + 1, numbers[f"count_{c}"] - 1), p - int(p)) for q, p in at.items()}
        start = before.get(c, 0)
        if any(start <= p < start + n for lo, hi, _ in wanted[c].values() for p in (lo, hi)):
            bases.append((c, part, start))
        before[c] = start + n
    running = Window.partitionBy("_c", "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    base = df.sparkSession.createDataFrame(bases, "_c int, _slice int, _base long")
    ends = placed.join(F.broadcast(base), ["_c", "_slice"]).withColumn("_end", F.col("_base") + F.sum("_n").over(running))  # at most six rows a column
    places = sorted({(c, p) for c, at in wanted.items() for lo, hi, _ in at.values() for p in (lo, hi)})
    here = [F.max(F.when((F.col("_c") == c) & (F.col("_end") - F.col("_n") <= p) & (F.col("_end") > p), F.col("_v"))).alias(f"at_{c}_{p}") for c, p in places]
    found = ends.agg(*here).first().asDict() if here else {}
    rows = []
    for i, c in enumerate(columns):
        quartiles = []
        for q in _QUARTILES:
            if i in wanted:
                lo, hi, part = wanted[i][q]
                a, b = found[f"at_{i}_{lo}"], found[f"at_{i}_{hi}"]
                quartiles.append(a + (b - a) * part)
            else:
                quartiles.append(None)
        n, mean, std, low, high = (numbers[f"{name}_{i}"] for name in basic)
        rows.append((c, n, mean, std, low, *quartiles, high))
    return df.sparkSession.createDataFrame(rows, "column string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double")
