"""Joins that say what happened to the rows.

No broadcast is forced anywhere: Spark broadcasts a side when its measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting
skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KeyPair = str | tuple[str, str]


def _pairs(on: Sequence[KeyPair]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in on]


def one_row_per_key(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """``df`` unchanged, except that a repeated key stops the job and is named.

    The check is part of the plan: one aggregation on the join key, whose partitioning a shuffle join above it can use
    as it is.  For a pass over the keys alone, give the keys alone: then it is a hash aggregation of counts.
    """
    payload = [c for c in df.columns if c not in keys]
    counted = [F.count(F.lit(1)).alias("_n"), *([F.any_value(F.struct(*payload)).alias("_row")] if payload else [])]
    grouped = df.groupBy(*keys).agg(*counted)
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    message = F.concat(F.lit(f"{label}: more than one row for key "), shown)
    single = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return grouped.filter(single).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def checked_join(left: DataFrame, right: DataFrame, on: Sequence[KeyPair], how: str = "left", *,
                 validate: str | None = None, indicator: str | None = None,
                 null_safe: bool = False) -> DataFrame:
    """Equi-join with the usual safeguards.

    ``on`` pairs differently named keys as (left, right); the right key column is
    dropped.  ``validate`` is "m:1", "1:m" or "1:1".  ``indicator`` names a column
    holding left_only, right_only or both.  Other columns must not share names.
    NULL keys match nothing unless ``null_safe``.
    """
    pairs = _pairs(on)
    if validate not in (None, "m:1", "1:m", "1:1"):
        raise ValueError(f"validate must be m:1, 1:m or 1:1, not {validate!r}")
    right_keys = {r for _, r in pairs}
    clash = (set(left.columns) & (set(right.columns) - right_keys))
    if clash:
        raise ValueError(f"rename before joining, both sides have {sorted(clash)}")
    if validate in ("m:1", "1:1"):
        right = one_row_per_key(right, [r for _, r in pairs], "right side")
    if validate in ("1:m", "1:1"):
        left = one_row_per_key(left, [l for l, _ in pairs], "left side").select(*left.columns)
    mine = left.withColumn("_in_left", F.lit(True)) if indicator else left
    theirs = right.withColumn("_in_right", F.lit(True)) if indicator else right
    theirs = theirs.select(*[F.col(c).alias(f"_right_{c}") if c in right_keys else F.col(c)
                             for c in theirs.columns])

    def same(l: str, r: str) -> Column:
        a, b = F.col(l), F.col(f"_right_{r}")
        return a.eqNullSafe(b) if null_safe else a == b

    joined = mine.join(theirs, reduce(lambda a, b: a & b, [same(l, r) for l, r in pairs]), how)
    if how in ("left_semi", "left_anti"):
        return joined.select(*left.columns)
    if how in ("right", "full", "outer", "full_outer", "right_outer"):
        joined = joined.withColumns({l: F.coalesce(F.col(l), F.col(f"_right_{r}")) for l, r in pairs})
    if indicator:
        joined = joined.withColumn(indicator, F.when(F.col("_in_right").isNull(), "left_only")
                                   .when(F.col("_in_left").isNull(), "right_only").otherwise("both"))
    payload = [c for c in right.columns if c not in right_keys]
    return joined.select(*left.columns, *payload, *([indicator] if indicator else []))


def join_aggregated(left: DataFrame, many: DataFrame, on: Sequence[KeyPair], aggregates: Sequence[Column],
                    how: str = "left") -> DataFrame:
    """Bring the many side down to one row per key first, so that no left row is multiplied."""
    pairs = _pairs(on)
    return checked_join(left, many.groupBy(*[r for _, r in pairs]).agg(*aggregates), on, how)


def resolve_alias(df: DataFrame, spelling: str, dictionary: DataFrame, alias: str, code: str,
                  normalise) -> DataFrame:
    """Look up the business key for a spelling that has been through ``normalise`` already.

    The dictionary goes through the same function here; otherwise its own oddities
    would never match.  Entries that collapse onto one text and one code count once;
    the same text with two codes stops the job.
    """
    entries = dictionary.select(normalise(F.col(alias)).alias(alias), F.col(code)).distinct()
    return checked_join(df, entries, [(spelling, alias)], "left", validate="m:1")


def interval_lookup(df: DataFrame, day: str, rates: DataFrame, start: str, end: str,
                    keys: Sequence[str] = ()) -> DataFrame:
    """Attach the row of ``rates`` whose [start, end] days contain ``day``; none is kept as NULL.

    A NULL end is open.  A period that ends before it starts stops the job, and so does a day that lies in
    two periods of a key.  A period is entered under the blocks of 2^k days it touches, where
    2^k is just below its length: three at most, however long it is.  Every
    different (key, day) of ``df`` is looked up once per k that its key uses, of which there are 22 at most.

    Both sides of the lookup have many more rows than the files they come from suggest, and Spark plans broadcasts by the size
    of files, so this one join is told to merge.
    """
    payload = [c for c in rates.columns if c not in (start, end, *keys)]
    forever = F.lit("9999-12-31").cast("date")
    first, last = F.unix_date(F.col(start).cast("date")), F.unix_date(F.coalesce(F.col(end).cast("date"), forever))
    message = F.concat(F.lit("a period ends before it starts: "), F.col(start).cast("string"))
    bounds = rates.select(*keys, *payload, first.alias("_first"), F.when(first > last, F.raise_error(message)).otherwise(last).alias("_last"))
    sized = bounds.withColumn("_level", F.floor(F.log2(F.col("_last") - F.col("_first") + 1)).cast("int"))
    periods = sized.withColumn("_block", F.explode(F.expr("sequence(shiftright(_first, _level), shiftright(_last, _level))")))
    days = df.select(*keys, F.col(day).alias("_day")).where(F.col("_day").isNotNull()).distinct()
    if keys:
        levels = sized.groupBy(*keys).agg(F.collect_set("_level").alias("_levels"))
        levelled = days.join(levels.hint("merge"), list(keys))
    else:
        used = [r[0] for r in sized.select("_level").distinct().where("_level is not null").collect()]
        levelled = days.withColumn("_levels", F.array(*[F.lit(k) for k in used]).cast("array<int>"))
    probes = (levelled.withColumn("_level", F.explode("_levels")).drop("_levels")
              .withColumn("_at", F.unix_date(F.col("_day").cast("date"))).withColumn("_block", F.expr("shiftright(_at, _level)")))
    hits = (probes.join(periods.hint("merge"), [*keys, "_level", "_block"]).where("_first <= _at and _at <= _last")
            .select(*keys, "_day", *payload))
    return checked_join(df, hits, [*keys, (day, "_day")], "left", validate="m:1")


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread: Sequence[str], salts: int,
                how: str = "left") -> DataFrame:
    """Equi-join for a key known to be hot: left rows are spread over ``salts`` copies of the right rows.

    The salt is a hash of the ``spread`` columns, so a recomputed task gives the
    same rows the same salt.  For joins whose left side decides (inner, left,
    left_semi, left_anti).
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only the left side may be spread")
    mine = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    theirs = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return mine.join(theirs, [*on, "_salt"], how).drop("_salt")


def totals(df: DataFrame, sums: Sequence[str]) -> DataFrame:
    """One row: number of rows and the sum of each named column."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(f"sum_{c}") for c in sums])


def reconcile(before: DataFrame, after: DataFrame, sums: Sequence[str]) -> DataFrame:
    """One row per measure: before, after, and whether they agree (missing equals missing)."""
    b, a = totals(before, sums), totals(after, sums)
    names = ["rows", *[f"sum_{c}" for c in sums]]

    def upright(df: DataFrame, side: str) -> DataFrame:
        pairs = [F.struct(F.lit(n).alias("measure"), F.col(n).cast("decimal(38,6)").alias(side)) for n in names]
        return df.select(F.inline(F.array(*pairs)))

    both = upright(b, "before").join(upright(a, "after"), "measure")
    return both.withColumn("agrees", F.col("before").eqNullSafe(F.col("after")))


def require_preserved(before: DataFrame, after: DataFrame, sums: Sequence[str]) -> None:
    """Stop unless row count and sums are the same on both sides (one-row results only)."""
    broken = reconcile(before, after, sums).filter(~F.col("agrees")).collect()
    if broken:
        raise ValueError("not preserved: " + "; ".join(f"{r.measure} {r.before} -> {r.after}" for r in broken))
