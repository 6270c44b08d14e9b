"""Sliding frames and as-of lookups over groups of any size.

Rows are range-partitioned once by key and sort order, sorted, numbered and stored, as in ``sliced``.  What a slice needs from
the slices around it comes as rows (the halo of a frame of rows) or as one row (the last match of an as-of lookup, what a frame in time has
before and behind the slice), so minima, maxima and frames in time work as well as sums, and no group has to fit a task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.operators.aggregate import joined_on_key
from sievework.operators.joins import one_row_per_key
from sievework.operators.order import SortKey, columns_of
from sievework.session import through_storage

_GROUP, _SLICE, _ID = "_group", "_slice", "_id"


def _placed(df: DataFrame, keys: Sequence[str], order: Sequence[Column], slices: int | None) -> DataFrame:
    """``df`` stored in sort order with its group, its slice, and an id that rises along the whole order."""
    group = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    named = df.withColumn(_GROUP, group)
    by = [F.col(_GROUP), *order, F.xxhash64(*df.columns)]
    ranged = named.repartitionByRange(slices, *by) if slices else named.repartitionByRange(*by)
    numbered = ranged.sortWithinPartitions(*by).withColumn(_SLICE, F.spark_partition_id()).withColumn(_ID, F.monotonically_increasing_id())
    return through_storage(numbered, "frames")


def _following(summary: DataFrame, far: Column, fits) -> DataFrame:
    """(_group, _slice, _next): the later slices of the group that some row of this slice belongs to.

    ``summary`` has one row per (group, slice); ``far`` is what is told of each later slice, rising with it, and ``fits(own, far)``
    whether the slice is reached.  How many slices are reached at most is found by doubling on this small table.
    """
    along = Window.partitionBy(_GROUP).orderBy(_SLICE)
    told = F.struct(F.col(_SLICE).alias("slice"), far.alias("far"))
    k = 1
    while not summary.select(F.lead(told, k).over(along).alias("t"), "*").where(F.col("t").isNotNull() & fits(F.col("t.far"))).isEmpty():
        k *= 2
    listed = summary.select("*", F.array(*[F.lead(told, i).over(along) for i in range(1, k)]).cast("array<struct<slice:int,far:bigint>>").alias("_all"))
    reached = listed.withColumn("_next", F.filter("_all", lambda t: t.isNotNull() & fits(t["far"])))
    return reached.where(F.size("_next") > 0).drop("_all")


def with_row_frame(df: DataFrame, keys: Sequence[str], order: Sequence[SortKey], aggregates: Mapping[str, Column], rows: int,
                   slices: int | None = None) -> DataFrame:
    """Aggregates over the last ``rows`` rows of the key, this one included: ``{"top": F.max("x")}``.

    Rows that agree in the sort keys are taken in the order of a hash of the row.  Each slice of a key borrows the last ``rows`` - 1
    rows before it, from as many slices as that takes; nothing else is copied.
    """
    if rows < 1:
        raise ValueError("a frame has at least one row")
    placed = _placed(df, keys, columns_of(order), slices)
    summary = placed.groupBy(_GROUP, _SLICE).agg(F.count(F.lit(1)).alias("_n"), F.max(_ID).alias("_last"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(_GROUP).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    summary = through_storage(summary.select(_GROUP, _SLICE, "_last", (before + F.col("_n")).alias("_until"), before.alias("_before")), "frame-slices")
    # A row with d rows behind it in its slice is d + (rows in between) + 1 rows before the first of a later slice.
    near = _following(summary, F.col("_before"), lambda far: far - F.col("_until") <= rows - 2)
    borrowed = placed.join(near.select(_GROUP, _SLICE, "_next", "_last", "_until"), [_GROUP, _SLICE]).where(F.col("_last") - F.col(_ID) <= rows - 2)
    wanted = F.filter("_next", lambda t: F.col("_last") - F.col(_ID) + t["far"] - F.col("_until") <= rows - 2)
    borrowed = borrowed.withColumn(_SLICE, F.explode(F.transform(wanted, lambda t: t["slice"])))
    frame = Window.partitionBy(_GROUP, _SLICE).orderBy(_ID).rowsBetween(1 - rows, 0)
    kept = [*df.columns, _GROUP, _SLICE, _ID]
    both = placed.select(*kept, F.lit(True).alias("_own")).unionByName(borrowed.select(*kept, F.lit(False).alias("_own")))
    return both.withColumns({name: c.over(frame) for name, c in aggregates.items()}).where("_own").select(*df.columns, *aggregates)


#: kind -> (what is kept of equal positions, how kept values combine)
_KINDS = {"sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def with_range_frame(df: DataFrame, keys: Sequence[str], at: Column, measures: Mapping[str, tuple[str, str]], reach: int,
                     slices: int | None = None) -> DataFrame:
    """Aggregates over the rows of the key whose position is within ``reach`` before this row's, equal positions included.

    ``at`` is a whole number: ``F.unix_date("day")`` with a reach of 6 for a week, ``F.unix_micros("ts")`` for durations.  ``measures`` are
    name -> (kind, column) with kind sum, count, min, max or mean.  Rows without a position get NULL (a count: 0).

    Rows of one position are combined first, before the shuffle, so frames run over positions and a crowded position costs
    nothing; results come back in a join that Spark can split.

    Positions are parted into stretches as long as a frame.  A frame is then the end of one stretch, from where the frame begins, and
    the start of the next one, up to the row: two running aggregates, however many rows a frame has.  They
    are combined, never subtracted, so sums of doubles stay what they are.
    """
    if reach < 0:
        raise ValueError("a frame reaches back, so its reach is not negative")
    parts: dict[str, tuple[str, str]] = {}
    for name, (kind, column) in measures.items():
        if kind not in (*_KINDS, "mean"):
            raise ValueError(f"unknown kind {kind!r}")
        parts |= {f"_{name}_sum": ("sum", column), f"_{name}_count": ("count", column)} if kind == "mean" else {f"_{name}": (kind, column)}
    named = df.withColumn("_at", at.cast("long"))
    by_position = named.where("_at is not null").groupBy(*keys, "_at").agg(*[_KINDS[kind][0](column).alias(part) for part, (kind, column) in parts.items()])
    combine = {part: _KINDS[kind][1] for part, (kind, _) in parts.items()}
    types = {f.name: f.dataType for f in by_position.agg(*[f(part).alias(part) for part, f in combine.items()]).schema}
    width = reach + 1
    own = F.struct(F.col("_at").alias("_t"), F.lit(True).alias("_own"))
    begin = F.struct((F.col("_at") - F.lit(reach)).alias("_t"), F.lit(False).alias("_own"))
    told = F.when(F.pmod(F.col("_at"), F.lit(width)) == reach, F.array(own)).otherwise(F.array(begin, own))
    rows = by_position.select("*", F.inline(told)).withColumns({part: F.when(F.col("_own"), F.col(part)) for part in parts})
    placed = _placed(rows, keys, [F.col("_t"), F.col("_own")], slices).withColumn("_stretch", F.col("_t") - F.pmod(F.col("_t"), F.lit(width)))

    def both(kind: str, a: Column, b: Column) -> Column:
        return {"min": F.least, "max": F.greatest}.get(kind, lambda a, b: F.coalesce(a + b, a, b))(a, b)

    # Of the stretches of a slice only the first and the last lie in others as well.
    here = Window.partitionBy(_GROUP, "_stretch")
    summary = placed.groupBy(_GROUP, _SLICE, "_stretch").agg(*[f(part).alias(part) for part, f in combine.items()])
    carried = summary.withColumn("_slices", F.count(F.lit(1)).over(here)).where("_slices > 1")
    ways = {"up": F.asc, "down": F.desc}
    carried = carried.select(_GROUP, _SLICE, "_stretch", *[f(part).over(here.orderBy(towards(_SLICE)).rowsBetween(Window.unboundedPreceding, -1)).alias(f"{part}_{way}")
                                                           for part, f in combine.items() for way, towards in ways.items()])
    known = placed.join(carried, [_GROUP, _SLICE, "_stretch"], "left")
    along = {way: Window.partitionBy(_GROUP, _SLICE, "_stretch").orderBy(towards(_ID)).rowsBetween(Window.unboundedPreceding, 0) for way, towards in ways.items()}
    told = {way: {part: both(kind, f(part).over(along[way]), F.col(f"{part}_{way}")) for (part, (kind, _)), f in zip(parts.items(), combine.values())} for way in ways}
    halves = known.withColumns({f"_half{part}": F.when(F.col("_own"), told["up"][part]).otherwise(told["down"][part]).cast(types[part]) for part in parts})
    key = F.struct(*[F.col(f"{_GROUP}.{k}").alias(k) for k in keys], F.col("_at").alias("_at"))
    framed = halves.groupBy(key.alias("_key")).agg(*[f(f"_half{part}").cast(types[part]).alias(part) for part, f in combine.items()])
    out = {name: F.col(f"_{name}_sum") / F.when(F.col(f"_{name}_count") > 0, F.col(f"_{name}_count")) if kind == "mean" else F.col(f"_{name}")
           for name, (kind, _) in measures.items()}
    per_key = framed.select("_key", *[c.alias(f"_{name}_out") for name, c in out.items()])
    joined = joined_on_key(named, [*keys, "_at"], per_key, "left")
    made = {name: F.coalesce(f"_{name}_out", F.lit(0)) if kind == "count" else F.col(f"_{name}_out") for name, (kind, _) in measures.items()}
    return joined.withColumns(made).select(*df.columns, *measures)


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, right_at: str, *, tolerance: str | None = None,
               direction: str = "backward", strict: bool = False, tie_break: Sequence[SortKey] | None = None, slices: int | None = None) -> DataFrame:
    """Each row of ``left`` with the last row of ``right`` of its key at or before its time; NULLs where there is none.

    ``direction`` "forward" takes the first at or after it.  ``strict`` leaves out equal times, ``tolerance`` (``"2 days"``) what is
    farther away.  All left rows are kept once.  NULL keys and NULL times match nothing.  Two right rows of a key at one time stop the job,
    unless ``tie_break`` says which comes first.  The other columns of ``right`` (``right_at`` among them) must not be
    in ``left``.

    Both tables are put in one order by key and time; within a slice the last right row is carried along, and one row per
    (key, slice) carries it into the next slices.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction must be backward or forward, not {direction!r}")
    payload = [c for c in right.columns if c not in keys]
    clash = set(left.columns) & set(payload)
    if clash:
        raise ValueError(f"rename before joining, both sides have {sorted(clash)}")
    back = direction == "backward"
    usable = right.where(" and ".join(f"`{k}` is not null" for k in [*keys, right_at]))
    if tie_break is None:
        usable = one_row_per_key(usable, [*keys, right_at], "right side").select(*right.columns)
    else:  # one row per time is enough, and keeps the order below free of ties
        first = Window.partitionBy(*keys, right_at).orderBy(*columns_of(tie_break))
        usable = usable.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")
    named = left.withColumns({"_time": F.col(at), "_row": F.struct(*left.columns)})
    none = F.lit(None).cast(usable.select(F.struct(*payload).alias("p")).schema["p"].dataType)
    theirs = usable.select(*keys, F.col(right_at).alias("_time"), F.struct(*payload).alias("_right"), F.lit(None).cast(named.schema["_row"].dataType).alias("_row"))
    mine = named.select(*keys, "_time", none.alias("_right"), "_row")
    # Where times are equal, a right row that counts comes first in the direction of the search.
    right_first = back != strict
    side = F.when(F.col("_row").isNull(), 0 if right_first else 1).otherwise(1 if right_first else 0)
    placed = _placed(theirs.unionByName(mine), keys, [F.col("_time"), side], slices)
    # Forward is backward in the opposite order: Spark computes a frame up to the last row anew for every row.
    pick, towards = (F.max_by, F.asc) if back else (F.min_by, F.desc)
    summary = placed.groupBy(_GROUP, _SLICE).agg(pick("_right", F.when(F.col("_right").isNotNull(), F.col(_ID))).alias("_edge"))
    along = Window.partitionBy(_GROUP).orderBy(towards(_SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(_GROUP, _SLICE, F.last("_edge", True).over(along).alias("_from"))
    here = Window.partitionBy(_GROUP, _SLICE).orderBy(towards(_ID)).rowsBetween(Window.unboundedPreceding, 0)
    found = placed.join(summary, [_GROUP, _SLICE]).withColumn("_right", F.coalesce(F.last("_right", True).over(here), F.col("_from"))).where("_row is not null")
    near = F.col("_time").isNotNull()
    if tolerance is not None:
        limit = F.expr(f"interval {tolerance}")
        near = near & (F.col(f"_right.{right_at}") >= F.col("_time") - limit if back else F.col(f"_right.{right_at}") <= F.col("_time") + limit)
    return found.select("_row.*", *[F.when(near, F.col(f"_right.`{c}`")).alias(c) for c in payload])
