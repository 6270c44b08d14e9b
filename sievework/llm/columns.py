"""Column builders shared by the corpus operators: bound values, words, shingles, row numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.session import through_storage

#: Characters that part words (fixed by the result contracts).
SPACE = r"[\x20\x09-\x0D]+"
SHINGLE_WORDS = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    An expression used inside a lambda would be computed for every element; a lambda
    variable is computed once, so the value is bound as the one element of an array.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Maximal runs without white space, in order; no words for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def window_hashes(word_list: Column, width: int = SHINGLE_WORDS) -> Column:
    """64-bit hash of every ``width``-word window; empty below ``width`` words.  ``word_list`` must be bound."""
    return F.when(F.size(word_list) < width, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(word_list) - width),
                    lambda i: F.xxhash64(*[word_list[i + k] for k in range(width)])))


def shingle_set(text: Column) -> Column:
    """Hashes of the distinct five-word shingles of the lower-cased text.

    Fewer than five words are one shingle; no words, or NULL, are the empty set.
    """
    def of(w: Column) -> Column:
        whole = F.array(F.xxhash64(F.concat_ws(" ", w)))
        return (F.when(F.size(w) >= SHINGLE_WORDS, F.array_distinct(window_hashes(w)))
                .when(F.size(w) > 0, whole).otherwise(F.array().cast("array<bigint>")))
    return let(words(F.lower(text)), of)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (case is ignored, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def plain_columns(df: DataFrame, needed: dict[str, str]) -> DataFrame:
    """Only the needed columns, cast to the given types: extra columns cannot clash with working names."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in needed.items()])


def numbered(df: DataFrame, order: list[str], name: str, label: str) -> DataFrame:
    """``df`` through storage with ``name``: 0, 1, 2, ... over the whole table in the order of ``order``.

    Range partitions are sorted and stored with their own row numbers; the rows before each
    partition come from one count per partition.  No window runs over the table.
    """
    placed = (df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
              .withColumn("__at", F.monotonically_increasing_id()))
    stored = through_storage(placed, label)
    part, row = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = stored.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    return (stored.withColumn("__part", part).join(offsets, "__part")
            .withColumn(name, F.col("__before") + row).drop("__part", "__before", "__at"))
