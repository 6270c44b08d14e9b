"""Checks of a table as a table: one row per check, with how many rows fail it and at most three of them.

Checks of rows share one pass: failures are counted while the data flows, and only the first three of each check go on, which
Spark limits before the shuffle.  Nothing stops at the first finding, and nothing but three examples per check is gathered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.operators.compare import _differs
from sievework.session import through_storage
from sievework.sinks.contract import EXAMPLES, name_problems, type_problems

FINDINGS = T.StructType([T.StructField("check", T.StringType()), T.StructField("failed", T.LongType()), T.StructField("examples", T.ArrayType(T.StringType()))])
#: Rows of a file that are compared with their neighbours in one group.
ORDER_BLOCK = 1 << 16


def shown(*columns: str) -> Column:
    """Key values as one text, for examples."""
    return F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])


def row_findings(df: DataFrame, checks: Mapping[str, Column], example: Column) -> DataFrame:
    """(check, failed, examples) for conditions that hold for faulty rows; NULL is no fault.

    Examples are the smallest three by ``example`` (text).
    """
    if not checks:
        return df.sparkSession.createDataFrame([], FINDINGS)
    seen = Observation()
    flags = {f"_f{i}": F.coalesce(c, F.lit(False)) for i, c in enumerate(checks.values())}
    flagged = df.select(example.alias("_example"), *[c.alias(n) for n, c in flags.items()])
    counted = flagged.observe(seen, *[F.count_if(F.col(n)).alias(n) for n in flags])
    failing = F.array_compact(F.array(*[F.when(F.col(n), F.lit(name)) for n, name in zip(flags, checks)]))
    faulty = counted.select("_example", F.explode(failing).alias("check"))
    nth = F.row_number().over(Window.partitionBy("check").orderBy("_example"))
    first = through_storage(faulty.withColumn("_nth", nth).where(F.col("_nth") <= EXAMPLES).select("check", "_nth", "_example"), "findings")
    numbers = seen.get
    rows = [(name, int(numbers[n] or 0)) for n, name in zip(flags, checks)]
    listed = first.groupBy("check").agg(F.transform(F.sort_array(F.collect_list(F.struct("_nth", "_example"))), lambda x: x["_example"]).alias("examples"))
    named = df.sparkSession.createDataFrame(rows, "check string, failed long").join(listed, "check", "left")
    return named.select("check", "failed", F.coalesce("examples", F.array().cast("array<string>")).alias("examples"))


def key_findings(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: how many keys more than one row has, and the first three."""
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(shown(*key).alias("k"))
    stored = through_storage(repeated, "repeated-keys")
    first = F.transform(F.sort_array(F.collect_list("k")), lambda k: k)
    examples = stored.orderBy("k").limit(EXAMPLES).agg(first.alias("examples"))
    return stored.agg(F.count(F.lit(1)).alias("failed")).crossJoin(examples).select(F.lit("unique key").alias("check"), "failed", "examples")  # one row each


def order_findings(df_from_files: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: how many rows lie behind a row with a greater key, files taken by their paths, and the first three places.

    ``df_from_files`` comes straight from a reader.  Rows are compared inside blocks of a file; blocks and
    files meet at their first and last rows only, which are few.
    """
    k = F.struct(*key)
    rows = df_from_files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), k.alias("k"))
    rows = rows.withColumn("block", F.floor(F.col("at") / ORDER_BLOCK))
    inside = rows.withColumn("before", F.lag("k").over(Window.partitionBy("file", "block").orderBy("at"))).where("k < before")
    ends = rows.groupBy("file", "block").agg(F.min_by(F.struct("at", "k"), "at").alias("first"), F.max_by("k", "at").alias("last"))
    across = ends.withColumn("before", F.lag("last").over(Window.orderBy("file", "block"))).where("first.k < before")  # one row per block
    places = inside.select("file", "at").unionByName(across.select("file", F.col("first.at").alias("at")))
    stored = through_storage(places, "order")
    examples = stored.orderBy("file", "at").limit(EXAMPLES).agg(F.sort_array(F.collect_list(F.struct("file", "at"))).alias("e"))
    told = F.transform("e", lambda x: F.concat(F.regexp_extract(x["file"], "[^/]*$", 0), F.lit(" row "), x["at"].cast("string")))
    return stored.agg(F.count(F.lit(1)).alias("failed")).crossJoin(examples).select(F.lit("order").alias("check"), "failed", told.alias("examples"))  # one row each


def contract_findings(df: DataFrame, agreed: T.StructType, key: Sequence[str], rules: Mapping[str, Column] | None = None, *, ordered_by: Sequence[str] = ()) -> DataFrame:
    """All findings of a table against what was agreed: columns, types, NOT NULL, rules, unique key, order of the files.

    ``rules`` are conditions that faulty rows fulfil.  Checks of columns that are absent are left out; the columns finding names them.
    """
    spark = df.sparkSession
    names, types = name_problems(df.schema, agreed), type_problems(df.schema, agreed, any_width=True)
    out = spark.createDataFrame([("columns", len(names), names), ("types", len(types), types)], FINDINGS)
    if any(k not in df.columns for k in key):
        return out
    checks = {f"{f.name} is missing": F.col(f.name).isNull() for f in agreed.fields if not f.nullable and f.name in df.columns}
    out = out.unionByName(row_findings(df, checks | dict(rules or {}), shown(*key))).unionByName(key_findings(df, key))
    return out.unionByName(order_findings(df, ordered_by)) if ordered_by else out


def comparison_findings(actual: DataFrame, expected: DataFrame, key: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """All findings of a table against the expected one: repeated keys of either side, extra and missing keys, differing values by column.

    Both tables meet once.  NULL keys are values; columns of another type, or that one side lacks, are findings themselves.  A key
    that is repeated on either side is compared with every partner it has.
    """
    spark = actual.sparkSession
    names, types = name_problems(actual.schema, expected.schema), type_problems(actual.schema, expected.schema)
    out = spark.createDataFrame([("columns", len(names), names), ("types", len(types), types)], FINDINGS)
    if any(k not in actual.columns for k in key):
        return out
    kinds = {f.name: f.dataType for f in expected.schema.fields}
    shared = [c for c in expected.columns if c not in key and c in actual.columns and actual.schema[c].dataType == kinds[c]]
    a = actual.select(*[F.col(k).alias(f"_k_{k}") for k in key], *[F.col(c).alias(f"_a_{c}") for c in shared], F.lit(True).alias("_in_a"))
    e = expected.select(*key, *[F.col(c).alias(f"_e_{c}") for c in shared], F.lit(True).alias("_in_e"))
    same = None
    for k in key:
        one = F.col(f"_k_{k}").eqNullSafe(F.col(k))
        same = one if same is None else same & one
    both = a.join(e, same, "full").withColumns({k: F.when(F.col("_in_a"), F.col(f"_k_{k}")).otherwise(F.col(k)) for k in key})
    paired = F.col("_in_a").isNotNull() & F.col("_in_e").isNotNull()
    checks = {"extra": F.col("_in_e").isNull(), "missing": F.col("_in_a").isNull()} | {f"values of {c}": paired & _differs(c, kinds[c], tolerance) for c in shared}
    sides = [key_findings(df, key).withColumn("check", F.lit(f"unique key, {side}")) for side, df in (("actual", actual), ("expected", expected))]
    return out.unionByName(sides[0]).unionByName(sides[1]).unionByName(row_findings(both, checks, shown(*key)))
