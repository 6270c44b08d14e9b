"""Writing so that a second run leaves the same table as the first.

Tables are plain partitioned Parquet directories.  Spark writes the new partitions
beside the table and moves them in when all tasks are done, so a failing computation
never touches the published table, and a table may be rebuilt from itself.  Rows go
through the shared scratch folder first only where they are needed twice.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from sievework.operators.dedup import latest_by
from sievework.operators.joins import one_row_per_key
from sievework.operators.order import SortKey
from sievework.session import through_storage
from sievework.sinks.contract import enforce_contract

LAYERS = ("bronze", "silver", "gold")


def layer_path(root: str, layer: str, table: str) -> str:
    """Where a table of a layer lives: untouched input, cleaned rows, summaries."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; with ``schema``, a table that does not exist yet reads as empty."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if schema is not None and "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    through_storage(df, "refresh").write.mode("overwrite").parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    """Add rows to an immutable log.  A repeated run repeats the rows: readers use latest_view."""
    df.write.mode("append").parquet(path)


def latest_view(spark: SparkSession, path: str, keys: Sequence[str], stamp: str,
                tie_break: Sequence[SortKey]) -> DataFrame:
    """Current state of an append log."""
    return latest_by(spark.read.parquet(path), keys, stamp, tie_break)


@contextmanager
def unsorted_partitions(spark: SparkSession, writers: int) -> Iterator[None]:
    """Writes started inside keep up to ``writers`` files per task open instead of sorting the task's rows by partition.

    For few partitions of many rows: the sort would need memory for all rows of a task.  Every open file has a buffer of its own.
    A task that meets more partitions sorts the rest of its rows.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(writers))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


# The characters that Spark writes as %XX in the folder of a partition, and its folder for NULL.
_ESCAPED = frozenset([*map(chr, range(1, 32)), *'"#%\'*/:=?\\\x7f{[]^'])
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _folder_text(value) -> str:
    if value is None or str(value) == "":
        return _NULL_FOLDER
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))


def _partition_dir(path: str, values: Mapping[str, object]) -> str:
    """The folder that Spark's writer gives a partition."""
    return "/".join([path.rstrip("/"), *[f"{_folder_text(k)}={_folder_text(v)}" for k, v in values.items()]])


def clear_partition(spark: SparkSession, path: str, values: Mapping[str, object], schema: T.StructType) -> None:
    """Leave a partition without rows."""
    data = T.StructType([f for f in schema.fields if f.name not in values])
    spark.createDataFrame([], data).write.mode("overwrite").parquet(_partition_dir(path, values))


def replace_partition(df: DataFrame, path: str, values: Mapping[str, str],
                      agreed: T.StructType | None = None, stored: bool = False) -> None:
    """Swap in one partition.  ``df`` holds its rows, without the partition columns.

    An empty result empties the partition: what the period no longer has must go.
    ``stored`` says that ``df`` reads finished files already and needs no staging.
    """
    checked = enforce_contract(df, agreed) if agreed is not None else df
    staged = checked if stored else through_storage(checked, "partition")
    staged.write.mode("overwrite").parquet(_partition_dir(path, values))


def replace_partitions(df: DataFrame, path: str, by: Sequence[str], agreed: T.StructType | None = None,
                       rerun: DataFrame | None = None, stored: bool = False) -> None:
    """Swap in every partition that ``df`` has rows for; all others stay as they are.

    ``rerun`` lists the partitions this run is responsible for (one row each).  Those
    of them without rows in ``df`` are emptied.  ``stored`` says that ``df`` and ``rerun`` read finished files already,
    none of them of the table, and need no staging.
    """
    spark = df.sparkSession
    if agreed is not None:
        df = enforce_contract(df.select(*agreed.fieldNames()), agreed)
    # Rebalancing brings rows of a partition together, so that not every task writes a
    # file into every partition, and splits partitions that are too large for one task.
    rows = df.hint("rebalance", *[F.col(c) for c in by])
    if rerun is not None and not stored:
        rows = df = through_storage(rows, "partitions")
        rerun = through_storage(rerun.select(*by).distinct(), "rerun")  # it may be derived from the table
    (rows.write.mode("overwrite").partitionBy(*by)
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    if rerun is not None:
        for row in null_safe(rerun, df.select(*by).distinct(), by, "left_anti").collect():
            clear_partition(spark, path, row.asDict(), df.schema)


def null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join in which NULL equals NULL."""
    named = right.select(*[F.col(c).alias(f"_right_{c}") for c in columns])
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in columns]
    return left.join(named, same, how)


def upsert(source: DataFrame, path: str, keys: Sequence[str], by: Sequence[str]) -> None:
    """Update matching keys, insert the others.  Keys absent from ``source`` stay; NULL is a value like others.

    A source with a repeated key stops the job.  Only partitions that hold or receive
    a key of the source are rewritten, also the one a key moves away from.
    """
    spark = source.sparkSession
    incoming = through_storage(source, "upsert")
    # A pass over the keys alone, which stops at a repeated one.
    one_row_per_key(incoming.select(*keys), keys, "upsert source").write.format("noop").mode("overwrite").save()
    current = read_table(spark, path, source.schema).select(*source.columns)
    touched = (null_safe(current, incoming, keys, "left_semi").select(*by)
               .unionByName(incoming.select(*by)).distinct())
    touched = through_storage(touched, "touched")
    kept = null_safe(null_safe(current, touched, by, "left_semi"), incoming, keys, "left_anti")
    replace_partitions(kept.unionByName(incoming), path, by, rerun=touched)


def export_single(df: DataFrame, path: str, key: Sequence[str], agreed: T.StructType | None = None) -> None:
    """One Parquet file in key order, for a consumer that asks for exactly that.

    One task writes all rows, so this is an export for results of bounded size;
    tables stay partitioned.
    """
    df = enforce_contract(df, agreed) if agreed is not None else df
    df.coalesce(1).sortWithinPartitions(*key).write.mode("overwrite").parquet(path)


def export_sorted(df: DataFrame, path: str, key: Sequence[str], files: int, agreed: T.StructType | None = None) -> None:
    """About ``files`` Parquet files that hold the rows in key order, file after file by name; each is written by a task of its own.

    Rows are range-partitioned by the key and sorted inside partitions, so the first file ends where the second begins.
    """
    df = enforce_contract(df, agreed) if agreed is not None else df
    df.repartitionByRange(files, *key).sortWithinPartitions(*key).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """Delimited text with a header.  Types are lost; use Parquet between steps."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("encoding", encoding).csv(path)


def month_of(day: Column) -> Column:
    """Partition value yyyy-MM of a date or timestamp column."""
    return F.date_format(day, "yyyy-MM")
