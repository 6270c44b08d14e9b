"""Delimited text in: everything stays text until its meaning has been decided."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.sources.encoding import profile_files

SOURCE_COLUMN = "_src"


def _reader(spark: SparkSession, encoding: str, separator: str, header: bool, multiline: bool):
    return (spark.read.option("header", header).option("sep", separator)
            .option("encoding", encoding).option("quote", '"').option("escape", '"')
            .option("mode", "FAILFAST").option("multiLine", multiline))


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_as_text(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], *,
                 encoding: str = "UTF-8", separator: str = ",", header: bool = True,
                 multiline: bool = False) -> DataFrame:
    """Files with one known header, every column as text, empty cells as empty text."""
    rows = _reader(spark, encoding, separator, header, multiline).schema(text_schema(columns)).csv(paths)
    return rows.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns],
                       F.col("_metadata.file_name").alias(SOURCE_COLUMN))


def read_delivery(spark: SparkSession, paths: str | Sequence[str], *, separator: str = ",",
                  multiline: bool = False) -> DataFrame:
    """All files of a delivery as one table, whatever their encodings and column orders.

    One scan per (encoding, header); columns are matched by name, and a column a
    file does not have is NULL for its rows.
    """
    groups: dict[tuple, list[str]] = defaultdict(list)
    for profile in profile_files(spark, paths, separator):
        groups[(profile.encoding, profile.header)].append(profile.path)
    parts = [read_as_text(spark, files, header, encoding=encoding, separator=separator, multiline=multiline)
             for (encoding, header), files in sorted(groups.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_typed(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType, *,
               encoding: str = "UTF-8", separator: str = ",", header: bool = True,
               date_format: str | None = None, timestamp_format: str | None = None) -> DataFrame:
    """Delimited text with given column types; a value that does not fit stops the job."""
    reader = _reader(spark, encoding, separator, header, False).schema(schema)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    return reader.csv(paths)


def read_inferred(spark: SparkSession, paths: str | Sequence[str], *, separator: str = ",") -> DataFrame:
    """Delimited text with guessed types: costs a second scan, and loses leading zeros."""
    return (spark.read.option("header", True).option("inferSchema", True).option("sep", separator)
            .option("escape", '"').csv(paths))


def read_json_lines(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType, *,
                    multiline: bool = False) -> DataFrame:
    """JSON, one object per line, or whole arrays per file with ``multiline``."""
    return spark.read.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST").json(paths)


def with_arrival(df: DataFrame, name: str = "_arrival") -> DataFrame:
    """Explicit arrival order for rows straight from a file scan: by file, by where the split begins in it, by row of the split.

    Splits are cut at the same bytes every time for the same settings of the reader, and rows of a split are read in order.
    Apply it directly to the reader's output, before any shuffle.  For Parquet, ``with_row_arrival`` depends on no splits.
    """
    return df.withColumn(name, F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("position")))


def with_row_arrival(df: DataFrame, name: str = "_arrival") -> DataFrame:
    """The same for Parquet files, whose rows are numbered in the file: neither splits nor retried tasks change the order."""
    return df.withColumn(name, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")))


def rows_per_file(df: DataFrame) -> DataFrame:
    """(file, rows, bytes) of every file, by its path, that rows of a scan come from; apply it directly to the reader's output."""
    return (df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
            .groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("rows")).select("file", "rows", "bytes"))
