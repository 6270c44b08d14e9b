"""Which encoding and which header each delivered file has.

Reading cp932 bytes as UTF-8 does not fail in Spark, it silently yields
replacement characters, and one scan over files with different headers swaps
columns.  Both facts are therefore established per file before anything is
parsed.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class FileProfile:
    path: str
    encoding: str
    header: tuple[str, ...]


@F.arrow_udf(T.BooleanType())
def _is_cp932(values: pa.Array) -> pa.Array:
    def strict(raw):
        if raw is None:
            return None
        try:
            raw.decode("cp932")
        except UnicodeDecodeError:
            return False
        return True

    return pa.array([strict(v) for v in values.to_pylist()], pa.bool_())


def encoding_evidence(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file: are all bytes valid UTF-8, are the others valid cp932.

    The text source hands on the raw bytes of each line, and neither encoding uses
    the line feed byte inside a character, so testing lines tests the file.  The
    scan splits large files; only flags are aggregated, so nothing is sorted, and what is
    shuffled is one partial row per file and task.
    """
    value = F.col("value")
    utf8 = F.is_valid_utf8(value)
    tested = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), utf8.alias("utf8"),
                                           _is_cp932(F.when(~utf8, value.cast("binary"))).alias("cp932"))
    return tested.groupBy("path").agg(
        F.bool_and("utf8").alias("utf8"),
        F.coalesce(F.bool_and("cp932"), F.lit(True)).alias("cp932"),
        F.count_if(~F.col("utf8") & ~F.col("cp932")).alias("unreadable_lines"))


@contextmanager
def _split_per_task(spark: SparkSession) -> Iterator[None]:
    """Scans run inside give every split of a file a task of its own: opening a file counts as much as the largest split."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name, None)
    spark.conf.set(name, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def first_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, first_line): the bytes of the first line of every file that has one; as long as the file listing.

    Every split is a task, so the first line of a file is the first row of the task that begins at the file's start.
    No other line leaves the scan.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("first_line"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("position"))
    with _split_per_task(spark):
        found = lines.where("block = 0 and position = 0").select("path", "first_line").collect()
    return spark.createDataFrame(found, "path string, first_line binary")


def _header(line: bytes, codec: str, separator: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([line.decode(codec).rstrip("\r")], delimiter=separator)))


def headers(spark: SparkSession, paths: str | Sequence[str], encoding: str, separator: str = ",") -> dict[tuple[str, ...], list[str]]:
    """The files behind each different header; as long as the file listing."""
    codec = "utf-8-sig" if encoding.upper() == "UTF-8" else "cp932" if encoding.lower() == "windows-31j" else encoding
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first_lines(spark, paths).orderBy("path").collect():
        found.setdefault(_header(bytes(row.first_line), codec, separator), []).append(row.path)
    if not found:
        raise ValueError(f"no files at {paths}")
    return found


def profile_files(spark: SparkSession, paths: str | Sequence[str], separator: str = ",") -> list[FileProfile]:
    """Encoding and header of every file; a file in neither encoding stops the job.

    The result is as long as the file listing, which the driver holds anyway.
    """
    found = []
    for row in encoding_evidence(spark, paths).join(first_lines(spark, paths), "path", "left").orderBy("path").collect():
        if row.utf8:
            encoding, codec = "UTF-8", "utf-8-sig"
        elif row.cp932:
            encoding, codec = "windows-31j", "cp932"
        else:
            raise ValueError(f"cannot tell the encoding of {row.path}: {row.unreadable_lines} lines "
                             "are neither UTF-8 nor cp932")
        found.append(FileProfile(row.path, encoding, _header(bytes(row.first_line), codec, separator)))
    if not found:
        raise ValueError(f"no files at {paths}")
    return found
