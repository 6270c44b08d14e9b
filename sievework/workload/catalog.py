"""Where queries register themselves."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.session import configure, scratch_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """The input tables of one scale factor: ``t.orders``, ``t.lineitem``, ..."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, frame)
        return frame

    @cached_property
    def scratch(self) -> str:
        return scratch_path(self.spark, "query")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, build: Callable[[Tables], DataFrame], sql: str | None) -> None:
    """Register a query; ``sql`` is None where SQL cannot express it."""
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
    if sql is not None:
        ORACLES[name] = sql


def iso(c: Column | str) -> Column:
    """A date or timestamp as text, for results that have to read the same everywhere."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def n_rows() -> Column:
    """Number of rows, named n."""
    return F.count(F.lit(1)).alias("n")


def cents(c: str) -> Column:
    """A money column as whole cents."""
    return F.rint(F.col(c) * 100).cast("bigint")
