"""Sources described as data: where they lie, how their columns are called, constants."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.sources.delimited import SOURCE_COLUMN, read_as_text
from sievework.sources.encoding import headers


@dataclass(frozen=True)
class SourceSpec:
    """One kind of file from one system, for one period."""

    path: str
    columns: tuple[str, ...]
    rename: Mapping[str, str]
    constants: Mapping[str, str] = field(default_factory=dict)
    encoding: str = "UTF-8"
    period: str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        """The files read by the names in their own headers; a file without an expected column stops the job."""
        parts = []
        for header, files in headers(spark, self.path, self.encoding).items():
            absent = [c for c in self.columns if c not in header]
            if absent:
                raise ValueError(f"{self.path}: expected columns are absent: {absent}")
            parts.append(read_as_text(spark, files, header, encoding=self.encoding).select(*self.columns, SOURCE_COLUMN))
        return self.shape(union_by_name(parts))

    def shape(self, raw: DataFrame) -> DataFrame:
        """Common names and constants; columns that are not renamed are left behind."""
        absent = [c for c in self.rename if c not in raw.columns]
        if absent:
            raise ValueError(f"{self.path}: expected columns are absent: {absent}")
        kept = [F.col(old).alias(new) for old, new in self.rename.items()]
        kept += [F.lit(v).alias(k) for k, v in self.constants.items()]
        if SOURCE_COLUMN in raw.columns:
            kept.append(F.col(SOURCE_COLUMN))
        return raw.select(*kept)


def union_by_name(frames: Iterable[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """Stack tables by column name, never by position."""
    frames = [f.select(*columns) if columns else f for f in frames]
    return reduce(lambda a, b: a.unionByName(b), frames)


def sources_for(registry: Iterable[SourceSpec], period: str) -> list[SourceSpec]:
    """The sources of a period; an unregistered period is an error, not an empty result."""
    hits = [s for s in registry if s.period == period]
    if not hits:
        raise ValueError(f"no source is registered for {period}")
    return hits


def load(spark: SparkSession, sources: Iterable[SourceSpec], columns: Sequence[str]) -> DataFrame:
    """All given sources in one table with the given columns."""
    return union_by_name([s.read(spark) for s in sources], columns)
