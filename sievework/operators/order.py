"""Sort keys with explicit direction and NULL placement."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SortKey:
    name: str
    descending: bool = False
    nulls_last: bool = True

    def column(self) -> Column:
        c = F.col(self.name)
        if self.descending:
            return c.desc_nulls_last() if self.nulls_last else c.desc_nulls_first()
        return c.asc_nulls_last() if self.nulls_last else c.asc_nulls_first()

    def reversed(self) -> "SortKey":
        return SortKey(self.name, not self.descending, not self.nulls_last)


def asc(name: str, nulls_last: bool = True) -> SortKey:
    return SortKey(name, False, nulls_last)


def desc(name: str, nulls_last: bool = True) -> SortKey:
    return SortKey(name, True, nulls_last)


def columns_of(keys: Sequence[SortKey]) -> list[Column]:
    return [k.column() for k in keys]
