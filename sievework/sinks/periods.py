"""Tables rebuilt period by period, switched by a pointer in a ledger.

A run writes the rows of all its periods into folders of its own, beside those that readers use.  Only when everything is
written and checked does one appended ledger file name the new folders, for all tables of a period at once: silver and
gold change together, a reader sees the old or the new rows and never a gap, and a run that stops leaves the pointers alone.
Old folders stay until ``vacuum``, so a published period can be put back.

The driver handles one row per (period, table), never rows of the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.sinks.publish import _partition_dir, layer_path, read_table, unsorted_partitions

PERIOD, RUN = "period", "run"
#: Files a task keeps open; with more periods than that it sorts the rest of its rows.
OPEN_FILES = 8
PUBLISHED, REFUSED = "published", "refused"
LEDGER = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("run", T.StringType(), False),
    T.StructField("period", T.StringType(), False),
    T.StructField("layer", T.StringType(), False),
    T.StructField("table", T.StringType(), False),
    T.StructField("rows", T.LongType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("reason", T.StringType(), True),
])


@dataclass(frozen=True)
class PeriodStore:
    """Period tables below ``root``.  A period is text (``2024-04``) and never NULL."""

    spark: SparkSession
    root: str

    # --- writing ---

    def new_run(self) -> str:
        """A name for a run's folders that no other run has."""
        return uuid.uuid4().hex

    def stage(self, df: DataFrame, layer: str, table: str, run: str) -> DataFrame:
        """Write ``df`` (with a period column) into the run's folder of the table, and read it back."""
        path = f"{layer_path(self.root, layer, table)}/{RUN}={run}"
        # Rows of a period come together, in as many tasks as its size needs; few periods meet in a task, so it need not sort.
        with unsorted_partitions(self.spark, OPEN_FILES):
            df.hint("rebalance", F.col(PERIOD)).write.mode("error").partitionBy(PERIOD).parquet(path)
        return self.spark.read.schema(_ordered(df.schema)).parquet(path)

    def publish(self, run: str, tables: Sequence[tuple[str, str]], rows: dict[tuple[str, str], int], periods: Iterable[str],
                refused: dict[str, str] | None = None) -> int:
        """Point ``periods`` at the run, except the ``refused`` ones, whose reason is noted.  Returns the number of the entry.

        ``tables`` are (layer, table), ``rows`` counts by (table, period); a period without rows is published as empty.
        All of it is one file, so it counts as a whole or not at all.
        """
        refused = refused or {}
        seq = self._last() + 1
        entries = [(seq, run, p, layer, table, int(rows.get((table, p), 0)), REFUSED if p in refused else PUBLISHED, refused.get(p))
                   for p in sorted(set(periods)) for layer, table in tables]
        self._append(entries)
        return seq

    def put_back(self, period: str, seq: int) -> int:
        """Publish a period again as entry ``seq`` had it.  Returns the number of the new entry."""
        old = self.ledger().where((F.col("seq") == seq) & (F.col(PERIOD) == period) & (F.col("status") == PUBLISHED)).collect()
        if not old:
            raise ValueError(f"entry {seq} did not publish {period}")
        new = self._last() + 1
        self._append([(new, *r[1:7], f"put back from entry {seq}") for r in old])
        return new

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete folders of periods that neither a pointer names nor one of the ``keep`` publications before it.

        Folders of unfinished runs go as well, so no run may be under way.  Returns what was deleted.
        """
        if keep < 0:
            raise ValueError("keep at least the published rows")
        named, gone = set(), []
        seen: dict[tuple, list] = {}
        for r in self.ledger().where(F.col("status") == PUBLISHED).orderBy(F.desc("seq"), F.desc("run")).collect():
            runs = seen.setdefault((r.layer, r.table, r.period), [])
            if r.run not in runs:
                runs.append(r.run)
            if runs.index(r.run) <= keep:
                named.add(self._folder(r.layer, r.table, r.run, r.period))
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for layer, table in sorted({(r.layer, r.table) for r in self.ledger().select("layer", "table").distinct().collect()}):
            top = jvm.org.apache.hadoop.fs.Path(layer_path(self.root, layer, table))
            fs = top.getFileSystem(conf)
            for run in fs.listStatus(top) if fs.exists(top) else []:
                for part in fs.listStatus(run.getPath()):
                    path = part.getPath()
                    plain = f"{layer_path(self.root, layer, table)}/{run.getPath().getName()}/{path.getName()}"
                    if part.isDirectory() and plain not in named:
                        fs.delete(path, True)
                        gone.append(plain)
        return sorted(gone)

    # --- reading ---

    def ledger(self) -> DataFrame:
        """All entries so far."""
        return read_table(self.spark, f"{self.root.rstrip('/')}/ledger", LEDGER)

    def pointers(self, table: str) -> DataFrame:
        """(period, seq, run, layer, rows) of a table: what each period points at now."""
        newest = F.max_by(F.struct("seq", "run", "layer", "rows"), F.struct("seq", "run"))
        return (self.ledger().where((F.col("table") == table) & (F.col("status") == PUBLISHED))
                .groupBy(PERIOD).agg(newest.alias("_p")).select(PERIOD, "_p.*"))

    def read(self, table: str, schema: T.StructType, periods: Iterable[str] | None = None) -> DataFrame:
        """The published rows of a table, all periods or the given ones; the period is a column.

        Only folders that a pointer names are listed, so neither old runs nor other periods are read.
        """
        wanted = None if periods is None else set(periods)
        now = [p for p in self.pointers(table).collect() if p.rows and (wanted is None or p.period in wanted)]
        fields = _ordered(schema)
        if not now:
            return self.spark.createDataFrame([], fields)
        base = layer_path(self.root, now[0].layer, table)
        placed = T.StructType([*fields.fields[:-1], T.StructField(RUN, T.StringType()), T.StructField(PERIOD, T.StringType())])
        return (self.spark.read.schema(placed).option("basePath", base)
                .parquet(*[self._folder(p.layer, table, p.run, p.period) for p in now]).select(*fields.fieldNames()))

    # --- helpers ---

    def _folder(self, layer: str, table: str, run: str, period: str) -> str:
        return _partition_dir(layer_path(self.root, layer, table), {RUN: run, PERIOD: period})

    def _last(self) -> int:
        return self.ledger().agg(F.max("seq")).first()[0] or 0

    def _append(self, entries: list[tuple]) -> None:
        if entries:
            self.spark.createDataFrame(entries, LEDGER).coalesce(1).write.mode("append").parquet(f"{self.root.rstrip('/')}/ledger")


def _ordered(schema: T.StructType) -> T.StructType:
    """The table's fields without the period, then the period as text."""
    return T.StructType([*[f for f in schema.fields if f.name != PERIOD], T.StructField(PERIOD, T.StringType())])
