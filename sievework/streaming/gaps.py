"""Silent stretches per key in a stream: keyed state with event-time timers and expiry.

Rows are thinned out where they are read: of a key's rows in one stretch shorter than the wanted gap only the first, the last
and the number go on, so a key with a third of all rows sends a few rows per task and stretch.  State per key is how far
its rows reach, and what has not been passed by the watermark yet; it goes when the key has been silent for ``expire``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Keyed state with timers is kept by Spark's RocksDB store only.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
GAPS = "{key} {kind}, last_seen timestamp, seen_again timestamp, n long"


def _micros(t: datetime) -> int:
    t = t if t.tzinfo else t.replace(tzinfo=timezone.utc)
    return (t - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


class _Gaps(StatefulProcessor):
    """State: ``reach`` (last time behind the watermark, rows since the last gap, the timer set), ``pending`` stretches by their start.

    Every question to the state is a message to the JVM, so a key asks once for each and writes only what changed.
    """

    def __init__(self, key: str, gap: timedelta, expire: timedelta):
        self.key, self.gap, self.expire = key, gap // timedelta(microseconds=1), expire // timedelta(milliseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.reach = handle.getValueState("reach", "at long, n long, timer long")
        self.pending = handle.getListState("pending", "lo long, hi long, n long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        fresh = [(_micros(r.lo), _micros(r.hi), r.n) for r in rows]
        yield from self._settle(key, fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._settle(key, [], timerValues.getCurrentWatermarkInMs())

    def _settle(self, key, fresh: list[tuple], watermark: int) -> Iterator[Row]:
        """Take what the watermark has passed in order of time; set a timer for the rest, or for the end."""
        pending = [(r[0], r[1], r[2]) for r in self.pending.get()]
        known = self.reach.get() or (None, 0, None)
        at, n, timer = known
        left = []
        for lo, hi, rows in sorted([*pending, *fresh]):
            if hi > watermark * 1000:
                left.append((lo, hi, rows))
                continue
            if at is not None and lo - at > self.gap:
                yield self._row(key, at, lo, n)
                n = 0
            at, n = hi if at is None else max(at, hi), n + rows
        if not left and at is not None and at // 1000 + self.expire <= watermark:
            yield self._row(key, at, None, n)
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.reach.clear()
            if pending:
                self.pending.clear()
            return
        if not left and at is None:
            return
        wanted = min(hi for _, hi, _ in left) // 1000 + 1 if left else at // 1000 + self.expire
        if wanted != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(wanted)
        if (at, n, wanted) != tuple(known):
            self.reach.update((at, n, wanted))
        if left and left != pending:
            self.pending.put(left)
        elif pending and not left:
            self.pending.clear()

    def _row(self, key, at: int, again: int | None, n: int) -> Row:
        def told(t):
            return None if t is None else datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=t)
        return Row(**{self.key: key[0], "last_seen": told(at), "seen_again": told(again), "n": n})

    def close(self) -> None:
        pass


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB; the session's setting comes back afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def gaps(stream: DataFrame, key: str, event_time: str, gap: timedelta, lateness: timedelta, expire: timedelta) -> DataFrame:
    """(key, last_seen, seen_again, n) of every stretch without rows longer than ``gap``; seen_again is NULL when the key was given up.

    ``n`` counts the key's rows since its last gap.  A key is given up after ``expire`` without rows (at least ``gap``); what it sends
    later starts anew.  Rows later than ``lateness`` may be dropped, as everywhere behind a watermark.  Rows without a key or a time
    are no one's.  Results come when the watermark passes them: a feed that ends needs ``end_of_feed``.
    """
    if expire < gap:
        raise ValueError("a key cannot be given up before its silence is a gap")
    kind = stream.schema[key].dataType.simpleString()
    width = max(1, int(gap.total_seconds() * 1e6) // 2)

    def thinned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            stretch = batch["at"] // width
            found = batch.groupby([batch["k"], stretch], sort=False)["at"].agg(["min", "max", "size"]).reset_index(level=0)
            yield pd.DataFrame({"k": found["k"], "lo": found["min"], "hi": found["max"], "n": found["size"]})

    rows = stream.where(f"`{key}` is not null and `{event_time}` is not null").select(F.col(key).alias("k"), F.unix_micros(F.col(event_time).cast("timestamp")).alias("at"))
    few = rows.mapInPandas(thinned, f"k {kind}, lo long, hi long, n long")
    timed = few.select(F.col("k").alias(key), F.timestamp_micros("lo").alias("lo"), F.timestamp_micros("hi").alias("hi"), "n")
    marked = timed.withWatermark("hi", f"{int(lateness.total_seconds() * 1000)} milliseconds")
    schema = T.StructType.fromDDL(GAPS.format(key=f"`{key}`", kind=kind))
    return marked.groupBy(key).transformWithState(_Gaps(key, gap, expire), schema, "append", "EventTime")


def end_of_feed(spark: SparkSession, schema: T.StructType, key: str, event_time: str, key_value, after: datetime) -> DataFrame:
    """One row of a key that nobody has, late enough to pass everything: the last delivery of a feed that ends."""
    values = {key: key_value, event_time: after}
    return spark.createDataFrame([tuple(values.get(f.name) for f in schema.fields)], schema)
