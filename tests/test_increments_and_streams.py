import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sievework.operators.compare import same_rows
from sievework.operators.order import asc
from sievework.streaming import incremental, streams

C = F.col
SCHEMA = "id int, ts timestamp_ntz, k string, v int"


def at(day, hour=0, minute=0):
    return datetime(2024, 1, day, hour, minute)


def drop_file(spark, folder, *events):
    spark.createDataFrame(list(events), SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def per_day(df):
    return df.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))


def published(spark, path):
    return {str(r.day): (r.n, r.v) for r in spark.read.parquet(path).collect()}


def test_late_rows_within_the_allowance_are_counted_once(spark, tmp_path):
    marks, path, source = str(tmp_path / "m"), str(tmp_path / "d"), str(tmp_path / "s")

    def run():
        return incremental.run_increment(spark.read.schema(SCHEMA).parquet(source), "ts", timedelta(days=3), marks, "day", per_day, path)

    drop_file(spark, source, (1, at(1), "a", 1), (2, at(4), "a", 2))
    assert run() == 1
    drop_file(spark, source, (3, at(2), "a", 10), (4, at(5), "a", 4))
    assert run() == 2
    assert published(spark, path) == {"2024-01-01": (1, 1), "2024-01-02": (1, 10), "2024-01-04": (1, 2), "2024-01-05": (1, 4)}
    run()
    assert published(spark, path)["2024-01-04"] == (1, 2)
    assert incremental.last_watermark(spark, marks)[1] == at(5)


def test_empty_source_is_no_run(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert incremental.run_increment(empty, "ts", timedelta(1), str(tmp_path / "m"), "day", per_day, str(tmp_path / "d")) == 0


def test_stream_rebuilds_touched_days_once_per_event(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "daily")
    sink = streams.rebuild_touched_days(str(tmp_path / "landed"), path, "ts", "day", ["id"], per_day)

    def run():
        streams.run_available(streams.open_stream(spark, source, spark.createDataFrame([], SCHEMA).schema, 1), str(tmp_path / "cp"), sink)

    drop_file(spark, source, (1, at(1), "a", 1), (2, at(2), "a", 2))
    run()
    drop_file(spark, source, (2, at(2), "a", 2), (3, at(1, 23), "a", 5))  # one repeated, one late
    run()
    assert published(spark, path) == {"2024-01-01": (2, 6), "2024-01-02": (1, 2)}
    run()
    assert published(spark, path) == {"2024-01-01": (2, 6), "2024-01-02": (1, 2)}
    # A batch that is delivered again after a crash leaves the table as it is.
    sink(spark.read.parquet(f"{tmp_path}/landed").filter("batch = 1").drop("batch", "day"), 1)
    assert published(spark, path) == {"2024-01-01": (2, 6), "2024-01-02": (1, 2)}


def test_stream_keeps_the_latest_row_per_key(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "latest")
    sink = streams.keep_latest(path, ["k"], "ts", [asc("id")], "part")

    def run():
        stream = streams.open_stream(spark, source, spark.createDataFrame([], SCHEMA).schema).withColumn("part", F.lit(0))
        streams.run_available(stream, str(tmp_path / "cp"), sink)

    drop_file(spark, source, (1, at(3), "a", 1), (2, at(1), "b", 2))
    run()
    drop_file(spark, source, (3, at(2), "a", 99), (4, at(2), "b", 3))  # the first is older than what is known
    run()
    assert {r.k: r.v for r in spark.read.parquet(path).collect()} == {"a": 1, "b": 3}


def test_windows_are_published_once_closed(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        stream = streams.with_event_time(streams.open_stream(spark, source, spark.createDataFrame([], SCHEMA).schema), "ts", "1 hour")
        streams.append_available(streams.window_counts(stream, "ts", "1 hour", None, []), str(tmp_path / "cp"), path)

    drop_file(spark, source, (1, at(1, 0, 10), "a", 1), (2, at(1, 0, 50), "a", 1))
    run()
    drop_file(spark, source, (3, at(1, 0, 55), "a", 1), (4, at(1, 5), "a", 1))  # late but inside the allowance
    run()
    assert [(str(r.window_start), r.n) for r in spark.read.parquet(path).collect()] == [("2024-01-01 00:00:00", 3)]


def test_open_windows_and_sessions_are_delivered_at_the_end(spark, tmp_path):
    source = str(tmp_path / "in")
    drop_file(spark, source, (1, at(1, 0, 10), "a", 1), (2, at(1, 5), "a", 1))
    drop_file(spark, source, (3, at(1, 0, 15), "a", 1), (4, at(1, 5, 50), "a", 1))

    def run(name, summarise):
        stream = streams.open_stream(spark, source, spark.createDataFrame([], SCHEMA).schema, 1)
        whole = streams.whole_at_the_end(stream, f"{tmp_path}/{name}-cp", f"{tmp_path}/{name}", "ts", summarise)
        return sorted((str(r[0]), r.n) for r in whole.collect())

    windows = [("2024-01-01 00:00:00", 2), ("2024-01-01 05:00:00", 2)]
    assert run("w", lambda df: streams.window_counts(df, "ts", "1 hour", None, [])) == windows
    found = [("2024-01-01 00:10:00", 2), ("2024-01-01 05:00:00", 1), ("2024-01-01 05:50:00", 1)]
    assert run("s", lambda df: streams.sessions(df, "ts", "30 minutes", [])) == found
    drop_file(spark, source, (5, at(1, 5, 20), "a", 1))
    assert run("w", lambda df: streams.window_counts(df, "ts", "1 hour", None, [])) == [windows[0], ("2024-01-01 05:00:00", 3)]


@pytest.mark.parametrize("gap,count", [("30 minutes", 3), ("3 hours", 2)])
def test_sessions_in_batch(spark, gap, count):
    df = spark.createDataFrame([(1, at(1, 0), "a", 1), (2, at(1, 0, 20), "a", 1), (3, at(1, 2), "a", 1), (4, at(1, 0), "b", 1)], SCHEMA)
    found = streams.sessions(df.withColumn("ts", C("ts").cast("timestamp")), "ts", gap, ["k"])
    assert found.count() == count and found.agg(F.sum("n")).first()[0] == 4


def test_landing_a_batch_twice(spark, tmp_path):
    write = streams.land_batches(str(tmp_path / "l"))
    batch = spark.createDataFrame([(1, at(1), "a", 1)], SCHEMA)
    write(batch, 7)
    write(batch, 7)
    assert same_rows(spark.read.parquet(str(tmp_path / "l")).drop("batch"), batch)


def silences(events, gap, expire=timedelta(days=20)):
    """(k, last seen, seen again, rows since the last gap) of sorted times per key."""
    out = []
    for k in {e[1] for e in events}:
        times, n = sorted(e[0] for e in events if e[1] == k), 0
        for a, b in zip(times, [*times[1:], None]):
            n += 1
            if b is None or b - a > gap:
                out.append((k, a, b, n))
                n = 0
    return sorted(out, key=str)


def test_gaps_with_out_of_order_rows_restarts_and_expiry(spark, tmp_path):
    from sievework.streaming import gaps
    rng, schema = random.Random(2), "k string, ts timestamp_ntz"
    start, gap, lateness = datetime(2024, 1, 1), timedelta(hours=2), timedelta(hours=6)
    events = [(start + timedelta(minutes=rng.randrange(6 * 24 * 60)), "hot" if rng.random() < 0.4 else f"k{rng.randrange(6)}") for _ in range(500)]
    inbox, path = str(tmp_path / "in"), str(tmp_path / "out")
    shape = spark.createDataFrame([], schema).schema

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        with gaps.state_store(spark):
            stream = streams.open_stream(spark, inbox, shape)
            streams.append_available(gaps.gaps(stream, "k", "ts", gap, lateness, timedelta(days=20)), str(tmp_path / "cp"), path)
        found = spark.read.parquet(path)
        return sorted(((r.k, r.last_seen, r.seen_again, r.n) for r in found.withColumns({c: C(c).cast("timestamp_ntz") for c in ("last_seen", "seen_again")}).collect()), key=str)

    # Deliveries overlap by less than the allowance, so rows come out of order but never too late.
    by_arrival = sorted(events, key=lambda e: e[0] + timedelta(minutes=rng.randrange(180)))
    for cut in range(0, 500, 125):
        got = run([(k, t) for t, k in by_arrival[cut:cut + 125]] + [(None, start), ("k0", None)])
        assert set(got) <= set(silences(events, gap))  # nothing is told before it is certain
    assert all(r[2] is not None for r in got)
    got = run([("the end", start + timedelta(days=60))])
    assert got == silences(events, gap)
    again = run([("hot", start + timedelta(days=61))])  # a key that was given up starts anew
    assert again == got
    with pytest.raises(ValueError):
        gaps.gaps(spark.createDataFrame([], schema), "k", "ts", gap, lateness, timedelta(hours=1))


class _Told:
    """A state store of one key that counts the messages to it."""

    def __init__(self):
        self.values, self.timers, self.messages = {}, set(), 0

    def state(self, name, empty):
        class State:
            def get(_):
                self.messages += 1
                return self.values.get(name, empty)

            def update(_, value):
                self.messages += 1
                self.values[name] = value
            put = update

            def clear(_):
                self.messages += 1
                self.values.pop(name, None)
        return State()

    def getValueState(self, name, schema):
        return self.state(name, None)

    def getListState(self, name, schema):
        return self.state(name, ())

    def registerTimer(self, at):
        self.messages += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.messages += 1
        self.timers.discard(at)


def test_a_key_asks_its_state_few_questions():
    from datetime import timedelta
    from sievework.streaming.gaps import _Gaps
    told, hour = _Told(), 3600 * 10**6
    gaps = _Gaps("k", timedelta(hours=1), timedelta(hours=10))
    gaps.init(told)
    settle = lambda fresh, hours: [(r.n, r.seen_again is None) for r in gaps._settle((1,), fresh, hours * hour // 1000)]
    assert settle([(0, 0, 2), (5 * hour, 5 * hour, 3)], 2) == [] and told.messages <= 5
    assert told.timers == {5 * hour // 1000 + 1} and told.values["pending"] == [(5 * hour, 5 * hour, 3)]
    told.messages = 0
    assert settle([], 3) == [] and told.messages == 2  # nothing has changed
    assert settle([], 6) == [(2, False)] and told.timers == {15 * hour // 1000} and "pending" not in told.values
    assert settle([], 15) == [(3, True)] and not told.timers and not told.values
    assert settle([], 16) == [] and not told.timers
