"""Version tables that are merged batch by batch, and facts that look versions up."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sievework.operators import history

LOG = "k string, at long, v string, gone boolean"


def versions_of(entries):
    """(k, v, from, to) from all entries; the last entry of a time counts."""
    out = []
    for key in {e[0] for e in entries}:
        states, last = sorted({e[1]: (None if e[3] else (e[2],)) for e in entries if e[0] == key}.items()), "none"
        changes = []
        for at, state in states:
            if last == "none" or state != last:
                changes.append((at, state))
            last = state
        for (at, state), (end, _) in zip(changes, [*changes[1:], (None, None)]):
            if state is not None:
                out.append((key, state[0], at, end))
    return sorted(out, key=str)


def log(seed, n=300):
    rng = random.Random(seed)
    return list({(k, at): (k, at, rng.choice(["x", "y", None]), rng.random() < 0.15) for k, at in
                 ((rng.choice(["hot", "hot", "a", "b", "c", None]), rng.randrange(120)) for _ in range(n))}.values())


@pytest.mark.parametrize("slices", [None, 25])
def test_history_in_one_pass(spark, rows, slices):
    entries = log(1)
    got = history.version_history(spark.createDataFrame(entries, LOG), ["k"], "at", ["v"], "gone", slices)
    assert sorted((tuple(r) for r in got.select("k", "v", "valid_from", "valid_to").collect()), key=str) == versions_of(entries)
    assert got.where("is_current <> (valid_to is null)").count() == 0


def test_merges_in_any_order_and_again(spark, tmp_path):
    path, entries = str(tmp_path / "dim"), log(2)
    random.Random(3).shuffle(entries)
    seen = []
    for k in range(0, len(entries), 40):
        part = entries[k:k + 40]
        seen += part
        assert history.merge_versions(spark.createDataFrame(part, LOG), path, ["k"], "at", ["v"], 4, "gone") >= (1 if k == 0 else 0)
        got = spark.read.parquet(history.versions_path(path)).select("k", "v", "valid_from", "valid_to").collect()
        assert sorted(map(tuple, got), key=str) == versions_of(seen)
        assert history.merge_versions(spark.createDataFrame(part, LOG), path, ["k"], "at", ["v"], 4, "gone") == 0
    corrected = [(k, at, "z", False) for k, at, *_ in entries if k == "a"][:3]
    history.merge_versions(spark.createDataFrame(corrected, LOG), path, ["k"], "at", ["v"], 4, "gone")
    got = spark.read.parquet(history.versions_path(path)).select("k", "v", "valid_from", "valid_to").collect()
    assert sorted(map(tuple, got), key=str) == versions_of([e for e in entries if e[:2] not in {c[:2] for c in corrected}] + corrected)


def test_only_folders_of_new_entries_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "dim")
    history.merge_versions(spark.range(200).selectExpr("cast(id as string) as k", "1L as at", "'x' as v"), path, ["k"], "at", ["v"], 16)
    before = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "dim" / "versions").glob("*/*.parquet")}
    assert history.merge_versions(spark.createDataFrame([("7", 2, "y")], "k string, at long, v string"), path, ["k"], "at", ["v"], 16) == 1
    after = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "dim" / "versions").glob("*/*.parquet")}
    assert len(set(before.items()) & set(after.items())) == len(before) - 1
    with pytest.raises(PySparkException, match="more than one row for key 7, 3"):
        history.merge_versions(spark.createDataFrame([("7", 3, "y"), ("7", 3, "z")], "k string, at long, v string"), path, ["k"], "at", ["v"], 16)


def test_facts_find_the_version_of_their_time(spark):
    entries = log(4)
    versions = history.version_history(spark.createDataFrame(entries, LOG), ["k"], "at", ["v"], "gone")
    rng = random.Random(6)
    facts = [(i, rng.choice(["hot", "hot", "a", "zz", None]), rng.choice([None, *range(-3, 125)])) for i in range(200)]
    got = {r.id: (r.v, r.valid_from, r.valid_to) for r in history.with_versions(spark.createDataFrame(facts, "id long, k string, t long"), versions, ["k"], "t", 20).collect()}
    known = versions_of(entries)
    for i, k, t in facts:
        hit = [(v, a, b) for key, v, a, b in known if k is not None and key == k and t is not None and a <= t and (b is None or t < b)]
        assert got[i] == (hit[0] if hit else (None, None, None))
