"""Profiles of runs and their drift; describing a table in one scan."""

import statistics

import pytest

from sievework.operators import profile, recorded


def test_drift_against_all_runs_before(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "part string, a long, b double"

    def record(run, *rows):
        recorded.record_profile(recorded.profile_of(spark.createDataFrame(list(rows), schema), run, "part", ["a", "b"]), path)
    assert recorded.drift_report(spark, path, 1).count() == 0
    record(1, *[("x", i, float(i)) for i in range(20)], ("old", 1, None), (None, 5, 1.0))
    record(2, *[("x", i, float(i)) for i in range(10, 30)], (None, 6, None))
    record(2, *[("x", i, float(i)) for i in range(10, 30)], (None, 6, None))  # recorded again: counts once
    record(3, *[("x", i + 500, None if i % 2 else float(i)) for i in range(20)], ("fresh", 1, 1.0), (None, 5, 1.0))
    found = {(r.part, r.measure): r for r in recorded.drift_report(spark, path, 3).collect()}
    assert {k: r.verdict for k, r in found.items()} == {
        ("x", "a"): "median", ("x", "b"): "missing", ("old", "a"): "gone", ("old", "b"): "gone", ("fresh", "a"): "new", ("fresh", "b"): "new",
        (None, "a"): None, (None, "b"): None}
    row = found["x", "a"]
    assert (row.runs, row.n, row.n_before, row.total_before, row.median) == (2, 20, 40, sum(range(20)) + sum(range(10, 30)), 509.0)
    assert found["x", "b"].missing == 10 and found["x", "b"].missing_before == 0
    first = recorded.drift_report(spark, path, 1).collect()
    assert {r.verdict for r in first} == {"new"}


def test_describe_in_one_scan(spark):
    values = [3, 1, 4, 1, 5, 9, 2, 6, None]
    df = spark.createDataFrame([(v, None, 2.0) for v in values], "a int, b double, c double")
    got = {r.column: tuple(r)[1:] for r in profile.describe(df, ["a", "b", "c"]).collect()}
    known = sorted(v for v in values if v is not None)
    q = statistics.quantiles(known, n=4, method="inclusive")
    n, mean, std, low, *quartiles, high = got["a"]
    assert (n, low, high, quartiles) == (8, 1.0, 9.0, q) and abs(mean - statistics.mean(known)) < 1e-12 and abs(std - statistics.stdev(known)) < 1e-12
    assert got["b"] == (0, None, None, None, None, None, None, None)
    assert got["c"] == (9, 2.0, 0.0, 2.0, 2.0, 2.0, 2.0, 2.0)
    assert {r["count"] for r in profile.describe(df.limit(0), ["a", "c"]).collect()} == {0}
    with pytest.raises(TypeError):
        profile.describe(spark.createDataFrame([("x",)], "s string"), ["s"])
