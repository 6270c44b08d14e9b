import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievework.operators import aggregate, compare, dedup, history, joins, profile, sliced
from sievework.operators.frames import as_of_join
from sievework.operators.order import asc, desc

C = F.col


@pytest.fixture(scope="module")
def skewed(spark):
    """6,000 rows; one key holds four fifths of them, one value and NULL a third each."""
    i = C("id")
    return spark.range(6000).select(
        i.alias("id"),
        F.when(i % 5 > 0, F.lit("hot")).when(i % 10 > 0, F.concat(F.lit("k"), i % 7)).alias("k"),
        F.when(i % 3 == 0, F.lit(7)).when(i % 3 == 1, F.lit(None)).otherwise(F.pmod(F.xxhash64(i), F.lit(97))).alias("v"),
        F.pmod(F.xxhash64(i, F.lit(1)), F.lit(500)).alias("t")).repartition(8).cache()


@pytest.mark.parametrize("order", [[asc("v"), desc("id")], [desc("v", nulls_last=False), asc("id")],
                                   [desc("t"), asc("id")], [asc("k"), asc("id")]])
@pytest.mark.parametrize("keys", [["k"], []])
def test_ranks_equal_plain_windows(skewed, order, keys):
    got = sliced.with_ranks(skewed, keys, order, row_number="rn", rank="rk", dense_rank="dr", average_rank="ar", slices=16)
    part = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(1))
    full, lead = part.orderBy(*[k.column() for k in order]), part.orderBy(order[0].column())
    want = skewed.withColumns({
        "rn": F.row_number().over(full).cast("bigint"), "rk": F.rank().over(lead).cast("bigint"),
        "dr": F.dense_rank().over(lead).cast("bigint"),
        "ar": F.rank().over(lead) + (F.count(F.lit(1)).over(lead.rangeBetween(0, 0)) - 1) / F.lit(2.0)})
    assert compare.same_rows(got, want)


def test_rank_fixture(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (4, 30)], "id int, v int")
    got = sliced.with_ranks(df, [], [asc("v"), asc("id")], row_number="rn", rank="rk", dense_rank="dr", average_rank="ar")
    assert [tuple(r)[2:] for r in got.orderBy("id").collect()] == [(1, 1, 1, 1.0), (2, 2, 2, 2.5), (3, 2, 2, 2.5), (4, 4, 3, 4.0)]


def test_carried_values_equal_plain_windows(skewed):
    w = W.partitionBy("k").orderBy("t", "id")
    up, down = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    order = ["t", "id"]
    checks = [
        (sliced.with_running_total(skewed, ["k"], [asc("t"), asc("id")], "v", "x", 16), skewed.withColumn("x", F.sum("v").over(up))),
        (sliced.fill_forward(skewed, ["k"], order, ["v"], 16), skewed.withColumn("v", F.last("v", True).over(up)).select(*skewed.columns)),
        (sliced.fill_backward(skewed, ["k"], order, ["v"], 16), skewed.withColumn("v", F.first("v", True).over(down)).select(*skewed.columns)),
        (sliced.with_neighbour(skewed, ["k"], order, "v", "x", slices=16), skewed.withColumn("x", F.lag("v").over(w))),
        (sliced.with_neighbour(skewed, ["k"], order, "v", "x", following=True, slices=16), skewed.withColumn("x", F.lead("v").over(w))),
    ]
    for got, want in checks:
        assert compare.same_rows(got, want)


def test_no_window_looks_at_the_rest_of_its_group_for_every_row(skewed):
    """A frame that ends with the last row is computed anew for every row, so a slice would cost the square of its rows."""
    log = skewed.select("k", "id", "v")
    right = skewed.select("k", C("t").alias("rt"), C("id").alias("rid"))
    for df in (sliced.fill_backward(skewed, ["k"], ["t", "id"], ["v"], 16), history.version_history(log, ["k"], "id", ["v"], slices=16),
               as_of_join(skewed, right, ["k"], "t", "rt", direction="forward", tie_break=[asc("rid")], slices=16)):
        assert "unboundedfollowing" not in df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_no_slice_holds_the_hot_group(skewed):
    """The point of slicing: the largest unit of window work is far below the hot key's 4,800 rows."""
    crowded = skewed.withColumns({"a": C("id") % 3, "b": C("id") % 2, "c": F.lit(1), "name": F.concat(F.lit("Customer#0000"), C("id").cast("string"))})
    for order in ([asc("v"), asc("id")], [asc("t"), asc("id")], [asc("v")], [asc("a"), asc("b"), asc("c"), asc("id")], [desc("name")], [asc("c")]):
        cut = sliced._slices(crowded, ["k"], order, 16)
        assert cut.groupBy("_group", "_slice").count().agg(F.max("count")).first()[0] < 900


def test_rolling_sum_equals_a_plain_window(skewed):
    frame = W.partitionBy("k").orderBy("t", "id").rowsBetween(-4, 0)
    got = sliced.with_rolling_sum(skewed, ["k"], [asc("t"), asc("id")], "v", "x", 5, 16)
    assert compare.same_rows(got, skewed.withColumn("x", F.sum("v").over(frame)))


@pytest.mark.parametrize("column", ["v", "t"])
def test_exact_quantiles(skewed, column):
    points = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r.fraction: r.value for r in sliced.exact_quantiles(skewed, column, points, 16).collect()}
    want = skewed.agg(F.percentile(column, points)).first()[0]
    assert [got[p] for p in points] == pytest.approx(want)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert sliced.exact_quantiles(empty, "v", [0.5]).collect()[0].value is None


CORRECTIONS = [("O-001", "2024-01-05", 2400, "completed"), ("O-002", "2024-01-06", 980, "completed"),
               ("O-001", "2024-01-09", None, "cancelled"), ("O-003", "2024-01-06", 3600, "completed")]


@pytest.fixture
def corrections(spark):
    return spark.createDataFrame(CORRECTIONS, "order_id string, ingested_at string, amount int, status string")


def test_latest_row_is_a_row_that_existed(corrections, rows):
    latest = dedup.latest_by(corrections, ["order_id"], "ingested_at", [asc("status")])
    assert rows(latest, "order_id", "amount", "status") == [
        ("O-001", None, "cancelled"), ("O-002", 980, "completed"), ("O-003", 3600, "completed")]
    mixed = dedup.coalesce_history(corrections, ["order_id"], ["ingested_at"], ["amount", "status"])
    assert ("O-001", 2400, "cancelled") in rows(mixed)


def test_picking_first_would_keep_a_cancelled_order(corrections):
    wrong = dedup.latest_by(corrections.filter("amount is not null"), ["order_id"], "ingested_at", [asc("status")])
    right = dedup.latest_by(corrections, ["order_id"], "ingested_at", [asc("status")]).filter("amount is not null")
    assert (wrong.count(), right.count()) == (3, 2)


def test_latest_row_is_cut_down_before_the_shuffle(corrections):
    plan = dedup.latest_by(corrections, ["order_id"], "ingested_at", [asc("status")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[-1]


def test_order_is_mandatory(corrections):
    with pytest.raises(ValueError):
        dedup.head_by(corrections, ["order_id"], [], 1)


def test_marks(corrections, rows):
    marked = dedup.mark_all_duplicates(corrections, ["order_id"], "dup")
    assert rows(marked, "order_id", "dup") == [("O-001", True), ("O-001", True), ("O-002", False), ("O-003", False)]
    later = dedup.mark_later_duplicates(corrections, ["order_id"], ["ingested_at"], "later")
    assert rows(later.filter("later"), "ingested_at") == [("2024-01-09",)]
    assert dedup.order_ties(corrections, ["order_id"], ["status"]).count() == 0


@pytest.fixture
def shop(spark):
    orders = spark.createDataFrame(
        [("O-1", "C-1", 100), ("O-2", "C-2", 200), ("O-3", "C-9", 300), ("O-4", None, 400)], "id string, cust string, amount int")
    customers = spark.createDataFrame([("C-1", "a"), ("C-2", None), ("C-3", "c")], "cust string, name string")
    return orders, customers


def test_join_kinds_and_origin(shop, rows):
    orders, customers = shop
    full = joins.checked_join(orders, customers, ["cust"], "full", indicator="origin")
    assert rows(full, "cust", "origin") == [("C-1", "both"), ("C-2", "both"), ("C-3", "right_only"), ("C-9", "left_only"), (None, "left_only")]
    assert joins.checked_join(orders, customers, ["cust"], "inner").count() == 2
    assert rows(joins.checked_join(customers, orders, ["cust"], "left_anti"), "cust") == [("C-3",)]
    assert joins.checked_join(orders, customers, ["cust"]).columns == ["id", "cust", "amount", "name"]


def test_duplicate_master_key_stops_the_join(shop):
    orders, customers = shop
    doubled = customers.unionByName(customers.filter("cust = 'C-1'"))
    with pytest.raises(PySparkException, match="more than one row for key C-1"):
        joins.checked_join(orders, doubled, ["cust"], validate="m:1").collect()
    assert rows_of(joins.duplicate_keys(doubled, ["cust"])) == [("C-1", 2)]
    with pytest.raises(PySparkException, match="left side"):
        joins.checked_join(doubled, orders, ["cust"], validate="1:m").collect()


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_equal_column_names_are_refused(shop):
    orders, customers = shop
    with pytest.raises(ValueError, match="amount"):
        joins.checked_join(orders, customers.withColumn("amount", F.lit(1)), ["cust"])


def test_fan_out_is_noticed_and_avoided(spark):
    orders = spark.createDataFrame([("O-1", 2400), ("O-2", 980)], "id string, amount int")
    payments = spark.createDataFrame([("O-1", 1200), ("O-1", 1200)], "id string, paid int")
    with pytest.raises(ValueError, match="rows 2.* -> 3"):
        joins.require_preserved(orders, joins.checked_join(orders, payments, ["id"]), ["amount"])
    safe = joins.join_aggregated(orders, payments, ["id"], [F.sum("paid").alias("paid")])
    joins.require_preserved(orders, safe, ["amount"])


def test_validity_periods(spark, rows):
    sales = spark.sql("SELECT * FROM VALUES (1, date'2019-09-30'), (2, date'2019-10-01'), (3, date'2030-01-01') AS t(id, day)")
    rates = spark.sql("SELECT * FROM VALUES (date'2014-04-01', date'2019-09-30', 8), (date'2019-10-01', date'2024-12-31', 10) AS t(a, b, rate)")
    assert rows(joins.interval_lookup(sales, "day", rates, "a", "b"), "id", "rate") == [(1, 8), (2, 10), (3, None)]
    overlapping = rates.unionByName(spark.sql("SELECT date'2019-10-01' a, date'2019-10-02' b, 9 rate"))
    with pytest.raises(PySparkException, match="more than one row"):
        joins.interval_lookup(sales, "day", overlapping, "a", "b").collect()


def test_periods_of_keys_are_looked_up_without_a_broadcast(spark, rows):
    """Both sides of the lookup are exploded, so the size of the files says nothing about what a broadcast would hold."""
    sales = spark.createDataFrame([(i, k, i) for i, k in enumerate("aabbc" * 20)] + [(100, None, 3)], "id long, k string, n int").selectExpr(
        "id", "k", "date_add(date'2020-01-01', n) AS day")
    rates = spark.sql("""SELECT * FROM VALUES ('a', date'2020-01-01', date'2020-01-31', 1), ('a', date'2020-02-01', null, 2), ('b', date'2019-01-01', date'2020-01-05', 3),
        ('b', date'2020-01-08', date'2020-01-08', 4), ('d', date'2020-01-01', null, 5) AS t(k, f, l, rate)""")
    got = joins.interval_lookup(sales, "day", rates, "f", "l", ["k"])
    assert not [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastHashJoin" in line and "_block" in line]

    def rate(i, k):
        return {"a": 1 if i < 31 else 2, "b": 3 if i < 5 else 4 if i == 7 else None}.get(k)
    assert dict(rows(got, "id", "rate")) == {**{i: rate(i, k) for i, k in enumerate("aabbc" * 20)}, 100: None}


def test_salted_join_equals_plain_join(skewed):
    master = skewed.select("k").distinct().na.drop().withColumn("name", F.upper("k"))
    for how in ("left", "inner", "left_anti", "left_semi"):
        assert compare.same_rows(joins.salted_join(skewed, master, ["k"], ["id"], 5, how), skewed.join(master, "k", how))


def test_zero_fill_keeps_totals_and_strangers(spark, rows):
    daily = spark.sql("SELECT * FROM VALUES (date'2024-04-01', 'S1', 5L), (date'2024-04-03', 'S9', 7L) AS t(day, shop, amount)")
    shops = spark.createDataFrame([("S1",), ("S2",)], "shop string")
    filled = aggregate.zero_fill(daily, "day", shops, ["amount"])
    assert filled.columns == daily.columns and filled.count() == 7
    assert filled.agg(F.sum("amount")).first()[0] == 12


def test_group_policies(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert aggregate.group(df, ["k"], [F.sum("v")]).count() == 2
    assert aggregate.group(df, ["k"], [F.sum("v")], drop_null_keys=True).count() == 1


def test_key_report_and_tokens(spark, rows):
    df = spark.createDataFrame([("a", "-"), ("a", "N/A"), ("b", "1")], "k string, v string")
    assert rows(profile.key_report(df, ["k"])) == [(3, 2, 1, 1)]
    assert rows(profile.token_hits(df, ["v"], ["-", "N/A"])) == [("v", "-", 1), ("v", "N/A", 1)]


def test_differences(spark, rows):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "y"), (3, 3.0, "z")], "id int, v double, s string")
    e = spark.createDataFrame([(1, 1.0 + 1e-12, "x"), (2, 2.5, None), (4, 4.0, "w")], "id int, v double, s string")
    assert rows(compare.key_difference(a, e, ["id"])) == [(3, "extra"), (4, "missing")]
    assert rows(compare.value_difference(a, e, ["id"], ["v", "s"], 1e-9), "id", "column") == [(2, "s"), (2, "v")]
    assert rows(compare.difference_counts(a, e, ["id"], ["v", "s"], 1e-9)) == [(1, 1, 1, 1)]
    assert not compare.same_rows(a, a.unionByName(a.limit(1)))


def test_change_log_and_history(spark, rows):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    log = spark.createDataFrame([(1, "x", 1, "U"), (1, "y", 2, "U"), (2, "b", 3, "D"), (4, "n", 4, "U")],
                                "id int, v string, seq int, kind string")
    assert rows(history.apply_changes(base, log, ["id"], "seq", "kind")) == [(1, "y"), (3, "c"), (4, "n")]
    entries = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 5, "a")], "id int, at int, v string")
    versions = history.version_history(entries, ["id"], "at", ["v"])
    assert rows(versions, "v", "valid_from", "valid_to", "is_current") == [
        ("a", 1, 3, False), ("a", 5, None, True), ("b", 3, 5, False)]
