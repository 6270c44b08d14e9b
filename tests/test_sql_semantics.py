"""Missing values, join conditions and grouping follow SQL."""

import pytest
from pyspark.sql import functions as F

from sievework.functions.parse import parse_date, parse_integer
from sievework.functions.text import missing_to_null
from sievework.operators import dedup, joins
from sievework.operators.order import asc, desc

C = F.col

# Small tables with planted dirt.
ORDERS = [("O-001", "C-01", "2024-01-05", "east", "completed", "2", "2400"), ("O-002", "C-01", "2024-01-06", "east", "cancelled", "1", "980"),
          ("O-003", "C-02", "2024-01-06", "west", "completed", "3", "3600"), ("O-004", "C-02", "2024-01-08", "WEST", "completed", "", "4800"),
          ("O-005", "C-03", "2024-01-09", "north", "pending", "1", "1200"), ("O-006", "C-03", "2024-01-11", "north", "completed", "5", "N/A"),
          ("O-007", "C-04", "2024-01-12", "south", "completed", "2", "2,400"), ("O-008", "C-04", "2024-01-12", "south", "completed", "1", "300"),
          ("O-009", "C-99", "2024-01-13", "east", "completed", "4", "4800"), ("O-010", "", "2024-01-14", "west", "pending", "2", "1960"),
          ("O-011", "C-01", "2024-01-15", "east", "completed", "0", "0"), ("O-012", "C-02", "", "west", "completed", "1", "780")]
CUSTOMERS = [("C-01", "gold"), ("C-02", "silver"), ("C-03", ""), ("C-04", "gold"), ("C-05", "bronze")]
PAYMENTS = [("P-01", "O-001", 1200), ("P-02", "O-001", 1200), ("P-03", "O-003", 3600), ("P-04", "O-005", 1200), ("P-05", "O-999", 500)]


@pytest.fixture(scope="module")
def t(spark):
    raw = spark.createDataFrame(ORDERS, "order_id string, customer_id string, order_date string, region string, status string, qty string, amount string")
    tokens = ["", "N/A", "-", "NULL"]
    text = raw.select(*[missing_to_null(C(c), tokens).alias(c) for c in raw.columns])
    orders = text.withColumns({"order_date": parse_date(C("order_date")), "region": F.lower("region"),
                               "qty": parse_integer(C("qty")), "amount": parse_integer(C("amount"), ",")}).cache()
    customers = spark.createDataFrame(CUSTOMERS, "customer_id string, tier string").select("customer_id", F.nullif("tier", F.lit("")).alias("tier"))
    payments = spark.createDataFrame(PAYMENTS, "payment_id string, order_id string, paid int")
    for name, df in (("orders_t", orders), ("customers_t", customers), ("payments_t", payments)):
        df.createOrReplaceTempView(name)
    return orders, customers, payments


def one(spark, sql):
    return spark.sql(sql).first()[0]


def test_comparison_with_null_selects_nothing(spark, t):
    assert one(spark, "SELECT count(*) FROM orders_t WHERE customer_id = NULL") == 0
    assert one(spark, "SELECT count(*) FROM orders_t WHERE customer_id IS NULL") == 1
    assert one(spark, "SELECT count(*) FROM orders_t WHERE order_date IS NULL") == 1


def test_not_in_and_not_exists(spark, t):
    orders, customers, payments = t
    assert one(spark, "SELECT count(*) FROM customers_t WHERE customer_id NOT IN (SELECT customer_id FROM orders_t)") == 0
    assert [r.customer_id for r in joins.checked_join(customers, orders, ["customer_id"], "left_anti").collect()] == ["C-05"]
    assert [r.payment_id for r in joins.checked_join(payments, orders, ["order_id"], "left_anti").collect()] == ["P-05"]


def test_counting(spark, t):
    row = spark.sql("SELECT count(*), count(amount), count(qty), count(DISTINCT region), sum(amount), avg(amount) FROM orders_t").first()
    assert tuple(row)[:5] == (12, 11, 11, 4, 23220) and row[5] == pytest.approx(23220 / 11)
    assert one(spark, "SELECT sum(amount) FROM orders_t WHERE order_id = 'O-006'") is None


def test_groups_of_missing_keys(spark, t):
    assert t[0].groupBy("customer_id").count().count() == 6
    assert {r.status: r["count"] for r in t[0].groupBy("status").count().collect()} == {"cancelled": 1, "completed": 9, "pending": 2}


def test_join_row_counts(t):
    orders, customers, payments = t
    assert joins.checked_join(orders, customers, ["customer_id"], "inner").count() == 10
    left = joins.checked_join(orders, customers, ["customer_id"], validate="m:1", indicator="origin")
    assert left.count() == 12 and left.filter("origin = 'left_only'").count() == 2
    gold = joins.checked_join(orders, customers.filter("tier = 'gold'"), ["customer_id"])
    assert (gold.count(), left.filter("tier = 'gold'").count()) == (12, 5)
    paid = joins.join_aggregated(orders, payments, ["order_id"], [F.count(F.lit(1)).alias("n"), F.sum("paid").alias("paid")])
    assert paid.count() == 12 and paid.filter("order_id = 'O-001'").first().n == 2 and paid.filter("n is null").count() == 9


def test_having(t):
    busy = t[0].groupBy("region").agg(F.count(F.lit(1)).alias("n")).filter("n >= 4")
    assert sorted(r.region for r in busy.collect()) == ["east", "west"]


def test_top_order_per_region(t):
    top = dedup.head_by(t[0], ["region"], [desc("amount"), asc("order_id")], 1)
    assert {r.region: r.order_id for r in top.collect()} == {"east": "O-009", "north": "O-005", "south": "O-007", "west": "O-004"}


def test_null_placement_is_always_written(t):
    first = t[0].orderBy(C("amount").desc_nulls_last(), "order_id").first()
    last = t[0].orderBy(C("amount").desc_nulls_first(), "order_id").first()
    assert (first.order_id, last.order_id) == ("O-004", "O-006")
