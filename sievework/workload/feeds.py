"""Messy deliveries made from the clean tables, in the plan.

What a delivery looks like depends on columns of the row, so the right answer can
be stated in SQL over the clean table.  The SQL for it stands next to each feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import zero_pad
from sievework.plans.sales import Masters
from sievework.workload.catalog import Tables


def widen(c: Column) -> Column:
    """Half-width digits to full-width ones."""
    return F.translate(c, "0123456789#", "".join(chr(ord(x) + 0xFEE0) for x in "0123456789#"))


def _by(column: str, cases: dict[str, Column]) -> Column:
    out = None
    for value, c in cases.items():
        out = F.when(F.col(column) == value, c) if out is None else out.when(F.col(column) == value, c)
    return out


# ---------------------------------------------------------------- orders
def order_systems(orders: DataFrame) -> DataFrame:
    """Orders with the till system that delivers them (a, b or c)."""
    return orders.withColumn("system", F.when(F.col("o_orderpriority").isin("1-URGENT", "4-NOT SPECIFIED"), "a")
                             .when(F.col("o_orderpriority").isin("2-HIGH", "5-LOW"), "b").otherwise("c"))


SYSTEM_SQL = ("CASE WHEN o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') THEN 'a' "
              "WHEN o_orderpriority IN ('2-HIGH', '5-LOW') THEN 'b' ELSE 'c' END")


def _order_text(orders: DataFrame, amount: Column, quantity: Column, delay_days: int) -> DataFrame:
    grouped = F.format_number(amount, 0)
    status = F.element_at(F.create_map(*[F.lit(x) for x in ("F", "completed", "O", "pending", "P", "cancelled")]),
                          F.col("o_orderstatus"))
    region = F.element_at(F.array(*[F.lit(x) for x in ("east", "west", "north", "south")]),
                          (F.col("o_custkey") % 4 + 1).cast("int"))
    name = F.when(F.col("o_custkey") % 97 == 0, _by("system", {"a": F.lit(""), "b": F.lit(" N/A"), "c": F.lit("-　")})) \
        .otherwise(F.concat(F.lit("Customer#"), zero_pad(F.col("o_custkey").cast("string"), 9)))
    return orders.select(
        "system",
        F.concat(F.lit("O-"), zero_pad(F.col("o_orderkey").cast("string"), 9)).alias("order_id"),
        _by("system", {"a": F.date_format("o_orderdate", "yyyy-MM-dd"),
                       "b": F.date_format("o_orderdate", "yyyy/MM/dd"),
                       "c": F.date_format("o_orderdate", "y年M月d日")}).alias("order_date"),
        _by("system", {"a": F.concat(F.lit("  "), name), "b": F.concat(name, F.lit(" ")),
                       "c": F.concat(F.lit("　"), name, F.lit("　"))}).alias("customer_name"),
        _by("system", {"a": region, "b": F.upper(region), "c": F.initcap(region)}).alias("region"),
        _by("system", {"a": status, "b": F.upper(status), "c": F.initcap(status)}).alias("status"),
        _by("system", {"a": quantity, "b": widen(quantity), "c": F.concat(quantity, F.lit("　"))}).alias("quantity"),
        _by("system", {"a": F.when(F.col("o_orderstatus") == "P", F.concat(amount.cast("string"), F.lit(".0")))
                       .otherwise(amount.cast("string")),
                       "b": grouped,
                       "c": F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("￥"), grouped))
                       .when(F.col("o_orderstatus") == "O", F.concat(grouped, F.lit("円")))
                       .otherwise(F.concat(F.lit("￥"), grouped, F.lit("円")))}).alias("amount"),
        F.date_format(F.date_add(F.col("o_orderdate").cast("date"), delay_days), "yyyy-MM-dd'T'HH:mm:ss")
        .alias("ingested_at"))


def order_feed(t: Tables) -> DataFrame:
    """First deliveries of all orders, and later corrections of the cancelled ones.

    A correction raises the amount by 100.  Corrections of low-priority orders carry
    no quantity: those orders are invalid and have to disappear.
    """
    orders = order_systems(t.orders.repartition("o_orderkey"))
    amount = F.floor("o_totalprice").cast("bigint")
    plain = F.when(F.col("o_custkey") % 10 == 9, _by("system", {"a": F.lit("NULL"), "b": F.lit("N/A"), "c": F.lit("-")})) \
        .otherwise((F.col("o_custkey") % 10).cast("string"))
    first = _order_text(orders, amount, plain, 1)
    void = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(" - ")).otherwise(plain)
    late = _order_text(orders.filter(F.col("o_orderstatus") == "P"), amount + 100, void, 30)
    return first.unionByName(late)


ORDER_ID_SQL = ("'O-' || CASE WHEN length(CAST(o_orderkey AS VARCHAR)) < 9 "
                "THEN lpad(CAST(o_orderkey AS VARCHAR), 9, '0') ELSE CAST(o_orderkey AS VARCHAR) END")
CUSTOMER_NAME_SQL = ("CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE 'Customer#' || "
                     "CASE WHEN length(CAST(o_custkey AS VARCHAR)) < 9 THEN lpad(CAST(o_custkey AS VARCHAR), 9, '0') "
                     "ELSE CAST(o_custkey AS VARCHAR) END END")
CLEAN_ORDERS_SQL = f"""
SELECT {ORDER_ID_SQL} AS order_id,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
       {CUSTOMER_NAME_SQL} AS customer_name,
       CASE o_custkey % 4 WHEN 0 THEN 'east' WHEN 1 THEN 'west' WHEN 2 THEN 'north' ELSE 'south' END AS region,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status,
       CAST(o_custkey % 10 AS INTEGER) AS quantity,
       CAST(floor(o_totalprice) AS BIGINT) + CASE WHEN o_orderstatus = 'P' THEN 100 ELSE 0 END AS amount_jpy
FROM orders
WHERE o_custkey % 10 BETWEEN 1 AND 8 AND NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')"""


# ---------------------------------------------------------------- sales
def sales_feed(t: Tables, *extra: Column) -> DataFrame:
    """Line items as three till systems deliver them: old (A), new (N) and web shop (R); ``extra`` columns come last."""
    back = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    sign = F.when(back, F.lit(-1)).otherwise(F.lit(1))
    qty = (sign * F.col("l_quantity").cast("bigint")).cast("string")
    amount = sign * F.floor("l_extendedprice").cast("bigint")
    no_qty = (F.col("l_tax") == 0.0) & (F.col("l_discount") == 0.1)
    no_amount = (F.col("l_tax") == 0.08) & (F.col("l_discount") == 0.0)
    supplier = F.col("l_suppkey").cast("string")
    long_name = F.concat(F.lit("Supplier#"), zero_pad(supplier, 9))
    part = F.col("l_partkey").cast("string")
    test = (F.col("l_tax") == 0.04) & (F.col("l_discount") == 0.05)
    return t.lineitem.repartition("l_orderkey", "l_linenumber").select(
        _by("l_returnflag", {"A": F.date_format("l_shipdate", "y年M月d日"), "N": F.date_format("l_shipdate", "y/M/d"),
                             "R": F.date_format("l_shipdate", "yyyy-MM-dd")}).alias("sale_date"),
        _by("l_returnflag", {"A": F.concat(widen(long_name), F.lit("　")), "N": F.concat(F.lit(" "), long_name),
                             "R": F.concat(F.lit("s-"), supplier)}).alias("shop_name"),
        F.when(F.col("l_returnflag") == "R", part).otherwise(zero_pad(part, 4)).alias("item_cd"),
        F.when(no_qty, F.lit("-")).when(F.col("l_returnflag") == "A", widen(qty)).otherwise(qty).alias("qty"),
        F.when(no_amount, F.lit("N/A")).when(F.col("l_returnflag") == "N",
                                             F.concat(F.lit("￥"), F.format_number(amount, 0)))
        .otherwise(amount.cast("string")).alias("amount"),
        F.when(F.col("l_returnflag") == "R", "税抜").otherwise("税込").alias("tax_type"),
        F.when(test, "テスト").when(back, "返品").otherwise("").alias("note"),
        _by("l_returnflag", {"A": F.lit("old"), "N": F.lit("new"), "R": F.lit("ec")}).alias("source"), *extra)


def yearly_sales(t: Tables) -> DataFrame:
    """The sales feed with the year as period; ``late`` marks the first lines of orders before 1998, which were sent again later."""
    year = F.date_format("l_shipdate", "yyyy")
    return sales_feed(t, year.alias("period"), ((year < "1998") & (F.col("l_linenumber") == 1)).alias("late"))


def sales_masters(t: Tables) -> Masters:
    """Alias dictionary from suppliers, shops from nations, items from parts."""
    key = F.col("s_suppkey").cast("string")
    shop = F.concat(F.lit("S"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0"))
    spellings = F.array(widen(F.concat(F.lit("Supplier#"), zero_pad(key, 9))), F.concat(F.lit("s-"), key))
    alias = t.supplier.select(F.explode(spellings).alias("alias"), shop.alias("shop_cd"))
    shops = t.nation.select(
        F.concat(F.lit("S"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("shop_cd"),
        F.col("n_name").alias("shop_name"), F.concat(F.lit("area "), F.col("n_regionkey")).alias("area"),
        F.when(F.col("n_regionkey") == 0, F.lit("1999-12-31").cast("date")).alias("close_date"))
    items = t.part.select(zero_pad(F.col("p_partkey").cast("string"), 4).alias("item_cd"),
                          F.col("p_name").alias("item_name"),
                          F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("category"),
                          F.lit(None).cast("date").alias("discontinued_date"))
    return Masters(alias, shops, items)


PRICED_SQL = """
lines AS (
  SELECT *, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -1 ELSE 1 END AS sgn,
         (l_tax = 0.0 AND l_discount = 0.1) AS no_qty, (l_tax = 0.08 AND l_discount = 0.0) AS no_amount,
         (l_tax = 0.04 AND l_discount = 0.05) AS is_test
  FROM lineitem),
typed AS (
  SELECT *, CAST(l_shipdate AS DATE) AS sale_date,
         CASE WHEN no_qty THEN NULL ELSE sgn * CAST(l_quantity AS BIGINT) END AS qty,
         CASE WHEN no_amount THEN NULL ELSE sgn * CAST(floor(l_extendedprice) AS BIGINT) END AS amount,
         CASE l_returnflag WHEN 'A' THEN 'old' WHEN 'N' THEN 'new' ELSE 'ec' END AS source
  FROM lines),
priced AS (
  SELECT *, CASE WHEN l_returnflag = 'R' THEN CAST(round_even(amount * CAST(1.1 AS DOUBLE), 0) AS BIGINT)
                 ELSE amount END AS amount_incl
  FROM typed)"""
SALES_SQL = PRICED_SQL + """,
fact AS (
  SELECT priced.*, 'S' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS shop_cd,
         CASE WHEN p_type = 'PROMO' THEN '未分類' ELSE p_type END AS category,
         CASE WHEN n_regionkey = 0 THEN DATE '1999-12-31' END AS close_date
  FROM priced JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
       JOIN part ON p_partkey = l_partkey
  WHERE NOT no_qty AND NOT no_amount),
target AS (
  SELECT * FROM fact WHERE NOT is_test AND NOT (close_date IS NOT NULL AND sale_date > close_date))"""


# ---------------------------------------------------------------- roster
def roster_feed(t: Tables) -> DataFrame:
    """Customers as staff rows: some delivered twice, some corrected, some without a code."""
    segment = F.col("c_mktsegment")
    code = F.col("c_custkey").cast("string")
    hired = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("c_custkey") % 5000).cast("int"))
    pay = F.lit(200000) + F.floor("c_acctbal").cast("bigint")

    def rows(source: DataFrame, raise_by: int, stamp: str) -> DataFrame:
        grouped = F.format_number(pay + raise_by, 0)
        return source.select(
            F.when(F.col("c_nationkey") == 24, F.lit("")).when(segment == "HOUSEHOLD", code)
            .otherwise(zero_pad(code, 4)).alias("code"),
            F.concat(F.col("c_name"), F.lit("　")).alias("name"),
            _by("c_mktsegment", {"MACHINERY": F.lit("ｾｰﾙｽ"), "BUILDING": F.lit("開発"), "AUTOMOBILE": F.lit("広報部"),
                                 "FURNITURE": F.lit("情シス"), "HOUSEHOLD": F.lit("Sales")}).alias("dept"),
            F.when((segment == "AUTOMOBILE") & (F.col("c_acctbal") < 0), F.lit("不明"))
            .when(segment == "MACHINERY", F.date_format(hired, "y年M月d日"))
            .otherwise(F.date_format(hired, "yyyy/MM/dd")).alias("hired_on"),
            F.when(F.col("c_nationkey") == 0, F.lit("-")).when(segment == "BUILDING", F.concat(F.lit("￥"), grouped))
            .otherwise(grouped).alias("base_pay"),
            F.when(F.col("c_nationkey") == 1, F.lit("N/A")).otherwise(F.lit("４０")).alias("weekly_hours"),
            F.upper(F.concat(F.col("c_name"), F.lit("@example.com"))).alias("mail"),
            F.lit(stamp).alias("updated_on"))

    staff = t.customer
    everyone = rows(staff, 0, "2024-04-01")
    twice = rows(staff.filter(segment == "BUILDING"), 0, "2024-04-01")
    corrected = rows(staff.filter(segment == "FURNITURE"), 1000, "2024-04-15")
    return everyone.unionByName(twice).unionByName(corrected)


def departments(t: Tables) -> DataFrame:
    """Five departments; the third and fourth are not used by any roster row."""
    return t.region.select(F.concat(F.lit("D0"), (F.col("r_regionkey") + 1).cast("string")).alias("dept_cd"),
                           F.col("r_name").alias("dept_name"),
                           F.concat(F.lit("division "), F.col("r_name")).alias("division"))


ROSTER_SQL = """
coded AS (
  SELECT *, CASE WHEN c_nationkey = 24 THEN NULL WHEN length(CAST(c_custkey AS VARCHAR)) < 4
                 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0') ELSE CAST(c_custkey AS VARCHAR) END AS code,
         versions.corrected
  FROM customer JOIN (SELECT 0 AS corrected UNION ALL SELECT 1) versions ON corrected = 0 OR c_mktsegment = 'FURNITURE'),
kept AS (
  SELECT * FROM coded
  QUALIFY code IS NULL OR row_number() OVER (PARTITION BY code ORDER BY corrected DESC, c_name) = 1),
staff AS (
  SELECT code, c_name AS name,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 0 THEN NULL
              ELSE DATE '2000-01-01' + CAST(c_custkey % 5000 AS INTEGER) END AS hired_on,
         CASE WHEN c_nationkey = 0 THEN NULL
              ELSE 200000 + CAST(floor(c_acctbal) AS BIGINT) + 1000 * corrected END AS base_pay,
         CASE WHEN c_nationkey = 1 THEN NULL ELSE 40 END AS weekly_hours,
         lower(c_name) || '@example.com' AS mail,
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'D01' WHEN 'HOUSEHOLD' THEN 'D01' WHEN 'BUILDING' THEN 'D02'
              WHEN 'FURNITURE' THEN 'D05' ELSE '広報部' END AS dept_cd
  FROM kept),
roster AS (
  SELECT staff.*, r_name AS dept_name, coalesce('division ' || r_name, '未分類') AS division,
         CASE WHEN code IS NULL AND hired_on IS NULL THEN 'code,hired_on' WHEN code IS NULL THEN 'code'
              WHEN hired_on IS NULL THEN 'hired_on' END AS reject_reason
  FROM staff LEFT JOIN region ON dept_cd = 'D0' || CAST(r_regionkey + 1 AS VARCHAR))"""


# ---------------------------------------------------------------- access log
PATHS = {"view": "/home", "click": "/items", "signup": "/api/users", "purchase": "/api/orders", "error": "/api/health"}


def log_feed(t: Tables) -> DataFrame:
    """Events as access-log text, with the arrival number of each line."""
    utc = F.col("event_type").isin("view", "click")
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    local = F.date_format(F.col("ts") + F.expr("interval 9 hours"), stamp)
    return t.events.repartition("event_id").select(
        F.when(utc, F.concat(F.date_format("ts", stamp), F.lit("Z"))).otherwise(F.concat(local, F.lit("+09:00"))).alias("ts"),
        _by("event_type", {k: F.lit(v) for k, v in PATHS.items()}).alias("path"),
        _by("event_type", {"view": F.lit("200"), "click": F.lit("302"), "signup": F.lit("201"),
                           "purchase": F.lit("-"), "error": F.lit("503")}).alias("status"),
        F.concat(F.col("value").cast("string"), F.lit("s")).alias("dur"),
        F.format_number(F.col("event_id") * 37, 0).alias("bytes"),
        F.when(F.col("user_id") % 10 != 0, F.col("user_id").cast("string")).alias("user_id"),
        F.col("event_id").alias("line"))


def resent_log(t: Tables) -> DataFrame:
    """The log with clicks delivered twice and purchases sent again with another duration.

    ``line`` is the arrival number: what is sent again arrives after everything else.
    """
    log = log_feed(t)
    again = log.filter(F.col("path") == "/items")
    revised = log.filter(F.col("path") == "/api/orders").withColumns(
        {"dur": F.lit("9.5s"), "line": F.col("line") + (1 << 40)})
    return log.unionByName(again).unionByName(revised)


def screens(t: Tables) -> DataFrame:
    """Screen names for some of the paths."""
    known = t.events.filter(F.col("event_type").isin("view", "click", "purchase")).select("event_type").distinct()
    return known.select(_by("event_type", {k: F.lit(v) for k, v in PATHS.items()}).alias("path"),
                        F.concat(F.lit("screen "), F.col("event_type")).alias("screen"))


LOG_SQL = """
log AS (
  SELECT ts, event_id AS line, user_id AS uid, value AS sec, event_id * 37 AS n_bytes, event_type,
         CASE event_type WHEN 'view' THEN '/home' WHEN 'click' THEN '/items' WHEN 'signup' THEN '/api/users'
              WHEN 'purchase' THEN '/api/orders' ELSE '/api/health' END AS path,
         CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 302 WHEN 'signup' THEN 201
              WHEN 'error' THEN 503 END AS status,
         CASE WHEN user_id % 10 != 0 THEN CAST(user_id AS VARCHAR) END AS user_id
  FROM events)"""
