"""Joins, aggregation, dedup, ranking, sorting, set operations, profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import parse, text
from sievework.operators import aggregate, compare, dedup, history, joins, profile
from sievework.operators.frames import as_of_join, with_range_frame, with_row_frame
from sievework.operators.order import asc, desc
from sievework.operators.sliced import exact_quantiles, with_neighbour, with_ranks, with_rolling_sum, with_running_total
from sievework.session import through_storage
from sievework.sources.delimited import with_row_arrival
from sievework.workload import feeds
from sievework.workload.catalog import cents, iso, n_rows, query

C = F.col
CENTS = "CAST(round_even({} * 100, 0) AS BIGINT)".format
SUM_CENTS = "CAST(sum(CAST(round_even({} * 100, 0) AS BIGINT)) AS BIGINT)".format


# ---------------------------------------------------------------- joins
query("join_inner",
      lambda t: feeds.log_feed(t).join(feeds.screens(t), "path").select("line", "path", "screen"),
      f"""WITH {feeds.LOG_SQL} SELECT line, path, 'screen ' || event_type AS screen FROM log
      WHERE event_type IN ('view', 'click', 'purchase')""")
query("join_left",
      lambda t: joins.checked_join(feeds.log_feed(t).select("line", "path"), feeds.screens(t), ["path"], validate="m:1"),
      f"""WITH {feeds.LOG_SQL} SELECT line, path, CASE WHEN event_type IN ('view', 'click', 'purchase')
      THEN 'screen ' || event_type END AS screen FROM log""")
query("join_right",
      lambda t: joins.checked_join(t.orders.filter(C("o_totalprice") > 450000).select("o_orderkey", "o_custkey"),
                                   t.customer.select("c_custkey", "c_name"), [("o_custkey", "c_custkey")], "right"),
      """SELECT o_orderkey, c_custkey AS o_custkey, c_name FROM (SELECT * FROM orders WHERE o_totalprice > 450000) o
         RIGHT JOIN customer ON o_custkey = c_custkey""")
query("join_full",
      lambda t: joins.checked_join(
          t.orders.filter(C("o_orderstatus") == "F").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("finished")),
          t.orders.filter(C("o_totalprice") > 490000).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("expensive")),
          ["o_custkey"], "full"),
      """SELECT o_custkey, finished, expensive FROM
         (SELECT o_custkey, count(*) AS finished FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) FULL JOIN
         (SELECT o_custkey, count(*) AS expensive FROM orders WHERE o_totalprice > 490000 GROUP BY 1) USING (o_custkey)""")


def _rates(t):
    """Tax rates by validity period and sales region, from the regions."""
    halves = F.array(*[F.struct(F.lit(a).cast("date").alias("valid_from"), F.lit(b).cast("date").alias("valid_to"),
                                F.lit(r).alias("base")) for a, b, r in
                       (("1995-01-01", "1998-06-30", 0.05), ("1998-07-01", "2001-12-31", 0.08))])
    return t.region.select(C("r_regionkey"), F.inline(halves)).select(
        "r_regionkey", "valid_from", "valid_to", (C("base") + C("r_regionkey") * 0.01).alias("rate"))


query("join_validity_period",
      lambda t: joins.interval_lookup(
          t.orders.select("o_orderkey", (C("o_custkey") % 5).cast("int").alias("r_regionkey"),
                          C("o_orderdate").cast("date").alias("day")),
          "day", _rates(t), "valid_from", "valid_to", ["r_regionkey"])
      .select("o_orderkey", iso("day").alias("day"), "rate"),
      """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
         CASE WHEN o_orderdate < DATE '1998-07-01' THEN CAST(0.05 AS DOUBLE) ELSE CAST(0.08 AS DOUBLE) END
         + (o_custkey % 5) * CAST(0.01 AS DOUBLE) AS rate FROM orders""")


def _last_purchase(t):
    """Every event with the purchase before it, of the last two days; one key has a third of the events."""
    events = t.events.select("event_id", "ts", "event_type", "value", F.when(C("event_id") % 3 == 0, 0).otherwise(C("user_id")).alias("who"))
    purchases = events.where("event_type = 'purchase'").select("who", C("ts").alias("bought_at"), cents("value").alias("bought"), C("event_id").alias("purchase"))
    return as_of_join(events, purchases, ["who"], "ts", "bought_at", tolerance="2 days", strict=True, tie_break=[asc("purchase")])


query("join_as_of",
      lambda t: _last_purchase(t).select("event_id", "purchase", "bought"),
      f"""WITH e AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS who FROM events),
         p AS (SELECT who, ts AS bought_at, {CENTS('value')} AS bought, event_id AS purchase FROM e WHERE event_type = 'purchase'
               QUALIFY row_number() OVER (PARTITION BY who, ts ORDER BY event_id) = 1)
         SELECT e.event_id, CASE WHEN bought_at >= ts - INTERVAL 2 DAY THEN purchase END AS purchase, CASE WHEN bought_at >= ts - INTERVAL 2 DAY THEN bought END AS bought
         FROM e ASOF LEFT JOIN p ON e.who = p.who AND e.ts > p.bought_at""")


def _rate_on_day(t):
    """Every order with the rate of its priority set last on or before its day; rates are set on a few days only."""
    day = C("o_orderdate").cast("date")
    rates = (t.orders.where(F.dayofyear(day).isin(5, 120, 250)).groupBy("o_orderpriority", day.alias("set_on"))
             .agg(F.sum(cents("o_totalprice")).alias("rate")))
    return as_of_join(t.orders.select("o_orderkey", "o_orderpriority", day.alias("day")), rates, ["o_orderpriority"], "day", "set_on")


query("rate_as_of_date",
      lambda t: _rate_on_day(t).select("o_orderkey", iso("set_on").alias("set_on"), "rate"),
      f"""WITH r AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS set_on, {SUM_CENTS('o_totalprice')} AS rate FROM orders
         WHERE dayofyear(o_orderdate) IN (5, 120, 250) GROUP BY 1, 2)
         SELECT o_orderkey, CAST(set_on AS VARCHAR) AS set_on, rate FROM orders ASOF LEFT JOIN r ON o_orderpriority = p AND CAST(o_orderdate AS DATE) >= set_on""")


def _status_as_of_day(t):
    """Every order with the version of its customer's status that is valid on its day; the newest version is open."""
    day = C("o_orderdate").cast("date").alias("day")
    last = t.orders.groupBy("o_custkey", day).agg(F.max_by("o_orderstatus", "o_orderkey").alias("status"))
    versions = history.version_history(last, ["o_custkey"], "day", ["status"])
    periods = versions.select("o_custkey", "status", "valid_from", F.date_sub("valid_to", 1).alias("last_day"))
    orders = t.orders.select("o_orderkey", "o_custkey", day)
    return joins.interval_lookup(orders, "day", periods, "valid_from", "last_day", ["o_custkey"]).select("o_orderkey", "status")


query("join_open_period", _status_as_of_day,
      """SELECT o_orderkey, last_value(o_orderstatus) OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS status FROM orders""")
query("join_condition_in_on",
      lambda t: t.orders.join(t.customer.filter(C("c_mktsegment") == "BUILDING"), C("o_custkey") == C("c_custkey"), "left")
      .select("o_orderkey", "c_name"),
      """SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'""")
query("join_condition_in_where",
      lambda t: t.orders.join(t.customer, C("o_custkey") == C("c_custkey"), "left").filter(C("c_mktsegment") == "BUILDING")
      .select("o_orderkey", "c_name"),
      """SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'""")
query("join_anti",
      lambda t: joins.checked_join(t.customer.select("c_custkey", "c_name"), t.orders.filter(C("o_totalprice") > 400000),
                                   [("c_custkey", "o_custkey")], "left_anti"),
      """SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000)
         ON c_custkey = o_custkey WHERE o_custkey IS NULL""")


def _sql(t, names, statement):
    for n in names:
        getattr(t, n).createOrReplaceTempView(n)
    return t.spark.sql(statement)


_NOT_EXISTS = """SELECT c_custkey FROM customer c WHERE NOT EXISTS
    (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)"""
query("join_not_exists", lambda t: _sql(t, ["customer", "orders"], _NOT_EXISTS), _NOT_EXISTS)
_NOT_IN = """SELECT n_nationkey FROM nation WHERE n_nationkey NOT IN
    (SELECT CASE WHEN c_acctbal < {} THEN NULL ELSE c_nationkey END FROM customer WHERE c_nationkey < 10)"""
query("join_not_in_with_null", lambda t: _sql(t, ["nation", "customer"], _NOT_IN.format(0)), _NOT_IN.format(0))
query("join_not_in_without_null", lambda t: _sql(t, ["nation", "customer"], _NOT_IN.format(-5000)), _NOT_IN.format(-5000))
query("join_semi",
      lambda t: joins.checked_join(t.customer.select("c_custkey"), t.orders.filter(C("o_totalprice") > 400000),
                                   [("c_custkey", "o_custkey")], "left_semi"),
      "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
query("join_indicator",
      lambda t: joins.checked_join(feeds.log_feed(t), feeds.screens(t), ["path"], indicator="origin", validate="m:1")
      .groupBy("origin").agg(n_rows()),
      f"""WITH {feeds.LOG_SQL} SELECT CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'both' ELSE 'left_only' END
      AS origin, count(*) AS n FROM log GROUP BY 1""")
query("join_null_safe",
      lambda t: joins.checked_join(
          feeds.log_feed(t).select("line", "user_id"),
          feeds.log_feed(t).groupBy("user_id").agg(F.count(F.lit(1)).alias("visits")), ["user_id"], null_safe=True),
      f"""WITH {feeds.LOG_SQL} SELECT line, user_id, count(*) OVER (PARTITION BY user_id) AS visits FROM log""")
query("join_one_to_one",
      lambda t: joins.checked_join(t.documents.select("doc_id", "lang"), t.labels.select("doc_id", "quality"), ["doc_id"],
                                   "inner", validate="1:1"),
      "SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)")
query("join_preaggregated",
      lambda t: joins.join_aggregated(
          t.orders.select("o_orderkey", "o_orderstatus"), t.lineitem, [("o_orderkey", "l_orderkey")],
          [F.count(F.lit(1)).alias("lines"), F.sum(cents("l_extendedprice")).alias("cents")]),
      f"""SELECT o_orderkey, o_orderstatus, lines, cents FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines,
         {SUM_CENTS('l_extendedprice')} AS cents FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""")
query("join_preserves_totals",
      lambda t: joins.reconcile(
          t.orders.withColumn("cents", cents("o_totalprice")),
          joins.checked_join(t.orders.withColumn("cents", cents("o_totalprice")), t.customer,
                             [("o_custkey", "c_custkey")], validate="m:1"), ["cents"])
      .select("measure", C("before").cast("bigint").alias("before"), C("after").cast("bigint").alias("after"), "agrees"),
      f"""SELECT 'rows' AS measure, count(*) AS before, count(*) AS after, true AS agrees FROM orders UNION ALL
         SELECT 'sum_cents', {SUM_CENTS('o_totalprice')}, {SUM_CENTS('o_totalprice')}, true FROM orders""")
query("join_rename_first",
      lambda t: joins.checked_join(t.supplier.select("s_suppkey", C("s_name").alias("name_raw"), "s_nationkey"),
                                   t.nation.select("n_nationkey", C("n_name").alias("name")),
                                   [("s_nationkey", "n_nationkey")], validate="m:1"),
      """SELECT s_suppkey, s_name AS name_raw, s_nationkey, n_name AS name FROM supplier JOIN nation
         ON s_nationkey = n_nationkey""")
query("join_alias_dictionary",
      lambda t: joins.resolve_alias(
          text.normalise_columns(feeds.sales_feed(t), ["shop_name"]), "shop_name", feeds.sales_masters(t).alias,
          "alias", "shop_cd", text.nfkc_strip).groupBy("shop_cd").agg(n_rows(), F.countDistinct("shop_name").alias("spellings")),
      """SELECT 'S' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS shop_cd, count(*) AS n,
         count(DISTINCT CASE WHEN l_returnflag = 'R' THEN 's-' || l_suppkey ELSE s_name END) AS spellings
         FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""")
query("join_columns_side_by_side",
      lambda t: joins.checked_join(t.customer.select("c_custkey", "c_name"),
                                   t.customer.select("c_custkey", cents("c_acctbal").alias("cents")), ["c_custkey"], "inner",
                                   validate="1:1"),
      f"SELECT c_custkey, c_name, {CENTS('c_acctbal')} AS cents FROM customer")
query("join_salted",
      lambda t: joins.salted_join(feeds.log_feed(t).select("line", "path"), feeds.screens(t), ["path"], ["line"], 4)
      .select("line", "screen"),
      f"""WITH {feeds.LOG_SQL} SELECT line, CASE WHEN event_type IN ('view', 'click', 'purchase')
      THEN 'screen ' || event_type END AS screen FROM log""")
query("grid_days_by_shop",
      lambda t: aggregate.calendar_grid(t.nation.select("n_name"), "day",
                                        t.events.agg(F.min(F.to_date("ts"))).scalar(), t.events.agg(F.max(F.to_date("ts"))).scalar())
      .select("n_name", iso("day").alias("day")),
      """SELECT n_name, CAST(CAST(d AS DATE) AS VARCHAR) AS day FROM nation, (SELECT unnest(generate_series(
         (SELECT CAST(min(ts) AS DATE) FROM events), (SELECT CAST(max(ts) AS DATE) FROM events), INTERVAL 1 DAY)) AS d)""")

# ---------------------------------------------------------------- aggregation
query("count_rows_per_key", lambda t: feeds.log_feed(t).groupBy("path").agg(n_rows()),
      f"WITH {feeds.LOG_SQL} SELECT path, count(*) AS n FROM log GROUP BY path")
query("count_present_values", lambda t: feeds.log_feed(t).groupBy("path").agg(F.count("user_id").alias("known"), n_rows()),
      f"WITH {feeds.LOG_SQL} SELECT path, count(user_id) AS known, count(*) AS n FROM log GROUP BY path")
query("count_distinct", lambda t: t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_suppkey").alias("suppliers")),
      "SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag")
query("sum_per_key", lambda t: t.lineitem.groupBy("l_suppkey").agg(F.sum(cents("l_extendedprice")).alias("cents")),
      f"SELECT l_suppkey, {SUM_CENTS('l_extendedprice')} AS cents FROM lineitem GROUP BY l_suppkey")
query("sum_of_nothing",
      lambda t: feeds.log_feed(t).groupBy("path").agg(
          F.sum(parse.parse_integer(C("status"))).alias("total"),
          F.coalesce(F.sum(parse.parse_integer(C("status"))), F.lit(0)).alias("total_or_zero")),
      f"""WITH {feeds.LOG_SQL} SELECT path, CAST(sum(status) AS BIGINT) AS total,
      coalesce(CAST(sum(status) AS BIGINT), 0) AS total_or_zero FROM log GROUP BY path""")
query("mean_two_denominators",
      lambda t: feeds.log_feed(t).agg(
          F.avg(parse.parse_integer(C("status"))).alias("mean_known"),
          (F.sum(parse.parse_integer(C("status"))) / F.count(F.lit(1))).alias("mean_all")),
      f"""WITH {feeds.LOG_SQL} SELECT avg(status) AS mean_known,
      CAST(sum(status) AS DOUBLE) / count(*) AS mean_all FROM log""")
query("min_max", lambda t: t.lineitem.groupBy("l_linestatus").agg(F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi")),
      "SELECT l_linestatus, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY l_linestatus")
query("named_aggregation",
      lambda t: t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
          F.sum(C("l_quantity").cast("bigint")).alias("qty"), F.sum(cents("l_extendedprice")).alias("cents"), n_rows()),
      f"""SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
         {SUM_CENTS('l_extendedprice')} AS cents, count(*) AS n FROM lineitem GROUP BY ALL""")
query("dict_aggregation",
      lambda t: t.lineitem.groupBy("l_returnflag").agg({"l_linenumber": "sum", "l_quantity": "max"})
      .withColumnsRenamed({"sum(l_linenumber)": "sum_line", "max(l_quantity)": "max_quantity"}),
      """SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS sum_line, max(l_quantity) AS max_quantity
         FROM lineitem GROUP BY l_returnflag""")
query("null_keys_kept", lambda t: aggregate.group(feeds.log_feed(t), ["user_id"], [n_rows()]),
      f"WITH {feeds.LOG_SQL} SELECT user_id, count(*) AS n FROM log GROUP BY user_id")
query("null_keys_dropped", lambda t: aggregate.group(feeds.log_feed(t), ["user_id"], [n_rows()], drop_null_keys=True),
      f"WITH {feeds.LOG_SQL} SELECT user_id, count(*) AS n FROM log WHERE user_id IS NOT NULL GROUP BY user_id")
query("group_by_derived_day",
      lambda t: t.events.groupBy(iso(F.to_date("ts")).alias("day"), "event_type").agg(n_rows(), F.sum(cents("value")).alias("cents")),
      f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, {SUM_CENTS('value')} AS cents
         FROM events GROUP BY 1, 2""")
query("group_counts_by_grain",
      lambda t: aggregate.grain_counts(t.lineitem, {
          "order": ["l_orderkey"], "day": ["l_shipdate"], "day_supplier": ["l_shipdate", "l_suppkey"],
          "day_supplier_part": ["l_shipdate", "l_suppkey", "l_partkey"]}),
      """SELECT 'order' AS grain, count(DISTINCT l_orderkey) AS groups FROM lineitem
         UNION ALL SELECT 'day', count(DISTINCT l_shipdate) FROM lineitem
         UNION ALL SELECT 'day_supplier', count(*) FROM (SELECT DISTINCT l_shipdate, l_suppkey FROM lineitem)
         UNION ALL SELECT 'day_supplier_part', count(*) FROM (SELECT DISTINCT l_shipdate, l_suppkey, l_partkey FROM lineitem)""")
query("where_before_group",
      lambda t: t.orders.filter(C("o_orderstatus") == "F").groupBy("o_custkey").agg(n_rows(), F.sum(cents("o_totalprice")).alias("cents")),
      f"""SELECT o_custkey, count(*) AS n, {SUM_CENTS('o_totalprice')} AS cents FROM orders WHERE o_orderstatus = 'F'
         GROUP BY o_custkey""")
query("having_after_group",
      lambda t: t.orders.groupBy("o_custkey").agg(n_rows(), F.sum(cents("o_totalprice")).alias("cents")).filter(C("cents") > 300000000),
      f"""SELECT o_custkey, count(*) AS n, {SUM_CENTS('o_totalprice')} AS cents FROM orders GROUP BY o_custkey
         HAVING {SUM_CENTS('o_totalprice')} > 300000000""")
query("pivot_sums",
      lambda t: aggregate.pivot_sum(t.events.select("event_type", iso(F.to_date("ts")).alias("day"), cents("value").alias("cents")),
                                    ["day"], "event_type", ["click", "error", "purchase", "signup", "view"], "cents"),
      "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, " + ", ".join(
          f"CAST(sum({CENTS('value')}) FILTER (event_type = '{e}') AS BIGINT) AS {e}"
          for e in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY 1")
query("unpivot",
      lambda t: t.lineitem.groupBy("l_returnflag").agg(F.max("l_quantity").alias("quantity"), F.max("l_tax").alias("tax"))
      .unpivot("l_returnflag", ["quantity", "tax"], "measure", "value"),
      """SELECT l_returnflag, 'quantity' AS measure, max(l_quantity) AS value FROM lineitem GROUP BY 1 UNION ALL
         SELECT l_returnflag, 'tax', max(l_tax) FROM lineitem GROUP BY 1""")
query("time_buckets_with_zeros",
      lambda t: aggregate.bucket_counts(t.events.filter(C("event_type") == "purchase"), "ts", "1 hour")
      .select(C("bucket").cast("timestamp_ntz").alias("bucket"), "n"),
      """WITH h AS (SELECT date_trunc('hour', ts) AS bucket, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1),
         axis AS (SELECT unnest(generate_series((SELECT min(bucket) FROM h), (SELECT max(bucket) FROM h), INTERVAL 1 HOUR)) AS bucket)
         SELECT axis.bucket, coalesce(n, 0) AS n FROM axis LEFT JOIN h USING (bucket)""")
query("first_value_per_group",
      lambda t: feeds.log_feed(t).groupBy("path").agg(F.min_by("user_id", F.when(C("user_id").isNotNull(), C("line"))).alias("first_user")),
      f"""WITH {feeds.LOG_SQL} SELECT path, arg_min(user_id, line) FILTER (user_id IS NOT NULL) AS first_user
      FROM log GROUP BY path""")
query("zero_fill_days_by_type",
      lambda t: aggregate.zero_fill(
          t.events.filter((C("value") > 60) & (C("event_type") != "view")).groupBy(F.to_date("ts").alias("day"), "event_type")
          .agg(n_rows(), F.sum(cents("value")).alias("cents")),
          "day", t.events.select("event_type").distinct(), ["n", "cents"]).select(iso("day").alias("day"), "event_type", "n", "cents"),
      f"""WITH s AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, {SUM_CENTS('value')} AS cents FROM events
                    WHERE value > 60 AND event_type <> 'view' GROUP BY 1, 2),
         grid AS (SELECT CAST(d AS DATE) AS day, event_type FROM (SELECT unnest(generate_series((SELECT min(day) FROM s),
                  (SELECT max(day) FROM s), INTERVAL 1 DAY)) AS d), (SELECT DISTINCT event_type FROM events))
         SELECT CAST(day AS VARCHAR) AS day, event_type, coalesce(n, 0) AS n, coalesce(cents, 0) AS cents
         FROM grid LEFT JOIN s USING (day, event_type)""")
_SETS = """SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY {}(l_returnflag, l_linestatus)"""
query("rollup_counts", lambda t: t.lineitem.rollup("l_returnflag", "l_linestatus").agg(n_rows()), _SETS.format("ROLLUP"))
query("cube_counts", lambda t: t.lineitem.cube("l_returnflag", "l_linestatus").agg(n_rows()), _SETS.format("CUBE"))
_GROUPING = """SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem
    GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())"""
query("grouping_sets_counts", lambda t: _sql(t, ["lineitem"], _GROUPING), _GROUPING)
query("conditional_aggregates",
      lambda t: t.lineitem.groupBy("l_returnflag").agg(
          F.count_if(C("l_discount") == 0).alias("undiscounted"),
          F.sum(F.when(C("l_discount") > 0.05, cents("l_extendedprice"))).alias("discounted_cents")),
      f"""SELECT l_returnflag, count(*) FILTER (l_discount = 0) AS undiscounted,
         CAST(sum({CENTS('l_extendedprice')}) FILTER (l_discount > 0.05) AS BIGINT) AS discounted_cents
         FROM lineitem GROUP BY l_returnflag""")
_CTE = """WITH spending AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
    busy AS (SELECT o_custkey FROM spending WHERE n > 12)
    SELECT c_mktsegment, count(*) AS n FROM customer JOIN busy ON c_custkey = o_custkey GROUP BY c_mktsegment"""
query("common_table_expressions", lambda t: _sql(t, ["customer", "orders"], _CTE), _CTE)
query("join_then_group_keep_unmatched",
      lambda t: joins.checked_join(feeds.log_feed(t), feeds.screens(t), ["path"], validate="m:1")
      .groupBy("user_id", "screen").agg(n_rows()),
      f"""WITH {feeds.LOG_SQL} SELECT user_id, CASE WHEN event_type IN ('view', 'click', 'purchase')
      THEN 'screen ' || event_type END AS screen, count(*) AS n FROM log GROUP BY 1, 2""")

# ---------------------------------------------------------------- dedup
_ORDER_LATEST = [desc("o_totalprice"), asc("o_orderkey")]
query("latest_row_per_key",
      lambda t: dedup.latest_by(t.orders, ["o_custkey"], "o_orderdate", _ORDER_LATEST)
      .select("o_custkey", "o_orderkey", iso(C("o_orderdate").cast("date")).alias("day"), "o_totalprice"),
      """SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_totalprice FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey) = 1""")
query("oldest_row_per_key",
      lambda t: dedup.oldest_by(t.orders, ["o_custkey"], "o_orderdate", [asc("o_orderkey")]).select("o_custkey", "o_orderkey"),
      """SELECT o_custkey, o_orderkey FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
query("undecided_order",
      lambda t: dedup.order_ties(t.orders.select("o_custkey", iso(C("o_orderdate").cast("date")).alias("day")), ["o_custkey"], ["day"]),
      """SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS rows FROM orders GROUP BY 1, 2
         HAVING count(*) > 1""")
query("distinct_rows", lambda t: feeds.resent_log(t).distinct().groupBy("path").agg(n_rows()),
      f"""WITH {feeds.LOG_SQL} SELECT path, count(*) * CASE WHEN path = '/api/orders' THEN 2 ELSE 1 END AS n
      FROM log GROUP BY path""")
query("distinct_texts", lambda t: t.documents.select("text").distinct().select(F.sha2("text", 256).alias("digest")),
      "SELECT sha256(text) AS digest FROM (SELECT DISTINCT text FROM documents)")
query("distinct_projection", lambda t: t.orders.select("o_orderstatus", "o_orderpriority").distinct(),
      "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def _last_arrival(t):
    """The log as two deliveries on disk; of a line sent again, what lies last counts."""
    path = f"{t.scratch}/log"
    log = feeds.resent_log(t).select("ts", "path", "dur", "line")
    for k, part in enumerate((log.where("line < (1L << 40)"), log.where("line >= (1L << 40)"))):
        part.repartitionByRange("line").sortWithinPartitions("line").write.parquet(f"{path}/delivery={k}")
    arrived = with_row_arrival(t.spark.read.parquet(path))
    return dedup.nth_rows(arrived, ["ts", "path"], [desc("delivery"), desc("_arrival")], 1, 1).select("path", "line", "dur")


query("keep_last_arrival", _last_arrival,
      f"""WITH {feeds.LOG_SQL}, arrivals AS (
        SELECT ts, path, line, CAST(sec AS VARCHAR) || 's' AS dur FROM log UNION ALL
        SELECT ts, path, line + (1::BIGINT << 40), '9.5s' FROM log WHERE event_type = 'purchase')
      SELECT path, line, dur FROM arrivals QUALIFY row_number() OVER (PARTITION BY ts, path ORDER BY line DESC, dur) = 1""")
query("mark_all_duplicates",
      lambda t: dedup.mark_all_duplicates(t.orders, ["o_custkey", "o_orderpriority", "o_orderstatus"], "repeated")
      .select("o_orderkey", "repeated"),
      """SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey, o_orderpriority, o_orderstatus) > 1 AS repeated FROM orders""")
query("mark_later_duplicates",
      lambda t: dedup.mark_later_duplicates(t.orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"], "later")
      .select("o_orderkey", "later"),
      """SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) > 1
         AS later FROM orders""")
query("mark_earlier_duplicates",
      lambda t: dedup.mark_later_duplicates(t.orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"], "earlier", "last")
      .select("o_orderkey", "earlier"),
      """SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) > 1
         AS earlier FROM orders""")
_PRICE = [desc("o_totalprice"), asc("o_orderkey")]
_PRICE_SQL = "row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice {}, o_orderkey {})"
query("head_per_group", lambda t: dedup.head_by(t.orders, ["o_orderpriority"], _PRICE, 5).select("o_orderpriority", "o_orderkey"),
      f"SELECT o_orderpriority, o_orderkey FROM orders QUALIFY {_PRICE_SQL.format('DESC', '')} <= 5")
query("tail_per_group", lambda t: dedup.tail_by(t.orders, ["o_orderpriority"], _PRICE, 5).select("o_orderpriority", "o_orderkey"),
      f"SELECT o_orderpriority, o_orderkey FROM orders QUALIFY {_PRICE_SQL.format('', 'DESC')} <= 5")
query("nth_per_group", lambda t: dedup.nth_rows(t.orders, ["o_orderpriority"], _PRICE, 3, 3).select("o_orderpriority", "o_orderkey"),
      f"SELECT o_orderpriority, o_orderkey FROM orders QUALIFY {_PRICE_SQL.format('DESC', '')} = 3")
query("coalesce_history",
      lambda t: dedup.coalesce_history(
          feeds.log_feed(t).withColumn("code", parse.parse_integer(C("status"))), ["path"], ["line"], ["user_id", "code"]),
      f"""WITH {feeds.LOG_SQL} SELECT path, arg_max(user_id, line) FILTER (user_id IS NOT NULL) AS user_id,
      CAST(arg_max(status, line) FILTER (status IS NOT NULL) AS BIGINT) AS code FROM log GROUP BY path""")
query("accident_or_correction",
      lambda t: dedup.without_accidents(feeds.resent_log(t).drop("user_id"), ["ts", "path"], "line", [asc("dur")])
      .groupBy("path", "dur").agg(n_rows()).filter(C("dur") == "9.5s"),
      f"""WITH {feeds.LOG_SQL} SELECT path, '9.5s' AS dur, count(*) AS n FROM log
      WHERE event_type = 'purchase' OR (sec = 9.5) GROUP BY path""")

# ---------------------------------------------------------------- ranking, sorting
query("ranks_within_key",
      lambda t: with_ranks(t.part, ["p_brand"], [desc("p_size"), asc("p_partkey")], row_number="rn", rank="rk",
                           dense_rank="dr", average_rank="ar").select("p_partkey", "rn", "rk", "dr", "ar"),
      """SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS rn,
         rank() OVER w AS rk, dense_rank() OVER w AS dr,
         rank() OVER w + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / CAST(2 AS DOUBLE) AS ar
         FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_size DESC)""")
query("rank_whole_table",
      lambda t: with_ranks(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"), [],
                           [desc("l_quantity"), asc("l_extendedprice")], rank="rk", average_rank="ar")
      .groupBy("l_quantity", "rk", "ar").agg(n_rows()),
      """SELECT l_quantity, rk, rk + (n - 1) / CAST(2 AS DOUBLE) AS ar, n FROM (
         SELECT l_quantity, count(*) AS n, CAST(1 + coalesce(sum(count(*)) OVER (ORDER BY l_quantity DESC
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rk FROM lineitem GROUP BY l_quantity)""")
query("running_total",
      lambda t: with_running_total(t.orders.withColumn("cents", cents("o_totalprice")), ["o_orderpriority"],
                                   [asc("o_orderdate"), asc("o_orderkey")], "cents", "running").select("o_orderkey", "running"),
      f"""SELECT o_orderkey, CAST(sum({CENTS('o_totalprice')}) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey
         ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM orders""")
query("rolling_sum_last_rows",
      lambda t: with_rolling_sum(t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate", cents("o_totalprice").alias("cents")),
                                 ["o_orderpriority"], [asc("o_orderdate"), asc("o_orderkey")], "cents", "last_seven", 7)
      .select("o_orderkey", "last_seven"),
      f"""SELECT o_orderkey, CAST(sum({CENTS('o_totalprice')}) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey
         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS last_seven FROM orders""")
query("rolling_max_last_rows",
      lambda t: with_row_frame(t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate", cents("o_totalprice").alias("cents")),
                               ["o_orderpriority"], [desc("o_orderdate"), asc("o_orderkey")],
                               {"top": F.max("cents"), "low": F.min("cents"), "n": F.count(F.lit(1))}, 50).select("o_orderkey", "top", "low", "n"),
      f"""SELECT o_orderkey, max({CENTS('o_totalprice')}) OVER w AS top, min({CENTS('o_totalprice')}) OVER w AS low, count(*) OVER w AS n
         FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)""")
query("rolling_week_sum",
      lambda t: with_range_frame(t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate", cents("o_totalprice").alias("cents")),
                                 ["o_orderpriority"], F.unix_date(C("o_orderdate").cast("date")),
                                 {"week": ("sum", "cents"), "top": ("max", "cents"), "low": ("min", "cents"), "n": ("count", "cents"), "mean": ("mean", "cents")}, 6)
      .select("o_orderkey", "week", "top", "low", "n", F.round("mean", 4).alias("mean")),
      f"""SELECT o_orderkey, CAST(sum({CENTS('o_totalprice')}) OVER w AS BIGINT) AS week, max({CENTS('o_totalprice')}) OVER w AS top,
         min({CENTS('o_totalprice')}) OVER w AS low, count(*) OVER w AS n,
         round(CAST(sum({CENTS('o_totalprice')}) OVER w AS DOUBLE) / count(*) OVER w, 4) AS mean
         FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY CAST(o_orderdate AS DATE)
         RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""")
query("rolling_day_of_events",
      lambda t: with_range_frame(t.events.select("event_id", "event_type", "ts", cents("value").alias("cents")), ["event_type"],
                                 F.unix_micros(C("ts").cast("timestamp")), {"day": ("sum", "cents"), "top": ("max", "cents")}, 24 * 3600 * 10**6)
      .select("event_id", "day", "top"),
      f"""SELECT event_id, CAST(sum({CENTS('value')}) OVER w AS BIGINT) AS day, max({CENTS('value')}) OVER w AS top FROM events
         WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)""")
query("ranks_of_crowded_text",
      lambda t: with_ranks(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", F.concat(F.lit("Customer#00000"), C("o_custkey").cast("string")).alias("name")),
                           [], [asc("o_orderstatus"), asc("o_orderpriority"), desc("name"), asc("o_orderkey")], row_number="rn", rank="rk",
                           dense_rank="dr").select("o_orderkey", "rn", "rk", "dr"),
      """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus, o_orderpriority, 'Customer#00000' || o_custkey DESC, o_orderkey) AS rn,
         rank() OVER (ORDER BY o_orderstatus) AS rk, dense_rank() OVER (ORDER BY o_orderstatus) AS dr FROM orders""")
query("previous_row",
      lambda t: with_neighbour(t.orders, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "o_custkey", "previous")
      .select("o_orderkey", "previous"),
      "SELECT o_orderkey, lag(o_custkey) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS previous FROM orders")
query("share_of_group_total",
      lambda t: aggregate.with_group_value(t.orders.select("o_orderkey", "o_custkey", cents("o_totalprice").alias("cents")),
                                           ["o_custkey"], [F.sum("cents").alias("total")])
      .select("o_orderkey", "total", (C("cents") / C("total")).alias("share")),
      f"""SELECT o_orderkey, total, CAST(cents AS DOUBLE) / CAST(total AS DOUBLE) AS share FROM (SELECT o_orderkey,
         {CENTS('o_totalprice')} AS cents, CAST(sum({CENTS('o_totalprice')}) OVER (PARTITION BY o_custkey) AS BIGINT) AS total
         FROM orders)""")
query("top_row_with_tie_rule",
      lambda t: dedup.head_by(feeds.log_feed(t).withColumn("code", parse.parse_integer(C("status"))), ["user_id"],
                              [desc("code"), asc("line")], 1).select("user_id", "line", "code"),
      f"""WITH {feeds.LOG_SQL} SELECT user_id, line, CAST(status AS BIGINT) AS code FROM log
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY status DESC NULLS LAST, line) = 1""")
query("sort_mixed_directions",
      lambda t: t.customer.orderBy(C("c_mktsegment").asc(), C("c_acctbal").desc(), C("c_custkey").asc()).select("c_custkey", "c_mktsegment"),
      "SELECT c_custkey, c_mktsegment FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
query("sort_nulls_placed",
      lambda t: feeds.log_feed(t).orderBy(C("user_id").desc_nulls_first(), C("line")).select("line", "user_id"),
      f"WITH {feeds.LOG_SQL} SELECT line, user_id FROM log ORDER BY user_id DESC NULLS FIRST, line")
query("top_k", lambda t: t.lineitem.orderBy(C("l_extendedprice").desc(), "l_orderkey", "l_partkey", "l_linenumber").limit(50)
      .select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"),
      """SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem
         ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber LIMIT 50""")
query("bottom_k", lambda t: t.orders.orderBy("o_totalprice", "o_orderkey").limit(50).select("o_orderkey", "o_totalprice"),
      "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50")
query("previous_day_change",
      lambda t: with_neighbour(through_storage(t.orders.groupBy(C("o_orderdate").cast("date").alias("day"))
                                               .agg(F.sum(cents("o_totalprice")).alias("cents")), "daily"),
                               [], ["day"], "cents", "before").select(iso("day").alias("day"), (C("cents") - C("before")).alias("change")),
      f"""SELECT CAST(day AS VARCHAR) AS day, cents - lag(cents) OVER (ORDER BY day) AS change FROM (SELECT CAST(o_orderdate AS DATE) AS day,
         {SUM_CENTS('o_totalprice')} AS cents FROM orders GROUP BY 1)""")

# ---------------------------------------------------------------- set operations
query("union_by_name",
      lambda t: t.customer.select(C("c_custkey").alias("id"), C("c_name").alias("name"))
      .unionByName(t.supplier.select(C("s_name").alias("name"), C("s_suppkey").alias("id"))),
      "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
query("key_set_difference",
      lambda t: compare.key_difference(t.orders.filter(C("o_orderstatus") == "F").select("o_custkey"),
                                       t.orders.filter(C("o_totalprice") > 250000).select("o_custkey"), ["o_custkey"]),
      """WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'),
         e AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 250000)
         SELECT o_custkey, 'extra' AS side FROM a ANTI JOIN e USING (o_custkey) UNION ALL
         SELECT o_custkey, 'missing' FROM e ANTI JOIN a USING (o_custkey)""")
query("row_set_difference",
      lambda t: compare.row_difference(feeds.resent_log(t).select("path", "status"), feeds.log_feed(t).select("path", "status")),
      f"""WITH {feeds.LOG_SQL} SELECT path, coalesce(CAST(status AS VARCHAR), '-') AS status, count(*) AS surplus FROM log
      WHERE event_type IN ('click', 'purchase') GROUP BY 1, 2""")
query("cell_difference",
      lambda t: compare.value_difference(
          t.orders.select("o_orderkey", "o_orderstatus", F.when(C("o_orderstatus") == "P", C("o_totalprice") + 1).otherwise(C("o_totalprice")).alias("o_totalprice")),
          t.orders.select("o_orderkey", "o_orderstatus", (C("o_totalprice") * (1 + 1e-12)).alias("o_totalprice")),
          ["o_orderkey"], ["o_orderstatus", "o_totalprice"], 1e-9).select("o_orderkey", "column"),
      "SELECT o_orderkey, 'o_totalprice' AS \"column\" FROM orders WHERE o_orderstatus = 'P'")
query("intersect_except",
      lambda t: t.lineitem.select("l_suppkey").intersect(t.supplier.select("s_suppkey")).withColumn("kind", F.lit("both"))
      .unionByName(t.orders.select(C("o_custkey").alias("l_suppkey")).exceptAll(t.customer.select("c_custkey")).withColumn("kind", F.lit("again"))),
      """SELECT l_suppkey, 'both' AS kind FROM (SELECT l_suppkey FROM lineitem INTERSECT SELECT s_suppkey FROM supplier)
         UNION ALL SELECT o_custkey, 'again' FROM (SELECT o_custkey FROM orders EXCEPT ALL SELECT c_custkey FROM customer)""")

# ---------------------------------------------------------------- profiling
query("profile_shape", lambda t: profile.shape(t.customer), "SELECT count(*) AS rows, CAST(5 AS INTEGER) AS columns FROM customer")
query("profile_columns", lambda t: profile.column_types(t.supplier),
      """SELECT CAST(0 AS INTEGER) AS position, 's_suppkey' AS "column", 'bigint' AS type, count(s_suppkey) AS present FROM supplier
         UNION ALL SELECT 1, 's_name', 'string', count(s_name) FROM supplier
         UNION ALL SELECT 2, 's_nationkey', 'int', count(s_nationkey) FROM supplier
         UNION ALL SELECT 3, 's_acctbal', 'double', count(s_acctbal) FROM supplier""")
query("profile_nulls", lambda t: profile.null_counts(feeds.log_feed(t).select("path", "user_id")),
      f"""WITH {feeds.LOG_SQL} SELECT 'path' AS "column", count(*) FILTER (path IS NULL) AS missing FROM log
      UNION ALL SELECT 'user_id', count(*) FILTER (user_id IS NULL) FROM log""")
query("profile_describe",
      lambda t: profile.describe(t.orders, ["o_totalprice", "o_custkey"]).withColumns(
          {"mean": F.round("mean", 4), "std": F.round("std", 4), **{c: F.round(c, 6) for c in ("q25", "q50", "q75")}}),
      " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
         round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
         round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75,
         CAST(max({c}) AS DOUBLE) AS max FROM orders""" for c in ("o_totalprice", "o_custkey")))
query("profile_value_counts", lambda t: profile.value_counts(feeds.log_feed(t), "user_id"),
      f"WITH {feeds.LOG_SQL} SELECT user_id AS value, count(*) AS n FROM log GROUP BY user_id")
query("profile_distinct_values", lambda t: t.part.select("p_brand").distinct(), "SELECT DISTINCT p_brand FROM part")
query("profile_unparsed", lambda t: profile.unparsed_values(feeds.log_feed(t), "status", parse.parse_integer),
      f"WITH {feeds.LOG_SQL} SELECT '-' AS value, count(*) AS n FROM log WHERE status IS NULL")
query("profile_token_hits",
      lambda t: profile.token_hits(feeds.roster_feed(t), ["code", "base_pay", "hired_on"], text.ROSTER_MISSING),
      """WITH r AS (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')),
         hits AS (SELECT count(*) FILTER (c_nationkey = 24) AS codes, count(*) FILTER (c_nationkey = 0) AS pays,
                  count(*) FILTER (c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 0) AS dates FROM r)
         SELECT c AS "column", k AS token, CASE WHEN c = 'code' AND k = '' THEN codes WHEN c = 'base_pay' AND k = '-' THEN pays
                WHEN c = 'hired_on' AND k = '不明' THEN dates ELSE 0 END AS hits
         FROM hits, (SELECT unnest(['code', 'base_pay', 'hired_on']) AS c), (SELECT unnest(['', '-', 'N/A', '不明']) AS k)""")
query("profile_change_report",
      lambda t: profile.change_report(
          feeds.sales_feed(t).select(C("shop_name"), text.nfkc_strip(C("shop_name")).alias("shop_name_n"),
                                     C("qty"), text.nfkc_strip(C("qty")).alias("qty_n")),
          [("shop_name", "shop_name_n"), ("qty", "qty_n")]),
      """SELECT 'shop_name' AS "column", count(*) FILTER (l_returnflag <> 'R') AS changed,
           count(DISTINCT l_suppkey || l_returnflag) AS distinct_before,
           count(DISTINCT l_suppkey || CASE WHEN l_returnflag = 'R' THEN 'R' ELSE '' END) AS distinct_after FROM lineitem
         UNION ALL SELECT 'qty', count(*) FILTER (l_returnflag = 'A' AND NOT (l_tax = 0.0 AND l_discount = 0.1)),
           count(DISTINCT CASE WHEN l_tax = 0.0 AND l_discount = 0.1 THEN '-' ELSE CASE WHEN l_returnflag = 'A' THEN 'w'
             WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '-' ELSE '' END || l_quantity END),
           count(DISTINCT CASE WHEN l_tax = 0.0 AND l_discount = 0.1 THEN '-' ELSE CASE
             WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '-' ELSE '' END || l_quantity END) FROM lineitem""")
query("profile_candidate_key", lambda t: profile.key_report(t.lineitem, ["l_orderkey", "l_linenumber"]),
      """SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, count(*) FILTER (n > 1) AS repeated_keys,
         CAST(sum(n - 1) AS BIGINT) AS surplus_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
query("profile_lateness",
      lambda t: exact_quantiles(through_storage(
          t.lineitem.join(t.orders, C("l_orderkey") == C("o_orderkey")).select(
              parse.seconds_between(C("o_orderdate"), C("l_shipdate")).alias("late")), "lateness"), "late", [0.5, 0.9, 0.99])
      .select("fraction", F.round("value", 3).alias("seconds")),
      " UNION ALL ".join(f"""SELECT CAST({q} AS DOUBLE) AS fraction, round(quantile_cont(CAST(date_diff('second', o_orderdate, l_shipdate)
         AS DOUBLE), {q}), 3) AS seconds FROM lineitem JOIN orders ON l_orderkey = o_orderkey""" for q in (0.5, 0.9, 0.99)))


# ---------------------------------------------------------------- history
def _status_log(t):
    return t.orders.select("o_custkey", C("o_orderkey").alias("seq"), C("o_orderstatus").alias("status"))


query("version_history",
      lambda t: history.version_history(_status_log(t), ["o_custkey"], "seq", ["status"]).drop("version_key"),
      """WITH marked AS (SELECT o_custkey, o_orderkey AS seq, o_orderstatus AS status,
           lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders),
         changed AS (SELECT * FROM marked WHERE before IS DISTINCT FROM status)
         SELECT o_custkey, status, seq AS valid_from, lead(seq) OVER (PARTITION BY o_custkey ORDER BY seq) AS valid_to,
           lead(seq) OVER (PARTITION BY o_custkey ORDER BY seq) IS NULL AS is_current FROM changed""")
query("apply_change_log",
      lambda t: history.apply_changes(
          t.customer.select("c_custkey", "c_mktsegment"),
          t.orders.select(C("o_custkey").alias("c_custkey"), C("o_orderpriority").alias("c_mktsegment"), "o_orderkey",
                          F.when(C("o_orderstatus") == "F", "D").otherwise("U").alias("kind")),
          ["c_custkey"], "o_orderkey", "kind"),
      """WITH newest AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
         SELECT c_custkey, coalesce(o_orderpriority, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN newest ON o_custkey = c_custkey
         WHERE o_orderstatus IS NULL OR o_orderstatus <> 'F'
         UNION ALL SELECT o_custkey, o_orderpriority FROM newest ANTI JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'F'""")
query("content_surrogate_key",
      lambda t: feeds.log_feed(t).select("line", text.content_key(C("path"), C("user_id")).alias("key")),
      f"""WITH {feeds.LOG_SQL} SELECT line, sha256('v' || path || chr(31) || coalesce('v' || user_id, 'n')) AS key FROM log""")
query("pseudonyms", lambda t: t.customer.select("c_custkey", text.pseudonym(C("c_name"), "round-1:").alias("alias")),
      "SELECT c_custkey, sha256('round-1:' || c_name) AS alias FROM customer")
