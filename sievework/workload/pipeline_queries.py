"""Files in and out, publication, whole pipelines, increments and streams.

Queries that publish something write below the shared scratch folder and return
what a reader of the published table sees.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions import parse
from sievework.operators import aggregate, compare
from sievework.operators.order import asc
from sievework.plans import orders as order_plan
from sievework.plans import roster as roster_plan
from sievework.plans import sales as sales_plan
from sievework.plans import weblog
from sievework.sinks import contract, findings, publish
from sievework.sources import delimited, encoding
from sievework.sources.registry import SourceSpec, load
from sievework.streaming import gaps, incremental, streams
from sievework.workload import feeds
from sievework.workload.catalog import cents, iso, n_rows, query

C = F.col
CENTS = "CAST(round_even({} * 100, 0) AS BIGINT)".format
SUM_CENTS = "CAST(sum(CAST(round_even({} * 100, 0) AS BIGINT)) AS BIGINT)".format
DAY = "CAST(CAST({} AS DATE) AS VARCHAR)".format


# ---------------------------------------------------------------- sources
def _csv(t, df, name, **options):
    path = f"{t.scratch}/{name}"
    writer = df.write.option("header", True).option("escape", '"')
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.csv(path)
    return path


query("read_csv_inferred",
      lambda t: delimited.read_inferred(t.spark, _csv(t, t.customer, "c"))
      .select(C("c_custkey").cast("bigint").alias("c_custkey"), "c_name", C("c_acctbal").cast("double").alias("c_acctbal")),
      "SELECT c_custkey, c_name, c_acctbal FROM customer")
query("read_csv_as_text",
      lambda t: delimited.read_as_text(
          t.spark, _csv(t, feeds.roster_feed(t).drop("mail"), "r"), ["code", "name", "dept", "hired_on", "base_pay", "weekly_hours", "updated_on"])
      .groupBy("code", "weekly_hours").agg(n_rows()).filter((C("code") == "") | (C("weekly_hours") == "N/A")),
      """WITH r AS (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE'))
         SELECT CASE WHEN c_nationkey = 24 THEN '' WHEN c_mktsegment = 'HOUSEHOLD' OR c_custkey > 999 THEN CAST(c_custkey AS VARCHAR)
                ELSE printf('%04d', c_custkey) END AS code, CASE WHEN c_nationkey = 1 THEN 'N/A' ELSE '４０' END AS weekly_hours, count(*) AS n
         FROM r WHERE c_nationkey IN (1, 24) GROUP BY 1, 2""")
query("read_csv_typed",
      lambda t: delimited.read_typed(
          t.spark, _csv(t, t.orders.select(F.lpad(C("o_orderkey").cast("string"), 12, "0").alias("code"),
                                           F.date_format("o_orderdate", "dd.MM.yyyy").alias("day")), "o"),
          "code string, day date", date_format="dd.MM.yyyy").select("code", iso("day").alias("day")),
      f"SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS code, {DAY('o_orderdate')} AS day FROM orders")
query("read_csv_cp932",
      lambda t: delimited.read_as_text(
          t.spark, _csv(t, t.part.select(C("p_partkey").cast("string").alias("key"), F.concat(F.lit("㈱山田①　"), C("p_name")).alias("name")),
                        "p", encoding="windows-31j"), ["key", "name"], encoding="windows-31j").select("key", "name"),
      "SELECT CAST(p_partkey AS VARCHAR) AS key, '㈱山田①　' || p_name AS name FROM part")
query("read_tab_separated_without_header",
      lambda t: delimited.read_as_text(
          t.spark, _csv(t, t.part.select("p_partkey", "p_name", "p_brand"), "p", sep="\t", header=False),
          ["key", "name", "brand"], separator="\t", header=False).select("key", "name", "brand"),
      "SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name, p_brand AS brand FROM part")


def _json(t):
    path = f"{t.scratch}/j"
    t.events.select("event_id", "event_type", "user_id").write.json(path)
    return delimited.read_json_lines(t.spark, path, "event_id bigint, event_type string, user_id bigint")


query("read_json_lines", _json, "SELECT event_id, event_type, user_id FROM events")


def _deliveries(t):
    """The order feed as files: three systems, two encodings, two column orders."""
    feed = feeds.order_feed(t)
    plain = list(order_plan.RAW_COLUMNS)
    layouts = {"a": (plain, "UTF-8"), "b": (plain[::-1], "UTF-8"), "c": (plain, "windows-31j")}
    return {system: _csv(t, feed.filter(C("system") == system).select(*columns), f"system={system}", encoding=charset)
            for system, (columns, charset) in layouts.items()}


def _evidence(t):
    paths = list(_deliveries(t).values())
    found = encoding.encoding_evidence(t.spark, paths).join(encoding.first_lines(t.spark, paths), "path")
    return found.select(F.regexp_extract("path", "system=(.)", 1).alias("system"), "utf8", "cp932",
                        F.split(F.decode("first_line", "UTF-8"), ",")[0].alias("first_column")).distinct()


query("detect_encoding", _evidence,
      f"""SELECT DISTINCT {feeds.SYSTEM_SQL} AS system, {feeds.SYSTEM_SQL} <> 'c' AS utf8, true AS cp932,
         CASE {feeds.SYSTEM_SQL} WHEN 'b' THEN 'ingested_at' ELSE 'order_id' END AS first_column FROM orders""")
query("read_mixed_delivery",
      lambda t: delimited.read_delivery(t.spark, list(_deliveries(t).values()))
      .select("order_id", F.lower("status").alias("status"), "ingested_at"),
      " UNION ALL ".join(f"""SELECT {feeds.ORDER_ID_SQL} AS order_id,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status,
         strftime(CAST(o_orderdate AS DATE) + {d}, '%Y-%m-%dT%H:%M:%S') AS ingested_at FROM orders {w}"""
                        for d, w in ((1, ""), (30, "WHERE o_orderstatus = 'P'"))))
def _status_files(t):
    """Line items in one folder per status, each written in one piece, read back with the files that rows come from."""
    path = f"{t.scratch}/lines"
    with publish.unsorted_partitions(t.spark, 16):
        (t.lineitem.select("l_orderkey", "l_linenumber", "l_linestatus", C("l_returnflag").alias("flag"))
         .repartition("flag").write.partitionBy("flag").parquet(path))
    rows = t.spark.read.parquet(path)
    named = delimited.rows_per_file(rows).join(rows.select(C("_metadata.file_path").alias("file"), "flag").distinct(), "file")
    return named.groupBy("flag").agg(F.sum("rows").alias("rows"), F.count_if(C("file").rlike("/part-[0-9]+[^/]*[.]parquet$") & (C("bytes") > 0)).alias("files"))


query("source_file_lineage", _status_files,
      "SELECT l_returnflag AS flag, CAST(count(*) AS BIGINT) AS rows, CAST(1 AS BIGINT) AS files FROM lineitem GROUP BY 1")

_STORE = {"売上日": "sale_date", "店舗名": "shop_name", "商品CD": "item_cd", "数量": "qty", "金額": "amount", "備考": "note"}
_WEB = {"受注日": "sale_date", "店舗名": "shop_name", "商品CD": "item_cd", "数量": "qty", "金額税抜": "amount", "ステータス": "note"}
_SYSTEMS = (("old", _STORE, ("売上日", "店舗名", "商品CD", "数量", "金額", "備考"), "税込", "windows-31j"),
            ("new", _STORE, ("店舗名", "商品CD", "数量", "金額", "売上日", "備考"), "税込", "UTF-8"),
            ("ec", _WEB, ("受注番号", "受注日", "店舗名", "商品CD", "数量", "金額税抜", "ステータス"), "税抜", "UTF-8"))


def _registry(t, period=None):
    """Sales files of three systems with their own column names, orders and encodings."""
    feed, specs = feeds.sales_feed(t), []
    for source, rename, columns, tax, charset in _SYSTEMS:
        back = {new: old for old, new in rename.items()}
        rows = feed.filter(C("source") == source).withColumnsRenamed(back).withColumn("受注番号", F.lit("EC"))
        path = _csv(t, rows.select(*columns), source, encoding=charset)
        specs.append(SourceSpec(path, columns, rename, {"tax_type": tax, "source": source}, charset, period))
    return specs


query("read_registered_sources",
      lambda t: load(t.spark, _registry(t), sales_plan.RAW_COLUMNS).groupBy("source", "tax_type", "note").agg(n_rows()),
      """SELECT CASE l_returnflag WHEN 'A' THEN 'old' WHEN 'N' THEN 'new' ELSE 'ec' END AS source,
         CASE l_returnflag WHEN 'R' THEN '税抜' ELSE '税込' END AS tax_type,
         CASE WHEN l_tax = 0.04 AND l_discount = 0.05 THEN 'テスト' WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '返品' ELSE '' END
         AS note, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""")


def _view(t):
    feed = feeds.log_feed(t)
    feed.createOrReplaceTempView("raw_log")
    return t.spark.sql("""SELECT line, nullif(user_id, '') AS user_id, try_cast(status AS int) AS status,
        try_cast(replace(bytes, ',', '') AS bigint) AS bytes FROM raw_log""")


query("sql_view_with_cleaning", _view,
      f"WITH {feeds.LOG_SQL} SELECT line, user_id, CAST(status AS INTEGER) AS status, n_bytes AS bytes FROM log")
_INLINE = """SELECT o_orderpriority, label, count(*) AS n FROM orders JOIN
    (VALUES ('F', 'completed'), ('O', 'pending'), ('P', 'cancelled')) AS s(code, label) ON o_orderstatus = code
    GROUP BY o_orderpriority, label"""


def _inline(t):
    t.orders.createOrReplaceTempView("orders")
    return t.spark.sql(_INLINE)


query("inline_rows", _inline, _INLINE)


# ---------------------------------------------------------------- sinks
def _monthly(df):
    return df.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))


def _partitioned(t):
    path = f"{t.scratch}/orders"
    publish.replace_partitions(_monthly(t.orders), path, ["month"])
    return t.spark.read.parquet(path)


query("read_partition_column",
      lambda t: _partitioned(t).filter(C("month") >= "2000-01").groupBy("month").agg(n_rows()),
      "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders WHERE o_orderdate >= DATE '2000-01-01' GROUP BY 1")


def _replaced(t):
    path = f"{t.scratch}/orders"
    rows = _monthly(t.orders).select("o_orderkey", "o_totalprice", "month", "o_orderstatus")
    publish.replace_partitions(rows, path, ["month"])
    again = rows.filter(C("month") >= "2001-01")
    publish.replace_partitions(again.withColumn("o_totalprice", C("o_totalprice") + 1), path, ["month"])
    publish.replace_partitions(again.withColumn("o_totalprice", C("o_totalprice") + 2).filter(C("month") != "2001-03"),
                               path, ["month"], rerun=again)
    return t.spark.read.parquet(path).groupBy("month").agg(n_rows(), F.sum(cents("o_totalprice")).alias("cents"))


query("publish_replace_partitions", _replaced,
      f"""SELECT month, count(*) AS n, {SUM_CENTS('o_totalprice')} + CASE WHEN month >= '2001-01' THEN 200 * count(*) ELSE 0 END AS cents
         FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders) WHERE month <> '2001-03' GROUP BY month""")


def _log(t):
    path = f"{t.scratch}/log"
    rows = t.orders.select("o_orderkey", "o_totalprice", F.lit(1).alias("run"))
    publish.append_log(rows, path)
    publish.append_log(rows.withColumns({"o_totalprice": C("o_totalprice") * 2, "run": F.lit(2)})
                       .filter(C("o_totalprice") > 500000), path)
    return publish.latest_view(t.spark, path, ["o_orderkey"], "run", [asc("o_totalprice")])


query("publish_append_and_read_latest", _log,
      """SELECT o_orderkey, CASE WHEN o_totalprice * 2 > 500000 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
         CAST(CASE WHEN o_totalprice * 2 > 500000 THEN 2 ELSE 1 END AS INTEGER) AS run FROM orders""")


def _refreshed(t):
    path = f"{t.scratch}/daily"
    daily = t.orders.groupBy(iso(C("o_orderdate").cast("date")).alias("day")).agg(n_rows())
    publish.full_refresh(daily, path)
    publish.full_refresh(publish.read_table(t.spark, path), path)
    return t.spark.read.parquet(path)


query("publish_full_refresh", _refreshed, f"SELECT {DAY('o_orderdate')} AS day, count(*) AS n FROM orders GROUP BY 1")


def _upserted(t):
    path = f"{t.scratch}/customers"
    base = t.customer.select("c_custkey", "c_acctbal", C("c_mktsegment").alias("segment"))
    publish.replace_partitions(base.filter(C("segment") != "FURNITURE"), path, ["segment"])
    moved = base.filter(C("segment").isin("FURNITURE", "BUILDING")).withColumn(
        "segment", F.when(C("c_acctbal") < 0, "RISK").otherwise(C("segment")))
    publish.upsert(moved, path, ["c_custkey"], ["segment"])
    return t.spark.read.parquet(path).select("c_custkey", "c_acctbal", "segment")


query("publish_upsert", _upserted,
      """SELECT c_custkey, c_acctbal, CASE WHEN c_mktsegment IN ('FURNITURE', 'BUILDING') AND c_acctbal < 0 THEN 'RISK'
         ELSE c_mktsegment END AS segment FROM customer""")


def _upserted_null(t):
    """Keys and partition values that are NULL are values like others, also when a row moves away from them."""
    path = f"{t.scratch}/customers"
    segment = F.when(C("c_mktsegment") != "FURNITURE", C("c_mktsegment"))
    base = t.customer.select(F.when(C("c_custkey") > 0, C("c_custkey")).alias("key"), "c_acctbal", segment.alias("segment"))
    publish.replace_partitions(base, path, ["segment"])
    some = base.filter((C("key") % 2 == 0) & C("segment").isNull()).withColumn("c_acctbal", F.lit(0.0))
    moved = base.filter((C("key") % 3 == 0) & (C("segment") == "BUILDING")).withColumn("segment", F.lit(None).cast("string"))
    publish.upsert(some.unionByName(moved), path, ["key"], ["segment"])
    return publish.read_table(t.spark, path, base.schema).select("key", cents("c_acctbal").alias("cents"), "segment")


query("upsert_null_partition", _upserted_null,
      f"""SELECT key, CASE WHEN c_mktsegment = 'FURNITURE' AND key % 2 = 0 THEN 0 ELSE {CENTS('c_acctbal')} END AS cents,
         CASE WHEN c_mktsegment = 'FURNITURE' OR c_mktsegment = 'BUILDING' AND key % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment
         FROM (SELECT *, CASE WHEN c_custkey > 0 THEN c_custkey END AS key FROM customer)""")


def _replaced_escaped(t):
    """Partition values with characters that folders cannot have, emptied and refilled."""
    path = f"{t.scratch}/orders"
    label = F.concat(C("o_orderpriority"), F.lit(": 100% = [a/b]"))
    rows = t.orders.select("o_orderkey", F.when(C("o_orderpriority") != "2-HIGH", label).alias("label"))
    publish.replace_partitions(rows, path, ["label"])
    publish.replace_partitions(rows.filter(C("label").startswith("1")), path, ["label"],
                               rerun=rows.filter(C("label").isNull() | (C("label") < "4")).select("label"))
    return publish.read_table(t.spark, path, rows.schema).groupBy("label").agg(n_rows())


query("replace_escaped_partition", _replaced_escaped,
      """SELECT o_orderpriority || ': 100% = [a/b]' AS label, count(*) AS n FROM orders
         WHERE o_orderpriority < '2' OR o_orderpriority >= '4' GROUP BY 1""")


def _exported(t):
    """The cleaned orders exported in key order; what comes back, and whether each file begins behind the one before it."""
    path = f"{t.scratch}/export"
    publish.export_sorted(order_plan.clean_orders(feeds.order_feed(t)), path, ["order_id"], 6, order_plan.ORDER_CONTRACT)
    back = t.spark.read.parquet(path)
    ordered = findings.order_findings(back, ["order_id"]).select((C("failed") == 0).alias("ordered"))
    return back.groupBy(C("_metadata.file_name").isNotNull().alias("stored")).agg(n_rows(), (F.countDistinct("_metadata.file_name") > 1).alias("several")).crossJoin(ordered)  # one row each


query("publish_single_file", _exported,
      f"SELECT true AS stored, count(*) AS n, true AS several, true AS ordered FROM ({feeds.CLEAN_ORDERS_SQL})")


# ---------------------------------------------------------------- contract
query("contract_enforced",
      lambda t: contract.enforce_contract(
          t.orders.select("o_orderkey", C("o_custkey"), cents("o_totalprice").alias("cents")),
          T.StructType([T.StructField("o_orderkey", T.LongType(), False), T.StructField("o_custkey", T.IntegerType()),
                        T.StructField("cents", T.LongType(), False)])),
      f"SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, {CENTS('o_totalprice')} AS cents FROM orders")


def _counts(t):
    clean = order_plan.clean_orders(feeds.order_feed(t))
    wrong = clean.withColumn("amount_jpy", F.when(C("status") == "pending", C("amount_jpy") + 1).otherwise(C("amount_jpy"))) \
        .filter(C("region") != "south")
    return compare.difference_counts(wrong, clean, ["order_id"], ["status", "amount_jpy"])


query("contract_difference_counts", _counts,
      f"""WITH c AS ({feeds.CLEAN_ORDERS_SQL}) SELECT CAST(0 AS BIGINT) AS extra, count(*) FILTER (region = 'south') AS missing,
         CAST(0 AS BIGINT) AS differs_status, count(*) FILTER (region <> 'south' AND status = 'pending') AS differs_amount_jpy FROM c""")

# ---------------------------------------------------------------- order pipeline


def _shown(orders):
    return orders.withColumn("order_date", iso("order_date"))


query("orders_clean", lambda t: _shown(order_plan.clean_orders(feeds.order_feed(t))), feeds.CLEAN_ORDERS_SQL)
query("orders_clean_from_files", lambda t: _shown(order_plan.ingest_orders(t.spark, list(_deliveries(t).values()))),
      feeds.CLEAN_ORDERS_SQL)
query("orders_monthly_by_status",
      lambda t: order_plan.clean_orders(feeds.order_feed(t)).groupBy(F.date_format("order_date", "yyyy-MM").alias("month"), "status")
      .agg(n_rows(), F.sum("quantity").alias("quantity"), F.sum("amount_jpy").alias("amount_jpy")),
      f"""SELECT left(order_date, 7) AS month, status, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS quantity,
         CAST(sum(amount_jpy) AS BIGINT) AS amount_jpy FROM ({feeds.CLEAN_ORDERS_SQL}) GROUP BY 1, 2""")

# ---------------------------------------------------------------- sales pipeline


def _fact(t):
    clean, _ = sales_plan.split_usable(sales_plan.classify(feeds.sales_feed(t)))
    return sales_plan.join_masters(clean, feeds.sales_masters(t))


query("sales_classified",
      lambda t: sales_plan.classify(feeds.sales_feed(t)).groupBy("source", "reject_reason").agg(
          n_rows(), F.sum("qty").alias("qty"), F.sum("amount").alias("amount"), F.sum("amount_incl").alias("amount_incl"),
          F.count_if(~C("amount").eqNullSafe(C("amount_incl"))).alias("repriced")),
      f"""WITH {feeds.PRICED_SQL}
      SELECT source, CASE WHEN no_qty THEN 'qty' WHEN no_amount THEN 'amount' END AS reject_reason, count(*) AS n,
        CAST(sum(qty) AS BIGINT) AS qty, CAST(sum(amount) AS BIGINT) AS amount, CAST(sum(amount_incl) AS BIGINT) AS amount_incl,
        count(*) FILTER (amount IS DISTINCT FROM amount_incl) AS repriced FROM priced GROUP BY 1, 2""")
query("sales_rejection_rate",
      lambda t: sales_plan.classify(feeds.sales_feed(t)).agg(
          n_rows(), F.count("reject_reason").alias("rejected"),
          F.bround(F.count("reject_reason") * 100.0 / F.count(F.lit(1)), 1).alias("percent")),
      """SELECT count(*) AS n, count(*) FILTER (r) AS rejected, round_even(count(*) FILTER (r) * CAST(100 AS DOUBLE) / count(*), 1) AS percent
         FROM (SELECT (l_tax = 0.0 AND l_discount = 0.1) OR (l_tax = 0.08 AND l_discount = 0.0) AS r FROM lineitem)""")
query("sales_fact",
      lambda t: _fact(t).groupBy("shop_cd", "category", "source").agg(n_rows(), F.sum("amount_incl").alias("amount")),
      f"WITH {feeds.SALES_SQL} SELECT shop_cd, category, source, count(*) AS n, CAST(sum(amount_incl) AS BIGINT) AS amount FROM fact GROUP BY 1, 2, 3")
query("sales_exclusions", lambda t: sales_plan.exclusion_counts(_fact(t)),
      f"""WITH {feeds.SALES_SQL} SELECT count(*) FILTER (is_test) AS test_rows,
         coalesce(CAST(sum(amount_incl) FILTER (is_test) AS BIGINT), 0) AS test_amount,
         count(*) FILTER (sale_date > close_date) AS closed_rows,
         coalesce(CAST(sum(amount_incl) FILTER (sale_date > close_date) AS BIGINT), 0) AS closed_amount FROM fact""")
_DAILY = ("CAST(sum(qty) AS BIGINT) AS qty, CAST(sum(amount_incl) AS BIGINT) AS amount_jpy, count(*) AS n_lines")
query("sales_daily_category",
      lambda t: sales_plan.daily_by_category(sales_plan.target_rows(_fact(t))).withColumn("sale_date", iso("sale_date")),
      f"""WITH {feeds.SALES_SQL} SELECT CAST(sale_date AS VARCHAR) AS sale_date, shop_cd, category, {_DAILY} FROM target
      GROUP BY 1, 2, 3""")
query("sales_daily_shop",
      lambda t: sales_plan.summarise(_fact(t), feeds.sales_masters(t).shops)[0].withColumn("sale_date", iso("sale_date")),
      f"""WITH {feeds.SALES_SQL}, daily AS (SELECT sale_date, shop_cd, {_DAILY} FROM target GROUP BY 1, 2),
      axis AS (SELECT CAST(unnest(generate_series((SELECT min(sale_date) FROM daily), (SELECT max(sale_date) FROM daily),
               INTERVAL 1 DAY)) AS DATE) AS sale_date),
      grid AS (SELECT sale_date, 'S' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS shop_cd FROM axis, nation WHERE n_regionkey <> 0)
      SELECT CAST(sale_date AS VARCHAR) AS sale_date, shop_cd, coalesce(qty, 0) AS qty, coalesce(amount_jpy, 0) AS amount_jpy,
        coalesce(n_lines, 0) AS n_lines FROM grid FULL JOIN daily USING (sale_date, shop_cd)""")
query("sales_category_crosstab",
      lambda t: aggregate.pivot_sum(
          sales_plan.daily_by_category(sales_plan.target_rows(_fact(t))), ["shop_cd"], "category",
          ["ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD", "未分類"], "amount_jpy").withColumnRenamed("未分類", "unclassified"),
      f"WITH {feeds.SALES_SQL} SELECT shop_cd, " + ", ".join(
          f"CAST(sum(amount_incl) FILTER (category = '{c}') AS BIGINT) AS {a}" for c, a in (
              ("ECONOMY", "ECONOMY"), ("LARGE", "LARGE"), ("MEDIUM", "MEDIUM"), ("SMALL", "SMALL"), ("STANDARD", "STANDARD"),
              ("未分類", "unclassified"))) + " FROM target GROUP BY shop_cd")


def _published_sales(t):
    """All files as one period through the whole pipeline, twice; then what a reader sees."""
    root, masters = t.scratch, feeds.sales_masters(t)
    registry = _registry(t, "all")
    sales_plan.run_month(t.spark, "all", registry, masters, root)
    sales_plan.run_month(t.spark, "all", registry, masters, root)
    return t.spark.read.parquet(publish.layer_path(root, "gold", "daily_category")).groupBy("shop_cd", "category").agg(
        F.sum("qty").alias("qty"), F.sum("amount_jpy").alias("amount_jpy"), F.sum("n_lines").alias("n_lines"))


query("sales_published", _published_sales,
      f"WITH {feeds.SALES_SQL} SELECT shop_cd, category, {_DAILY} FROM target GROUP BY 1, 2")

# ---------------------------------------------------------------- roster


def _roster(t):
    return roster_plan.clean_roster(feeds.roster_feed(t), feeds.departments(t))


query("roster_clean",
      lambda t: _roster(t).select("code", "name", iso("hired_on").alias("hired_on"), "base_pay", "weekly_hours", "mail", "dept_cd",
                                  "dept_name", "division", "reject_reason"),
      f"""WITH {feeds.ROSTER_SQL} SELECT code, name, CAST(hired_on AS VARCHAR) AS hired_on, base_pay,
      CAST(weekly_hours AS BIGINT) AS weekly_hours, mail, dept_cd, dept_name, division, reject_reason FROM roster""")
query("roster_headcount", lambda t: roster_plan.headcount(_roster(t).filter(C("reject_reason").isNull())),
      f"""WITH {feeds.ROSTER_SQL} SELECT division, count(*) AS people, CAST(sum(base_pay) AS BIGINT) AS base_pay FROM roster
      WHERE reject_reason IS NULL GROUP BY division""")

# ---------------------------------------------------------------- access log
query("weblog_typed",
      lambda t: weblog.typed_requests(feeds.log_feed(t)).withColumn("ts", C("ts").cast("timestamp_ntz")),
      f"""WITH {feeds.LOG_SQL} SELECT ts, ts + INTERVAL 9 HOUR AS ts_jst, path, CAST(status AS BIGINT) AS status, sec AS dur_sec,
      n_bytes AS bytes, user_id FROM log""")
query("weblog_seconds", lambda t: feeds.log_feed(t).select("line", "dur", weblog.seconds(C("dur")).alias("dur_sec")),
      f"WITH {feeds.LOG_SQL} SELECT line, CAST(sec AS VARCHAR) || 's' AS dur, sec AS dur_sec FROM log")
query("weblog_server_errors",
      lambda t: feeds.log_feed(t).filter(parse.parse_integer(C("status")) >= 500).select("line", "status"),
      f"WITH {feeds.LOG_SQL} SELECT line, CAST(status AS VARCHAR) AS status FROM log WHERE status >= 500")
query("weblog_hour_utc",
      lambda t: feeds.log_feed(t).select("line", F.hour(parse.parse_instant(C("ts"))).alias("hour")),
      f"WITH {feeds.LOG_SQL} SELECT line, CAST(hour(ts) AS INTEGER) AS hour FROM log")
query("weblog_page_report",
      lambda t: weblog.page_report(feeds.log_feed(t)).withColumn("mean_sec", F.round("mean_sec", 9)),
      f"WITH {feeds.LOG_SQL} SELECT path, count(*) AS requests, round(avg(sec), 9) AS mean_sec FROM log GROUP BY path")


# ---------------------------------------------------------------- increments
def _hourly(df):
    return df.groupBy("day", "event_type").agg(n_rows(), F.sum(cents("value")).alias("cents"))


def _increment(t):
    marks, path = f"{t.scratch}/marks", f"{t.scratch}/daily"
    half = t.events.filter(C("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).filter(C("event_type") != "error")
    args = ("ts", timedelta(days=20), marks, "day", _hourly, path)
    incremental.run_increment(half, *args)
    incremental.run_increment(t.events, *args)
    incremental.run_increment(t.events, *args)
    return t.spark.read.parquet(path).select(iso("day").alias("day"), "event_type", "n", "cents")


_BY_DAY = f"SELECT {DAY('ts')} AS day, event_type, count(*) AS n, {SUM_CENTS('value')} AS cents FROM events GROUP BY 1, 2"
query("increment_with_lateness", _increment, _BY_DAY)


def _increment_undated(t):
    """Rows without an event time are published under the day NULL, and once."""
    marks, path = f"{t.scratch}/marks", f"{t.scratch}/daily"
    events = t.events.withColumn("ts", F.when(C("event_id") % 7 != 0, C("ts")))
    args = ("ts", timedelta(days=20), marks, "day", _hourly, path)
    incremental.run_increment(events.filter((C("event_id") % 2 == 0)), *args)
    incremental.run_increment(events, "ts", timedelta(days=400), *args[2:])
    return t.spark.read.parquet(path).select(iso("day").alias("day"), "event_type", "n", "cents")


query("increment_undated_rows", _increment_undated,
      f"""SELECT CASE WHEN event_id % 7 <> 0 THEN {DAY('ts')} END AS day, event_type, count(*) AS n, {SUM_CENTS('value')} AS cents
         FROM events GROUP BY 1, 2""")
query("rows_since_watermark",
      lambda t: incremental.rows_since(t.events, "ts", t.events.agg(F.max("ts").alias("m")).first().m, timedelta(days=3)).select("event_id"),
      "SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 3 DAY")


# ---------------------------------------------------------------- streams
def _event_stream(t):
    return streams.open_stream(t.spark, f"{t.folder}/events.parquet*", t.events.schema)


def _stream_days(t):
    path = f"{t.scratch}/daily"
    sink = streams.rebuild_touched_days(f"{t.scratch}/landed", path, "ts", "day", ["event_id"], _hourly)
    streams.run_available(_event_stream(t), f"{t.scratch}/progress", sink)
    return t.spark.read.parquet(path).select(iso("day").alias("day"), "event_type", "n", "cents")


query("stream_rebuild_days", _stream_days, _BY_DAY)


def _stream_latest(t):
    path = f"{t.scratch}/latest"
    rows = _event_stream(t).select("user_id", "event_id", "ts", "event_type", (C("user_id") % 8).alias("part"))
    streams.run_available(rows, f"{t.scratch}/progress", streams.keep_latest(path, ["user_id"], "ts", [asc("event_id")], "part"))
    return t.spark.read.parquet(path).select("user_id", "event_id", "event_type")


query("stream_latest_per_key", _stream_latest,
      "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1")


def _ended_stream(t, name, results):
    """What a stream over the events delivers until its feed ends: a last delivery, far behind all others, closes what is open."""
    inbox, path = f"{t.scratch}/{name}-in", f"{t.scratch}/{name}"
    end = gaps.end_of_feed(t.spark, t.events.schema, "event_type", "ts", "the end", datetime(2030, 1, 1))
    for delivery in (t.events, end):
        delivery.write.mode("append").parquet(inbox)
        stream = streams.with_event_time(streams.open_stream(t.spark, inbox, t.events.schema), "ts", "1 hour")
        streams.append_available(results(stream), f"{t.scratch}/{name}-progress", path)
    return t.spark.read.parquet(path)


def _stream_windows(t):
    counted = _ended_stream(t, "windows", lambda stream: streams.window_counts(stream, "ts", "1 hour", None, ["event_type"]))
    return counted.select(C("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


query("stream_hourly_windows", _stream_windows,
      "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")


def _stream_repeats(t):
    """The stream joined by a second delivery of itself, each event kept once."""
    path = f"{t.scratch}/once"
    twice = _event_stream(t).unionByName(_event_stream(t))
    once = streams.first_deliveries(streams.with_event_time(twice, "ts", "1 hour"), ["event_id"])
    streams.append_available(once, f"{t.scratch}/progress", path)
    return t.spark.read.parquet(path).groupBy("event_type").agg(n_rows(), F.countDistinct("event_id").alias("events"))


query("stream_drop_repeats", _stream_repeats,
      "SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS events FROM events GROUP BY event_type")


def _stream_sessions(t):
    found = _ended_stream(t, "sessions", lambda stream: streams.sessions(stream, "ts", "30 minutes", ["event_type"]))
    return found.select(C("session_start").cast("timestamp_ntz").alias("session_start"), "event_type", "n")


query("stream_sessions", _stream_sessions,
      """WITH g AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM events
                    WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
         s AS (SELECT *, sum(opens) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
         SELECT min(ts) AS session_start, event_type, count(*) AS n FROM s GROUP BY event_type, sid""")


def _whole(t, summarise):
    return streams.whole_at_the_end(_event_stream(t), f"{t.scratch}/progress", f"{t.scratch}/landed", "ts", summarise)


query("stream_hourly_windows_whole",
      lambda t: _whole(t, lambda df: streams.window_counts(df, "ts", "1 hour", None, ["event_type"]))
      .select(C("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n"),
      "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
query("stream_sessions_whole",
      lambda t: _whole(t, lambda df: streams.sessions(df, "ts", "30 minutes", ["event_type"]))
      .select(C("session_start").cast("timestamp_ntz").alias("session_start"), "event_type", "n"),
      """WITH g AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM events
                    WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
         s AS (SELECT *, sum(opens) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
         SELECT min(ts) AS session_start, event_type, count(*) AS n FROM s GROUP BY event_type, sid""")
query("sliding_windows",
      lambda t: streams.window_counts(t.events.withColumn("ts", C("ts").cast("timestamp")), "ts", "2 hours", "1 hour", ["event_type"])
      .select(C("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n"),
      """SELECT date_trunc('hour', ts) - INTERVAL 1 HOUR * k AS window_start, event_type, count(*) AS n FROM events,
         (SELECT unnest([0, 1]) AS k) GROUP BY 1, 2""")
