"""Projection, conditions, predicates, missing values, text, numbers, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import logic, parse, text
from sievework.operators.sliced import fill_backward, fill_forward
from sievework.workload import feeds
from sievework.workload.catalog import cents, iso, query

C = F.col

# ---------------------------------------------------------------- projection
query("project_reorder", lambda t: t.customer.select("c_name", "c_custkey"),
      "SELECT c_name, c_custkey FROM customer")
query("project_rename",
      lambda t: feeds.log_feed(t).withColumnsRenamed({"ts": "requested_at", "dur": "duration"})
      .select("requested_at", "duration", "path"),
      f"""WITH {feeds.LOG_SQL}
      SELECT CASE WHEN event_type IN ('view', 'click') THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
                  ELSE strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+09:00' END AS requested_at,
             CAST(sec AS VARCHAR) || 's' AS duration, path FROM log""")
query("project_add_column",
      lambda t: t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                                  (C("l_quantity") * C("l_tax")).alias("weighted_tax")),
      "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * l_tax AS weighted_tax FROM lineitem")
query("project_drop_column", lambda t: t.supplier.drop("s_acctbal"),
      "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
query("project_constants",
      lambda t: t.supplier.select("s_suppkey", F.lit("税込").alias("tax_type"), F.lit("old").alias("source")),
      "SELECT s_suppkey, '税込' AS tax_type, 'old' AS source FROM supplier")
query("condition_two_way",
      lambda t: t.customer.select(
          "c_custkey", F.when(C("c_acctbal") > 0, "plus").otherwise("minus").alias("sign"),
          logic.keep_where(C("c_acctbal"), C("c_acctbal") >= 0, F.lit(0.0)).alias("kept"),
          logic.mask_where(C("c_acctbal"), C("c_acctbal") >= 0, F.lit(0.0)).alias("masked")),
      """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'plus' ELSE 'minus' END AS sign,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE 0.0 END AS kept,
         CASE WHEN c_acctbal >= 0 THEN 0.0 ELSE c_acctbal END AS masked FROM customer""")
query("condition_with_unknown",
      lambda t: feeds.log_feed(t).select(
          "line", logic.graded(parse.parse_integer(C("status")), 300, "high", "low", "unknown").alias("grade")),
      f"""WITH {feeds.LOG_SQL}
      SELECT line, CASE WHEN status IS NULL THEN 'unknown' WHEN status > 300 THEN 'high' ELSE 'low' END AS grade
      FROM log""")
query("condition_bands",
      lambda t: t.part.select("p_partkey", logic.bands(C("p_size"), [0, 10, 30, 50], ["small", "medium", "large"])
                              .alias("band")),
      """SELECT p_partkey, CASE WHEN p_size > 0 AND p_size <= 10 THEN 'small' WHEN p_size > 10 AND p_size <= 30
         THEN 'medium' WHEN p_size > 30 AND p_size <= 50 THEN 'large' END AS band FROM part""")
query("condition_update_in_place",
      lambda t: t.orders.select("o_orderkey", F.when(C("o_orderstatus") == "P", F.lit("4-NOT SPECIFIED"))
                                .otherwise(C("o_orderpriority")).alias("o_orderpriority")),
      """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END
         AS o_orderpriority FROM orders""")
query("compute_row_wise",
      lambda t: t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber",
                                  F.greatest("l_discount", "l_tax").alias("higher_rate")),
      "SELECT l_orderkey, l_partkey, l_linenumber, greatest(l_discount, l_tax) AS higher_rate FROM lineitem")
query("compute_column_wise",
      lambda t: t.lineitem.agg(*[F.max(c).alias(f"max_{c}") for c in ("l_quantity", "l_discount", "l_tax")]),
      """SELECT max(l_quantity) AS max_l_quantity, max(l_discount) AS max_l_discount, max(l_tax) AS max_l_tax
         FROM lineitem""")
query("chain_filter_group_sort",
      lambda t: t.orders.filter("o_totalprice > 100000").groupBy("o_orderpriority")
      .agg(F.sum(cents("o_totalprice")).alias("total_cents"), F.count(F.lit(1)).alias("n"))
      .orderBy(C("total_cents").desc()),
      """SELECT o_orderpriority, CAST(sum(CAST(round_even(o_totalprice * 100, 0) AS BIGINT)) AS BIGINT) AS total_cents,
         count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority""")

# ---------------------------------------------------------------- filters
query("filter_comparison", lambda t: t.orders.filter(C("o_totalprice") >= 400000).select("o_orderkey", "o_totalprice"),
      "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 400000")
query("filter_boolean",
      lambda t: t.lineitem.filter((C("l_quantity") > 40) & (C("l_discount") < 0.03) | ~(C("l_returnflag") != "R"))
      .select("l_orderkey", "l_linenumber", "l_partkey"),
      """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
         WHERE (l_quantity > 40 AND l_discount < 0.03) OR NOT (l_returnflag <> 'R')""")
query("filter_membership", lambda t: t.events.filter(C("event_type").isin("click", "purchase"))
      .select("event_id", "event_type"),
      "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
query("filter_between", lambda t: t.part.filter(C("p_size").between(10, 20)).select("p_partkey", "p_size"),
      "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20")
query("filter_string_expression",
      lambda t: t.lineitem.filter("l_quantity >= 30 and l_discount > 0.05").select("l_orderkey", "l_partkey", "l_quantity"),
      "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity >= 30 AND l_discount > 0.05")
query("filter_contains",
      lambda t: t.documents.filter(text.contains_text(C("text"), "the ")).select("doc_id", "lang"),
      "SELECT doc_id, lang FROM documents WHERE coalesce(contains(text, 'the '), false)")
query("filter_prefix", lambda t: feeds.log_feed(t).filter(C("path").startswith("/api")).select("line", "path"),
      f"WITH {feeds.LOG_SQL} SELECT line, path FROM log WHERE path LIKE '/api%'")
query("filter_null", lambda t: feeds.log_feed(t).filter(C("user_id").isNull()).select("line"),
      f"WITH {feeds.LOG_SQL} SELECT line FROM log WHERE user_id IS NULL")
query("filter_any_null",
      lambda t: feeds.log_feed(t).withColumn("code", parse.parse_integer(C("status")))
      .filter(logic.any_null(["user_id", "code"])).select("line"),
      f"WITH {feeds.LOG_SQL} SELECT line FROM log WHERE user_id IS NULL OR status IS NULL")
query("filter_drop_missing", lambda t: feeds.log_feed(t).na.drop(subset=["user_id"]).select("line", "user_id", "status"),
      f"""WITH {feeds.LOG_SQL} SELECT line, user_id, coalesce(CAST(status AS VARCHAR), '-') AS status
      FROM log WHERE user_id IS NOT NULL""")
query("filter_or_missing",
      lambda t: feeds.log_feed(t).withColumn("code", parse.parse_integer(C("status")))
      .filter(logic.or_missing(C("code") <= 300, C("code"))).select("line"),
      f"WITH {feeds.LOG_SQL} SELECT line FROM log WHERE status <= 300 OR status IS NULL")
query("filter_three_way",
      lambda t: feeds.log_feed(t).groupBy(logic.truth_of(parse.parse_integer(C("status")) > 300).alias("outcome"))
      .agg(F.count(F.lit(1)).alias("n")),
      f"""WITH {feeds.LOG_SQL} SELECT CASE WHEN status IS NULL THEN 'unknown' WHEN status > 300 THEN 'true'
      ELSE 'false' END AS outcome, count(*) AS n FROM log GROUP BY 1""")
query("rows_head_in_order",
      lambda t: t.orders.orderBy(C("o_orderdate"), C("o_orderkey")).limit(100).select("o_orderkey"),
      "SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
query("rows_deterministic_sample",
      lambda t: t.customer.filter(F.left(text.pseudonym(C("c_custkey"), "s1"), F.lit(1)) < "4").select("c_custkey"),
      "SELECT c_custkey FROM customer WHERE left(sha256('s1' || CAST(c_custkey AS VARCHAR)), 1) < '4'")

# ---------------------------------------------------------------- missing values
query("missing_tokens",
      lambda t: text.normalise_columns(feeds.order_feed(t), ["customer_name", "quantity", "ingested_at"],
                                       text.ORDER_MISSING).select("order_id", "customer_name", "quantity", "ingested_at"),
      f"""SELECT {feeds.ORDER_ID_SQL} AS order_id, {feeds.CUSTOMER_NAME_SQL} AS customer_name,
             CASE WHEN o_custkey % 10 <> 9 THEN CAST(o_custkey % 10 AS VARCHAR) END AS quantity,
             strftime(CAST(o_orderdate AS DATE) + 1, '%Y-%m-%dT%H:%M:%S') AS ingested_at FROM orders
      UNION ALL
      SELECT {feeds.ORDER_ID_SQL}, {feeds.CUSTOMER_NAME_SQL},
             CASE WHEN o_custkey % 10 <> 9 AND o_orderpriority <> '5-LOW' THEN CAST(o_custkey % 10 AS VARCHAR) END,
             strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%dT%H:%M:%S') FROM orders WHERE o_orderstatus = 'P'""")
query("missing_fill_placeholder", lambda t: feeds.log_feed(t).na.fill("anonymous", ["user_id"]).select("line", "user_id"),
      f"WITH {feeds.LOG_SQL} SELECT line, coalesce(user_id, 'anonymous') AS user_id FROM log")
query("missing_coalesce_attempts",
      lambda t: feeds.log_feed(t).select("line", F.coalesce(parse.parse_integer(C("status")),
                                                            parse.parse_integer(C("user_id")), F.lit(-1).cast("bigint"))
                                         .alias("code")),
      f"""WITH {feeds.LOG_SQL} SELECT line,
      coalesce(CAST(status AS BIGINT), CAST(user_id AS BIGINT), -1) AS code FROM log""")


def _gappy(t):
    return t.events.select("event_id", "event_type", "ts",
                           F.when(C("user_id") % 3 == 0, C("user_id")).alias("seen"))


query("missing_fill_forward",
      lambda t: fill_forward(_gappy(t), ["event_type"], ["ts", "event_id"], ["seen"]).select("event_id", "seen"),
      """SELECT event_id, last_value(CASE WHEN user_id % 3 = 0 THEN user_id END IGNORE NULLS) OVER
         (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen
         FROM events""")
query("missing_fill_backward",
      lambda t: fill_backward(_gappy(t), ["event_type"], ["ts", "event_id"], ["seen"]).select("event_id", "seen"),
      """SELECT event_id, first_value(CASE WHEN user_id % 3 = 0 THEN user_id END IGNORE NULLS) OVER
         (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS seen
         FROM events""")

# ---------------------------------------------------------------- text
query("text_nfkc",
      lambda t: t.customer.select("c_custkey", text.nfkc_strip(F.concat(F.lit("　"), feeds.widen(C("c_name")), F.lit(" ")))
                                  .alias("name")),
      "SELECT c_custkey, c_name AS name FROM customer")
query("text_nfkc_composed",
      lambda t: t.customer.select("c_custkey", text.nfkc_strip(F.concat(F.lit("㈱①ﾊﾞ "), C("c_name"))).alias("name")),
      "SELECT c_custkey, '(株)1バ ' || c_name AS name FROM customer")
query("text_documents_normalised",
      lambda t: t.documents.select("doc_id", text.nfkc_strip(C("text")).alias("text")),
      # The driver's prose is in composed form already; SQL has no NFKC, so this holds only for such text.
      """SELECT doc_id, trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30)
         || chr(31) || ' ' || chr(133)) AS text FROM documents""")
query("text_zero_pad",
      lambda t: t.customer.select("c_custkey", text.zero_pad(C("c_custkey").cast("string"), 3).alias("code"),
                                  text.zero_pad((-C("c_custkey")).cast("string"), 6).alias("signed_code")),
      """SELECT c_custkey, CASE WHEN c_custkey < 1000 THEN printf('%03d', c_custkey) ELSE CAST(c_custkey AS VARCHAR) END
         AS code, CASE WHEN c_custkey = 0 THEN '000000' WHEN c_custkey < 100000 THEN '-' || printf('%05d', c_custkey)
         ELSE CAST(-c_custkey AS VARCHAR) END AS signed_code FROM customer""")
query("text_replace",
      lambda t: t.customer.select("c_custkey", F.replace("c_name", F.lit("#"), F.lit("-")).alias("literal"),
                                  F.regexp_replace("c_name", "#0*", " ").alias("pattern")),
      """SELECT c_custkey, replace(c_name, '#', '-') AS literal, regexp_replace(c_name, '#0*', ' ') AS pattern
         FROM customer""")
query("text_affixes",
      lambda t: t.supplier.select("s_suppkey", text.remove_suffix(C("s_name"), "0").alias("no_suffix"),
                                  text.remove_prefix(C("s_name"), "Supplier#").alias("no_prefix"),
                                  F.rtrim(C("s_name"), F.lit("0")).alias("right_trimmed"),
                                  F.ltrim(F.right("s_name", F.lit(9)), F.lit("0")).alias("left_trimmed")),
      """SELECT s_suppkey, CASE WHEN s_name LIKE '%0' THEN left(s_name, length(s_name) - 1) ELSE s_name END AS no_suffix,
         replace(s_name, 'Supplier#', '') AS no_prefix, rtrim(s_name, '0') AS right_trimmed,
         ltrim(right(s_name, 9), '0') AS left_trimmed FROM supplier""")
query("text_slices",
      lambda t: t.part.select("p_partkey", F.left("p_name", F.lit(3)).alias("first3"),
                              F.expr("left(p_name, char_length(p_name) - 1)").alias("all_but_last"),
                              F.char_length("p_name").alias("chars")),
      """SELECT p_partkey, left(p_name, 3) AS first3, left(p_name, length(p_name) - 1) AS all_but_last,
         CAST(length(p_name) AS INTEGER) AS chars FROM part""")
query("text_case", lambda t: t.nation.select("n_nationkey", F.lower("n_name").alias("low"), F.upper(F.lower("n_name")).alias("up")),
      "SELECT n_nationkey, lower(n_name) AS low, upper(lower(n_name)) AS up FROM nation")
query("text_split_columns",
      lambda t: t.orders.select("o_orderkey", text.split_part(C("o_orderpriority"), "-", 0).alias("rank"),
                                text.split_part(C("o_orderpriority"), "-", 1).alias("label"),
                                text.split_part(C("o_orderpriority"), "-", 2).alias("rest")),
      """SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS rank, split_part(o_orderpriority, '-', 2) AS label,
         CAST(NULL AS VARCHAR) AS rest FROM orders""")
query("text_extract",
      lambda t: t.events.select("event_id", text.extract_first(C("props"), "([0-9]+)").alias("digits"),
                                text.extract_first(C("event_type"), "([0-9]+)").alias("none")),
      """SELECT event_id, nullif(regexp_extract(props, '([0-9]+)', 1), '') AS digits, CAST(NULL AS VARCHAR) AS none
         FROM events""")
query("text_concat",
      lambda t: feeds.log_feed(t).select("line", F.concat("path", F.lit("/"), "user_id").alias("visit")),
      f"WITH {feeds.LOG_SQL} SELECT line, path || '/' || user_id AS visit FROM log")
query("map_values_keep",
      lambda t: t.orders.select("o_orderkey", text.map_values(C("o_orderstatus"), {"F": "completed", "O": "pending"})
                                .alias("status")),
      """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE o_orderstatus END
         AS status FROM orders""")
query("map_values_null",
      lambda t: t.orders.select("o_orderkey", text.map_values(C("o_orderstatus"), {"F": True, "O": False}, "null")
                                .alias("done")),
      "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS done FROM orders")
query("element_function",
      lambda t: feeds.log_feed(t).select("line", F.concat(F.lit("user "), F.lpad("user_id", 4, "0")).alias("label")),
      f"WITH {feeds.LOG_SQL} SELECT line, 'user ' || lpad(user_id, 4, '0') AS label FROM log")

# ---------------------------------------------------------------- numbers
query("parse_amounts",
      lambda t: text.normalise_columns(feeds.order_feed(t), ["amount"], text.ORDER_MISSING)
      .select("order_id", "ingested_at", parse.parse_amount(C("amount"), on_error="raise").alias("amount")),
      f"""SELECT {feeds.ORDER_ID_SQL} AS order_id, strftime(CAST(o_orderdate AS DATE) + 1, '%Y-%m-%dT%H:%M:%S') AS ingested_at,
             CAST(floor(o_totalprice) AS BIGINT) AS amount FROM orders UNION ALL
      SELECT {feeds.ORDER_ID_SQL}, strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%dT%H:%M:%S'),
             CAST(floor(o_totalprice) AS BIGINT) + 100 FROM orders WHERE o_orderstatus = 'P'""")
query("parse_quantities",
      lambda t: text.normalise_columns(feeds.order_feed(t), ["quantity"], text.ORDER_MISSING)
      .groupBy(parse.parse_amount(C("quantity"), marks="", on_error="raise").cast("int").alias("quantity"))
      .agg(F.count(F.lit(1)).alias("n")),
      """SELECT quantity, count(*) AS n FROM (
           SELECT CASE WHEN o_custkey % 10 <> 9 THEN CAST(o_custkey % 10 AS INTEGER) END AS quantity FROM orders
           UNION ALL SELECT CASE WHEN o_custkey % 10 <> 9 AND o_orderpriority <> '5-LOW'
             THEN CAST(o_custkey % 10 AS INTEGER) END FROM orders WHERE o_orderstatus = 'P') GROUP BY quantity""")
query("parse_number_lenient",
      lambda t: feeds.log_feed(t).select("line", parse.parse_integer(C("status")).alias("status")),
      f"WITH {feeds.LOG_SQL} SELECT line, CAST(status AS BIGINT) AS status FROM log")
query("parse_number_strict",
      lambda t: feeds.log_feed(t).select("line", F.replace("bytes", F.lit(","), F.lit("")).cast("bigint").alias("bytes")),
      f"WITH {feeds.LOG_SQL} SELECT line, n_bytes AS bytes FROM log")
query("parse_sql_try_cast",
      lambda t: feeds.log_feed(t).select("line", F.expr("try_cast(status AS int)").alias("status")),
      f"WITH {feeds.LOG_SQL} SELECT line, CAST(status AS INTEGER) AS status FROM log")
query("parse_accounting_negative",
      lambda t: t.customer.select("c_custkey", parse.parse_accounting(
          F.when(C("c_acctbal") < 0, F.concat(F.lit("("), F.format_number(F.floor(F.abs("c_acctbal")), 0), F.lit(")")))
          .otherwise(F.format_number(F.floor("c_acctbal"), 0)), on_error="raise").alias("balance")),
      """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN -CAST(floor(abs(c_acctbal)) AS BIGINT)
         ELSE CAST(floor(c_acctbal) AS BIGINT) END AS balance FROM customer""")
query("parse_flags",
      lambda t: t.orders.select("o_orderkey", parse.parse_flag(
          F.element_at(F.create_map(*[F.lit(x) for x in ("F", "有", "O", "N", "P", "?")]), C("o_orderstatus"))).alias("flag")),
      "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS flag FROM orders")
query("sentinel_missing",
      lambda t: t.part.select("p_partkey", text.missing_to_null(C("p_size").cast("string"), ["50"]).cast("int").alias("size")),
      "SELECT p_partkey, nullif(p_size, 50) AS size FROM part")
query("tax_included",
      lambda t: t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                                  parse.tax_included(F.floor("l_extendedprice").cast("bigint"), 1.1).alias("incl")),
      """SELECT l_orderkey, l_linenumber, l_partkey,
         CAST(round_even(CAST(floor(l_extendedprice) AS BIGINT) * CAST(1.1 AS DOUBLE), 0) AS BIGINT) AS incl FROM lineitem""")
query("arithmetic_shares",
      lambda t: t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                                  F.try_divide(C("l_extendedprice"), C("l_quantity")).alias("unit_price"),
                                  F.try_divide(C("l_extendedprice"), C("l_discount")).alias("per_discount")),
      """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / nullif(l_quantity, 0) AS unit_price,
         l_extendedprice / nullif(l_discount, 0) AS per_discount FROM lineitem""")
query("round_half_even",
      lambda t: t.lineitem.groupBy("l_returnflag").agg(
          F.bround(F.count_if(C("l_linestatus") == "F") * 100.0 / F.count(F.lit(1)), 1).alias("percent")),
      """SELECT l_returnflag, round_even(count(*) FILTER (l_linestatus = 'F') * CAST(100 AS DOUBLE) / count(*), 1) AS percent
         FROM lineitem GROUP BY l_returnflag""")

# ---------------------------------------------------------------- dates
query("parse_dates_lenient",
      lambda t: text.normalise_columns(feeds.sales_feed(t), ["sale_date"], text.SALES_MISSING)
      .groupBy(parse.parse_date(C("sale_date")).alias("day")).agg(F.count(F.lit(1)).alias("n"))
      .select(iso("day").alias("day"), "n"),
      "SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, count(*) AS n FROM lineitem GROUP BY 1")
query("parse_dates_strict",
      lambda t: feeds.order_feed(t).select("order_id", "ingested_at",
                                           iso(parse.parse_date(C("order_date"), on_error="raise")).alias("day")),
      f"""SELECT {feeds.ORDER_ID_SQL} AS order_id, strftime(CAST(o_orderdate AS DATE) + 1, '%Y-%m-%dT%H:%M:%S') AS ingested_at,
             CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders UNION ALL
      SELECT {feeds.ORDER_ID_SQL}, strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%dT%H:%M:%S'),
             CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders WHERE o_orderstatus = 'P'""")
query("parse_other_date_spellings",
      lambda t: t.orders.select(
          "o_orderkey",
          iso(parse.parse_short_date(F.date_format("o_orderdate", "MM/dd/yy"))).alias("short_date"),
          iso(parse.excel_serial_date((F.unix_date(C("o_orderdate").cast("date")) + 25569).cast("string"))).alias("serial_date")),
      """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + CASE WHEN year(o_orderdate) < 2000 THEN
         INTERVAL 100 YEAR ELSE INTERVAL 0 YEAR END AS DATE)::VARCHAR AS short_date,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS serial_date FROM orders""")
query("parse_timestamps_mixed_zone",
      lambda t: feeds.log_feed(t).select("line", parse.parse_instant(C("ts"), "raise").cast("timestamp_ntz").alias("utc")),
      f"WITH {feeds.LOG_SQL} SELECT line, ts AS utc FROM log")
query("parse_timestamps_format",
      lambda t: t.events.select("event_id", F.try_to_timestamp(F.date_format("ts", "yyyy/MM/dd HH:mm:ss"), F.lit("yyyy/MM/dd HH:mm:ss"))
                                .cast("timestamp_ntz").alias("second"),
                                F.try_to_timestamp(C("event_type"), F.lit("yyyy/MM/dd HH:mm:ss")).cast("timestamp_ntz").alias("none")),
      "SELECT event_id, date_trunc('second', ts) AS second, CAST(NULL AS TIMESTAMP) AS none FROM events")
query("zone_convert",
      lambda t: feeds.log_feed(t).select("line", parse.wall_clock(parse.parse_instant(C("ts")), "Asia/Tokyo").alias("ts_jst")),
      f"WITH {feeds.LOG_SQL} SELECT line, ts + INTERVAL 9 HOUR AS ts_jst FROM log")
query("zone_attach",
      lambda t: t.events.select("event_id", parse.instant_of(C("ts"), "Asia/Tokyo").cast("timestamp_ntz").alias("utc")),
      "SELECT event_id, ts - INTERVAL 9 HOUR AS utc FROM events")
query("date_parts",
      lambda t: t.events.select("event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.day("ts").alias("d"),
                                F.hour("ts").alias("h"), F.weekday("ts").alias("wd"), F.date_format("ts", "EEEE").alias("name")),
      """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(day(ts) AS INTEGER) AS d,
         CAST(hour(ts) AS INTEGER) AS h, CAST(isodow(ts) - 1 AS INTEGER) AS wd, dayname(ts) AS name FROM events""")
query("date_truncate",
      lambda t: t.events.select("event_id", iso(F.to_date("ts")).alias("day"),
                                F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
                                iso(F.trunc("ts", "month")).alias("month_start"), F.date_format("ts", "yyyy-MM").alias("period")),
      """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, date_trunc('hour', ts) AS hour,
         CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS month_start, strftime(ts, '%Y-%m') AS period FROM events""")
query("time_difference",
      lambda t: t.events.select("event_id", parse.seconds_between(F.lit("2024-01-01").cast("timestamp_ntz"), C("ts")).alias("secs")),
      "SELECT event_id, CAST(date_diff('microsecond', TIMESTAMP '2024-01-01', ts) AS DOUBLE) / 1e6 AS secs FROM events")
query("date_range_of_column",
      lambda t: t.orders.agg(iso(F.min("o_orderdate").cast("date")).alias("first"), iso(F.max("o_orderdate").cast("date")).alias("last")),
      """SELECT CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last
         FROM orders""")
