"""What happens from run to run: periods published one by one, recorded history, increments, findings.

As elsewhere, queries that publish something write below the shared scratch folder and return what a reader sees.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.operators import history, recorded
from sievework.plans import sales_periods
from sievework.sinks import findings
from sievework.sinks.periods import PeriodStore
from sievework.streaming import gaps, streams
from sievework.streaming.landing import Landing
from sievework.workload import feeds
from sievework.workload.catalog import cents, iso, n_rows, query

C = F.col
_DAILY = "CAST(sum(qty) AS BIGINT) AS qty, CAST(sum(amount_incl) AS BIGINT) AS amount_jpy, count(*) AS n_lines"


# ---------------------------------------------------------------- periods
def _years(t):
    """The years that occur, one row each on the driver."""
    return sorted(r[0] for r in t.lineitem.select(F.date_format("l_shipdate", "yyyy")).distinct().collect())


def _store(t):
    return PeriodStore(t.spark, t.scratch)


def _published_years(store):
    """What a reader sees, with the number of the entry each year points at."""
    now = store.pointers("daily_category").select("period", "seq")
    return (store.read("daily_category", sales_periods.DAILY_CATEGORY).groupBy("period", "shop_cd", "category").agg(
        F.sum("qty").alias("qty"), F.sum("amount_jpy").alias("amount_jpy"), F.sum("n_lines").alias("n_lines"))
        .join(now, "period").select("period", "shop_cd", "category", "qty", "amount_jpy", "n_lines", "seq"))


def _years_sql(seq):
    return (f"WITH {feeds.SALES_SQL} SELECT strftime(sale_date, '%Y') AS period, shop_cd, category, {_DAILY}, "
            f"CAST({seq} AS BIGINT) AS seq FROM target GROUP BY 1, 2, 3")


def _backfill(t):
    """All years, some without the lines that were sent later; then only those years again, whole, in one pass."""
    store, feed, masters = _store(t), feeds.yearly_sales(t), feeds.sales_masters(t)
    early = [y for y in _years(t) if y < "1998"]
    sales_periods.run_periods(feed.filter(~C("late")), masters, store, _years(t))
    sales_periods.run_periods(feed.filter(C("period") < "1998"), masters, store, early)
    return _published_years(store)


query("sales_backfill", _backfill, _years_sql("CASE WHEN strftime(sale_date, '%Y') < '1998' THEN 2 ELSE 1 END"))


def _new_month(t):
    """A new period joins the others, which keep their rows and their entry."""
    store, feed, masters = _store(t), feeds.yearly_sales(t), feeds.sales_masters(t)
    *old, new = _years(t)
    sales_periods.run_periods(feed.filter(C("period") < new), masters, store, old)
    sales_periods.run_periods(feed.filter(C("period") == new), masters, store, [new])
    return _published_years(store)


query("sales_new_month", _new_month, _years_sql("CASE WHEN strftime(sale_date, '%Y') = (SELECT max(strftime(l_shipdate, '%Y')) FROM lineitem) THEN 2 ELSE 1 END"))


def _any_order(t):
    """Later years first, earlier ones after them: the summaries per day and shop are those of one run."""
    store, feed, masters = _store(t), feeds.yearly_sales(t), feeds.sales_masters(t)
    sales_periods.run_periods(feed.filter(C("period") >= "1998"), masters, store, [y for y in _years(t) if y >= "1998"])
    sales_periods.run_periods(feed.filter(C("period") < "1998"), masters, store, [y for y in _years(t) if y < "1998"])
    return store.read("daily_shop", sales_periods.DAILY_SHOP).withColumn("sale_date", iso("sale_date"))


query("sales_months_any_order", _any_order,
      f"""WITH {feeds.SALES_SQL}, daily AS (SELECT strftime(sale_date, '%Y') AS period, sale_date, shop_cd, {_DAILY} FROM target GROUP BY 1, 2, 3),
      axis AS (SELECT period, CAST(unnest(generate_series(min(sale_date), max(sale_date), INTERVAL 1 DAY)) AS DATE) AS sale_date FROM daily GROUP BY period),
      grid AS (SELECT period, sale_date, 'S' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS shop_cd FROM axis, nation WHERE n_regionkey <> 0)
      SELECT period, CAST(sale_date AS VARCHAR) AS sale_date, shop_cd, CAST(coalesce(qty, 0) AS INTEGER) AS qty, coalesce(amount_jpy, 0) AS amount_jpy,
        CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines FROM grid FULL JOIN daily USING (period, sale_date, shop_cd)""")


def _stage_metrics(t):
    store = _store(t)
    sales_periods.run_periods(feeds.yearly_sales(t), feeds.sales_masters(t), store, _years(t))
    return sales_periods.published_metrics(store)


_STAGES = {"arrived": ("priced", "true"), "rejected": ("priced", "no_qty OR no_amount"), "fact": ("fact", "true"), "no_shop": ("fact", "false"),
           "no_item": ("fact", "false"), "test": ("fact", "is_test"), "closed": ("fact", "sale_date > close_date"),
           "target": ("fact", "NOT is_test AND NOT coalesce(sale_date > close_date, false)")}
query("stage_metrics", _stage_metrics,
      f"WITH {feeds.SALES_SQL}, daily AS (SELECT sale_date, shop_cd, category, sum(amount_incl) AS amount FROM target GROUP BY 1, 2, 3), "
      "axis AS (SELECT strftime(sale_date, '%Y') AS period, CAST(max(sale_date) - min(sale_date) + 1 AS BIGINT) * (SELECT count(*) FROM nation WHERE n_regionkey <> 0) AS n "
      "FROM daily GROUP BY 1), shops AS (SELECT DISTINCT sale_date, shop_cd FROM daily WHERE shop_cd IN (SELECT 'S' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') "
      "FROM nation WHERE n_regionkey = 0)) "
      + " UNION ALL ".join(
          f"SELECT strftime(sale_date, '%Y') AS period, '{s}' AS stage, count(*) FILTER ({c}) AS rows, coalesce(CAST(sum(amount_incl) FILTER ({c}) AS BIGINT), 0) AS amount, "
          f"CAST(1 AS BIGINT) AS seq FROM {table} GROUP BY 1" for s, (table, c) in _STAGES.items())
      + " UNION ALL SELECT strftime(sale_date, '%Y'), 'daily_category', count(*), CAST(sum(amount) AS BIGINT), CAST(1 AS BIGINT) FROM daily GROUP BY 1"
        " UNION ALL SELECT axis.period, 'daily_shop', any_value(axis.n) + (SELECT count(*) FROM shops WHERE strftime(sale_date, '%Y') = axis.period), "
        "CAST(sum(daily.amount) AS BIGINT), CAST(1 AS BIGINT) FROM axis JOIN daily ON strftime(daily.sale_date, '%Y') = axis.period GROUP BY axis.period")


# ---------------------------------------------------------------- late rows
def _too_late(t):
    """Three deliveries; the second brings a third of the events of the first weeks, far behind the allowance.  Then nothing new."""
    landing = Landing(t.spark, f"{t.scratch}/landing", t.events.schema, "ts", timedelta(days=1))
    path, inbox = f"{t.scratch}/daily", f"{t.scratch}/inbox"
    early, held = C("ts") < F.lit("2024-01-20").cast("timestamp_ntz"), C("event_id") % 3 == 0
    per_day = lambda df: df.groupBy("day", "event_type").agg(n_rows(), F.sum(cents("value")).alias("cents"))
    for delivery in (t.events.where(early & ~held), t.events.where(early & held), t.events.where(~early | C("ts").isNull()), None):
        if delivery is not None:
            delivery.write.mode("append").parquet(inbox)
        landing.land_new_files(inbox)
        landing.publish(per_day, path)
    late = landing.days().groupBy("day").agg(F.sum("too_late").alias("too_late"))
    return t.spark.read.parquet(path).join(late, "day").select(iso("day").alias("day"), "event_type", "n", "cents", "too_late")


_CENTS = "CAST(round_even(value * 100, 0) AS BIGINT)"
query("increment_too_late_rows", _too_late,
      f"""WITH high AS (SELECT CAST(max(ts) - INTERVAL 1 DAY AS DATE) AS d FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_id % 3 <> 0),
      late AS (SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_id % 3 = 0 AND ts < TIMESTAMP '2024-01-20' AND CAST(ts AS DATE) < (SELECT d FROM high)) AS too_late
               FROM events GROUP BY 1)
      SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, CAST(sum({_CENTS}) AS BIGINT) AS cents, CAST(any_value(too_late) AS BIGINT) AS too_late
      FROM events JOIN late ON late.day = CAST(ts AS DATE) GROUP BY 1, 2""")


# ---------------------------------------------------------------- keyed state
def _user_gaps(t):
    """Silences of over twelve hours per user.  The feed comes in three deliveries and ends; every run goes on from the state of the last."""
    inbox, path = f"{t.scratch}/inbox", f"{t.scratch}/gaps"
    day = lambda d: F.lit(f"2024-01-{d}").cast("timestamp_ntz")
    end = gaps.end_of_feed(t.spark, t.events.schema, "user_id", "ts", -1, datetime(2025, 1, 1))
    deliveries = (t.events.where(C("ts") < day(11)), t.events.where((C("ts") >= day(11)) & (C("ts") < day(21))), t.events.where(C("ts") >= day(21)), end)
    for delivery in deliveries:
        delivery.write.mode("append").parquet(inbox)
        with gaps.state_store(t.spark):
            stream = streams.open_stream(t.spark, inbox, t.events.schema)
            found = gaps.gaps(stream, "user_id", "ts", timedelta(hours=12), timedelta(hours=1), timedelta(days=40))
            streams.append_available(found, f"{t.scratch}/progress", path)
    return t.spark.read.parquet(path).select("user_id", C("last_seen").cast("timestamp_ntz").alias("last_seen"), C("seen_again").cast("timestamp_ntz").alias("seen_again"), "n")


query("stream_user_gaps", _user_gaps,
      """WITH e AS (SELECT user_id, ts, lead(ts) OVER w AS following, CASE WHEN ts - lag(ts) OVER w > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS opens FROM events
         WHERE ts IS NOT NULL AND user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
         s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS stretch FROM e)
         SELECT user_id, max(ts) AS last_seen, CASE WHEN bool_and(following IS NOT NULL) THEN arg_max(following, ts) END AS seen_again, count(*) AS n FROM s GROUP BY user_id, stretch""")


# ---------------------------------------------------------------- findings
_ORDER_CONTRACT = T.StructType([T.StructField("o_orderkey", T.LongType(), False), T.StructField("o_custkey", T.LongType(), False),
                                T.StructField("status", T.StringType(), False), T.StructField("cents", T.LongType()), T.StructField("clerk", T.StringType())])


def _faulty_orders(t):
    """Orders with an unknown status, missing customers, an unexpected column, and some rows twice; written as files in key order."""
    rows = t.orders.select("o_orderkey", F.when(C("o_custkey") % 97 != 0, C("o_custkey")).alias("o_custkey"),
                           F.when(C("o_custkey") % 13 == 0, "?").otherwise(C("o_orderstatus")).alias("status"), cents("o_totalprice").alias("cents"), C("o_orderpriority").alias("extra"))
    twice = rows.unionByName(rows.where("o_orderkey % 50 = 0"))
    path = f"{t.scratch}/orders"
    twice.repartitionByRange(5, "o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(path)
    return t.spark.read.parquet(path)


def _listed(df):
    """Examples as one text, so that they compare like any value."""
    return df.select("check", "failed", F.concat_ws(" | ", "examples").alias("examples"))


query("contract_findings",
      lambda t: _listed(findings.contract_findings(_faulty_orders(t), _ORDER_CONTRACT, ["o_orderkey"], {
          "unknown status": ~C("status").isin("F", "O", "P"), "cheap": C("cents") < 100_000_00}, ordered_by=["o_orderkey"])),
      f"""WITH r AS (SELECT o_orderkey AS k, CASE WHEN o_custkey % 97 <> 0 THEN o_custkey END AS c, o_custkey % 13 = 0 AS unknown,
        {_CENTS.replace('value', 'o_totalprice')} AS cents FROM orders),
      t AS (SELECT * FROM r UNION ALL SELECT * FROM r WHERE k % 50 = 0),
      f AS (SELECT 'o_orderkey is missing' AS "check", CAST(k AS VARCHAR) AS k FROM t WHERE k IS NULL UNION ALL SELECT 'o_custkey is missing', CAST(k AS VARCHAR) FROM t WHERE c IS NULL
        UNION ALL SELECT 'status is missing', CAST(k AS VARCHAR) FROM t WHERE false UNION ALL SELECT 'unknown status', CAST(k AS VARCHAR) FROM t WHERE unknown
        UNION ALL SELECT 'cheap', CAST(k AS VARCHAR) FROM t WHERE cents < 10000000
        UNION ALL SELECT 'unique key', CAST(k AS VARCHAR) FROM t GROUP BY k HAVING count(*) > 1),
      names("check") AS (VALUES ('o_orderkey is missing'), ('o_custkey is missing'), ('status is missing'), ('unknown status'), ('cheap'), ('unique key'))
      SELECT n."check", count(k) AS failed, coalesce(array_to_string(list(k ORDER BY k)[1:3], ' | '), '') AS examples FROM names n LEFT JOIN f ON f."check" = n."check" GROUP BY 1
      UNION ALL SELECT 'columns', 2, 'missing column clerk | unexpected column extra' UNION ALL SELECT 'types', 0, '' UNION ALL SELECT 'order', 0, ''""")


def _compared_orders(t):
    """Orders with some missing, some that nobody expects, and two columns with wrong values."""
    expected = t.orders.select("o_orderkey", C("o_orderstatus").alias("status"), cents("o_totalprice").alias("cents"), "o_orderpriority")
    actual = expected.where("o_orderkey % 11 <> 0").withColumns({
        "status": F.when(C("o_orderkey") % 7 == 0, "X").otherwise(C("status")), "cents": F.when(C("o_orderkey") % 5 != 0, C("cents"))})
    extra = expected.where("o_orderkey % 101 = 0").withColumn("o_orderkey", -C("o_orderkey") - 1)
    return findings.comparison_findings(actual.unionByName(extra), expected, ["o_orderkey"])


query("comparison_findings", lambda t: _listed(_compared_orders(t)),
      """WITH o AS (SELECT o_orderkey AS k FROM orders), a AS (SELECT k FROM o WHERE k % 11 <> 0),
      f AS (SELECT 'missing' AS "check", CAST(k AS VARCHAR) AS k FROM o WHERE k % 11 = 0 UNION ALL SELECT 'extra', CAST(-k - 1 AS VARCHAR) FROM o WHERE k % 101 = 0
        UNION ALL SELECT 'values of status', CAST(k AS VARCHAR) FROM a WHERE k % 7 = 0 UNION ALL SELECT 'values of cents', CAST(k AS VARCHAR) FROM a WHERE k % 5 = 0),
      names("check") AS (VALUES ('missing'), ('extra'), ('values of status'), ('values of cents'), ('values of o_orderpriority'), ('columns'), ('types'), ('unique key, actual'),
        ('unique key, expected'))
      SELECT n."check", count(k) AS failed, coalesce(array_to_string(list(k ORDER BY k)[1:3], ' | '), '') AS examples FROM names n LEFT JOIN f ON f."check" = n."check" GROUP BY 1""")


# ---------------------------------------------------------------- star schema
def _entries(t):
    """Changes of a customer's status and tier; some orders end the customer."""
    return t.orders.select("o_custkey", C("o_orderkey").alias("seq"), C("o_orderstatus").alias("status"), (C("o_orderpriority") < "3").alias("tier"),
                           (C("o_orderkey") % 17 == 0).alias("left"))


def _dimension(t):
    """The version table after three batches, of which the second is older than what is known and the third is the second again."""
    path, entries = f"{t.scratch}/customer", _entries(t)
    late = (C("seq") % 3 == 1)
    for batch in (entries.where(~late), entries.where(late), entries.where(late)):
        rewritten = history.merge_versions(batch, path, ["o_custkey"], "seq", ["status", "tier"], 16, "left")
    return t.spark.read.parquet(history.versions_path(path)), rewritten


def _merged_dimension(t):
    table, rewritten = _dimension(t)
    return table.select("o_custkey", "status", "tier", "valid_from", "valid_to", "is_current", F.lit(rewritten).alias("rewritten_last"))


_VERSIONS_SQL = """marked AS (SELECT o_custkey, o_orderkey AS seq, o_orderstatus AS status, o_orderpriority < '3' AS tier, o_orderkey % 17 = 0 AS gone,
        CASE WHEN o_orderkey % 17 = 0 THEN 'end' ELSE o_orderstatus || (o_orderpriority < '3') END AS state FROM orders),
      lagged AS (SELECT *, lag(state) OVER (PARTITION BY o_custkey ORDER BY seq) AS before FROM marked),
      changed AS (SELECT *, lead(seq) OVER (PARTITION BY o_custkey ORDER BY seq) AS valid_to FROM lagged WHERE before IS DISTINCT FROM state),
      versions AS (SELECT o_custkey, status, tier, seq AS valid_from, valid_to, valid_to IS NULL AS is_current FROM changed WHERE NOT gone)"""
query("dimension_merge", _merged_dimension,
      f"WITH {_VERSIONS_SQL} SELECT o_custkey, status, tier, valid_from, valid_to, is_current, 0 AS rewritten_last FROM versions")


def _facts_with_versions(t):
    """Every order with its customer as known half a step later, by the surrogate key of the version."""
    versions = _dimension(t)[0].select("o_custkey", "status", "tier", "valid_from", "valid_to")
    facts = t.orders.select("o_orderkey", "o_custkey", (C("o_orderkey") - C("o_orderkey") % 5).alias("at"))
    return history.with_versions(facts, versions, ["o_custkey"], "at").select("o_orderkey", "status", "tier", "valid_from", "valid_to")


query("fact_with_versions", _facts_with_versions,
      f"""WITH {_VERSIONS_SQL} SELECT o.o_orderkey, v.status, v.tier, v.valid_from, v.valid_to FROM orders o LEFT JOIN versions v
      ON v.o_custkey = o.o_custkey AND v.valid_from <= o.o_orderkey - o.o_orderkey % 5 AND (v.valid_to IS NULL OR v.valid_to > o.o_orderkey - o.o_orderkey % 5)""")


# ---------------------------------------------------------------- recorded history
def _drift(t):
    """Profiles of daily sales per shipping mode of line items, recorded year by year (one year twice); the last year against the others."""
    path = f"{t.scratch}/profiles"
    flag = F.when(C("l_linestatus") == "F", "done").when(C("l_shipdate") < F.lit("1999-06-01").cast("timestamp_ntz"), "open")
    daily = t.lineitem.groupBy(F.year("l_shipdate").alias("year"), C("l_shipdate").cast("date").alias("day"), flag.alias("mode")).agg(
        F.sum(cents("l_extendedprice")).alias("cents"), F.max(F.when(C("l_discount") > 0.09, C("l_quantity"))).alias("most"))
    daily.write.parquet(f"{t.scratch}/daily")
    daily = t.spark.read.parquet(f"{t.scratch}/daily")
    years = [int(y) for y in _years(t)]
    for year in (*years[:-1], years[0], years[-1]):
        changed = daily.where(C("year") == year).withColumn("cents", F.when(C("mode") == "done", C("cents") * (9 if year == years[-1] else 1)).otherwise(C("cents")))
        recorded.record_profile(recorded.profile_of(changed, year, "mode", ["cents", "most"]), path)
    return recorded.drift_report(t.spark, path, years[-1])


_Q = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
query("profile_drift", _drift,
      f"""WITH daily AS (SELECT year(l_shipdate) AS y, CAST(l_shipdate AS DATE) AS day,
        CASE WHEN l_linestatus = 'F' THEN 'done' WHEN l_shipdate < TIMESTAMP '1999-06-01' THEN 'open' END AS part,
        CAST(sum(CAST(round_even(l_extendedprice * 100, 0) AS BIGINT)) AS DOUBLE) AS cents, max(l_quantity) FILTER (l_discount > 0.09) AS most FROM lineitem GROUP BY 1, 2, 3),
      last AS (SELECT max(y) AS y FROM daily),
      long AS (SELECT y, part, 'cents' AS measure, CASE WHEN part = 'done' AND y = (SELECT y FROM last) THEN cents * 9 ELSE cents END AS v FROM daily
        UNION ALL SELECT y, part, 'most', most FROM daily),
      now AS (SELECT part, measure, count(v) AS n, count(*) FILTER (v IS NULL) AS missing, sum(v) AS total, quantile_disc(v, 0.5) AS median FROM long
        WHERE y = (SELECT y FROM last) GROUP BY 1, 2),
      before AS (SELECT part, measure, count(DISTINCT y) AS runs, count(v) AS n_before, count(*) FILTER (v IS NULL) AS missing_before, sum(v) AS total_before,
        {", ".join(f"quantile_disc(v, {f}) AS {n}" for n, f in _Q.items())} FROM long WHERE y < (SELECT y FROM last) GROUP BY 1, 2)
      SELECT coalesce(a.part, b.part) AS part, coalesce(a.measure, b.measure) AS measure, runs, n, n_before, missing, missing_before, total, total_before, median, q25, q50, q75,
        CASE WHEN b.measure IS NULL THEN 'new' WHEN a.measure IS NULL THEN 'gone'
          WHEN median < q25 - (q75 - q25) * CAST(1.5 AS DOUBLE) OR median > q75 + (q75 - q25) * CAST(1.5 AS DOUBLE) THEN 'median'
          WHEN missing / (n + missing) > 2 * (missing_before / (n_before + missing_before)) AND missing / (n + missing) > missing_before / (n_before + missing_before) + 0.01 THEN 'missing' END AS verdict
      FROM now a FULL JOIN before b ON a.part IS NOT DISTINCT FROM b.part AND a.measure = b.measure""")
