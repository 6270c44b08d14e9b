"""Sales of any number of periods in one pass, published period by period.

A backfill of years is the same job as one new month: the period is a column, every stage handles all periods of the run at
once, and checks are made and published per period.  Nothing loops over periods.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.operators.aggregate import zero_fill_within
from sievework.plans import sales
from sievework.session import through_storage
from sievework.sinks.contract import ContractError, enforce_contract
from sievework.sinks.periods import PERIOD, PeriodStore
from sievework.sources.registry import SourceSpec, sources_for, union_by_name

TABLES = (("silver", "rejected"), ("silver", "fact"), ("gold", "daily_category"), ("gold", "daily_shop"))
DAILY_CATEGORY = T.StructType([*sales.DAILY_CATEGORY.fields, T.StructField(PERIOD, T.StringType())])
DAILY_SHOP = T.StructType([*sales.DAILY_SHOP.fields, T.StructField(PERIOD, T.StringType())])
METRICS = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("period", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("amount", T.LongType()),
])


def deliveries(spark: SparkSession, registry: Iterable[SourceSpec], periods: Iterable[str]) -> DataFrame:
    """The registered files of the periods in one table, each row with the period of its file."""
    registry = list(registry)
    found = [(p, s) for p in sorted(set(periods)) for s in sources_for(registry, p)]
    return union_by_name([s.read(spark).select(*sales.RAW_COLUMNS, F.lit(p).alias(PERIOD)) for p, s in found])


def _per_period(df: DataFrame, stages: dict) -> DataFrame:
    """(period, stage, rows, amount) for conditions on the rows of ``df``; one scan."""
    measures = []
    for name, condition in stages.items():
        measures += [F.count_if(condition).alias(f"{name}_rows"), F.sum(F.when(condition, F.col("_amount"))).alias(f"{name}_amount")]
    told = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(f"{s}_rows").alias("rows"), F.coalesce(f"{s}_amount", F.lit(0)).cast("long").alias("amount")) for s in stages])
    return df.groupBy(PERIOD).agg(*measures).select(PERIOD, F.inline(told))


def stage_metrics(classified: DataFrame, fact: DataFrame, by_category: DataFrame, by_shop: DataFrame) -> DataFrame:
    """(period, stage, rows, amount): what arrived, was rejected, joined, excluded and summarised in every period."""
    usable = F.col("reject_reason").isNull()
    return (_per_period(classified.withColumn("_amount", F.col("amount_incl")), {"arrived": F.lit(True), "rejected": ~usable})
            .unionByName(_per_period(fact.withColumn("_amount", F.col("amount_incl")), {
                "fact": F.lit(True), "no_shop": F.col("shop_cd").isNull(), "no_item": F.col("item_name").isNull(),
                "test": sales.is_test_slip(), "closed": sales.is_after_closing(), "target": ~sales.is_test_slip() & ~sales.is_after_closing()}))
            .unionByName(_per_period(by_category.withColumn("_amount", F.col("amount_jpy")), {"daily_category": F.lit(True)}))
            .unionByName(_per_period(by_shop.withColumn("_amount", F.col("amount_jpy")), {"daily_shop": F.lit(True)})))


def problems(metrics: dict[str, dict[str, tuple[int, int]]], max_rejected: float | None) -> dict[str, str]:
    """What is wrong with each period, from (rows, amount) by stage; periods without a problem are absent."""
    out = {}
    for period, m in metrics.items():
        rows, amount = {s: v[0] for s, v in m.items()}, {s: v[1] for s, v in m.items()}
        wrong = []
        if rows.get("fact", 0) != rows["arrived"] - rows["rejected"]:
            wrong.append(f"joining the masters made {rows.get('fact', 0)} of {rows['arrived'] - rows['rejected']} rows")
        wrong += [f"{t} adds up to {amount.get(t, 0)}, the facts to {amount.get('target', 0)}"
                  for t in ("daily_category", "daily_shop") if amount.get(t, 0) != amount.get("target", 0)]
        if max_rejected is not None and rows["rejected"] > max_rejected * rows["arrived"]:
            wrong.append(f"{rows['rejected']} of {rows['arrived']} rows were rejected")
        if wrong:
            out[period] = "; ".join(wrong)
    return out


def run_periods(raw: DataFrame, masters: sales.Masters, store: PeriodStore, periods: Iterable[str], max_rejected: float | None = None) -> int:
    """Rebuild ``periods`` from ``raw`` (RAW_COLUMNS and period) and publish those that pass; returns the number of the ledger entry.

    ``periods`` are those the run answers for: one of them without rows is published as empty, and rows of other
    periods stop the run.  A period refused by its checks keeps its published rows and stops the run
    after the others have been published.  With ``max_rejected``, a period with a larger share of rejected rows is refused.
    """
    wanted = sorted(set(periods))
    if not wanted:
        raise ValueError("a run answers for at least one period")
    run = store.new_run()
    stray = F.when(F.coalesce(F.col(PERIOD).isin(*wanted), F.lit(False)), F.col(PERIOD)).otherwise(
        F.raise_error(F.concat(F.lit("a row of a period that is not part of the run: "), F.coalesce(PERIOD, F.lit("NULL")))).cast("string"))
    named = raw.select(*sales.RAW_COLUMNS, stray.alias(PERIOD))
    classified = through_storage(sales.classify(named), "classified")
    clean, rejected = sales.split_usable(classified)
    rejected = store.stage(rejected, "silver", "rejected", run)
    fact = store.stage(sales.join_masters(clean, masters), "silver", "fact", run)
    target = sales.target_rows(fact)
    by_category = target.groupBy(PERIOD, "sale_date", "shop_cd", "category").agg(
        F.sum("qty").alias("qty"), F.sum("amount_incl").alias("amount_jpy"), F.count(F.lit(1)).alias("n_lines"))
    by_category = store.stage(enforce_contract(by_category.select(*DAILY_CATEGORY.fieldNames()), DAILY_CATEGORY), "gold", "daily_category", run)
    per_shop = by_category.groupBy(PERIOD, "sale_date", "shop_cd").agg(*[F.sum(c).alias(c) for c in ("qty", "amount_jpy", "n_lines")])
    by_shop = zero_fill_within(per_shop, PERIOD, "sale_date", sales.open_shops(masters.shops), ["qty", "amount_jpy", "n_lines"])
    by_shop = store.stage(enforce_contract(by_shop.select(*DAILY_SHOP.fieldNames()), DAILY_SHOP), "gold", "daily_shop", run)

    found: dict[str, dict[str, tuple[int, int]]] = {}
    told = stage_metrics(classified, fact, by_category, by_shop).collect()  # a row per period and stage
    for r in told:
        found.setdefault(r.period, {})[r.stage] = (r.rows, r.amount)
    wrong = problems(found, max_rejected)
    counts = {(t, p): m.get(t, (0, 0))[0] for p, m in found.items() for _, t in TABLES}
    store.spark.createDataFrame([(run, r.period, r.stage, r.rows, r.amount) for r in told], METRICS).coalesce(1).write.mode("append").parquet(metrics_path(store))
    seq = store.publish(run, TABLES, counts, wanted, wrong)
    if wrong:
        raise ContractError("; ".join(f"{p}: {why}" for p, why in sorted(wrong.items())))
    return seq


def metrics_path(store: PeriodStore) -> str:
    return f"{store.root.rstrip('/')}/metrics"


def published_metrics(store: PeriodStore) -> DataFrame:
    """(period, stage, rows, amount, seq) of the runs that the published periods come from."""
    now = store.pointers("fact").select("seq", "run", PERIOD)
    return store.spark.read.schema(METRICS).parquet(metrics_path(store)).join(now, ["run", PERIOD]).select(PERIOD, "stage", "rows", "amount", "seq")
