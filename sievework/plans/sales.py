"""Sales of several till systems -> cleaned facts -> daily summaries, month by month."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.logic import after_date
from sievework.functions.parse import parse_date, parse_integer, tax_included
from sievework.functions.text import SALES_MISSING, nfkc_strip, normalise_columns, select_once, zero_pad
from sievework.operators.aggregate import zero_fill
from sievework.operators.joins import checked_join, resolve_alias
from sievework.session import scratch_path, through_storage
from sievework.sinks.contract import enforce_contract
from sievework.sinks.publish import layer_path, replace_partition, unsorted_partitions
from sievework.sources.registry import SourceSpec, load, sources_for

# Names and constants of the agreed tables.
RAW_COLUMNS = ("sale_date", "shop_name", "item_cd", "qty", "amount", "tax_type", "note", "source")
TEXT_COLUMNS = ("sale_date", "shop_name", "item_cd", "qty", "amount", "note")
TAX_EXCLUDED = "税抜"
TAX_RATE = 1.1
ITEM_CODE_WIDTH = 4
UNCLASSIFIED = "未分類"
TEST_SLIP = "テスト"
DAILY_SHOP = T.StructType([
    T.StructField("sale_date", T.DateType()),
    T.StructField("shop_cd", T.StringType()),
    T.StructField("qty", T.IntegerType()),
    T.StructField("amount_jpy", T.LongType()),
    T.StructField("n_lines", T.IntegerType()),
])
DAILY_CATEGORY = T.StructType([
    T.StructField("sale_date", T.DateType()),
    T.StructField("shop_cd", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("qty", T.IntegerType()),
    T.StructField("amount_jpy", T.LongType()),
    T.StructField("n_lines", T.IntegerType()),
])


@dataclass(frozen=True)
class Masters:
    """alias(alias, shop_cd); shops(shop_cd, shop_name, area, close_date);
    items(item_cd, item_name, category, discontinued_date)."""

    alias: DataFrame
    shops: DataFrame
    items: DataFrame


def classify(raw: DataFrame, tax_rate: float = TAX_RATE) -> DataFrame:
    """Typed sales with ``reject_reason``: NULL for usable rows.  No row is dropped."""
    text = normalise_columns(raw, TEXT_COLUMNS, SALES_MISSING)
    amount = parse_integer(F.col("amount"), marks="¥,")
    made = {
        "item_cd": zero_pad(F.col("item_cd"), ITEM_CODE_WIDTH),
        "sale_date": parse_date(F.col("sale_date")),
        "qty": parse_integer(F.col("qty")),
        "amount": amount,
    }
    typed = select_once(text, [made[c].alias(c) if c in made else F.col(c) for c in text.columns])
    included = (F.when(F.col("tax_type") == TAX_EXCLUDED, tax_included(F.col("amount"), tax_rate))
                .otherwise(F.col("amount")))
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in ("sale_date", "qty", "amount")]
    reasons = F.concat_ws(",", *missing)
    return typed.withColumns({"amount_incl": included,
                              "reject_reason": F.when(reasons != "", reasons)})


def split_usable(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected): together exactly the classified rows."""
    reason = F.col("reject_reason")
    return classified.filter(reason.isNull()).drop("reject_reason"), classified.filter(reason.isNotNull())


def join_masters(clean: DataFrame, masters: Masters) -> DataFrame:
    """Sales with shop and item attributes; no row is added or lost, unmatched ones keep NULLs."""
    df = clean.withColumnRenamed("shop_name", "shop_name_raw")
    df = resolve_alias(df, "shop_name_raw", masters.alias, "alias", "shop_cd", nfkc_strip)
    df = checked_join(df, masters.shops.select("shop_cd", "shop_name", "area", "close_date"), ["shop_cd"],
                      validate="m:1")
    df = checked_join(df, masters.items.select("item_cd", "item_name", "category", "discontinued_date"),
                      ["item_cd"], validate="m:1")
    return df.withColumn("category", F.coalesce("category", F.lit(UNCLASSIFIED)))


def is_test_slip() -> Column:
    return F.coalesce(F.col("note") == TEST_SLIP, F.lit(False))


def is_after_closing(inclusive: bool = False) -> Column:
    return after_date(F.col("sale_date"), F.col("close_date"), inclusive)


def target_rows(fact: DataFrame) -> DataFrame:
    """Facts that count: no test slips, no sales after the shop closed.  Returns count."""
    return fact.filter(~is_test_slip() & ~is_after_closing())


def exclusion_counts(fact: DataFrame) -> DataFrame:
    """One row: how many facts and how much money each exclusion rule removes."""
    measures = []
    for name, rule in (("test", is_test_slip()), ("closed", is_after_closing())):
        measures += [F.count_if(rule).alias(f"{name}_rows"),
                     F.coalesce(F.sum(F.when(rule, F.col("amount_incl"))), F.lit(0)).alias(f"{name}_amount")]
    return fact.agg(*measures)


def _daily(target: DataFrame, *keys: str) -> DataFrame:
    return target.groupBy("sale_date", *keys).agg(
        F.sum("qty").alias("qty"), F.sum("amount_incl").alias("amount_jpy"), F.count(F.lit(1)).alias("n_lines"))


def daily_by_category(target: DataFrame) -> DataFrame:
    """Sales per day, shop and category; only combinations that occur."""
    return _daily(target, "shop_cd", "category")


def open_shops(shops: DataFrame) -> DataFrame:
    """Codes of the shops that have not closed, from the master."""
    return shops.filter(F.col("close_date").isNull()).select("shop_cd")


def daily_by_shop(by_category: DataFrame, shops: DataFrame) -> DataFrame:
    """Sales per day and shop, with zero rows for open shops on days without sales.

    Built from the category summary, so the facts are aggregated once.
    """
    per_shop = by_category.groupBy("sale_date", "shop_cd").agg(
        F.sum("qty").alias("qty"), F.sum("amount_jpy").alias("amount_jpy"), F.sum("n_lines").alias("n_lines"))
    return zero_fill(per_shop, "sale_date", open_shops(shops), ["qty", "amount_jpy", "n_lines"])


def summarise(fact: DataFrame, shops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(by shop, by category) from the facts before exclusion."""
    by_category = daily_by_category(target_rows(fact))
    return daily_by_shop(by_category, shops), by_category


def run_month(spark: SparkSession, month: str, registry: Iterable[SourceSpec], masters: Masters, root: str) -> dict:
    """Rebuild everything of one month below ``root``; returns the recorded counts.

    The month comes from the caller, never from the clock, so a run can be repeated
    or a past month rebuilt.  Facts are staged once and read back by both summaries; the
    counts are collected while they are written.  Silver and gold are swapped after the last check; for periods
    that readers must see whole, with a history to return to, use ``sales_periods.run_periods``.
    """
    sources = sources_for(registry, month)
    raw = load(spark, sources, RAW_COLUMNS)
    classified = classify(raw)
    arrived = Observation("arrived")
    counted = classified.observe(arrived, F.count(F.lit(1)).alias("raw_rows"),
                                 F.count("reject_reason").alias("rejected_rows"))
    staged_path = scratch_path(spark, f"classified-{month}")
    with unsorted_partitions(spark, 2):
        (counted.withColumn("usable", F.col("reject_reason").isNull())
         .write.partitionBy("usable").parquet(staged_path))
    layout = T.StructType([*classified.schema.fields, T.StructField("usable", T.BooleanType())])
    staged = spark.read.schema(layout).parquet(staged_path)
    clean = staged.filter(F.col("usable")).drop("usable", "reject_reason")
    rejected = staged.filter(~F.col("usable")).drop("usable")

    joined = Observation("joined")
    fact = join_masters(clean, masters).observe(
        joined, F.count(F.lit(1)).alias("fact_rows"), F.sum("amount_incl").alias("fact_amount"),
        F.count_if(F.col("shop_cd").isNull()).alias("no_shop"),
        F.count_if(F.col("item_name").isNull()).alias("no_item"),
        F.count_if(is_test_slip()).alias("test_rows"),
        F.sum(F.when(is_test_slip(), F.col("amount_incl"))).alias("test_amount"),
        F.count_if(is_after_closing()).alias("closed_rows"),
        F.sum(F.when(is_after_closing(), F.col("amount_incl"))).alias("closed_amount"))
    stored = through_storage(fact, f"fact-{month}")
    counts = {**arrived.get, **joined.get}
    if counts["fact_rows"] != counts["raw_rows"] - counts["rejected_rows"]:
        raise ValueError(f"{month}: joining the masters changed the number of rows: {counts}")

    targeted = Observation("targeted")
    target = target_rows(stored).observe(targeted, F.sum("amount_incl").alias("total"))
    by_category = _staged(daily_by_category(target), "daily_category", DAILY_CATEGORY, counts)
    by_shop = _staged(daily_by_shop(by_category, masters.shops), "daily_shop", DAILY_SHOP, counts)
    for table in ("daily_category", "daily_shop"):
        if counts[f"{table}_amount"] != targeted.get["total"]:
            raise ValueError(f"{month}: {table} adds up to {counts[f'{table}_amount']}, "
                             f"the facts to {targeted.get['total']}")
    # Nothing is swapped before all checks have passed.
    for layer, table, rows in (("silver", "rejected", rejected), ("silver", "fact", stored), ("gold", "daily_category", by_category), ("gold", "daily_shop", by_shop)):
        replace_partition(rows, layer_path(root, layer, table), {"month": month}, stored=True)
    return counts


def _staged(summary: DataFrame, table: str, agreed: T.StructType, counts: dict) -> DataFrame:
    """The summary as agreed, written to the scratch folder; its rows and total are counted on the way."""
    seen = Observation(table)
    checked = enforce_contract(summary.select(*agreed.fieldNames()), agreed)
    watched = checked.observe(seen, F.sum("amount_jpy").alias("total"), F.count(F.lit(1)).alias("rows"))
    staged = through_storage(watched, table)
    counts[f"{table}_rows"], counts[f"{table}_amount"] = seen.get["rows"], seen.get["total"]
    return staged
