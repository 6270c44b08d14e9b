"""Order deliveries -> one clean order table.

The order of the steps is part of the result: a correction replaces the earlier
row before unusable rows are excluded, so an order invalidated by its correction
disappears instead of surviving in its old form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.parse import parse_amount, parse_date
from sievework.functions.text import ORDER_MISSING, normalise_columns, select_once
from sievework.operators.dedup import latest_by
from sievework.operators.order import asc
from sievework.sinks.contract import enforce_contract
from sievework.sources.delimited import read_delivery

# The agreed output table.
ORDER_CONTRACT = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("order_date", T.DateType(), False),
    T.StructField("customer_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("amount_jpy", T.LongType(), False),
])

RAW_COLUMNS = ("order_id", "order_date", "customer_name", "region", "status", "quantity", "amount", "ingested_at")


def typed_orders(raw: DataFrame) -> DataFrame:
    """Normalised and typed order rows; text nobody can read stops the job."""
    text = normalise_columns(raw.select(*RAW_COLUMNS), RAW_COLUMNS, ORDER_MISSING)
    return select_once(text, [
        "order_id",
        parse_date(F.col("order_date"), on_error="raise").alias("order_date"),
        "customer_name",
        F.lower("region").alias("region"),
        F.lower("status").alias("status"),
        parse_amount(F.col("quantity"), marks="", on_error="raise").cast("int").alias("quantity"),
        parse_amount(F.col("amount"), on_error="raise").alias("amount_jpy"),
        "ingested_at"])


def usable(orders: DataFrame) -> DataFrame:
    """Orders with a date, an amount and a positive quantity."""
    return orders.filter(F.col("order_date").isNotNull() & F.col("amount_jpy").isNotNull()
                         & (F.col("quantity") > 0))


def clean_orders(raw: DataFrame) -> DataFrame:
    """The agreed order table (unsorted; sort where it is exported)."""
    cleaned = usable(latest_by(typed_orders(raw), ["order_id"], "ingested_at",
                               [asc("amount_jpy"), asc("quantity")]))
    return enforce_contract(cleaned.select(*ORDER_CONTRACT.fieldNames()), ORDER_CONTRACT)


def ingest_orders(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All files of a delivery, whatever their encodings and column orders, as clean orders."""
    return clean_orders(read_delivery(spark, paths))
