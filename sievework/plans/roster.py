"""Staff roster -> clean rows and quarantined rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.parse import ROSTER_DATE_LAYOUTS, parse_date, parse_integer
from sievework.functions.text import ROSTER_MISSING, map_values, normalise_columns, zero_pad
from sievework.operators.dedup import latest_by
from sievework.operators.joins import checked_join
from sievework.operators.order import asc

# Column names of the delivery, department spellings, placeholder.
COLUMNS = {"社員コード": "code", "氏名": "name", "部署": "dept", "入社日": "hired_on", "基本給": "base_pay",
           "週勤務時間": "weekly_hours", "メール": "mail", "更新日": "updated_on"}
DEPARTMENT_ALIASES = {
    "営業部": "D01", "営業": "D01", "セールス": "D01", "Sales": "D01",
    "開発部": "D02", "開発": "D02", "エンジニアリング": "D02",
    "人事部": "D03", "人事": "D03",
    "経理部": "D04", "経理": "D04",
    "情報システム部": "D05", "情シス": "D05",
}
UNCLASSIFIED = "未分類"
CODE_WIDTH = 4


def typed_roster(raw: DataFrame) -> DataFrame:
    """Normalised, typed rows; what cannot be read is missing."""
    text = normalise_columns(raw, COLUMNS.values(), ROSTER_MISSING)
    return text.withColumns({
        "mail": F.lower("mail"),
        "code": zero_pad(F.col("code"), CODE_WIDTH),
        "hired_on": parse_date(F.col("hired_on"), ROSTER_DATE_LAYOUTS),
        "base_pay": parse_integer(F.col("base_pay"), marks="¥,"),
        "weekly_hours": parse_integer(F.col("weekly_hours"), marks="¥,"),
    })


def clean_roster(raw: DataFrame, departments: DataFrame,
                 aliases: Mapping[str, str] = DEPARTMENT_ALIASES) -> DataFrame:
    """One row per staff code with ``reject_reason`` (NULL when usable).

    ``raw`` has the columns named in COLUMNS (renamed); ``departments`` has dept_cd,
    dept_name and division.  Rows without a code belong to no key: each different one
    of them stays, and is rejected.
    """
    typed = typed_roster(raw).distinct()
    others = [asc(c) for c in ("name", "dept", "base_pay", "weekly_hours", "mail", "hired_on")]
    current = (latest_by(typed.filter(F.col("code").isNotNull()), ["code"], "updated_on", others)
               .unionByName(typed.filter(F.col("code").isNull())))
    coded = current.withColumn("dept_cd", map_values(F.col("dept"), aliases, unmapped="keep"))
    joined = checked_join(coded, departments.select("dept_cd", "dept_name", "division"), ["dept_cd"],
                          validate="m:1")
    reason = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in ("code", "hired_on")])
    return joined.withColumns({"division": F.coalesce("division", F.lit(UNCLASSIFIED)),
                               "reject_reason": F.when(reason != "", reason)})


def headcount(clean: DataFrame) -> DataFrame:
    """People and base pay per division."""
    return clean.groupBy("division").agg(F.count(F.lit(1)).alias("people"), F.sum("base_pay").alias("base_pay"))
