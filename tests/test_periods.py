"""Periods published through the ledger: backfill, new months, refusals, going back."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_pipelines import masters, registry  # noqa: F401  (fixtures)

from sievework.plans import sales, sales_periods
from sievework.sinks.contract import ContractError
from sievework.sinks.periods import PeriodStore

C = F.col


@pytest.fixture
def store(spark, tmp_path):
    return PeriodStore(spark, str(tmp_path / "it's 100% here"))


def run(store, masters, specs, *periods, **options):  # noqa: F811
    return sales_periods.run_periods(sales_periods.deliveries(store.spark, specs, periods), masters, store, periods, **options)


def by_shop(store, period):
    rows = store.read("daily_shop", sales_periods.DAILY_SHOP, [period]).groupBy("shop_cd").agg(F.sum("amount_jpy").alias("a")).collect()
    return {r.shop_cd: r.a for r in rows}


def total(store, period):
    return store.read("daily_shop", sales_periods.DAILY_SHOP, [period]).agg(F.sum("amount_jpy")).first()[0]


APRIL, FIXED, MAY = {"S01": 2360, "S02": 600, "S03": 9759}, {"S01": 3260, "S02": 600, "S03": 10559}, {"S01": 2430, "S02": 1700, "S03": 2650}


def test_backfill_new_month_and_back(store, masters, registry):  # noqa: F811
    assert run(store, masters, registry["april"], "2024-04") == 1
    assert by_shop(store, "2024-04") == APRIL and total(store, "2024-04") == 12719
    old_reader = store.read("daily_category", sales_periods.DAILY_CATEGORY)
    before = old_reader.count()
    assert run(store, masters, registry["may"], "2024-05") == 2  # a new month leaves the other alone
    assert by_shop(store, "2024-04") == APRIL and by_shop(store, "2024-05") == MAY
    assert {r.period: r.seq for r in store.pointers("fact").collect()} == {"2024-04": 1, "2024-05": 2}
    assert run(store, masters, registry["april"] + registry["fix"], "2024-04") == 3  # the backfill adds 1,700
    assert by_shop(store, "2024-04") == FIXED and total(store, "2024-04") == 12719 + 1700 and by_shop(store, "2024-05") == MAY
    assert old_reader.count() == before  # a reader of the old rows goes on with them
    assert store.put_back("2024-04", 1) == 4
    assert by_shop(store, "2024-04") == APRIL and by_shop(store, "2024-05") == MAY
    with pytest.raises(ValueError, match="did not publish"):
        store.put_back("2024-05", 1)


def test_many_periods_in_one_run_equal_single_runs_in_any_order(spark, store, masters, registry, tmp_path):  # noqa: F811
    everything = registry["april"] + registry["fix"] + registry["may"]
    run(store, masters, everything, "2024-04", "2024-05")
    other = PeriodStore(spark, str(tmp_path / "other"))
    run(other, masters, everything, "2024-05")
    run(other, masters, everything, "2024-04")
    for table, schema in (("daily_shop", sales_periods.DAILY_SHOP), ("daily_category", sales_periods.DAILY_CATEGORY)):
        a, b = (sorted(s.read(table, schema).collect(), key=str) for s in (store, other))
        assert a == b and a
    shops = store.read("daily_shop", sales_periods.DAILY_SHOP)
    assert shops.filter("period = '2024-04'").count() == 30 and shops.filter("period = '2024-05'").count() == 24


def test_metrics_of_the_published_runs(store, masters, registry):  # noqa: F811
    run(store, masters, registry["april"], "2024-04")
    run(store, masters, registry["april"] + registry["fix"], "2024-04")
    found = {r.stage: (r.rows, r.amount, r.seq) for r in sales_periods.published_metrics(store).collect()}
    assert found["arrived"][0] == 24 and found["rejected"][0] == 2 and found["fact"] == (22, 14869, 2)
    assert found["closed"] == (1, 450, 2) and found["daily_shop"][1] == found["daily_category"][1] == found["target"][1] == 14419


def test_refused_period_keeps_its_rows_and_others_go_on(store, masters, registry):  # noqa: F811
    run(store, masters, registry["april"], "2024-04")
    everything = registry["april"] + registry["fix"] + registry["may"]
    with pytest.raises(ContractError, match="2024-04: 2 of 24 rows were rejected"):
        run(store, masters, everything, "2024-04", "2024-05", max_rejected=0.05)
    assert by_shop(store, "2024-04") == APRIL and by_shop(store, "2024-05") == MAY
    refused = store.ledger().where("status = 'refused'").select("period", "reason").distinct().collect()
    assert [(r.period, r.reason) for r in refused] == [("2024-04", "2 of 24 rows were rejected")]
    broken = sales.Masters(masters.alias, masters.shops.unionByName(masters.shops.filter("shop_cd = 'S01'")), masters.items)
    with pytest.raises(PySparkException, match="more than one row for key S01"):
        run(store, broken, everything, "2024-04")
    assert by_shop(store, "2024-04") == APRIL  # silver and gold still point at the first run
    assert store.read("fact", store.spark.createDataFrame([], "amount_incl long, period string").schema, ["2024-04"]).agg(F.sum("amount_incl")).first()[0] == 13169


def test_empty_stray_and_unknown_periods(store, masters, registry):  # noqa: F811
    run(store, masters, registry["may"], "2024-05")
    feed = sales_periods.deliveries(store.spark, registry["may"], ["2024-05"])
    sales_periods.run_periods(feed.limit(0), masters, store, ["2024-05", "2024-06"])
    assert store.read("daily_shop", sales_periods.DAILY_SHOP).count() == 0  # what a period no longer has must go
    assert {(r.period, r.rows) for r in store.pointers("daily_shop").collect()} == {("2024-05", 0), ("2024-06", 0)}
    for stray in ("2024-07", None):
        with pytest.raises(PySparkException, match="not part of the run"):
            sales_periods.run_periods(feed.withColumn("period", F.lit(stray).cast("string")), masters, store, ["2024-05"])
    with pytest.raises(ValueError, match="at least one period"):
        sales_periods.run_periods(feed, masters, store, [])
    with pytest.raises(ValueError, match="2024-08"):
        sales_periods.deliveries(store.spark, registry["may"], ["2024-08"])
    assert store.put_back("2024-05", 1) == 3 and by_shop(store, "2024-05") == MAY


def test_vacuum_deletes_only_what_nothing_names(store, masters, registry):  # noqa: F811
    run(store, masters, registry["april"], "2024-04")
    run(store, masters, registry["april"] + registry["fix"], "2024-04")
    run(store, masters, registry["may"], "2024-05")
    assert store.vacuum(keep=1) == []
    assert len(store.vacuum(keep=0)) == 4  # the four tables of the first run
    assert by_shop(store, "2024-04") == FIXED and by_shop(store, "2024-05") == MAY
    run(store, masters, registry["april"], "2024-04")
    assert by_shop(store, "2024-04") == APRIL


def test_two_runs_with_one_number(store, spark):
    """Runs that publish at the same time: one of them counts, the same one for every reader and table."""
    rows = spark.createDataFrame([("a", "p")], "v string, period string")
    for name in ("b", "a"):
        store.stage(rows.withColumn("v", F.lit(name)), "gold", "t", name)
        store._append([(1, name, "p", "gold", "t", 1, "published", None)])
    assert [r.v for r in store.read("t", rows.schema).collect()] == ["b"]
