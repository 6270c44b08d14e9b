import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework import session
from sievework.operators.compare import same_rows
from sievework.operators.order import asc
from sievework.sinks import contract, publish
from sievework.sources import delimited, encoding
from sievework.sources.registry import SourceSpec, sources_for

C = F.col


def put(folder, name, text, charset="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(charset) if isinstance(text, str) else text)
    return str(path)


def test_delivery_with_two_encodings_and_column_orders(spark, tmp_path, rows):
    put(tmp_path, "a.csv", "id,name\n1,山田\n2,\"\"\n")
    put(tmp_path, "b.csv", "name,id\n㈱①　鈴木,3\n", "cp932")
    put(tmp_path, "c.csv", "id,name,extra\n4,\"a,b \"\"q\"\"\",x\n")
    got = delimited.read_delivery(spark, str(tmp_path))
    assert rows(got, "id", "name", "extra", "_src") == [
        ("1", "山田", None, "a.csv"), ("2", "", None, "a.csv"), ("3", "㈱①　鈴木", None, "b.csv"), ("4", 'a,b "q"', "x", "c.csv")]


def test_profile_names_encoding_and_header(spark, tmp_path):
    put(tmp_path, "a.csv", "﻿id,名前\n1,x\n")
    put(tmp_path, "b.csv", "id,名前\n1,山田\n", "cp932")
    found = encoding.profile_files(spark, str(tmp_path))
    assert [(f.encoding, f.header) for f in found] == [("UTF-8", ("id", "名前")), ("windows-31j", ("id", "名前"))]


def test_undecidable_file_stops_the_job(spark, tmp_path):
    put(tmp_path, "a.csv", b"id,name\n1,\x81\x20\xff\n")
    with pytest.raises(ValueError, match="a.csv"):
        delimited.read_delivery(spark, str(tmp_path))


def test_text_reader_guesses_nothing(spark, tmp_path, rows):
    path = put(tmp_path, "a.csv", "code,v\n0012,N/A\n,-\n\"\",NULL\n")
    assert rows(delimited.read_as_text(spark, path, ["code", "v"]), "code", "v") == [("", "-"), ("", "NULL"), ("0012", "N/A")]
    assert rows(delimited.read_typed(spark, path, "code string, v string"), "code")[-2:] == [(None,), (None,)]
    bad = put(tmp_path, "b.csv", "n\n1\nx\n")
    with pytest.raises(Exception, match="MALFORMED"):
        delimited.read_typed(spark, bad, "n int").collect()


def test_row_of_wrong_width_stops_the_job(spark, tmp_path):
    path = put(tmp_path, "a.csv", "a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED"):
        delimited.read_as_text(spark, path, ["a", "b"]).collect()


def test_arrival_order_follows_files_and_lines(spark, tmp_path):
    put(tmp_path, "1.csv", "k,v\na,1\na,2\n")
    put(tmp_path, "2.csv", "k,v\na,3\n")
    read = spark.read.schema("k string, v string").option("header", True).csv(str(tmp_path))
    arrived = delimited.with_arrival(read)
    assert arrived.orderBy(C("_arrival").desc()).first().v == "3"
    assert [r.v for r in arrived.orderBy("_arrival").collect()] == ["1", "2", "3"]


def test_json_array_and_lines(spark, tmp_path):
    lines = put(tmp_path, "l.json", '{"a": 1}\n{"a": 2}\n')
    array = put(tmp_path, "a.json", '[{"a": 1},\n {"a": 2}]')
    assert delimited.read_json_lines(spark, lines, "a int").count() == 2
    assert delimited.read_json_lines(spark, array, "a int", multiline=True).count() == 2


def test_registry_refuses_unknown_periods_and_columns(spark, tmp_path):
    path = put(tmp_path, "a.csv", "x\n1\n")
    spec = SourceSpec(path, ("x",), {"x": "y"}, {"source": "s"}, period="2024-04")
    assert sources_for([spec], "2024-04") == [spec]
    with pytest.raises(ValueError, match="2024-05"):
        sources_for([spec], "2024-05")
    with pytest.raises(ValueError, match="absent"):
        SourceSpec(path, ("x",), {"z": "y"}).read(spark)


AGREED = T.StructType([T.StructField("day", T.DateType()), T.StructField("shop", T.StringType(), False),
                       T.StructField("amount", T.LongType())])


@pytest.fixture
def daily(spark):
    return spark.sql("SELECT date'2024-04-01' AS day, 'S1' AS shop, 5L AS amount UNION ALL SELECT date'2024-04-02', 'S2', 7L")


def test_contract_accepts_and_narrows(daily):
    assert contract.enforce_contract(daily.withColumn("amount", C("amount").cast("int")), AGREED).schema["amount"].dataType == T.LongType()


@pytest.mark.parametrize("spoil,word", [
    (lambda d: d.withColumn("amount", C("amount").cast("string")), "amount: string"),
    (lambda d: d.drop("amount"), "missing column amount"),
    (lambda d: d.withColumn("note", F.lit("x")), "unexpected column note"),
    (lambda d: d.select("shop", "day", "amount"), "column order"),
])
def test_contract_refuses(daily, spoil, word):
    with pytest.raises(contract.ContractError, match=word):
        contract.enforce_contract(spoil(daily), AGREED)


def test_contract_tests_values_while_they_flow(daily):
    with pytest.raises(PySparkException, match="shop is missing"):
        contract.enforce_contract(daily.withColumn("shop", F.lit(None).cast("string")), AGREED).collect()
    too_big = daily.withColumn("amount", F.lit(3_000_000_000))
    narrow = T.StructType([AGREED["day"], AGREED["shop"], T.StructField("amount", T.IntegerType())])
    with pytest.raises(PySparkException):
        contract.enforce_contract(too_big, narrow).collect()


def test_check_stops_at_the_first_failure_or_lists_all(spark):
    want = spark.createDataFrame([(i, i * 10, "x") for i in range(10)], "id int, v int, s string")
    got = want.filter("id < 8").withColumn("v", F.when(C("id") < 5, C("v") + 1).otherwise(C("v")))
    first = contract.check_contract(got, want, ["id"])
    assert [(f.check, f.ok) for f in first][-1] == ("row set", False)
    assert first[-1].examples == ((8, "missing"), (9, "missing"))
    everything = {f.check: f for f in contract.check_contract(got, want, ["id"], fail_fast=False)}
    assert not everything["values of v"].ok and len(everything["values of v"].examples) == 3 and everything["values of s"].ok
    assert all(f.ok for f in contract.check_contract(want, want, ["id"]))
    doubled = contract.check_contract(want.unionByName(want.filter("id = 1")), want, ["id"])
    assert doubled[-1].check == "unique key" and doubled[-1].examples == ((1,),)
    with pytest.raises(contract.ContractError, match="row set"):
        contract.require(first)


def test_single_export_is_one_sorted_file(spark, tmp_path):
    df = spark.range(1000).select(F.format_string("%04d", 999 - C("id")).alias("id")).repartition(7)
    path = str(tmp_path / "out")
    publish.export_single(df, path, ["id"])
    back = spark.read.parquet(path)
    assert len(back.inputFiles()) == 1 and contract.file_is_sorted(back, ["id"])
    df.coalesce(1).write.parquet(str(tmp_path / "unsorted"))
    assert not contract.file_is_sorted(spark.read.parquet(str(tmp_path / "unsorted")), ["id"])


def months(spark, *triples):
    return spark.createDataFrame(list(triples), "id int, v int, month string")


def test_replacing_partitions_twice_changes_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    publish.replace_partitions(months(spark, (1, 1, "2024-04"), (2, 2, "2024-05")), path, ["month"])
    for _ in range(2):
        publish.replace_partitions(months(spark, (1, 9, "2024-04")), path, ["month"])
    assert rows(spark.read.parquet(path), "id", "v", "month") == [(1, 9, "2024-04"), (2, 2, "2024-05")]


def test_partition_without_rows_is_emptied(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    publish.replace_partitions(months(spark, (1, 1, "2024-04"), (2, 2, "2024-05")), path, ["month"])
    publish.replace_partition(months(spark).drop("month"), path, {"month": "2024-04"})
    assert rows(spark.read.parquet(path), "id") == [(2,)]
    publish.replace_partitions(months(spark, (3, 3, "2024-06")), path, ["month"], rerun=months(spark, (0, 0, "2024-05"), (0, 0, "2024-06")))
    assert rows(spark.read.parquet(path), "id") == [(3,)]


def test_appending_doubles_and_the_latest_view_does_not(spark, tmp_path):
    path = str(tmp_path / "log")
    for run in (1, 1, 2):
        publish.append_log(months(spark, (1, run, "x"), (2, run, "x")), path)
    assert spark.read.parquet(path).count() == 6
    view = publish.latest_view(spark, path, ["id"], "v", [asc("month")])
    assert view.count() == 2 and view.agg(F.min("v")).first()[0] == 2


def test_upsert_moves_inserts_and_keeps(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    publish.upsert(months(spark, (1, 1, "a"), (2, 2, "a"), (3, 3, "b")), path, ["id"], ["month"])
    for _ in range(2):
        publish.upsert(months(spark, (3, 30, "a"), (4, 4, "c")), path, ["id"], ["month"])
    assert rows(spark.read.parquet(path), "id", "v", "month") == [(1, 1, "a"), (2, 2, "a"), (3, 30, "a"), (4, 4, "c")]
    with pytest.raises(PySparkException, match="more than one row"):
        publish.upsert(months(spark, (1, 1, "a"), (1, 2, "a")), path, ["id"], ["month"])
    assert spark.read.parquet(path).count() == 4


def test_full_refresh_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.full_refresh(months(spark, (1, 1, "a"), (2, 2, "b")), path)
    publish.full_refresh(publish.read_table(spark, path).filter("id > 1"), path)
    assert spark.read.parquet(path).count() == 1


def test_missing_table_reads_as_empty_only_with_a_schema(spark, tmp_path):
    path = str(tmp_path / "none")
    assert publish.read_table(spark, path, AGREED).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        publish.read_table(spark, path)


def test_csv_roundtrip_keeps_text_only(spark, tmp_path, daily):
    path = str(tmp_path / "c")
    publish.write_csv(daily, path)
    back = delimited.read_as_text(spark, path, daily.columns).drop("_src")
    assert {f.dataType.simpleString() for f in back.schema} == {"string"}
    assert same_rows(back.select(C("day").cast("date"), "shop", C("amount").cast("bigint")).withColumns({"day": C("day")}), daily)


def test_layers_and_months(spark):
    assert publish.layer_path("/r/", "gold", "t") == "/r/gold/t"
    with pytest.raises(ValueError):
        publish.layer_path("/r", "platinum", "t")
    got = spark.createDataFrame([(datetime.date(2024, 4, 1),)], "d date").select(publish.month_of(C("d")).alias("m"))
    assert got.first().m == "2024-04"


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_few_large_partitions_are_written_without_a_sort(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id % 3 AS flag", "id % 40 AS many").repartition(1)
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    with publish.unsorted_partitions(spark, 8):
        assert spark.conf.get(setting) == "8"
        for name in ("flag", "many"):
            rows.write.partitionBy(name).parquet(str(tmp_path / name))
    assert spark.conf.get(setting) == before
    for name, n in (("flag", 3), ("many", 40)):
        back = spark.read.parquet(str(tmp_path / name))
        assert len(back.inputFiles()) == n and same_rows(back.select("id", C(name).cast("long")), rows.select("id", name))


def test_line_items_are_written_per_flag_without_a_sort(spark, tmp_path, monkeypatch):
    import __spark_entry__
    writer, settings = type(spark.range(1).write), []
    write = writer.parquet

    def watched(self, path, *args, **kwargs):
        settings.append((path.rsplit("/", 1)[1], int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))))
        return write(self, path, *args, **kwargs)
    monkeypatch.setattr(writer, "parquet", watched)
    found = __spark_entry__.queries()["source_file_lineage"](spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.flag, r.files) for r in found) == [("A", 1), ("N", 1), ("R", 1)]
    assert [n for name, n in settings if name == "lines"] > [3]


def test_deliveries_take_as_many_files_as_their_rows_need(spark):
    """A fixed number of files would make the sort of a task, and what a task reads back, grow with the table."""
    import glob
    import __spark_entry__
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}
    before = {name: spark.conf.get(name, None) for name in settings}
    logs = spark.conf.get("spark.checkpoint.dir") + "/sievework/query-*/log/delivery=0"
    known = set(glob.glob(logs))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        __spark_entry__.queries()["keep_last_arrival"](spark, "/root/testdata/sf0.001")
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    made, = set(glob.glob(logs)) - known
    assert len(glob.glob(f"{made}/*.parquet")) > 4
