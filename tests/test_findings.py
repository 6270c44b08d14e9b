"""Findings as rows: counts, bounded examples, order of files."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.sinks import findings
from sievework.sources.delimited import rows_per_file, with_arrival, with_row_arrival

AGREED = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("v", T.LongType(), False), T.StructField("s", T.StringType())])


def told(df):
    return {r.check: (r.failed, r.examples) for r in df.collect()}


def test_contract_findings(spark):
    rows = [(i, None if i % 4 == 0 else i, "x") for i in range(20)] + [(7, 7, "x"), (7, 7, "x"), (None, 1, None)]
    df = spark.createDataFrame(rows, "id long, v long, s string")
    found = told(findings.contract_findings(df, AGREED, ["id"], {"large": F.col("v") > 17, "never": F.col("s") == "y"}))
    assert found == {"columns": (0, []), "types": (0, []), "id is missing": (1, ["NULL"]), "v is missing": (5, ["0", "12", "16"]),
                     "large": (2, ["18", "19"]), "never": (0, []), "unique key": (1, ["7"])}
    other = told(findings.contract_findings(df.select("id", F.col("v").cast("string").alias("v"), F.lit(1).alias("w")), AGREED, ["id"]))
    assert other["columns"] == (2, ["missing column s", "unexpected column w"]) and other["types"][0] == 1
    assert set(told(findings.contract_findings(df.drop("id"), AGREED, ["id"]))) == {"columns", "types"}
    assert told(findings.contract_findings(df.limit(0), AGREED, ["id"]))["unique key"] == (0, [])


def test_one_fault_in_every_row_keeps_three_examples(spark):
    many = spark.range(50_000).withColumn("v", F.lit(None).cast("long"))
    found = told(findings.row_findings(many, {"v is missing": F.col("v").isNull()}, findings.shown("id")))
    assert found == {"v is missing": (50_000, ["0", "1", "10"])}
    assert findings.row_findings(many, {}, findings.shown("id")).count() == 0


def test_order_across_blocks_and_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(findings, "ORDER_BLOCK", 10)
    path = str(tmp_path / "t")
    spark.range(100).repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(path)
    assert told(findings.order_findings(spark.read.parquet(path), ["id"])) == {"order": (0, [])}
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "u"))
    spark.createDataFrame([(i if i != 20 else 5,) for i in range(35)], "id long").coalesce(1).write.parquet(str(tmp_path / "w"))
    failed, examples = told(findings.order_findings(spark.read.parquet(str(tmp_path / "w")), ["id"]))["order"]
    assert failed == 1 and examples[0].endswith(" row 20")  # at the border of two blocks
    failed, examples = told(findings.order_findings(spark.read.parquet(str(tmp_path / "w"), str(tmp_path / "u")), ["id"]))["order"]
    assert failed == 2  # "u" comes before "w" and ends above its begin
    failed, _ = told(findings.order_findings(spark.read.parquet(path, str(tmp_path / "u")), ["id"]))["order"]
    assert failed == 1  # "t" ends above the begin of "u"


def test_comparison_findings(spark):
    schema = "id long, v double, s string"
    expected = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, None), (3, 3.0, "c"), (None, 4.0, "d")], schema)
    actual = spark.createDataFrame([(1, 1.0 + 1e-12, "a"), (2, 2.5, None), (9, 3.0, "c"), (9, 3.0, "c"), (None, 4.0, "e")], schema)
    found = told(findings.comparison_findings(actual, expected, ["id"], 1e-9))
    assert found == {"columns": (0, []), "types": (0, []), "unique key, actual": (1, ["9"]), "unique key, expected": (0, []), "extra": (2, ["9", "9"]), "missing": (1, ["3"]),
                     "values of v": (1, ["2"]), "values of s": (1, ["NULL"])}
    typed = told(findings.comparison_findings(actual.withColumn("v", F.lit("1")), expected, ["id"]))
    assert typed["types"][0] == 1 and "values of v" not in typed


def test_arrival_order_survives_splits(spark, tmp_path):
    path = str(tmp_path / "a")
    spark.createDataFrame([(i,) for i in range(1000)], "v long").coalesce(1).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert [r.v for r in with_row_arrival(spark.read.parquet(path)).repartition(7).orderBy("_arrival").collect()] == list(range(1000))
        (tmp_path / "b.csv").write_text("".join(f"{i}\n" for i in range(2000)))
        text = with_arrival(spark.read.schema("v long").csv(str(tmp_path / "b.csv")))
        assert text.select("_arrival.block").distinct().count() > 1
        assert [r.v for r in text.repartition(7).orderBy("_arrival").collect()] == list(range(2000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    told_rows = rows_per_file(spark.read.parquet(path)).collect()
    assert [(r.rows, r.file.endswith(".parquet"), r.bytes > 0) for r in told_rows] == [(1000, True, True)]
