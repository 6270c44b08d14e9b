import random
import unicodedata

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sievework.functions import logic, parse, text

C = F.col


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {kind}")


def apply(spark, values, make, kind="string"):
    out = column(spark, values, kind).select("i", make(C("s")).alias("r")).orderBy("i")
    return [r.r for r in out.collect()]


def test_nfkc_strip_equals_unicodedata_for_every_character(spark):
    values = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c <= 0xDFFF]
    rnd = random.Random(7)
    pool = [chr(c) for c in (*range(32, 0x250), *range(0x3000, 0x3100), *range(0xFF00, 0xFFF0), 0x3099, 0x309A, 0x301)]
    values += ["".join(rnd.choices(pool, k=6)) for _ in range(5000)]
    wrong = [v for v, r in zip(values, apply(spark, values, text.nfkc_strip))
             if unicodedata.normalize("NFKC", v).strip() != r]
    assert wrong == []


def test_missing_values_stay_missing(spark):
    assert apply(spark, [None, "", "　"], text.nfkc_strip) == [None, "", ""]


def test_missing_tokens_are_compared_after_normalising(spark):
    raw = column(spark, ["NULL", " N/A ", "－", "", "　", "x-", None])
    clean = text.normalise_columns(raw, ["s"], text.ORDER_MISSING).orderBy("i")
    assert [r.s for r in clean.collect()] == [None, None, None, None, None, "x-", None]


def test_unknown_columns_are_refused(spark):
    with pytest.raises(ValueError, match="nope"):
        text.normalise_columns(column(spark, ["a"]), ["nope"])


def test_zero_pad_keeps_long_and_signed_text(spark):
    values = ["5", "-5", "+7", "12345", "", None]
    assert apply(spark, values, lambda c: text.zero_pad(c, 4)) == [None if v is None else v.zfill(4) for v in values]


def test_affixes_and_parts(spark):
    assert apply(spark, ["1.2s", "ss", "x"], lambda c: text.remove_suffix(c, "s")) == ["1.2", "s", "x"]
    assert apply(spark, ["##a", "a#"], lambda c: text.remove_prefix(c, "#")) == ["#a", "a#"]
    assert apply(spark, ["a-b", "a"], lambda c: text.split_part(c, "-", 1)) == ["b", None]
    assert apply(spark, ["a12b", "ab"], lambda c: text.extract_first(c, r"(\d+)")) == ["12", None]


def test_value_maps(spark):
    table = {"はい": True, "いいえ": False}
    assert apply(spark, ["はい", "?", None], lambda c: text.map_values(c, table, "null")) == [True, None, None]
    assert apply(spark, ["営業", "広報部"], lambda c: text.map_values(c, {"営業": "D01"})) == ["D01", "広報部"]
    with pytest.raises(PySparkException, match="not in the dictionary"):
        apply(spark, ["?"], lambda c: text.map_values(c, table, "raise"))


def test_dates_in_three_spellings(spark):
    values = ["2024-01-05", "2024/1/5", "2024年1月5日", "2024年1月", "5/1/2024", "2024-02-30", "2024/1-5", None]
    assert [str(d) if d else None for d in apply(spark, values, parse.parse_date)] == ["2024-01-05"] * 3 + [None] * 5


@pytest.mark.parametrize("bad", ["yesterday", "2024-02-30"])
def test_strict_dates_stop_the_job(spark, bad):
    with pytest.raises(PySparkException, match="unreadable date"):
        apply(spark, ["2024-01-05", bad], lambda c: parse.parse_date(c, on_error="raise"))


def test_other_date_spellings(spark):
    assert [str(d) for d in apply(spark, ["01/05/24"], parse.parse_short_date)] == ["2024-01-05"]
    assert [str(d) for d in apply(spark, ["45296"], parse.excel_serial_date)] == ["2024-01-05"]


def test_amounts(spark):
    values = ["1200", "1200.0", "1,200", "¥1,200", "1,200円", "-3", "abc", "NaN", None]
    assert apply(spark, values, parse.parse_amount) == [1200] * 5 + [-3, None, None, None]
    assert apply(spark, ["1200.0", "1200.5", "-"], parse.parse_integer) == [1200, None, None]
    assert apply(spark, ["(1,200)", "1200"], parse.parse_accounting) == [-1200, 1200]
    with pytest.raises(PySparkException, match="unreadable amount"):
        apply(spark, ["abc"], lambda c: parse.parse_amount(c, on_error="raise"))


def test_flags(spark):
    assert apply(spark, ["1", "N", "TRUE", "無", "?"], parse.parse_flag) == [True, False, True, False, None]


def test_tax_rounds_half_even_on_the_binary_product(spark):
    values = [409, 1090, 500, 1227, 728, 545, 872, 55, -500, -364]
    assert apply(spark, values, lambda c: parse.tax_included(c, 1.1), "bigint") == [round(v * 1.1) for v in values]


def test_mixed_offsets_are_one_instant(spark):
    got = apply(spark, ["2024-01-05T00:00:00Z", "2024-01-05T09:00:00+09:00"],
                lambda c: parse.wall_clock(parse.parse_instant(c), "Asia/Tokyo"))
    assert [str(x) for x in got] == ["2024-01-05 09:00:00"] * 2


def test_three_valued_split_loses_no_row(spark):
    df = column(spark, [1, 2000, None], "int")
    parts = logic.split_three_ways(df, C("s") > 1000)
    assert [p.count() for p in parts] == [1, 1, 1]


def test_band_edges_belong_to_the_lower_band(spark):
    got = apply(spark, [0.0, 10.0, 10.5, 100.0, 101.0], lambda c: logic.bands(c, [0, 10, 100], ["small", "large"]), "double")
    assert got == [None, "small", "large", "large", None]


def test_closing_day_boundary(spark):
    df = spark.sql("SELECT date'2024-03-31' AS d, date'2024-03-31' AS c UNION ALL SELECT date'2024-04-10', null")
    assert [r[0] for r in df.select(logic.after_date(C("d"), C("c"))).collect()] == [False, False]
    assert [r[0] for r in df.select(logic.after_date(C("d"), C("c"), True)).collect()] == [True, False]
