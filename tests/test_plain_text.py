"""Text that needs neither Python nor decimals takes the short way, and comes out as by the long one."""

import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions import parse, text


@F.arrow_udf(T.StringType())
def told(values: pa.Array) -> pa.Array:
    return pa.array([None if v is None else "python" for v in values.to_pylist()], pa.string())


def test_wide_text_stays_in_the_jvm(spark, monkeypatch):
    monkeypatch.setattr(text, "_nfkc", told.asNondeterministic())
    given = ["Ｓｕｐｐｌｉｅｒ＃００１　", "1998年3月26日", "￥17,480", "テスト", "返品", "　東京\t", " a ", "", None, "ﾃｽﾄ", "バ", "①", " x"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string")
    found = [r.v for r in df.select("i", text.nfkc_strip(F.col("v")).alias("v")).orderBy("i").collect()]
    assert found == ["Supplier#001", "1998年3月26日", "¥17,480", "テスト", "返品", "東京", "a", "", None, "python", "python", "python", "python"]


def test_every_character_as_python_has_it(spark):
    marks = ["", "゙", "́", "　", "\x1f", " ", "a"]
    given = [a + chr(c) + b for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000 for a, b in (("", ""), (marks[c % 7], marks[c // 7 % 7]))]
    df = spark.createDataFrame(pa.table({"v": given}))
    wrong = [(r.v, r.n) for r in df.select("v", text.nfkc_strip(F.col("v")).alias("n")).collect() if r.n != unicodedata.normalize("NFKC", r.v).strip()]
    assert not wrong


def test_plain_digits_need_no_decimals(spark, monkeypatch):
    given = ["0", "-13", "+7", "007", "1" * 18, "9" * 19, "9223372036854775807", "9223372036854775808", "12.0", "12.5", "1e3", " 5 ", "5\n", "5\x01", "-", "", "٣", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string")
    both = lambda: [tuple(r) for r in df.select(parse.parse_integer(F.col("v")), parse.parse_amount(F.col("v")), "i").orderBy("i").collect()]
    short = both()
    whole = [0, -13, 7, 7, int("1" * 18), 9999999999999999999, 9223372036854775807, 9223372036854775808, 12, None, 1000, 5, 5, None, None, None, None, None]
    whole = [None if w is not None and w > 9223372036854775807 else w for w in whole]
    assert [r[0] for r in short] == whole
    assert [r[1] for r in short] == [12 if v == "12.5" else w for v, w in zip(given, whole)]
    with monkeypatch.context() as m:
        m.setattr(parse, "_decimal", lambda bare: F.lit(None).cast("decimal(38,12)"))
        assert [r[:2] for r in both()][:5] == [r[:2] for r in short][:5]
    monkeypatch.setattr(parse, "_whole", lambda bare, other: other)
    assert both() == short
