"""The first line of every file, however Spark splits and packs the files."""

from sievework.sources import encoding


def test_first_lines_without_python(spark, tmp_path, monkeypatch):
    names = {f"f{k:02d}.csv": (b"h%d,\x82\xa0\r\n" % k if k % 2 else b"h%d\n" % k) + b"row,1\n" * (k * 40) for k in range(30)}
    names["one.csv"], names["empty.csv"], names["blank.csv"] = b"no line end", b"", b"\nsecond\n"
    for name, data in names.items():
        (tmp_path / name).write_bytes(data)
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda *a, **k: (_ for _ in ()).throw(AssertionError("lines went to Python")))
    keep = {n: spark.conf.get(n, None) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("134217728b", "1000b"):  # many files could share a task, or a file is several splits
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = {r.path.rsplit("/", 1)[1]: bytes(r.first_line) for r in encoding.first_lines(spark, str(tmp_path)).collect()}
            assert found == {n: d.split(b"\n")[0].rstrip(b"\r") for n, d in names.items() if d}
            assert spark.conf.get("spark.sql.files.openCostInBytes", None) == keep["spark.sql.files.openCostInBytes"]
    finally:
        for n, v in keep.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
