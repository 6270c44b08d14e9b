"""Intermediate tables that are deleted as soon as nothing reads them any more."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.session import scratch_path


class Scratch:
    """Tables written to the shared folder, by label."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def store(self, df: DataFrame, label: str, replace: bool = False) -> DataFrame:
        """Write ``df`` and read it back; ``replace`` deletes the tables of this label that ``df`` was made from."""
        path = scratch_path(self.spark, label)
        df.write.mode("error").parquet(path)
        if replace:
            self.drop(label)
        self.paths.setdefault(label, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        """Delete all tables of the labels.  What was computed from them has to be stored already."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for label in labels:
            for path in self.paths.pop(label, []):
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(conf).delete(target, True)
