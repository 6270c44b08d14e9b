"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# All of these are runtime settings, so they can be applied to a session that
# somebody else has created.
RUNTIME_SETTINGS = {
    # Wall-clock results must not depend on where the driver runs.
    "spark.sql.session.timeZone": "UTC",
    # A bad cast stops the job instead of producing a quiet NULL.
    "spark.sql.ansi.enabled": "true",
    # Lets the CSV source decode windows-31j (cp932) deliveries.
    "spark.sql.legacy.javaCharsets": "true",
    # Sizes of shuffle partitions, join strategies and skewed join partitions
    # are decided from measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Python workers get a few MB at a time, however long the texts are.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # Shuffle files go when their query ends, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the runtime settings; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset, a folder in the session's warehouse is used, which tables already
    need on storage that executors share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so reruns cannot collide."""
    return f"{shared_dir(spark)}/sievework/{label}-{uuid.uuid4().hex}"


def through_storage(df, label: str):
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage so that several consumers share one computation, and stays
    readable when executors are lost.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
