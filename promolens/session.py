"""Session helpers: recommended settings, the shared work folder, staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot (user, session) in the wide left joins even where a later step must shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(app: str = "promolens", cpus: str = "8", **conf: str) -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_recommended(spark: SparkSession) -> None:
    """Set the recommended SQL options on a running session."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)


def work_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all executors share. Where it is unset, a single-machine
    session works below its warehouse; any other master, ``local-cluster`` included, must set it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{base.rstrip('/')}/promolens-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared work folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read instead of a recomputation, and lets several consumers
    read just the columns they need.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{label}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._work_path = path
    return out


def discard(*staged: DataFrame) -> None:
    """Remove the folders of frames that ``stage`` returned, once all that reads them is written."""
    for df in staged:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(df._work_path).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
