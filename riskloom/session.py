"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "riskloom", **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("RISKLOOM_DRIVER_MEMORY", "8g"),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    } | conf
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/riskloom/{name}-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """From now on in this session, batches of at most ``rows`` rows go to Python, so that neither the JVM nor a worker
    holds a whole partition of texts at once; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


#: Whether Spark removes the shuffle files of an execution when it ends, and not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut in the lineage that
    outlives any executor. The shuffle files that the write needed go with its end, so that a job of many
    cuts holds on disk what one of them shuffles, not all."""
    spark = df.sparkSession
    path, before = fresh_path(spark, name), spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)
