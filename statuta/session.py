"""Session construction and the few run-time helpers every operator shares."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings used for local runs and tests; a cluster brings its own.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("statuta")
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of the data directory ``sf_dir``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give CPU-heavy Python stages enough tasks.

    A small number of large input splits would leave cores idle.  Only then
    the rows are redistributed, by hash of ``key`` so that a retried task sees
    the same rows; otherwise the scan's own splits are kept and nothing is
    shuffled.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(max(want, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), key)


def _with_checkpoint_folder(spark: SparkSession) -> None:
    """Set the folder for checkpoints: the one the session names in ``spark.checkpoint.dir``;
    only where that is unset on a local master (tests) a local folder is used."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            import tempfile

            folder = tempfile.mkdtemp(prefix="statuta-checkpoint-")
        context.setCheckpointDir(folder)


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint."""
    _with_checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As ``durable``, but as compressed Parquet in that folder, of which readers take the columns they need."""
    spark = df.sparkSession
    _with_checkpoint_folder(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stored-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
