"""Session, table access and lineage helpers shared by every module."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def get_spark(master: str | None = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the test-suite and the bench use; without a master the session that the cluster's settings make."""
    builder = SparkSession.builder.appName("tandemtext")
    if master is None:
        builder = builder.config("spark.sql.session.timeZone", "UTC")
        for key, value in conf.items():
            builder = builder.config(key, value)
        return builder.getOrCreate()
    builder = (
        builder.master(master)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TANDEMTEXT_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Parquet table ``name`` of ``sf_dir``; ``columns`` narrows the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def latest(df: DataFrame, key: str | list[str], order: str = "loaded_at") -> DataFrame:
    """One row per key: the one of latest ``order`` (nulls last; full ties by a row hash).

    Spark plans the ``rank = 1`` filter as a WindowGroupLimit, so each map task
    already keeps one row per key before the shuffle; a key that holds a third
    of the table therefore sends one row per task. Rows whose key is null form
    one group. Empty input gives empty output.
    """
    keys = [key] if isinstance(key, str) else list(key)
    plain = [c for c, t in df.dtypes if "map<" not in t and t != "variant"]
    window = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), F.xxhash64(*plain))
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def _checkpoint_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tandemtext-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in ``spark.checkpoint.dir``; a local folder is set only where none is configured."""
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As :func:`cut_lineage`, compressed and by columns: for long texts, of which a checkpoint writes every byte."""
    folder = f"{_checkpoint_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def spread(df: DataFrame) -> DataFrame:
    """Repartition before a CPU-bound Python stage.

    Adaptive execution sizes partitions by bytes, so a few megabytes of long
    texts would run on one core. The number follows the session's shuffle
    partitions, twice the cores at least.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism))
