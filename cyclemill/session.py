"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "cyclemill") -> SparkSession:
    """Session for tests and benches on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # windows multiply their input by 50, so small partitions are worth a task of their own
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.executorEnv.OMP_NUM_THREADS", "1")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path for a written table that every executor can reach.

    It lies under ``spark.checkpoint.dir``, which a session on one machine gets here if it has none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # the setting itself cannot be changed in a running session
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cyclemill-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/cyclemill/{purpose}-{uuid.uuid4().hex}"


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """The rows from a written table, for plans that read them more than once.

    The table backs what is made of it, so it stays in the shared folder, as checkpoints do.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_table(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table through Hadoop's file system, wherever it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
