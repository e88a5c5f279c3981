"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STAGE_FOLDER = "matchlens-stage"


def local_session(cores: str = "8", **settings: str) -> SparkSession:
    """A local session for tests and the benchmark: UTC, no UI port, few shuffle partitions."""
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100KB",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **settings,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("matchlens")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    A folder of our own is set only on a local master; a cluster without the setting is an error,
    because data staged on one machine would be lost with it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="matchlens-"))
    return context.getCheckpointDir()


def _own_folder(spark: SparkSession) -> str:
    """Where this application stages its tables; others may share the folder above."""
    return f"{checkpoint_dir(spark)}/{STAGE_FOLDER}/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """An unused path for an intermediate table in the shared folder."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a scan of it.

    Used where a result is read more than once or must not be recomputed differently. The files
    outlive executors, and later reads prune columns. With ``folder`` the table goes below it, so that
    the caller can delete several at once.
    """
    path = f"{folder}/{label}" if folder else new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str) -> tuple:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _hadoop(spark, path)
    return files.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    files, hadoop_path = _hadoop(spark, path)
    files.delete(hadoop_path, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the folder above the target is made if it is missing."""
    files, hadoop_path = _hadoop(spark, source)
    _, hadoop_target = _hadoop(spark, target)
    files.mkdirs(hadoop_target.getParent())
    if not files.rename(hadoop_path, hadoop_target):
        raise OSError(f"cannot move {source} to {target}")


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    files, hadoop_path = _hadoop(spark, path)
    if not files.exists(hadoop_path):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(hadoop_path) if entry.isDirectory()]


def drop_staged(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; DataFrames that read them become unusable."""
    delete_path(spark, _own_folder(spark))
