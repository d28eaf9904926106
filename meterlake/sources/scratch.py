"""Scratch tables: results cut from their lineage and kept where every executor can read them."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Only a local session, whose executors are this very process, gets a folder of its own when
    none is named.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    return _local_folder(spark.sparkContext.applicationId)


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"meterlake-{application}-")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialize(rows: DataFrame, purpose: str, by: str | None = None) -> DataFrame:
    """Write the rows once, in a folder for each value of the column ``by`` if given, and return a scan of them.

    Used before iterative work and before a second pass, so that neither repeats the plan behind
    the rows. The files survive lost executors.
    """
    path = new_folder(rows.sparkSession, purpose)
    rows.write.parquet(path, partitionBy=by)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark can reach."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative MLlib fits cut their lineage only when a checkpoint folder is set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
