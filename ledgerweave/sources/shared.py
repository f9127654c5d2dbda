"""Intermediate tables in the folder all executors share.

A table written here cuts the lineage: a lost executor costs a re-read, not a
recomputation.  The folder is the cluster's ``spark.checkpoint.dir``; where that is
unset, it is a folder below the warehouse; on a cluster a warehouse on the driver's own
disk is refused, because executors would write to theirs.  The caller's session is left
as it is.
"""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    """The shared folder itself."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        check_shared(base, spark.sparkContext.master)
    return base.rstrip("/")


def check_shared(folder: str, master: str) -> None:
    """Raises where the executors of ``master`` cannot all see a folder of the driver's machine."""
    if urlparse(folder).scheme in ("", "file") and not master.startswith("local"):
        raise ValueError(f"{folder} is on the driver's machine; set spark.checkpoint.dir to a folder "
                         "that all executors share")


def shared_dir(spark: SparkSession) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_base(spark)}/ledgerweave/{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Deletes a path made by ``shared_dir``, on whatever file system it lies."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def write_through(df: DataFrame, path: str | None = None) -> DataFrame:
    """The same rows read back from a table, for results used many times."""
    path = path or shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
