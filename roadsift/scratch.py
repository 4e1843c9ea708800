"""Steps of a job written to the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_checkpoints(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: the cluster's, as spark.checkpoint.dir names it. Where it is unset, one of our own in local mode (tests), and an error elsewhere."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="roadsift-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df written as a table to the shared folder and read again: without the steps before it, and without what the optimizer
    has inferred from these, which grows with every step."""
    at = f"{shared_checkpoints(df.sparkSession)}/step-{uuid.uuid4().hex}"
    df.write.parquet(at)
    out = df.sparkSession.read.schema(df.schema).parquet(at)
    out._written_at = at
    return out


def forget(*steps: DataFrame) -> None:
    """Delete what cut() wrote for steps that nothing reads any more."""
    for df in steps:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
