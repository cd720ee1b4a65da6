"""Tables in the folder that all executors share: they cut lineage, so that loops don't grow their plan."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset and the master is local, a temporary folder."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="sitespark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame, name: str = "table") -> DataFrame:
    """df written to the shared folder, and read from there."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df dealt over all tasks, rows of equal `by` together: small files come in one or two, and small shuffles are put together in
    one or two, however much is made of each of their rows."""
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism), *by)
