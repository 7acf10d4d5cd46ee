"""Cutting lineage through the shared checkpoint folder of the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only a local master may go
    without one; it gets a scratch folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="openloop-")


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared folder, so that neither a lost executor
    nor a second use computes it again."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def staged(df: DataFrame, *partitions: str) -> DataFrame:
    """Like :func:`durable` for results that may be large: a Parquet table in the shared
    folder, of which a later use reads the columns it needs, and of a table stored by
    ``partitions`` the folders it needs. It is removed when the application ends."""
    spark = df.sparkSession
    place = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(place, partitionBy=list(partitions) or None)
    folder = spark._jvm.org.apache.hadoop.fs.Path(place)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(place)
