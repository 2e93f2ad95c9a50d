"""Reliable checkpoints in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir or what the session has set; a temporary folder where neither is set, in local mode only."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        root = context.getConf().get("spark.checkpoint.dir", None)
        if not root and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(root or f"file://{tempfile.mkdtemp(prefix='shockline-')}")
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Evaluated once, its lineage cut, kept where lost executors don't matter."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The same as a table of Parquet files there: compact, and read by columns."""
    path = f"{shared_folder(df.sparkSession)}/shockline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
