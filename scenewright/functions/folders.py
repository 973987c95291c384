"""The folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that spark.checkpoint.dir names; a session in one process may do without that setting."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="scenewright-")
    return f"{base}/{name}-{uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back, so that what uses it twice computes it once."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
