"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table, read by Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Only where a session in one process (local tests) leaves it unset a folder of our own is made.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        context = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = context.get() if context.isDefined() else None
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='scenewright-checkpoints-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found


_scopes: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder, which does not exist yet."""
    path = f"{shared_dir(spark)}/scenewright/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def saved(df: DataFrame, name: str, *, keep: bool = False) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage is cut,
    lost executors cost nothing that came before, and later passes do not recompute.
    keep: not among the tables that scratch() deletes."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if keep and _scopes:
        _scopes[-1].remove(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables saved inside are deleted at the end; what is to stay is written elsewhere before."""
    _scopes.append([])
    try:
        yield
    finally:
        for found in _scopes.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(found)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows and bytes that go to a Python worker together at most.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Lower the session's Arrow batches to what two workers beside an executor can hold, whatever the texts' lengths."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def text_key(text: str = "text") -> Column:
    """128 bits of the text's SHA-256, null as empty: rows are put together by it, so that ids never pass through Python."""
    return F.substring(F.unhex(F.sha2(text_or_empty(text), 256)), 1, 16)


def unused(df: DataFrame, name: str) -> str:
    """name, or name with underscores after it where df has such a column, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns_of(df: DataFrame) -> list[Column]:
    """df's columns for a select, whatever their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
