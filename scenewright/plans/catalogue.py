"""Every registered query and its DuckDB text."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import books, chains, details, exports, media, oracles, tables


def wide(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with 32-bit columns as 64-bit ones, so that counts and places have one type everywhere."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        return df.select([F.col(c).cast("long").alias(c) if kind == "int" else F.col(c) for c, kind in df.dtypes])

    return run


QUERIES = {name: wide(query) for name, query in {**books.QUERIES, **tables.QUERIES, **chains.QUERIES, **media.QUERIES, **details.QUERIES, **exports.QUERIES}.items()}
ORACLES = {**books.ORACLES, **tables.ORACLES, **chains.ORACLES, **oracles.ORACLES, **details.ORACLES, **exports.ORACLES}
