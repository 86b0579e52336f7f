"""The given star-schema parquet tables (``<dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hayloft.functions.time import to_timestamp_columns

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; TIMESTAMP_NTZ columns become session-zone TIMESTAMPs.

    The projection is lazy, so column pruning and filters still reach the
    parquet scan; its splits are the input's own.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return to_timestamp_columns(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
