"""Calendar source: one row per day, ``date DATE NOT NULL``."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar(spark: SparkSession, start: _dt.date | str, end: _dt.date | str) -> DataFrame:
    """Days ``start..end`` inclusive (fixed bounds)."""
    lo = F.lit(str(start)).cast("date")
    hi = F.lit(str(end)).cast("date")
    return spark.range(1).select(F.explode(F.sequence(lo, hi)).alias("date"))


def calendar_of(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Days from the first to the last ``date_col`` of ``df``, computed in Spark.

    One global ``min``/``max`` (partial aggregation), then a single generated
    row per day: the output size is bounded by the date span, not the data.
    """
    bounds = df.agg(F.min(F.to_date(date_col)).alias("lo"), F.max(F.to_date(date_col)).alias("hi"))
    return bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi")).alias("date")
    )
