"""Time helpers: epoch seconds, buckets and the open validity end."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: end of an open validity interval.
OPEN_END = _dt.datetime(2099, 12, 31, 23, 59, 59)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(c) -> Column:
    """Whole epoch seconds of a TIMESTAMP, floored (same as ``cast(ts as long)``)."""
    return F.unix_seconds(_col(c))


def time_bucket(c, seconds: int) -> Column:
    """Integer bucket ``floor(epoch_seconds / seconds)`` of a TIMESTAMP or DATE.

    DATE values are promoted to midnight in the session zone, exactly as the
    comparisons between DATE and TIMESTAMP columns do.
    """
    return F.floor(epoch_seconds(_col(c).cast("timestamp")) / F.lit(int(seconds)))


def year_month(c) -> Column:
    """``yyyy-MM`` of a timestamp, the silver partition key."""
    return F.date_format(_col(c), "yyyy-MM")


def to_timestamp_columns(df, types=("timestamp_ntz",)):
    """Cast every TIMESTAMP_NTZ column to session-zone TIMESTAMP (by name, in place)."""
    out = df
    for field in df.schema.fields:
        if field.dataType.typeName() in types:
            out = out.withColumn(field.name, F.col(field.name).cast("timestamp"))
    return out
