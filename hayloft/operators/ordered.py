"""Skew-safe "last seen" value along an ordered key (timestamp as-of scans).

A plain ``Window.partitionBy(keys).orderBy(t)`` sends every row of one key to
one task: a key holding a third of all rows becomes a third of the job in a
single task. Here the rows are dealt by ranges of ``(key, order)``, so that a busy
key, and a busy week of it, falls into as many parts as its rows need; the last
value is carried over the edges of the parts:

1. rows with the number of their part are written to the checkpoint folder, as
   everything below must see the same parts, also after a lost executor;
2. in-part running ``last(ignorenulls)`` on ``(key, part)``;
3. summary ``groupBy(key, part)`` (partial aggregation, one row per key and
   part), then a window over the *summary* by key ordered by part;
4. equi-join of the summary back on ``(key, part)``; the big side is already
   hash-partitioned on those columns by step 2, so only the summary moves.

Keys are packed into one struct column so NULL keys group together (window
semantics) while the join stays a plain equi-join on a non-null column.
The result is exact — no row is dropped, capped or sampled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hayloft.session import scratch_path

KEY = "_hl_key"
BUCKET = "_hl_bucket"
NO_TIME = -(1 << 62)  # bucket of NULL times, before every other as NULLs sort first


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)


def dealt_by_range(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], parts: int | None = None) -> DataFrame:
    """Add the packed key and, as bucket, the part of a range partitioning on ``(key, order)``.

    Parts ascend with ``(key, order)`` and hold about equally many rows each.
    """
    spark = df.sparkSession
    ranges = [F.col(KEY), *_order(order)]
    dealt = df.withColumn(KEY, _key(keys)).repartitionByRange(*([parts] if parts else []), *ranges)
    dealt = dealt.withColumn(BUCKET, F.spark_partition_id().cast("long"))
    path = scratch_path(spark, "ranges")
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def _order(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def last_seen(df: DataFrame, order: Sequence[str | Column], value: str, out: str) -> DataFrame:
    """``out`` = last non-NULL ``value`` up to and including the current row of the key."""
    order_cols = _order(order)
    w_in = (
        Window.partitionBy(KEY, BUCKET)
        .orderBy(*order_cols)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    df = df.withColumn("_hl_in", F.last(value, ignorenulls=True).over(w_in))

    last_per_bucket = df.groupBy(KEY, BUCKET).agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order_cols))).alias("_hl_last")
    )
    w_prev = (
        Window.partitionBy(KEY).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = last_per_bucket.select(
        KEY, BUCKET, F.last("_hl_last", ignorenulls=True).over(w_prev).alias("_hl_carry")
    )
    return (
        df.join(carry, on=[KEY, BUCKET], how="left")
        .withColumn(out, F.coalesce(F.col("_hl_in"), F.col("_hl_carry")))
        .drop("_hl_in", "_hl_carry")
    )
