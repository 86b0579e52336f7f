"""Slowly changing dimension (type 2) from a stream of state messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from hayloft.functions.time import OPEN_END, epoch_seconds, time_bucket
from hayloft.operators.ordered import BUCKET, NO_TIME

GROUP = "_hl_group"
FINGERPRINT_SEPARATOR = ", "
DEFAULT_BUCKET_SECONDS = 3600
# Names and configurations change seldom. A bucket of hours then holds one row, and all rows
# go through the window per key; a bucket of a quarter holds many, of which two do.
CONFIGURATION_BUCKET_SECONDS = 90 * 86400


def _tie_break(df: DataFrame) -> Column:
    """Orders rows equal in time and fingerprint, so that a recomputed task picks the same one."""
    return F.xxhash64(*[F.col(f.name) for f in df.schema if not isinstance(f.dataType, (MapType, VariantType))])


def _bucket(time_col: str, seconds: int) -> Column:
    return F.coalesce(time_bucket(time_col, seconds), F.lit(NO_TIME))


def scd2(
    df: DataFrame,
    partition_columns: Sequence[str],
    column_names: Sequence[str],
    orderby_col: str = "time",
    *,
    open_end=OPEN_END,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    time_columns: Sequence[str] = (),
    one_per_state: bool = False,
) -> DataFrame:
    """Validity intervals of the tracked columns per key.

    * fingerprint = ``concat_ws(", ", column_names)`` (NULLs are skipped);
    * rows of a key are ordered by ``(orderby_col, fingerprint)``, NULL times
      first; a row is kept when its fingerprint differs from the row before (the
      first row of a key is always kept);
    * ``end_time`` = time of the next *kept* row, ``open_end`` for the last;
    * a column literally named ``time`` becomes ``start_time``;
    * ``duration_s`` = whole seconds between start and end.

    All input columns are kept; existing ``end_time`` / ``duration_s`` are
    replaced in place.

    ``time_columns`` are columns that follow from the time (a month). ``one_per_state`` states
    that a key has few rows of equal time and fingerprint, as periods have that ``scd2`` made.
    Neither changes the result.

    Plan: every key takes the same way. Of rows with the same key, time and
    fingerprint only the first can be kept, so they are collapsed before anything is
    gathered: to the different rows where all columns are tracked or follow from the time,
    else to the first by a combined ``min_by``. Rows at one instant, and all
    rows of a key without a time, are then about as many as their different
    fingerprints. What is left is shuffled on ``(key, time bucket)``; inside a bucket ``lag`` finds the change candidates (the bucket's
    first row and every change) and ``lead`` the next one. What a candidate
    between two others needs is then known. The first and the last candidate
    of each bucket, at most two rows per key and bucket, go through one window
    per key, which decides whether the first is a change at all and where the
    last one ends. Both branches read the same shuffle (equal columns), so the
    input is scanned once.
    """
    fp, t, tie = "_hl_fp", orderby_col, "_hl_tie"
    keys = list(partition_columns)
    # the key's columns travel in the key, what is computed anew or replaced not at all
    replaced = {"end_time", "duration_s"} - set(column_names)
    rest = [c for c in df.columns if c != t and c not in keys and c not in replaced]
    fingerprint = F.concat_ws(FINGERPRINT_SEPARATOR, *[F.col(c) for c in column_names])
    if not one_per_state and set(rest) <= {*column_names, *time_columns}:
        # equal in time and fingerprint is as good as equal: grouped by all columns, by hash
        df_rows = df.select(*keys, t, *rest).distinct()
    elif not one_per_state:
        first = F.min_by(F.struct(*([F.col(c) for c in rest] or [F.lit(0)])), tie).alias("_hl_row")
        grouped = df.withColumns({fp: fingerprint, tie: _tie_break(df)}).groupBy(*keys, t, fp).agg(first)
        df_rows = grouped.select(*keys, t, *[F.col("_hl_row")[c].alias(c) for c in rest])
    else:
        df_rows = df.select(*keys, t, *rest)

    # A hash of the group leads each order: rows are mostly told apart by it, without a look at
    # the strings of the key. It is made behind the shuffle, so it does not travel.
    collapsed = df_rows.withColumn(BUCKET, _bucket(t, bucket_seconds)).repartition(*keys, BUCKET)
    collapsed = collapsed.withColumns({fp: fingerprint, tie: _tie_break(df_rows), GROUP: F.xxhash64(*keys, BUCKET)})
    in_bucket = Window.partitionBy(GROUP, *keys, BUCKET).orderBy(t, fp, tie)
    candidates = (
        collapsed.withColumn("_hl_lag", F.lag(F.struct(fp)).over(in_bucket))
        .where(F.col("_hl_lag").isNull() | (F.col(fp) != F.col("_hl_lag")[fp]))
        .withColumn("_hl_next", F.lead(F.struct(F.col(t).alias("t"))).over(in_bucket))
        .withColumns({"_hl_first": F.col("_hl_lag").isNull(), "_hl_last": F.col("_hl_next").isNull()})
        .drop("_hl_lag", tie, GROUP)
    )
    inner = candidates.where(~F.col("_hl_first") & ~F.col("_hl_last")).withColumn("_hl_end", F.col("_hl_next.t"))

    edges = candidates.where(F.col("_hl_first") | F.col("_hl_last")).repartition(*keys or [F.lit(0)])
    edges = edges.withColumn(GROUP, F.xxhash64(*keys) if keys else F.lit(0))
    by_key = Window.partitionBy(GROUP, *keys).orderBy(BUCKET, t, fp)
    before = F.lag(F.struct(fp)).over(by_key)
    # the next change of a later row: a lead over the same order, so that the rows are sorted once
    named = ", ".join(f"`{c}`" for c in (GROUP, *keys))
    later = F.expr(f"lead(_hl_change) IGNORE NULLS OVER (PARTITION BY {named} ORDER BY `{BUCKET}`, `{t}`, `{fp}`)")
    edges = (
        edges.withColumn("_hl_kept", ~F.col("_hl_first") | before.isNull() | (F.col(fp) != before[fp]))
        # the first change that a bucket's first row stands for: itself, or the candidate after it
        .withColumn(
            "_hl_change",
            F.when(F.col("_hl_first"), F.when(F.col("_hl_kept"), F.struct(F.col(t).alias("t"))).otherwise(F.col("_hl_next"))),
        )
        .withColumn("_hl_later", later)
        .where("_hl_kept")
    )
    end_of_edge = (
        F.when(F.col("_hl_next").isNotNull(), F.col("_hl_next.t"))
        .when(F.col("_hl_later").isNotNull(), F.col("_hl_later.t"))
        .otherwise(F.lit(open_end))
    )
    edges = edges.withColumn("_hl_end", end_of_edge).drop("_hl_kept", "_hl_change", "_hl_later", GROUP)
    kept = inner.unionByName(edges)

    new = {
        "end_time": F.col("_hl_end").cast("timestamp").alias("end_time"),
        "duration_s": (epoch_seconds(F.col("_hl_end").cast("timestamp")) - epoch_seconds(F.col(t))).alias("duration_s"),
    }
    out = [new.pop(c) if c in new else F.col(c).alias("start_time") if c == "time" else F.col(c) for c in df.columns]
    return kept.select(*out, *new.values())
