"""Point-in-time (validity-interval) left join of facts to an SCD2 dimension.

Semantics of ``fact LEFT JOIN dim ON keys AND t ∈ interval`` where the
interval is ``[start, end)`` (``bounds="[)"``) or ``(start, end]``
(``bounds="(]"``). Intervals of one ``keys + tie_break`` must not overlap, which
holds for what :func:`hayloft.operators.scd.scd2` produces per key. When
``keys`` is only a prefix of the dimension's own key (several devices per farm),
``tie_break`` names the rest of it: each device is looked up on its own, and of
those valid at the fact's time the one that started last (then the larger
``tie_break``) wins, instead of fanning the fact out.

Plan: the distinct ``(keys, fact time)`` and the dimension rows are unioned and
scanned in time order per key and device ("as-of"), so the cost is linear: no
equi-join on a weak key that would pair every fact of a hot key with every
dimension row of it. The found values are joined back to the facts on
``(keys, fact time)``, a plain equi-join whose skew Spark can split.

* DATE fact times: a key has one probe per day, and the dimension is first
  reduced to one row per key and *first day it can apply to* (``max_by``,
  combined map-side). The scanned group is bounded by the date span, not by the
  data volume, so one window suffices. With ``tie_break`` the reduced dimension is
  written to the checkpoint folder when the join is declared, as it is read twice.
* TIMESTAMP fact times: the range-partitioned ``last_seen`` of
  :mod:`hayloft.operators.ordered`. Probes and dimension rows are written to the
  checkpoint folder when the join is declared.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, MapType, VariantType

from hayloft.operators import ordered
from hayloft.session import scratch_path


def _payload(columns: Mapping[str, str], start_col: str, end_col: str, tie_break: Sequence[str]) -> Column:
    return F.struct(
        F.col(start_col).cast("timestamp").alias("start"),
        *[F.col(c).alias(f"tb{i}") for i, c in enumerate(tie_break)],
        F.col(end_col).cast("timestamp").alias("end"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)],
    )


def _valid_dim(dim: DataFrame, keys: Sequence[str], start_col: str) -> DataFrame:
    rows = dim.where(F.col(start_col).isNotNull())
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())  # NULL keys never match
    return rows


def point_in_time_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    fact_time: str,
    columns: Mapping[str, str],
    *,
    bounds: str = "[)",
    start_col: str = "start_time",
    end_col: str = "end_time",
    tie_break: Sequence[str] = (),
    one_per_time: bool = False,
    dealt_by: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """Add dimension columns ``columns`` (``{dim_column: output_name}``) to ``fact``.

    Every fact row is kept exactly once; the added columns are NULL when no
    interval contains the fact time (or the fact key has NULLs). A DATE fact
    time is compared as midnight of that day in the session zone.

    ``one_per_time`` states that ``fact`` has one row per ``(keys, fact_time)``, as
    an aggregated fact has: its rows then take part in the scan themselves and
    are read once, where otherwise the distinct probes are joined back.
    ``dealt_by`` names those of ``keys`` that rows of a DATE scan are dealt by (all by default).
    A result that is grouped or written by fewer columns than ``keys`` then needs no other shuffle.
    ``parts`` is the number of ranges that TIMESTAMP probes are dealt into (default:
    Spark's number of shuffle partitions).
    """
    if bounds not in ("[)", "(]"):
        raise ValueError("bounds must be '[)' or '(]'")
    daily = isinstance(fact.schema[fact_time].dataType, DateType)
    valid = _valid_dim(dim, keys, start_col).withColumns({f"_hl_d{i}": F.col(c) for i, c in enumerate(tie_break)})
    device = [f"_hl_d{i}" for i in range(len(tie_break))]

    if one_per_time:
        row = F.struct(*([F.col(c) for c in fact.columns if c not in (*keys, fact_time)] or [F.lit(0)])).alias("_hl_row")
        probes = fact.select(*keys, F.col(fact_time).alias("_hl_t"), row)
    else:
        known = fact.where(F.col(fact_time).isNotNull())
        for k in keys:
            known = known.where(F.col(k).isNotNull())
        probes = known.select(*keys, F.col(fact_time).alias("_hl_t")).distinct()
    payload = _payload(columns, start_col, end_col, tie_break)
    if daily:
        valid = _by_first_day(valid, [*keys, *device], payload, bounds, start_col, end_col)
    if device:
        if daily:
            valid = _stored(valid)  # read for the devices and for the scan
        # one probe per device of the key: devices of a key, not dimension rows
        devices = valid.select(*keys, *device).distinct().groupBy(*keys).agg(F.collect_list(F.struct(*device)).alias("_hl_devices"))
        probes = probes.join(devices, list(keys), "left" if one_per_time else "inner")
        names = [c for c in probes.columns if c not in ("_hl_devices", "_hl_row")]
        if one_per_time:
            probes = probes.select(*names, "_hl_row", F.posexplode_outer("_hl_devices").alias("_hl_nth", "_hl_device"))
            # the row goes along with one of its probes
            row = F.when(F.coalesce(F.col("_hl_nth"), F.lit(0)) == 0, F.col("_hl_row")).alias("_hl_row")
            probes = probes.select(*names, row, *[F.col("_hl_device")[d].alias(d) for d in device])
        else:
            probes = probes.select(*names, F.inline("_hl_devices"))

    if daily:
        seen = _scan_days(probes, valid, [*keys, *device], dealt_by)
    else:
        seen = _scan_times(probes, valid, [*keys, *device], payload, bounds, start_col, parts)
    t = F.col("_hl_t").cast("timestamp")
    inside = (t < F.col("_hl_seen.end")) if bounds == "[)" else (t <= F.col("_hl_seen.end"))
    latest = F.struct("_hl_seen.start", *[f"_hl_seen.tb{i}" for i in range(len(tie_break))])
    if one_per_time:
        found = seen.withColumn("_hl_seen", F.when(F.col("_hl_seen").isNotNull() & inside, F.col("_hl_seen")))
        if device:
            found = found.groupBy(*keys, "_hl_t").agg(
                _latest(found, "_hl_seen", F.when(F.col("_hl_seen").isNotNull(), latest)),
                F.first("_hl_row", ignorenulls=True).alias("_hl_row"),
            )
        own = [F.col(c) if c in keys else F.col("_hl_t").alias(c) if c == fact_time else F.col("_hl_row")[c].alias(c) for c in fact.columns]
        return found.select(*own, *[F.col(f"_hl_seen.c{i}").alias(out) for i, out in enumerate(columns.values())])
    hits = seen.where(F.col("_hl_seen").isNotNull() & inside)
    if device:
        hits = hits.groupBy(*keys, "_hl_t").agg(_latest(hits, "_hl_seen", latest))
    hits = hits.select(
        *[F.col(k).alias(f"_hl_k{i}") for i, k in enumerate(keys)],
        "_hl_t",
        *[F.col(f"_hl_seen.c{i}").alias(f"_hl_c{i}") for i in range(len(columns))],
    )
    on = [fact[k] == hits[f"_hl_k{i}"] for i, k in enumerate(keys)] + [fact[fact_time] == hits["_hl_t"]]
    return fact.join(hits, on, "left").select(
        *[fact[c] for c in fact.columns], *[hits[f"_hl_c{i}"].alias(out) for i, out in enumerate(columns.values())]
    )


def _latest(df: DataFrame, payload: str, order: Column) -> Column:
    """The payload that is last by ``order``.

    A payload begins with its start and, per device, differs in nothing else that orders it, so where
    it can be compared the largest is the last one, and travels without an order beside it.
    """
    plain = not any(isinstance(f.dataType, (MapType, VariantType)) for f in df.schema[payload].dataType)
    return (F.max(payload) if plain else F.max_by(payload, order)).alias(payload)


def _stored(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, "periods")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _by_first_day(dim, keys, payload, bounds, start_col, end_col):
    """The dimension as one row (``_hl_dim``) per key and first day (``_hl_t``) that it can apply to."""
    start = F.col(start_col).cast("timestamp")
    start_day = F.to_date(start)
    if bounds == "[)":
        # start <= midnight(D): D is the start day when the start is a midnight
        first_day = F.when(start == start_day.cast("timestamp"), start_day).otherwise(F.date_add(start_day, 1))
    else:
        # start < midnight(D)
        first_day = F.date_add(start_day, 1)
    rows = dim.select(*keys, first_day.alias("_hl_t"), payload.alias("_hl_dim"))
    return rows.groupBy(*keys, "_hl_t").agg(_latest(rows, "_hl_dim", F.struct("_hl_dim.start", "_hl_dim.end")))


def _scan_days(probes, reduced, keys, dealt_by):
    reduced = reduced.withColumn("_hl_rank", F.lit(0))
    both = probes.withColumn("_hl_rank", F.lit(1)).unionByName(reduced, allowMissingColumns=True)
    both = both.repartition(*dealt_by) if dealt_by else both
    w = (
        Window.partitionBy(*keys)
        .orderBy("_hl_t", "_hl_rank")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return both.withColumn("_hl_seen", F.last("_hl_dim", ignorenulls=True).over(w)).where("_hl_rank = 1")


def _scan_times(probes, dim, keys, payload, bounds, start_col, parts):
    # At equal times a "[)" dimension row is visible to the fact (start <= t),
    # a "(]" one is not (start < t): order the row kinds accordingly.
    dim_rank, fact_rank = (0, 1) if bounds == "[)" else (1, 0)
    dim_rows = dim.select(
        *keys,
        F.col(start_col).cast("timestamp").alias("_hl_t"),
        F.lit(dim_rank).alias("_hl_rank"),
        payload.alias("_hl_dim"),
    )
    probe_rows = probes.withColumn("_hl_rank", F.lit(fact_rank))
    both = probe_rows.unionByName(dim_rows, allowMissingColumns=True)
    order = ["_hl_t", "_hl_rank", F.col("_hl_dim.end")]
    scanned = ordered.last_seen(ordered.dealt_by_range(both, keys, order, parts), order, "_hl_dim", "_hl_seen")
    return scanned.where(F.col("_hl_rank") == F.lit(fact_rank))
