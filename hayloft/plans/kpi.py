"""KPI series over the gold facts (filter + group-sum in Spark, no collect)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hayloft.plans import gold

FARM_DIMS = ("farm_license", "date")
FEED_DIMS = ("farm_license", "feed_name", "date")
RATION_DIMS = ("farm_license", "ration_name", "date")


def kpi_series(
    fact: DataFrame,
    dims: Sequence[str],
    kpi: str | None,
    *,
    farms: str | Sequence[str] | None = None,
    start: _dt.date | str | None = None,
    end: _dt.date | str | None = None,
    allowed: Sequence[str] | None = None,
) -> DataFrame:
    """Filter by farms and inclusive date bounds, then sum ``kpi`` per ``dims``.

    ``farms``: None → all, a string → that farm, a list → those farms (empty
    → no rows). NULL bounds are open. Groups with a NULL dimension are
    dropped and all-NULL groups give 0, ordered by ``dims``. Without ``kpi``
    the filtered rows are returned unaggregated.
    """
    out = fact
    if farms is not None:
        farm_list = [farms] if isinstance(farms, str) else list(farms)
        out = out.where(F.col("farm_license").isin(farm_list)) if farm_list else out.where(F.lit(False))
    if start is not None:
        out = out.where(F.col("date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        out = out.where(F.col("date") <= F.lit(str(end)).cast("date"))
    if kpi is None:
        return out
    valid = set(allowed) if allowed is not None else set(fact.columns) - set(dims)
    if kpi not in valid:
        raise ValueError(f"unknown KPI {kpi!r}")
    for d in dims:
        out = out.where(F.col(d).isNotNull())
    # Dealt by ranges of ``dims`` first: grouping and order then need no exchange of their own. A
    # fact has about one row per group, so that combining before the exchange would save nothing.
    return (
        out.select(*dims, kpi)
        .repartitionByRange(*dims)
        .groupBy(*dims)
        .agg(F.coalesce(F.sum(kpi), F.lit(0)).alias(kpi))
        .orderBy(*dims)
    )


def farm_kpi(fact: DataFrame, kpi: str | None, **filters) -> DataFrame:
    return kpi_series(fact, FARM_DIMS, kpi, allowed=gold.FARM_MEASURES, **filters)


def feed_kpi(fact: DataFrame, kpi: str | None, **filters) -> DataFrame:
    return kpi_series(fact, FEED_DIMS, kpi, allowed=gold.FEED_MEASURES, **filters)


def ration_kpi(fact: DataFrame, kpi: str | None, **filters) -> DataFrame:
    return kpi_series(fact, RATION_DIMS, kpi, allowed=gold.RATION_MEASURES, **filters)
