"""Measure expressions shared by the gold facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp_non_negative(c) -> Column:
    """``0`` for values ``<= 0``, the value otherwise (NULL stays NULL)."""
    x = _col(c)
    return F.when(x <= 0, F.lit(0)).otherwise(x)


def loading_accuracy(requested, loaded) -> Column:
    """``least / greatest * 100``; NULL operands are skipped by least/greatest."""
    req, got = _col(requested), _col(loaded)
    return F.try_divide(F.least(req, got), F.greatest(req, got)) * F.lit(100)


def count_equal(value: str, *cols) -> Column:
    """Number of ``cols`` equal to ``value`` as INT; NULL when any column is NULL."""
    total = None
    for c in cols:
        term = (_col(c) == F.lit(value)).cast("int")
        total = term if total is None else total + term
    return total


def surrogate_key(*cols, mode: str = "hash") -> Column:
    """Non-null surrogate key.

    ``hash`` (default) is a SHA-256 of the natural key: identical on recompute
    after a lost executor and on re-runs. ``uuid`` is a random UUID per row.
    """
    if mode == "uuid":
        return F.expr("uuid()")
    parts = [F.coalesce(_col(c).cast("string"), F.lit("\u0000")) for c in cols]
    # sha2 is typed nullable; the coalesce (never taken) makes the NOT NULL explicit
    return F.coalesce(F.sha2(F.concat_ws("\u0001", *parts), 256), F.lit(""))
