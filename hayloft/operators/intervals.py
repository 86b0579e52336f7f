"""Interval splitting at window boundaries and daily gap filling."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hayloft.functions.time import epoch_seconds

DAY_SECONDS = 86400
PIECES_AT_ONCE = 4096  # pieces of one interval that one array holds
_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": DAY_SECONDS, "week": 7 * DAY_SECONDS}


def step_seconds_of(step: int | str) -> int:
    """Seconds of a window duration given as seconds or as text like ``"1 days"``."""
    if isinstance(step, int):
        return step
    amount, unit = step.split()
    unit = unit.lower().rstrip("s")
    if unit not in _UNIT_SECONDS:
        raise ValueError(f"unsupported window duration {step!r}")
    return int(amount) * _UNIT_SECONDS[unit]


def fill_days(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str = "date",
    measures: Sequence[str] = (),
    *,
    round_digits: int | None = 2,
    pos_col: str | None = None,
) -> DataFrame:
    """Dense daily series per key.

    Each row with date ``D`` and next date ``N`` of its key (``lead``):

    * ``N`` NULL (last row): one row for ``D``;
    * ``N > D``: rows ``D, D+1, …, N-1``;
    * ``N = D`` (duplicate key and day): no row, so the last duplicate in
      window order survives.

    ``measures`` keep their value (rounded to ``round_digits``) on the observed
    day and are NULL on filled days; every other column is carried forward.
    Pure DATE arithmetic: the result does not depend on the session zone.

    The input must be daily: one row per key and day (duplicates are allowed, but
    a key's rows meet in one window). A key then holds at most as many rows as
    there are days in the data.
    """
    d = F.col(date_col)
    nxt = F.col("_hl_next")
    # days are counted from the row's own: a sequence of dates would go through the calendar for each of them
    last = F.when(nxt.isNull() & d.isNotNull(), F.lit(0)).when(nxt > d, F.date_diff(nxt, d) - 1)
    pos = pos_col or "_hl_pos"
    exploded = df.withColumn("_hl_next", F.lead(d).over(Window.partitionBy(*keys).orderBy(d))).select(
        *[F.col(c) for c in df.columns],
        F.explode(F.sequence(F.lit(0), last)).alias(pos),
    )

    def measure(c: str):
        value = F.round(F.col(c), round_digits) if round_digits is not None else F.col(c)
        return F.when(F.col(pos) == 0, value).alias(c)

    out_cols = []
    for c in df.columns:
        if c == date_col:
            # a row without a date has no days; the coalesce (never taken) makes the NOT NULL explicit
            out_cols.append(F.coalesce(F.date_add(d, F.col(pos)), F.lit(_dt.date(1970, 1, 1))).alias(date_col))
        elif c in measures:
            out_cols.append(measure(c))
        else:
            out_cols.append(F.col(c))
    if pos_col:
        out_cols.append(F.col(pos))
    return exploded.select(*out_cols)


def split_intervals(
    df: DataFrame,
    start_col: str,
    end_col: str,
    step_seconds: int | str = DAY_SECONDS,
    *,
    pos_col: str | None = None,
    spread: bool = False,
) -> DataFrame:
    """Cut ``[start, end)`` at boundaries that all rows share; one row per piece.

    ``step_seconds`` is a number of seconds or a duration text such as
    ``"1 days"`` or ``"15 minutes"``. Boundaries: whole-day steps lie on local
    midnights, counted in days from 1970-01-01 (a week starts on a Thursday, as
    ``window()`` has it); steps that divide a day on local midnight plus multiples of
    the step; other steps on multiples of the step from the epoch.

    Pieces keep all input columns with ``start_col``/``end_col`` replaced by
    the piece bounds and gain ``start_date``, ``end_date`` (and ``pos_col`` if
    given). Pieces of zero length are dropped. An open interval (``end``
    NULL) yields one piece from ``start`` with ``end`` NULL. Whole-day steps
    use calendar days, so pieces follow local midnights across DST changes.

    An interval is cut in two levels, first into runs of ``PIECES_AT_ONCE`` pieces and
    these into pieces, so no array grows with the length of an interval. With ``spread``
    the runs are dealt out anew in between: a few very long intervals (a century
    by hours) then fill all tasks, at the price of an exchange.
    """
    step_seconds = step_seconds_of(step_seconds)
    start, end = F.col(start_col), F.col(end_col)
    day0 = F.to_date(start)
    if step_seconds % DAY_SECONDS == 0:
        n_days = step_seconds // DAY_SECONDS
        epoch = F.lit("1970-01-01").cast("date")
        first_k = F.floor(F.datediff(day0, epoch) / F.lit(n_days))
        last_k = F.floor(F.datediff(F.to_date(end), epoch) / F.lit(n_days))

        def bound(k):
            return F.date_add(epoch, (k * F.lit(n_days)).cast("int")).cast("timestamp")

    else:
        origin = epoch_seconds(day0.cast("timestamp")) if DAY_SECONDS % step_seconds == 0 else F.lit(0)
        step = F.lit(int(step_seconds))
        first_k = F.floor((epoch_seconds(start) - origin) / step)
        last_k = F.floor((epoch_seconds(end) - origin) / step)

        def bound(k):
            return F.timestamp_seconds(origin + k * step)

    upto = F.greatest(F.coalesce(last_k, first_k), first_k)
    runs = df.select("*", F.explode(F.sequence(first_k, upto, F.lit(PIECES_AT_ONCE).cast("long"))).alias("_hl_run"))
    if spread:
        runs = runs.repartition(df.sparkSession.sparkContext.defaultParallelism, start_col, "_hl_run")
    run_end = F.least(F.col("_hl_run") + F.lit(PIECES_AT_ONCE - 1), upto)
    exploded = runs.select("*", F.explode(F.sequence(F.col("_hl_run"), run_end)).alias("_hl_k"))
    k = F.col("_hl_k")
    piece_start = F.greatest(start, bound(k))
    piece_end = F.least(bound(k + 1), end)
    pieces = (
        exploded.withColumn("_hl_ps", piece_start)
        .withColumn("_hl_pe", F.when(end.isNotNull(), piece_end))
        .where(
            (end.isNull() & (k == first_k))
            | (end.isNotNull() & (epoch_seconds("_hl_pe") > epoch_seconds("_hl_ps")))
        )
    )
    if pos_col:
        # renumber from 0 over the kept pieces
        pieces = pieces.withColumn(pos_col, (k - first_k).cast("int"))
    out = [
        F.col("_hl_ps").alias(start_col) if c == start_col
        else F.col("_hl_pe").alias(end_col) if c == end_col
        else F.col(c)
        for c in df.columns
    ]
    return pieces.select(
        *out,
        F.to_date("_hl_ps").alias("start_date"),
        F.to_date("_hl_pe").alias("end_date"),
        *([F.col(pos_col)] if pos_col else []),
    )
