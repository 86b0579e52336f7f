"""Property tests (hypothesis): gap fill, pairing, interval split, SCD2 validity."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hayloft.operators.intervals import fill_days, split_intervals, step_seconds_of
from hayloft.operators.pairing import pair_events
from hayloft.operators.scd import scd2

BASE = dt.datetime(2023, 3, 20)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40), st.integers(1, 9)),
                min_size=1, max_size=30, unique_by=lambda x: (x[0], x[1])))
def test_fill_days_dense_and_sum_preserving(spark, items):
    rows = [(k, (BASE + dt.timedelta(days=d)).date(), float(v)) for k, d, v in items]
    out = fill_days(spark.createDataFrame(rows, "k string, date date, m double"), ["k"], "date", ["m"]).collect()
    for key in {r[0] for r in rows}:
        days = sorted(r.date for r in out if r.k == key)
        want = sorted(r[1] for r in rows if r[0] == key)
        assert days == [want[0] + dt.timedelta(days=i) for i in range((want[-1] - want[0]).days + 1)]
    assert sum(r.m or 0 for r in out) == sum(r[2] for r in rows)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 200_000)), min_size=1, max_size=25),
       st.lists(st.tuples(st.integers(0, 2), st.integers(0, 200_000)), min_size=1, max_size=25))
def test_pairing_is_subset_of_equi_join(spark, starts, ends):
    s = spark.createDataFrame([(k, BASE + dt.timedelta(seconds=t), i) for i, (k, t) in enumerate(starts)],
                              "k int, start_time timestamp, sid int")
    e = spark.createDataFrame([(k, BASE + dt.timedelta(seconds=t), i) for i, (k, t) in enumerate(ends)],
                              "k int, end_time timestamp, eid int")
    got = sorted((r.sid, r.eid) for r in pair_events(s, e, ["k"], max_gap_seconds=3600).collect())
    want = sorted((i, j) for i, (k1, t1) in enumerate(starts) for j, (k2, t2) in enumerate(ends)
                  if k1 == k2 and t1 < t2 and t2 - t1 < 3600)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5 * 86400), st.integers(0, 3 * 86400)), min_size=1, max_size=15),
       st.sampled_from([3600, 86400, "6 hours"]))
def test_split_pieces_cover_interval(spark, items, step):
    rows = [(i, BASE + dt.timedelta(seconds=a), BASE + dt.timedelta(seconds=a + n)) for i, (a, n) in enumerate(items)]
    df = spark.createDataFrame(rows, "id int, start_time timestamp, end_time timestamp")
    out = split_intervals(df, "start_time", "end_time", step).collect()
    width = step_seconds_of(step)
    for i, s, e in rows:
        pieces = sorted((r.start_time, r.end_time) for r in out if r.id == i)
        if int(e.timestamp()) - int(s.timestamp()) <= 0:
            assert pieces == []
            continue
        assert pieces[0][0] == s and pieces[-1][1] == e
        assert all(a[1] == b[0] for a, b in zip(pieces, pieces[1:]))
        assert all((p1 - p0).total_seconds() <= width for p0, p1 in pieces)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20_000), st.sampled_from("xyz")),
                min_size=1, max_size=40, unique_by=lambda x: (x[0], x[1])))
def test_scd2_periods_disjoint_and_contiguous(spark, items):
    rows = [(k, BASE + dt.timedelta(seconds=t), v) for k, t, v in items]
    out = scd2(spark.createDataFrame(rows, "k int, time timestamp, v string"), ["k"], ["v"],
               bucket_seconds=600).collect()
    for key in {r[0] for r in rows}:
        periods = sorted((r.start_time, r.end_time, r.v) for r in out if r.k == key)
        assert all(a[1] == b[0] and a[2] != b[2] for a, b in zip(periods, periods[1:]))
        assert periods[0][0] == min(r[1] for r in rows if r[0] == key)
