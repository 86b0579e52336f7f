import datetime as dt
import random

from conftest import ts
from hayloft.operators.pairing import pair_events
from hayloft.plans import silver

T0 = ts("2023-06-01 06:00:00")


def _starts(spark, items):
    return spark.createDataFrame(items, "k int, start_time timestamp, sid int")


def _ends(spark, items):
    return spark.createDataFrame(items, "k int, end_time timestamp, eid int")


def test_gap_bounds_are_strict_whole_seconds(spark):
    starts = _starts(spark, [(1, T0, 1)])
    ends = _ends(spark, [
        (1, T0 + dt.timedelta(seconds=1), 10),
        (1, T0 + dt.timedelta(seconds=43199), 11),
        (1, T0 + dt.timedelta(seconds=43200), 12),
        (1, T0 - dt.timedelta(seconds=5), 13),
        (1, T0 + dt.timedelta(seconds=43199, microseconds=900000), 14),
        (2, T0 + dt.timedelta(seconds=10), 15),
    ])
    got = sorted(r.eid for r in pair_events(starts, ends, ["k"]).collect())
    assert got == [10, 11, 14]


def test_all_matches_are_kept(spark):
    starts = _starts(spark, [(1, T0, 1), (1, T0 + dt.timedelta(hours=1), 2)])
    ends = _ends(spark, [(1, T0 + dt.timedelta(hours=2), 10), (1, T0 + dt.timedelta(hours=3), 11)])
    got = sorted((r.sid, r.eid) for r in pair_events(starts, ends, ["k"]).collect())
    assert got == [(1, 10), (1, 11), (2, 10), (2, 11)]


def test_bucketed_join_equals_brute_force(spark):
    rnd = random.Random(11)
    s_items, e_items = [], []
    for i in range(300):
        k = 0 if i % 3 else rnd.randrange(1, 4)  # hot key 0
        s_items.append((k, T0 + dt.timedelta(seconds=rnd.randrange(0, 4 * 86400)), i))
        e_items.append((k, T0 + dt.timedelta(seconds=rnd.randrange(0, 4 * 86400)), 1000 + i))
    for gap in (3600, 43200):
        got = sorted((r.sid, r.eid) for r in pair_events(
            _starts(spark, s_items), _ends(spark, e_items), ["k"], max_gap_seconds=gap).collect())
        want = sorted(
            (s[2], e[2]) for s in s_items for e in e_items
            if s[0] == e[0] and s[1] < e[1]
            and int(e[1].timestamp()) - int(s[1].timestamp()) < gap
        )
        assert got == want


def _load_frames(spark, start_rows, done_rows):
    start = spark.createDataFrame(
        start_rows,
        "farm_license string, device_number int, ration_id int, seq_nr int, time timestamp, "
        "year_month string, req_weight int, start_weight int")
    done = spark.createDataFrame(
        done_rows,
        "farm_license string, device_number int, ration_id int, seq_nr int, time timestamp, "
        "total_weight int, results array<struct<feedId:int,reqWeight:int,weight:int,completed:boolean>>")
    return start, done


def test_loading_activity_zero_duration_speed_is_null(spark):
    start, done = _load_frames(
        spark,
        [("f", 1, 7, 1, T0, "2023-06", 1000, 10)],
        [("f", 1, 7, 1, T0 + dt.timedelta(milliseconds=300), 900, None),
         ("f", 1, 7, 1, T0 + dt.timedelta(seconds=100), 1000, None)],
    )
    act = silver.loading_activity(start, done)
    got = sorted((r.duration_s, r.loading_speed_ration_g_per_s) for r in act.collect())
    assert got == [(0, None), (100, 10.0)]
    ids = {r.loading_uuid for r in act.collect()}
    assert len(ids) == 1 and None not in ids  # one start → one id shared by its ends


def test_loading_activity_contract(spark):
    from hayloft import schemas
    from hayloft.plans.contract import check_schema
    start, done = _load_frames(spark, [("f", 1, 7, 1, T0, "2023-06", 1000, 10)],
                               [("f", 1, 7, 1, T0 + dt.timedelta(seconds=60), 900, None)])
    check_schema(silver.loading_activity(start, done), schemas.SILVER_LOADING_ACTIVITY)
    check_schema(silver.loading_activity(start, done, id_mode="uuid"), schemas.SILVER_LOADING_ACTIVITY)


def test_loading_activity_needs_all_keys(spark):
    start, done = _load_frames(spark, [("f", 1, 7, 1, T0, "2023-06", 1000, 10)],
                               [("f", 1, 7, 2, T0 + dt.timedelta(seconds=60), 900, None),
                                ("f", 2, 7, 1, T0 + dt.timedelta(seconds=60), 900, None)])
    assert silver.loading_activity(start, done).count() == 0
