import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import d, ts
from hayloft.functions.time import OPEN_END
from hayloft.operators.asof import point_in_time_join

DIM_SCHEMA = "farm string, start_time timestamp, end_time timestamp, name string"


def _dim(spark):
    return spark.createDataFrame(
        [("f", ts("2023-01-02 00:00:00"), ts("2023-01-05 00:00:00"), "first"),
         ("f", ts("2023-01-05 00:00:00"), ts("2023-01-07 08:00:00"), "second"),
         ("f", ts("2023-01-07 08:00:00"), OPEN_END, "third")],
        DIM_SCHEMA,
    )


def _facts(spark, days):
    return spark.createDataFrame([("f", d(x), i) for i, x in enumerate(days)] + [(None, d("2023-01-03"), 99)],
                                 "farm string, date date, n int")


DAYS = ["2023-01-01", "2023-01-02", "2023-01-04", "2023-01-05", "2023-01-07", "2023-01-08"]


def _names(out):
    return {(r.farm, str(r.date)): r.dim_name for r in out.collect()}


def test_closed_open_bounds(spark):
    out = point_in_time_join(_facts(spark, DAYS), _dim(spark), ["farm"], "date", {"name": "dim_name"}, bounds="[)")
    got = _names(out)
    assert got[("f", "2023-01-01")] is None          # before the first validity
    assert got[("f", "2023-01-02")] == "first"       # equal to start: inside
    assert got[("f", "2023-01-05")] == "second"      # equal to end of first: next one
    assert got[("f", "2023-01-07")] == "second"      # name set at 08:00 applies from the next day
    assert got[("f", "2023-01-08")] == "third"
    assert got[(None, "2023-01-03")] is None          # NULL key never matches
    assert out.count() == len(DAYS) + 1


def test_open_closed_bounds(spark):
    out = point_in_time_join(_facts(spark, DAYS), _dim(spark), ["farm"], "date", {"name": "dim_name"}, bounds="(]")
    got = _names(out)
    assert got[("f", "2023-01-02")] is None          # equal to start: outside
    assert got[("f", "2023-01-04")] == "first"
    assert got[("f", "2023-01-05")] == "first"       # equal to end: inside
    assert got[("f", "2023-01-07")] == "second"
    assert got[("f", "2023-01-08")] == "third"


def test_gap_in_validity_gives_null(spark):
    dim = spark.createDataFrame([("f", ts("2023-01-01"), ts("2023-01-03"), "a"),
                                 ("f", ts("2023-01-05"), OPEN_END, "b")], DIM_SCHEMA)
    facts = _facts(spark, ["2023-01-02", "2023-01-04", "2023-01-06"])
    got = _names(point_in_time_join(facts, dim, ["farm"], "date", {"name": "dim_name"}))
    assert [got[("f", x)] for x in ("2023-01-02", "2023-01-04", "2023-01-06")] == ["a", None, "b"]


def test_two_devices_latest_start_wins(spark):
    dim = spark.createDataFrame(
        [("f", 1, ts("2023-01-01"), OPEN_END, "dev1"),
         ("f", 2, ts("2023-01-03"), ts("2023-01-05"), "dev2-a"),
         ("f", 2, ts("2023-01-05"), OPEN_END, "dev2-b")],
        "farm string, device int, start_time timestamp, end_time timestamp, name string")
    facts = _facts(spark, ["2023-01-02", "2023-01-04", "2023-01-06"])
    out = point_in_time_join(facts, dim, ["farm"], "date", {"name": "dim_name"}, bounds="(]", tie_break=["device"])
    got = _names(out)
    assert [got[("f", x)] for x in ("2023-01-02", "2023-01-04", "2023-01-06")] == ["dev1", "dev2-a", "dev2-b"]
    assert out.count() == 4  # no fan-out


def _brute(facts, dims, bounds):
    out = []
    for k, t, fid in facts:
        best = None
        for dk, s, e, v in dims:
            if k is None or dk != k:
                continue
            ok = (s <= t < e) if bounds == "[)" else (s < t <= e)
            if ok and (best is None or s > best[0]):
                best = (s, v)
        out.append((fid, best[1] if best else None))
    return sorted(out)


def test_timestamp_facts_match_brute_force_across_buckets(spark):
    rnd = random.Random(5)
    base = ts("2023-02-01")
    dims, facts = [], []
    for k in ("a", "b", "c"):
        t = base
        for i in range(60 if k == "a" else 10):
            nxt = t + dt.timedelta(minutes=rnd.randrange(1, 240))
            dims.append((k, t, nxt, f"{k}{i}"))
            t = nxt
        dims[-1] = (k, dims[-1][1], OPEN_END, dims[-1][3])
    for i in range(400):
        facts.append((rnd.choice(["a", "a", "b", "c", "z", None]),
                      base + dt.timedelta(minutes=rnd.randrange(-60, 60 * 24 * 10)), i))
    fdf = spark.createDataFrame(facts, "farm string, t timestamp, fid int")
    ddf = spark.createDataFrame(dims, DIM_SCHEMA)
    for bounds in ("[)", "(]"):
        for parts in (1, 7, 40):
            out = point_in_time_join(fdf, ddf, ["farm"], "t", {"name": "v"}, bounds=bounds, parts=parts)
            assert sorted((r.fid, r.v) for r in out.collect()) == _brute(facts, dims, bounds)


def _brute_latest(facts, dims, bounds):
    """Fan-out join, then the latest start (then device, then end) survives."""
    out = []
    for k, day, fid in facts:
        t = dt.datetime.combine(day, dt.time())
        best = None
        for dk, dev, s, e, v in dims:
            if k is None or dk != k:
                continue
            if (s <= t < e) if bounds == "[)" else (s < t <= e):
                cand = (s, dev, e, v)
                best = cand if best is None or cand[:3] > best[:3] else best
        out.append((fid, best[3] if best else None))
    return sorted(out)


def test_daily_facts_match_brute_force_with_devices(spark):
    rnd = random.Random(9)
    base = ts("2023-05-01")
    dims = []
    for k in ("a", "b"):
        for dev in (1, 2):
            t = base + dt.timedelta(hours=rnd.randrange(0, 48))
            for i in range(30):
                # starts at midnight now and then, several per day sometimes
                step = dt.timedelta(days=rnd.randrange(0, 3), hours=rnd.choice([0, 0, 5, 13]))
                nxt = t + step if step else t + dt.timedelta(hours=7)
                dims.append((k, dev, t, nxt, f"{k}{dev}-{i}"))
                t = nxt
            dims[-1] = dims[-1][:3] + (OPEN_END, dims[-1][4])
    facts = [(rnd.choice(["a", "b", "c", None]), (base + dt.timedelta(days=rnd.randrange(-2, 60))).date(), i)
             for i in range(300)]
    fdf = spark.createDataFrame(facts, "farm string, date date, fid int")
    ddf = spark.createDataFrame(dims, "farm string, device int, start_time timestamp, end_time timestamp, name string")
    for bounds in ("[)", "(]"):
        out = point_in_time_join(fdf, ddf, ["farm"], "date", {"name": "v"}, bounds=bounds, tie_break=["device"])
        assert sorted((r.fid, r.v) for r in out.collect()) == _brute_latest(facts, dims, bounds)


def test_overlapping_devices_closed_period_falls_back_to_the_open_one(spark):
    dim = spark.createDataFrame(
        [("f", 1, ts("2023-01-01"), OPEN_END, "dev1"), ("f", 2, ts("2023-01-03"), ts("2023-01-04"), "dev2")],
        "farm string, device int, start_time timestamp, end_time timestamp, name string")
    days = ["2023-01-02", "2023-01-03", "2023-01-10"]
    facts = _facts(spark, days * 2)  # several facts a key and day
    for bounds, want in (("[)", ["dev1", "dev2", "dev1"]), ("(]", ["dev1", "dev1", "dev1"])):
        out = point_in_time_join(facts, dim, ["farm"], "date", {"name": "dim_name"}, bounds=bounds, tie_break=["device"])
        got = _names(out)
        assert [got[("f", x)] for x in days] == want
        assert out.count() == 2 * len(days) + 1
    times = facts.withColumn("date", F.col("date").cast("timestamp"))
    out = point_in_time_join(times, dim, ["farm"], "date", {"name": "dim_name"}, tie_break=["device"], parts=5)
    assert sorted((str(r.date)[:10], r.dim_name) for r in out.where("farm = 'f'").collect()) == sorted(
        zip(days * 2, ["dev1", "dev2", "dev1"] * 2))


def test_one_row_per_day_facts_give_the_same(spark):
    dim = spark.createDataFrame(
        [("f", 1, ts("2023-01-01"), OPEN_END, "dev1"), ("f", 2, ts("2023-01-03"), ts("2023-01-04"), "dev2"),
         ("g", 1, ts("2023-01-05"), OPEN_END, "g1")],
        "farm string, device int, start_time timestamp, end_time timestamp, name string")
    days = [d("2023-01-01") + dt.timedelta(days=i) for i in range(8)]
    facts = spark.createDataFrame([(k, x, i) for k in ("f", "g", "none", None) for i, x in enumerate(days)],
                                  "farm string, date date, n int")
    for bounds in ("[)", "(]"):
        for tie in ([], ["device"]):
            some = dim if tie else dim.where("device = 1")
            plain, once = (sorted(map(str, point_in_time_join(facts, some, ["farm"], "date", {"name": "v"}, bounds=bounds,
                                                              tie_break=tie, one_per_time=o).collect())) for o in (False, True))
            assert plain == once and len(once) == 32


def test_a_busy_week_of_one_key_falls_into_many_parts(spark):
    """A third of all rows belongs to one key, all within a week: no part holds much more than its share."""
    from hayloft.operators import ordered

    base = ts("2023-05-01")
    hot = [("hot", base + dt.timedelta(seconds=i * 60)) for i in range(10_000)]
    rest = [(f"k{i % 500}", base + dt.timedelta(hours=i)) for i in range(20_000)]
    df = spark.createDataFrame(hot + rest, "k string, t timestamp")
    dealt = ordered.dealt_by_range(df, ["k"], ["t"], 30)
    sizes = [r["count"] for r in dealt.groupBy(ordered.BUCKET).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 2000
    assert dealt.where("k = 'hot'").select(ordered.BUCKET).distinct().count() >= 8
    spans = dealt.where("k = 'hot'").groupBy(ordered.BUCKET).agg(F.min("t").alias("a"), F.max("t").alias("b")).orderBy(ordered.BUCKET).collect()
    assert all(x.b < y.a for x, y in zip(spans, spans[1:]))
