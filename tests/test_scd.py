import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import rows, ts
from hayloft.functions.time import OPEN_END
from hayloft.operators.scd import scd2


def test_scd2_hand_checked(spark):
    data = [
        ("north", "2024-02-28 23:00:00", "idle", 3),
        ("north", "2024-02-29 01:30:00", "idle", 3),   # no change
        ("north", "2024-02-29 01:30:01", "idle", 4),
        ("north", "2024-03-01 00:00:00", "busy", 4),
        ("north", "2024-03-02 00:00:00", "idle", 4),   # back again: a period of its own
        ("south", "2024-02-29 12:00:00", "busy", 9),
    ]
    df = spark.createDataFrame(data, "farm string, time string, state string, level int").withColumn(
        "time", F.col("time").cast("timestamp")
    )
    out = scd2(df, ["farm"], ["state", "level"], "time")
    assert out.columns == ["farm", "start_time", "state", "level", "end_time", "duration_s"]
    got = [tuple(r.values()) for r in rows(out, "farm", "start_time")]
    last = int((OPEN_END - ts("2024-03-02")).total_seconds())
    assert got == [
        ("north", ts("2024-02-28 23:00:00"), "idle", 3, ts("2024-02-29 01:30:01"), 9001),
        ("north", ts("2024-02-29 01:30:01"), "idle", 4, ts("2024-03-01"), 81 * 1000 - 1),
        ("north", ts("2024-03-01"), "busy", 4, ts("2024-03-02"), 86400),
        ("north", ts("2024-03-02"), "idle", 4, OPEN_END, last),
        ("south", ts("2024-02-29 12:00:00"), "busy", 9, OPEN_END, last + 3 * 43200),
    ]


def test_scd2_null_times_come_first_like_plain_lag_and_lead(spark):
    base = ts("2023-01-01")
    recs = [(1, None, "A"), (1, None, "B"), (1, base + dt.timedelta(hours=1), "B"), (1, base + dt.timedelta(hours=2), "A"),
            (2, None, "A"), (2, base, "A"), (2, base + dt.timedelta(days=9), "C"), (3, None, "Z"), (None, base, "N")]
    df = spark.createDataFrame(recs, "k int, time timestamp, v string")
    df.createOrReplaceTempView("scd_null_times")
    plain = spark.sql("""
        SELECT k, time, v, lead(time, 1, TIMESTAMP'2099-12-31 23:59:59') OVER (PARTITION BY k ORDER BY time, v) AS e
        FROM (SELECT *, lag(v) OVER (PARTITION BY k ORDER BY time, v) AS p FROM scd_null_times) WHERE p IS NULL OR p <> v""")
    want = sorted((tuple(r) for r in plain.collect()), key=str)
    for bucket in (60, 3600, 86400 * 30):
        out = scd2(df, ["k"], ["v"], bucket_seconds=bucket)
        assert sorted(((r.k, r.start_time, r.v, r.end_time) for r in out.collect()), key=str) == want


def test_scd2_ties_and_repeated_rows(spark):
    base = ts("2023-01-01")
    recs = [(1, base, v, n) for v in "AB" for n in (3, 1, 2)] + [(1, base, "A", 3)]
    df = spark.createDataFrame(recs, "k int, time timestamp, v string, n int")
    got = [sorted((r.v, r.n, r.end_time) for r in scd2(x, ["k"], ["v"]).collect()) for x in (df, df.repartition(3))]
    assert got[0] == got[1] and [(v, e) for v, _, e in got[0]] == [("A", base), ("B", OPEN_END)]


def test_scd2_scans_its_input_once(spark, tmp_path):
    recs = [(i % 3, ts("2023-01-01") + dt.timedelta(hours=i), "AB"[i % 2]) for i in range(60)]
    spark.createDataFrame(recs, "k int, time timestamp, v string").write.parquet(str(tmp_path / "t"))
    df = scd2(spark.read.parquet(str(tmp_path / "t")), ["k"], ["v"])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("+- == Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final and "Broadcast" not in final


def test_scd2_keeps_columns_and_overwrites_end(spark):
    df = spark.createDataFrame(
        [("f", ts("2023-01-01 10:00:00"), "a", ts("2023-01-05"), 5),
         ("f", ts("2023-01-02 10:00:00"), "a", ts("2023-01-06"), 6),
         ("f", ts("2023-01-03 10:00:00"), "b", ts("2023-01-07"), 7)],
        "farm string, start_time timestamp, v string, end_time timestamp, duration_s bigint",
    )
    out = scd2(df, ["farm"], ["v"], orderby_col="start_time")
    assert out.columns == ["farm", "start_time", "v", "end_time", "duration_s"]
    got = rows(out, "start_time")
    assert [(r["v"], r["end_time"]) for r in got] == [("a", ts("2023-01-03 10:00:00")), ("b", OPEN_END)]
    assert got[0]["duration_s"] == 2 * 86400


def test_scd2_null_values_are_skipped_in_fingerprint(spark):
    df = spark.createDataFrame(
        [(1, ts("2023-01-01"), "A", None), (1, ts("2023-01-02"), None, "A"), (1, ts("2023-01-03"), "B", None)],
        "k int, time timestamp, a string, b string",
    )
    out = rows(scd2(df, ["k"], ["a", "b"]), "start_time")
    assert [r["start_time"] for r in out] == [ts("2023-01-01"), ts("2023-01-03")]


def _brute_scd2(records):
    """Plain per-key scan: lag -> keep changes -> lead over kept."""
    out = []
    by_key = {}
    for k, t, v in records:
        by_key.setdefault(k, []).append((t, v))
    for k, seq in by_key.items():
        seq.sort()
        kept = [seq[i] for i in range(len(seq)) if i == 0 or seq[i][1] != seq[i - 1][1]]
        for i, (t, v) in enumerate(kept):
            end = kept[i + 1][0] if i + 1 < len(kept) else OPEN_END
            out.append((k, t, v, end))
    return sorted(out, key=lambda r: (r[0], r[1], r[2]))


def test_scd2_matches_plain_scan_across_many_buckets(spark):
    rnd = random.Random(7)
    base = ts("2023-03-01")
    records = []
    for k in range(5):
        n = 400 if k == 0 else 40  # key 0 is hot
        for _ in range(n):
            t = base + dt.timedelta(seconds=rnd.randrange(0, 6 * 3600))
            records.append((k, t, rnd.choice("AAB")))
    # distinct (key, time) so the order is total
    seen, uniq = set(), []
    for r in records:
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            uniq.append(r)
    df = spark.createDataFrame(uniq, "k int, time timestamp, v string")
    want = _brute_scd2(uniq)
    for bucket in (1, 60, 600, 3600, 86400):
        out = scd2(df, ["k"], ["v"], bucket_seconds=bucket)
        got = sorted((r["k"], r["start_time"], r["v"], r["end_time"]) for r in out.collect())
        assert got == want, f"bucket={bucket}"


def test_scd2_validity_is_contiguous(spark):
    rnd = random.Random(3)
    base = ts("2023-01-01")
    recs = [(k, base + dt.timedelta(minutes=i * 7 + k), rnd.choice("XY")) for k in range(3) for i in range(200)]
    out = scd2(spark.createDataFrame(recs, "k int, time timestamp, v string"), ["k"], ["v"],
               bucket_seconds=300)
    got = sorted((r["k"], r["start_time"], r["end_time"]) for r in out.collect())
    for (k1, _, e1), (k2, s2, _) in zip(got, got[1:]):
        if k1 == k2:
            assert e1 == s2


def test_scd2_a_million_rows_at_one_instant_are_collapsed_before_the_window(spark):
    """Also a million rows without a time: what reaches one task is a row per state."""
    states = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("id") % 3 + 1).cast("int"))
    instant = F.when(F.col("id") % 2 == 0, F.lit("2023-01-01 05:00:00").cast("timestamp"))
    df = spark.range(2_000_000).select(F.lit(1).alias("k"), instant.alias("time"), states.alias("v"), "id")
    out = scd2(df, ["k"], ["v"])
    got = sorted((str(r.start_time), r.v, str(r.end_time)) for r in out.collect())
    at = "2023-01-01 05:00:00"
    assert got == sorted([("None", "A", "None"), ("None", "B", "None"), ("None", "C", at), (at, "A", at), (at, "B", at), (at, "C", str(OPEN_END))])
    final = out._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert "partial_min_by" in final
