from conftest import d, rows, ts
from hayloft.operators.intervals import fill_days, split_intervals


def _daily(spark, items):
    return spark.createDataFrame(items, "k string, date date, m double, name string")


def test_fill_days_cases(spark):
    df = _daily(spark, [
        ("a", d("2023-01-01"), 1.234, "x"),
        ("a", d("2023-01-02"), 2.0, "x"),     # consecutive
        ("a", d("2023-01-05"), 3.0, "y"),     # 3-day gap before it
        ("b", d("2023-01-01"), 4.0, "z"),     # single day (last day of its key)
        ("c", d("2023-01-01"), 5.0, "p"),
        ("c", d("2023-01-01"), 6.0, "q"),     # duplicate key and day
        ("c", d("2023-01-02"), 7.0, "r"),
    ])
    out = rows(fill_days(df, ["k"], "date", ["m"], pos_col="pos"), "k", "date", "m")
    got = [(r["k"], str(r["date"]), r["m"], r["name"], r["pos"]) for r in out]
    assert got[:6] == [
        ("a", "2023-01-01", 1.23, "x", 0),
        ("a", "2023-01-02", 2.0, "x", 0),
        ("a", "2023-01-03", None, "x", 1),
        ("a", "2023-01-04", None, "x", 2),
        ("a", "2023-01-05", 3.0, "y", 0),
        ("b", "2023-01-01", 4.0, "z", 0),
    ]
    c_rows = [g for g in got if g[0] == "c"]
    assert len(c_rows) == 2 and c_rows[1][1:3] == ("2023-01-02", 7.0)
    assert c_rows[0][1] == "2023-01-01" and c_rows[0][2] in (5.0, 6.0)


def test_fill_days_is_dense_and_preserves_sums(spark):
    df = _daily(spark, [("a", d("2023-03-20"), 1.0, "x"), ("a", d("2023-03-30"), 2.0, "x"),
                        ("a", d("2023-04-02"), 4.0, "x")])
    out = fill_days(df, ["k"], "date", ["m"])
    dates = sorted(r.date for r in out.collect())
    assert len(dates) == (dates[-1] - dates[0]).days + 1
    assert sum(r.m or 0 for r in out.collect()) == 7.0
    assert not out.schema["date"].nullable


def test_fill_days_same_in_two_zones(spark):
    df = _daily(spark, [("a", d("2023-03-24"), 1.0, "x"), ("a", d("2023-03-28"), 2.0, "y"),
                        ("a", d("2023-10-27"), 3.0, "z"), ("a", d("2023-10-31"), 4.0, "w")])
    results = []
    for zone in ("UTC", "Europe/Berlin"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        results.append(rows(fill_days(df, ["k"], "date", ["m"]), "date"))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert results[0] == results[1]


def _intervals(spark, items):
    return spark.createDataFrame(items, "id int, start_time timestamp, end_time timestamp")


def test_split_intervals_day(spark):
    df = _intervals(spark, [
        (1, ts("2023-01-01 10:00"), ts("2023-01-01 12:00")),   # inside one day
        (2, ts("2023-01-01 22:00"), ts("2023-01-03 02:00")),   # over two midnights
        (3, ts("2023-01-01 22:00"), ts("2023-01-02 00:00")),   # ends at midnight
        (4, ts("2023-01-01 05:00"), None),                     # open
        (5, ts("2023-01-01 05:00"), ts("2023-01-01 05:00")),   # zero length
    ])
    out = rows(split_intervals(df, "start_time", "end_time", 86400, pos_col="pos"), "id", "pos")
    got = [(r["id"], str(r["start_time"]), str(r["end_time"]), r["pos"]) for r in out]
    assert got == [
        (1, "2023-01-01 10:00:00", "2023-01-01 12:00:00", 0),
        (2, "2023-01-01 22:00:00", "2023-01-02 00:00:00", 0),
        (2, "2023-01-02 00:00:00", "2023-01-03 00:00:00", 1),
        (2, "2023-01-03 00:00:00", "2023-01-03 02:00:00", 2),
        (3, "2023-01-01 22:00:00", "2023-01-02 00:00:00", 0),
        (4, "2023-01-01 05:00:00", "None", 0),
    ]
    assert {r["start_date"] for r in out if r["id"] == 2} == {d("2023-01-01"), d("2023-01-02"), d("2023-01-03")}


def test_split_intervals_hour(spark):
    df = _intervals(spark, [(1, ts("2023-01-01 10:30"), ts("2023-01-01 12:15"))])
    out = rows(split_intervals(df, "start_time", "end_time", 3600, pos_col="pos"), "pos")
    assert [(str(r["start_time"])[11:16], str(r["end_time"])[11:16], r["pos"]) for r in out] == [
        ("10:30", "11:00", 0), ("11:00", "12:00", 1), ("12:00", "12:15", 2)]
