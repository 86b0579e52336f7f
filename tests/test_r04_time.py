"""What the layered run and the KPI series do less of, or at once."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from hayloft.plans import checks, gold
from hayloft.session import options, together
from hayloft.sources.files import write_table


def _final(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_independent_steps_run_at_once_under_one_set_of_options(spark):
    key = "spark.sql.parquet.compression.codec"
    before, meet = spark.conf.get(key), threading.Barrier(2, timeout=60)

    def step(n):
        meet.wait()  # both are there
        with options(spark, {key: "zstd"}):
            meet.wait()
        if n:
            meet.wait()
        else:
            assert spark.conf.get(key) == "zstd"
            meet.wait()
        return spark.range(n + 1).count()

    assert together(spark, [lambda: step(0), lambda: step(1)]) == [1, 2]
    assert spark.conf.get(key) == before
    with pytest.raises(ZeroDivisionError):
        together(spark, [lambda: 1 / 0, lambda: 1])
    assert spark.conf.get(key) == before


def test_tables_have_no_checksum_files(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(spark.range(9).selectExpr("id", "id % 3 AS part"), path, partition_by=["part"]) == 9
    names = [f for _, _, files in os.walk(path) for f in files]
    assert len([f for f in names if f.endswith(".parquet")]) == 3 and not [f for f in names if f.endswith(".crc")]
    assert spark.read.parquet(path).count() == 9


def _plain(fact, keys):
    """What the checks count, day by day."""
    rows = [(tuple(r[k] for k in keys), r.date, r.kg) for r in fact.collect()]
    times = {}
    for key, day, _ in rows:
        times[key, day] = times.get((key, day), 0) + 1
    lost = 0
    for key in {k for k, _ in times}:
        days = {d for k, d in times if k == key and d is not None}
        lost += (max(days) - min(days)).days + 1 - len(days) if days else 0
    return {
        "lost": lost,
        "twice": sum(n for n in times.values() if n > 1),
        "nulls": sum(d is None for _, d, _ in rows),
        "measured": {(k, d) for k, d, kg in rows if kg is not None and d is not None},
    }


@pytest.mark.parametrize("seed", range(4))
def test_days_gathered_as_bits_are_judged_as_days_are(spark, tmp_path, seed):
    """Runs, gaps, repeated days, NULL keys and days, before 1970 and over the edges of what is gathered."""
    day0 = dt.date(1969, 11, 20)
    h = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(100))
    fact = spark.range(1500).select(
        F.when(F.col("id") % 5 < 4, (F.col("id") % 5).cast("string")).alias("farm"),
        F.when(h != 7, F.date_add(F.lit(day0), (F.col("id") / 5).cast("int") + F.when(h < 3 * seed, 90).otherwise(0))).alias("date"),
        F.when(h > 60, F.lit(1.0)).alias("kg"),
    )
    if seed == 0:
        fact = fact.where("date IS NOT NULL")
    fact.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    ddl, want = "date DATE NOT NULL", _plain(fact, ["farm"])
    notable = checks._notable_days(fact, ["farm"], ["kg"], ddl)
    assert str(tmp_path) not in "".join(notable.inputFiles())
    assert checks._gap_days(notable, ["farm"]).count() == want["lost"]
    got = {r.constraint: r.n_rows for r in checks.counted_findings(notable, ddl, ["farm", "date"]).collect()}
    assert got == {k: n for k, n in (("date NOT NULL", want["nulls"]), ("unique farm, date", want["twice"])) if n}
    held = [((r.farm,), r.date) for r in notable.where(f"{checks.MEASURED} AND date IS NOT NULL").collect()]
    assert len(held) == len(set(held)) and set(held) == want["measured"]


def test_filled_days_are_combined_before_the_shuffle(spark, tmp_path, monkeypatch):
    """What reaches it is a row per key and DAYS_AT_ONCE days, not a row per day."""
    plans, kept = [], checks._kept
    monkeypatch.setattr(checks, "_kept", lambda days: plans.append(_final(days)) or kept(days))
    empty = F.lit(None).cast("double").alias("kg")
    fact = spark.range(3000).select(F.lit("n").alias("farm"), F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("date"), empty)
    assert checks._notable_days(fact, ["farm"], ["kg"], "date DATE NOT NULL").count() == 0
    assert len(plans) == 1 and "REPARTITION_BY_COL" not in plans[0] and "partial_bit_or" in plans[0]


def test_days_of_both_sides_are_compared_without_a_sort(spark):
    """NULL keys are values, repeated days count once, days without a measure are not held."""
    day = dt.date(2024, 2, 28)
    seen = spark.createDataFrame([("a", day), ("a", day), (None, day), ("b", day), ("b", None)], "k string, date date")
    held = spark.createDataFrame([("a", day, 1.0), (None, day, 2.0), ("b", day, None), ("c", day, 3.0), ("c", day, 3.0), (None, None, 1.0)], "k string, date date, kg double")
    out = checks.reconcile_days(seen, held, ["k"], ["kg"])
    assert out.columns == ["k", "date", "finding"]
    assert sorted(map(tuple, out.collect())) == [("b", day, "missing"), ("c", day, "unobserved")]
    assert "Join" not in _final(out) and "Sort" not in _final(out)


def test_observed_days_are_dealt_once(spark):
    """Their grouping is that of the comparison."""
    line = "array<struct<feedId:int,reqWeight:int,weight:int,completed:boolean>>"
    loads = spark.range(40).selectExpr(
        "'f' AS farm_license", "timestamp'2024-01-01' AS start_time", "'u' AS loading_uuid", "1 AS seq_nr", "1 AS ration_id", "1D AS loading_speed_ration_g_per_s",
        "9L AS duration_s", "5 AS loaded_weight_ration_g", f"CAST(array(struct(1, 2, 3, true), struct(2, 2, 3, true)) AS {line}) AS results")
    fact = spark.range(1).selectExpr("'f' AS farm_license", "1 AS feed_id", "date'2024-01-01' AS date", "1D AS kg")
    out = checks.reconcile_days(gold.FEED.observed_days(loads), fact, gold.FEED.keys, ["kg"])
    assert [tuple(r) for r in out.collect()] == [("f", 2, dt.date(2024, 1, 1), "missing")]
    assert _final(out).count("Exchange hashpartitioning") == 1
