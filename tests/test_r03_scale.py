"""What the layered run, the KPI series and the as-of lookup read and move once."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from conftest import ts
from hayloft import schemas
from hayloft.operators.asof import point_in_time_join
from hayloft.operators.scd import scd2
from hayloft.plans import catalog, checks, kpi, standins

SF = "/root/testdata/sf0.001"


def _final(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


@pytest.mark.parametrize("varied", [False, True])
def test_messages_of_orders_are_those_of_each_kind(spark, varied):
    start = standins.load_start_messages(spark, SF, varied=varied)
    if not varied:
        start = start.withColumn("time", F.col("time") - F.expr("INTERVAL 90 MINUTES"))
    want = (
        standins.load_done_messages(spark, SF, varied=varied)
        .unionByName(start)
        .unionByName(standins.kitchen_feed_name_payloads(spark, SF))
        .unionByName(standins.ration_name_payloads(spark, SF))
    )
    got = standins.order_messages(spark, SF, varied=varied).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_delivered_csv_is_compressed(spark):
    path = catalog._bronze_csv(spark, SF, standins.robot_config_payloads(spark, SF)).removeprefix("file:")
    files = glob.glob(f"{path}/part-*")
    assert files and all(f.endswith(".csv.gz") for f in files)


def test_gold_is_read_once_by_its_checks(spark, tmp_path, monkeypatch):
    """Gaps, measured days, NULLs and repeated keys are found out of one pass over the stored fact."""
    day = dt.date(2024, 2, 28)
    rows = [("n", day, 1.0), ("n", day + dt.timedelta(3), 2.0), ("s", day, None), ("s", day + dt.timedelta(1), 4.0), ("s", day + dt.timedelta(1), 4.0), ("w", None, 5.0)]
    ddl = "farm string, date date, kg double"
    spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.schema(ddl).parquet(str(tmp_path / "fact"))
    observed = spark.createDataFrame([("n", day), ("s", day)], "farm string, date date")
    notable = checks._notable_days(fact, ["farm"], ["kg"], "date DATE NOT NULL")
    assert str(tmp_path) not in "".join(notable.inputFiles())
    with pytest.raises(checks.CheckFailed) as found:
        checks.check_gold({"t": fact}, {"t": ["farm"]}, counts={"t": 6}, observed={"t": observed}, measures={"t": ["kg"]},
                          contracts={"t": "date DATE NOT NULL"})
    assert str(found.value) == ("t lacks 2 days; t has 1 missing days; t has 2 unobserved days; t: date NOT NULL broken by 1 rows; "
                                "t: unique farm, date broken by 2 rows")


def test_kpi_series_moves_its_rows_once(spark):
    fact = spark.range(5000).select(
        (F.col("id") % 7).cast("string").alias("farm_license"), F.expr("date_add(DATE'2024-01-01', CAST(id % 90 AS INT))").alias("date"),
        F.col("id").cast("double").alias("loaded_weight_kg"))
    out = kpi.farm_kpi(fact, "loaded_weight_kg")
    assert _final(out).count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in _final(out)
    got = [(r.farm_license, r.date) for r in out.collect()]
    assert got == sorted(set(got)) and len(got) == 7 * 90


def test_dimension_of_several_devices_is_made_once(spark, tmp_path):
    cfg = [("f", d, ts("2024-01-01") + dt.timedelta(days=i), "AB"[(i + d) % 2]) for d in (1, 2) for i in range(6)]
    spark.createDataFrame(cfg, "k string, device int, time timestamp, v string").write.parquet(str(tmp_path / "cfg"))
    dim = scd2(spark.read.parquet(str(tmp_path / "cfg")), ["k", "device"], ["v"])
    fact = spark.createDataFrame([("f", dt.date(2024, 1, 4), 1), ("g", dt.date(2024, 1, 4), 2), (None, dt.date(2024, 1, 4), 3)], "k string, day date, n int")
    out = point_in_time_join(fact, dim, ["k"], "day", {"v": "state", "device": "by"}, bounds="(]", tie_break=["device"], one_per_time=True)
    assert out.columns == ["k", "day", "n", "state", "by"]
    assert str(tmp_path) not in "".join(out.inputFiles())
    assert sorted((r.n, r.state, r.by) for r in out.collect()) == [(1, "A", 2), (2, None, None), (3, None, None)]
