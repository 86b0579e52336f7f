"""End-to-end layered run: CSV messages → bronze → silver0 → silver1 → gold."""

import csv
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from hayloft import schemas
from hayloft.plans import checks
from hayloft.plans.medallion import gold_transformations, run_layers
from hayloft.sources.files import read_csv_messages, read_table


def _msg(msg_type, time, data, device_type="robot", device=1, farm="F1"):
    return [farm, device_type, device, msg_type, time, json.dumps(data, ensure_ascii=False)]


MESSAGES = [
    _msg("ROBOT_CONFIG", "2023-01-01 06:00:00",
         {"phases": "THREE_PHASE", "freqTypeMixer": "SCHNEIDER", "freqTypeRoller": "COMMSK", "relaysType": "R1"}),
    _msg("ROBOT_CONFIG", "2023-01-01 07:00:00",
         {"phases": "ONE_PHASE", "freqTypeMixer": "X", "freqTypeRoller": "X", "relaysType": "R1"},
         device_type="kitchen"),
    _msg("ROBOT_CONFIG", "2023-01-02 07:00:00",
         {"phases": "ONE_PHASE", "freqTypeMixer": "X", "freqTypeRoller": "X", "relaysType": "UNKNOWN"}),
    _msg("KITCHEN_FEED_NAMES", "2023-01-01 05:00:00",
         {"feedNames": [{"feedId": 1, "name": "MaÃ¯s"}, {"feedId": 2, "name": "Gras"}, {"feedId": 0, "name": "-"}]}),
    _msg("RATION_NAMES", "2023-01-01 05:00:00", {"rationNames": [{"rationId": 7, "name": "TMR"}]}),
    _msg("LOAD_START", "2023-01-01 08:00:00", {"rationId": 7, "reqWeight": 3000, "startWeight": 0, "seqNr": 1}),
    _msg("LOAD_START", "2023-01-01 08:00:00", {"rationId": 7, "reqWeight": 3000, "startWeight": 0, "seqNr": 1}),
    _msg("LOAD_DONE", "2023-01-01 08:10:00",
         {"rationId": 7, "weight": 2900, "seqNr": 1,
          "results": [{"feedId": 1, "reqWeight": 2000, "weight": 1900, "completed": True},
                      {"feedId": 2, "reqWeight": 1000, "weight": 1000, "completed": True}]}),
    _msg("LOAD_START", "2023-01-03 09:00:00", {"rationId": 7, "reqWeight": 1000, "startWeight": 0, "seqNr": 2}),
    _msg("LOAD_DONE", "2023-01-03 09:05:00",
         {"rationId": 7, "weight": 1000, "seqNr": 2,
          "results": [{"feedId": 1, "reqWeight": 1000, "weight": 1000, "completed": True}]}),
]


@pytest.fixture(scope="module")
def layers(spark):
    root = tempfile.mkdtemp(prefix="hayloft-medallion-")
    csv_path = os.path.join(root, "bronze_table.csv")
    with open(csv_path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh, quoting=csv.QUOTE_MINIMAL, doublequote=True)
        w.writerow(["farm_license", "device_type", "device_number", "msg_type", "time", "data"])
        w.writerows(MESSAGES)
    dirs = run_layers(spark, csv_path, os.path.join(root, "warehouse"))
    return spark, csv_path, dirs


def test_csv_scan_lineage(layers):
    spark, csv_path, _ = layers
    df = read_csv_messages(spark, csv_path)
    rows = df.collect()
    assert len(rows) == len(MESSAGES)
    assert all(r.source_path.endswith("bronze_table.csv") and r.processing_time is not None for r in rows)
    assert json.loads(rows[3].data)["feedNames"][0]["name"] == "MaÃ¯s"


def test_silver_tables(layers):
    spark, _, dirs = layers
    silver = dirs["silver"]
    assert read_table(spark, os.path.join(silver, "load_start")).count() == 2  # duplicate removed
    act = read_table(spark, os.path.join(silver, "silver_loading_activity"), schemas.SILVER_LOADING_ACTIVITY)
    assert sorted(r.duration_s for r in act.collect()) == [300, 600]
    cfg = read_table(spark, os.path.join(silver, "silver_robot_config_dim"), schemas.SILVER_ROBOT_CONFIG_DIM)
    assert [(r.phases, r.freq_controller_type_mixer) for r in cfg.collect()] == [("3", "SCHNEIDER")]
    names = read_table(spark, os.path.join(silver, "silver_kitchen_feed_names_dim"),
                       schemas.SILVER_KITCHEN_FEED_NAMES_DIM)
    assert sorted((r.feed_id, r.name) for r in names.collect()) == [(1, "Maïs"), (2, "Gras")]


def test_gold_tables(layers):
    spark, _, dirs = layers
    g = {t.result_table: read_table(spark, os.path.join(dirs["gold"], t.result_table), t.schema_ddl)
         for t in gold_transformations()}
    feed = {(r.feed_id, str(r.date)): r for r in g["feed_daily_fact"].collect()}
    assert sorted(feed) == [(1, "2023-01-01"), (1, "2023-01-02"), (1, "2023-01-03"), (2, "2023-01-01")]
    assert feed[(1, "2023-01-01")].loaded_weight_kg == 1.9
    # the name set at 05:00 on day 1 covers midnights from day 2 on; a filled day
    # carries the observed day's (still NULL) name forward
    assert feed[(1, "2023-01-02")].feed_name is None and feed[(1, "2023-01-02")].loaded_weight_kg is None
    assert feed[(1, "2023-01-03")].feed_name == "Maïs"
    ration = {str(r.date): r for r in g["ration_daily_fact"].collect()}
    # a name set at 05:00 applies from the next day on ("(]" bounds against midnight)
    assert [ration[x].ration_name for x in ("2023-01-01", "2023-01-02", "2023-01-03")] == [None, None, "TMR"]
    farm = {str(r.date): r for r in g["farm_daily_fact"].collect()}
    assert farm["2023-01-01"].nr_schneider_freq_control is None
    assert (farm["2023-01-03"].nr_schneider_freq_control, farm["2023-01-03"].nr_commsk_freq_control) == (1, 1)
    counts = {r.table: r.ok for r in checks.row_counts(g).collect()}
    assert counts == {"feed_daily_fact": True, "ration_daily_fact": True, "farm_daily_fact": True}
    keys = {"feed_daily_fact": ["farm_license", "feed_id"], "ration_daily_fact": ["farm_license", "ration_id"],
            "farm_daily_fact": ["farm_license"]}
    for name, df in g.items():
        assert checks.missing_days(df, keys=keys[name]).count() == 0


def test_counts_come_from_the_writes(layers):
    spark, _, dirs = layers
    assert dirs.rows["bronze_table"] == len(MESSAGES) and dirs.rows["load_start"] == 2
    for t in gold_transformations():
        assert dirs.rows[t.result_table] == read_table(spark, os.path.join(dirs["gold"], t.result_table)).count()


def test_rejects_are_kept_beside_the_layers(spark, tmp_path):
    bad = [["F1", "robot", "first", "LOAD_DONE", "2023-01-01 08:10:00", "{}"], ["F1", "robot", 1, "LOAD_DONE", "2023-01-01 08:10:00", '{"rationId": 7']]
    path = str(tmp_path / "m.csv")
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(["farm_license", "device_type", "device_number", "msg_type", "time", "data"])
        w.writerows(MESSAGES + bad)
    run = run_layers(spark, path, str(tmp_path / "warehouse"))
    assert (run.rows["bronze_table"], run.rows["rejected_records"], run.rows["rejected_payloads"]) == (len(MESSAGES) + 1, 1, 1)
    records = read_table(spark, os.path.join(run["bronze"], "rejected_records")).collect()
    assert [r.record for r in records] == ["F1,robot,first,LOAD_DONE,2023-01-01 08:10:00,{}"]
    payloads = read_table(spark, os.path.join(run["bronze"], "rejected_payloads")).collect()
    assert [(r.msg_type, r.data) for r in payloads] == [("LOAD_DONE", '{"rationId": 7')]


@pytest.mark.parametrize("change,finding", [
    ("date <> DATE'2023-01-03'", "1 missing days"),  # an observed day at the end: no gap shows it
    ("date <> DATE'2023-01-02'", "lacks 1 days"),  # a filled day
])
def test_a_fact_that_lost_a_day_fails_the_run(spark, layers, tmp_path, change, finding):
    from hayloft.plans.medallion import LayerRun, check_run
    from hayloft.sources.files import write_table

    _, _, dirs = layers
    for t in gold_transformations():
        fact = read_table(spark, os.path.join(dirs["gold"], t.result_table), t.schema_ddl)
        write_table(fact.where(change) if t.result_table == "farm_daily_fact" else fact, str(tmp_path / t.result_table), partition_by=["farm_license"])
    run = LayerRun({**dirs, "gold": str(tmp_path)}, [])
    run.rows = dirs.rows
    with pytest.raises(checks.CheckFailed, match=f"farm_daily_fact .*{finding}"):
        check_run(spark, run)


def test_duplicate_keys_and_nulls_break_the_contract(spark, layers):
    from hayloft.plans.contract import constraint_findings

    _, _, dirs = layers
    t = next(t for t in gold_transformations() if t.result_table == "farm_daily_fact")
    fact = read_table(spark, os.path.join(dirs["gold"], t.result_table), t.schema_ddl)
    keys = ["farm_license", "date"]
    assert constraint_findings(fact, t.schema, keys).collect() == []
    twice = fact.unionByName(fact.limit(1)).unionByName(fact.limit(1).withColumn("date", F.lit(None).cast("date")))
    found = {r.constraint: r.n_rows for r in constraint_findings(twice, t.schema, keys).collect()}
    assert found == {"date NOT NULL": 1, "unique farm_license, date": 2}
