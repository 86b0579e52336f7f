"""What writes leave on disk, and how the layered run deals and checks its facts."""

import os

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import ts
from hayloft import schemas
from hayloft.llm import quality
from hayloft.operators.scd import scd2
from hayloft.plans import parsers, silver
from hayloft.session import options, shuffles_released
from hayloft.sources.files import write_table


def test_options_hold_inside_the_block_only(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with shuffles_released(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before
    with options(spark, {"hayloft.none": "1"}):
        assert spark.conf.get("hayloft.none") == "1"
    assert spark.conf.get("hayloft.none", None) is None


def test_scd2_of_tracked_columns_is_grouped_by_hash(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.lit(ts("2024-01-01")).alias("time"), F.lit("A").alias("v"))
    out = scd2(df, ["k"], ["v"])
    assert out.count() == 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "min_by" not in plan


def test_training_lets_its_rows_go():
    rng = np.random.default_rng(1)
    cells = [np.unique(rng.integers(0, 1 << quality.DIMENSIONS_LOG2, 500)).astype(np.int32) for _ in range(60)]
    values = [np.ones(len(c), np.float32) for c in cells]
    size = sum(map(len, cells))
    quality.fit(cells, values, np.array([[i % 2, i % 3 == 0] for i in range(60)], float), epochs=1)
    assert sum(map(len, cells)) == sum(map(len, values)) < size


def test_tables_are_written_with_zstd(spark, tmp_path):
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    path = str(tmp_path / "t")
    assert write_table(spark.range(100).selectExpr("id", "sha2(string(id), 256) AS uuid"), path) == 100
    files = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")]
    found = {pq.ParquetFile(f).metadata.row_group(0).column(1).compression for f in files}
    assert found == {"ZSTD"} and spark.conf.get("spark.sql.parquet.compression.codec") == before


def test_columns_that_follow_from_others_are_made_behind_the_rebalancing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).selectExpr("id", "id % 3 AS part")
    n = write_table(df, path, partition_by=["part"], finish=lambda d: d.withColumn("twice", F.col("id") * 2))
    stored = spark.read.parquet(path)
    assert n == stored.where("twice = 2 * id").count() == 100


def test_what_follows_from_a_payload_is_not_dealt_with_it():
    assert parsers.ROBOT_CONFIG._follows() == ["msg_type", "phases", "freq_type_mixer", "freq_type_roller", "relays_type"]
    assert parsers.LOAD_DONE._follows() == ["msg_type", "total_weight", "results"]
    assert parsers.RATION_NAMES._follows() == ["msg_type"]


def test_picked_messages_are_those_with_the_smallest_values(spark):
    load = lambda w, s: ("F", "robot", 1, "LOAD_START", ts("2024-01-01"), w and '{"rationId": 1, "reqWeight": %s, "startWeight": %s, "seqNr": 1}' % (w, s))
    messages = [(*load(*x), ts("2024-01-02"), "f") for x in (("9", "1"), ("5", "3"), ("5", "2"), ("null", "7"), (None, None))]
    bronze = spark.createDataFrame(messages, schemas.struct(schemas.BRONZE))
    built = parsers.LOAD_START.build(bronze.where("data NOT LIKE '%null%'"))
    assert built.columns == schemas.struct(schemas.SILVER0_LOAD_START).fieldNames()
    picked = {(r.ration_id, r.req_weight, r.start_weight, r.msg_type) for r in built.collect()}
    assert picked == {(1, 5, 2, "LOAD_START")}
    both = {(r.ration_id, r.req_weight, r.start_weight) for r in parsers.LOAD_START.build(bronze).collect()}
    assert both == {(1, None, 7), (None, None, None)}


def test_dimensions_of_stored_messages_are_not_grouped_first(spark):
    row = lambda day, device, name: ("F", device, ts(f"2024-01-0{day}"), 1, name, "2024-01")
    rows = [row(1, 1, "a"), row(1, 2, "a"), row(2, 1, "b"), row(3, 2, "b"), row(4, 1, "a")]
    df = spark.createDataFrame(rows, "farm_license string, device_number int, time timestamp, feed_id int, name string, year_month string")
    lean, whole = silver.stored_feed_names_dim(df), silver.kitchen_feed_names_dim(df)
    assert sorted(lean.collect()) == sorted(whole.collect()) and lean.count() == 3
    assert "Aggregate" not in lean._jdf.queryExecution().executedPlan().toString()
