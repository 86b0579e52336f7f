import csv
import os
import tempfile

from hayloft.sources.files import read_table
from hayloft.streaming import ingest_bronze

HEADER = ["farm_license", "device_type", "device_number", "msg_type", "time", "data"]


def _write(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(HEADER)
        w.writerows(rows)


def test_incremental_bronze_ingest(spark):
    root = tempfile.mkdtemp(prefix="hayloft-stream-")
    src, bronze, ckpt = (os.path.join(root, x) for x in ("in", "bronze", "ckpt"))
    os.makedirs(src)
    _write(os.path.join(src, "a.csv"), [
        ["F1", "robot", 1, "LOAD_START", "2023-01-01 08:00:00", '{"rationId": 1}'],
        ["F1", "robot", 1, "RATION_NAMES", "2023-01-01 05:00:00", '{"rationNames": []}'],
    ])
    ingest_bronze(spark, src, bronze, ckpt)
    assert read_table(spark, bronze).count() == 2

    # a second run only reads the new file; the first is not ingested twice
    _write(os.path.join(src, "b.csv"), [["F2", "robot", 2, "LOAD_START", "2023-01-02 08:00:00", "{}"]])
    ingest_bronze(spark, src, bronze, ckpt)
    out = read_table(spark, bronze)
    assert out.count() == 3
    assert sorted(r.msg_type for r in out.select("msg_type").distinct().collect()) == ["LOAD_START", "RATION_NAMES"]
    assert {os.path.basename(r.source_path) for r in out.collect()} == {"a.csv", "b.csv"}
    assert out.where("msg_type = 'LOAD_START'").count() == 2
