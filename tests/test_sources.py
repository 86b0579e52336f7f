import datetime as dt
import os
import tempfile

from hayloft.sources.calendar import calendar
from hayloft.sources.files import read_table, write_table

DDL = "farm_license STRING, year_month STRING, n LONG"


def test_calendar_fixed_bounds(spark):
    days = [r.date for r in calendar(spark, "2023-01-01", "2023-12-31").collect()]
    assert len(days) == 365 and days[0] == dt.date(2023, 1, 1) and days[-1] == dt.date(2023, 12, 31)
    assert not calendar(spark, "2023-01-01", "2023-01-02").schema["date"].nullable


def test_partitioned_roundtrip_keeps_declared_order_and_types(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="hayloft-src-"), "t")
    df = spark.createDataFrame([("0042", "2023-01", 1), ("7", "2023-02", 2)], DDL)
    write_table(df, path, partition_by=["farm_license"])
    plain = read_table(spark, path)
    assert plain.columns[-1] == "farm_license"  # partition column moves to the end on plain read
    typed = read_table(spark, path, DDL)
    assert typed.columns == ["farm_license", "year_month", "n"]
    assert typed.schema["farm_license"].dataType.simpleString() == "string"
    assert sorted(r.farm_license for r in typed.collect()) == ["0042", "7"]  # no numeric inference
    write_table(df.limit(1), path, partition_by=["farm_license"])  # overwrite replaces the table
    assert read_table(spark, path, DDL).count() == 1


def test_partition_values_stay_text_without_a_schema(spark, tmp_path):
    from hayloft.sources.files import read_table, write_table

    option = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(option)
    spark.conf.set(option, "true")
    try:
        path = str(tmp_path / "t")
        write_table(spark.createDataFrame([("007", 1), ("12", 2)], "farm_license string, n int"), path, partition_by=["farm_license"])
        assert sorted(r.farm_license for r in read_table(spark, path).collect()) == ["007", "12"]
        assert spark.conf.get(option) == "true"
    finally:
        spark.conf.set(option, before)


def test_stream_and_batch_tables_do_not_share_a_path(spark, tmp_path):
    import pytest

    from hayloft.sources.files import write_table
    from hayloft.streaming.ingest import ingest

    batch, streamed, source = (str(tmp_path / n) for n in ("batch", "streamed", "source"))
    df = spark.createDataFrame([("a", 1)], "msg_type string, n int")
    df.write.parquet(source)
    write_table(df, batch)
    stream = lambda: spark.readStream.schema(df.schema).parquet(source)
    with pytest.raises(ValueError, match="batch-written"):
        ingest(stream(), batch, str(tmp_path / "c1"))
    ingest(stream(), streamed, str(tmp_path / "c2")).awaitTermination()
    with pytest.raises(ValueError, match="written by a stream"):
        write_table(df, streamed)


def test_checkpoint_folder_is_required_on_a_cluster():
    import pytest

    from hayloft.session import checkpoint_root

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "local-cluster[2,1,1024]"

        def getConf(self):
            return Conf()

    session = type("Session", (), {"conf": Conf(), "sparkContext": Context()})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(session)


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    """A rewrite that breaks half way: whole tables and single partitions keep their old rows, nothing is left beside them."""
    import pytest
    from pyspark.sql import functions as F

    path = str(tmp_path / "layer" / "t")
    good = spark.range(100).select("id", (F.col("id") % 4).cast("string").alias("p"))
    assert write_table(good, path, partition_by=["p"]) == 100
    broken = spark.range(0, 400, 1, 8).select(
        F.when(F.col("id") == 399, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id") + 1000).alias("id"),
        (F.col("id") % 4).cast("string").alias("p"))
    for mode in ("overwrite", "partitions"):
        with pytest.raises(Exception, match="broken row"):
            write_table(broken, path, partition_by=["p"], mode=mode, cluster=False)
        assert sorted(r.id for r in read_table(spark, path).collect()) == list(range(100))
    one = spark.range(5).select((F.col("id") + 500).alias("id"), F.lit("2").alias("p"))
    assert write_table(one, path, partition_by=["p"], mode="partitions") == 5
    assert sorted(r.id for r in read_table(spark, path).where("p = '2'").collect()) == list(range(500, 505))
    assert read_table(spark, path).count() == 80


def test_a_swap_interrupted_between_its_renames_is_finished(spark, tmp_path):
    path = tmp_path / "t"
    write_table(spark.range(7), str(path))
    os.rename(path, tmp_path / ".t.earlier-0123456789ab")  # the crash: moved aside, nothing moved in
    assert read_table(spark, str(path)).count() == 7
    assert write_table(spark.range(0), str(path)) == 0  # an empty table replaces it
    assert read_table(spark, str(path), "id LONG").count() == 0
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_every_csv_row_is_a_message_or_a_reject(spark, tmp_path):
    from hayloft.sources.files import split_csv_messages

    lines = [
        "farm_license,device_type,device_number,msg_type,time,data",
        'F1,robot,1,CLICK,2023-01-01 06:00:00,"{""k"": 1}"',
        'F1,robot,one,CLICK,2023-01-01 06:00:00,"{}"',  # not a number
        "F1,robot,1,CLICK,someday,{}",  # not a time
        "F1,robot,1,CLICK",  # too few values
        "F1,robot,1,CLICK,2023-01-01 06:00:00,a,b",  # too many
        "F2,robot,,CLICK,,",  # NULLs are values
    ]
    (tmp_path / "m.csv").write_text("\n".join(lines) + "\n")
    messages, rejects = split_csv_messages(spark, str(tmp_path / "m.csv"))
    assert sorted(r.farm_license for r in messages.collect()) == ["F1", "F2"]
    assert messages.count() == 2 and messages.select("farm_license").count() == 2  # whatever is read
    assert sorted(r.record for r in rejects.collect()) == sorted(lines[2:6])
    assert all(r.source_path.endswith("m.csv") for r in rejects.collect())


def test_payloads_are_parsed_or_rejected(spark):
    from hayloft.operators.shred import rejected, shred

    rows = [(1, "A", '{"n": 1, "xs": [{"v": 2}]}'), (2, "A", '{"n": 1, "xs"'), (3, "A", '{"n": "one"}'), (4, "A", None), (5, "A", ""),
            (6, "A", "[1]"), (7, "A", "{}"), (8, "B", "nonsense"), (9, "A", '{"n": null, "more": 1}')]
    df = spark.createDataFrame(rows, "id int, msg_type string, data string")
    ddl = "n INT, xs ARRAY<STRUCT<v: INT>>"
    good = shred(df, "A", ddl, {"n": "n", "xs": "xs"}, malformed="drop")
    bad = rejected(df, "A", ddl)
    assert sorted(r.id for r in good.collect()) == [1, 4, 7, 9] and bad.columns == df.columns
    assert sorted((r.id, r.data) for r in bad.collect()) == [(2, '{"n": 1, "xs"'), (3, '{"n": "one"}'), (5, ""), (6, "[1]")]
    assert [r.xs[0].v for r in good.where("id = 1").collect()] == [2]
    assert shred(df, "A", ddl, {"n": "n"}).count() == 8  # kept by default


def test_released_intermediates_are_removed(spark):
    from hayloft.session import release_scratch, scratch_mark, scratch_path

    kept = scratch_path(spark, "before")
    mark = scratch_mark(spark)
    paths = [scratch_path(spark, "t") for _ in range(3)]
    for p in [kept, *paths]:
        spark.range(3).write.parquet(p)
    assert release_scratch(spark, mark, but_last=True) == 2
    assert [os.path.exists(p) for p in [kept, *paths]] == [True, False, False, True]
    assert release_scratch(spark, mark) == 1 and not os.path.exists(paths[2])
    assert os.path.exists(kept)
