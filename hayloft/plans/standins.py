"""Telemetry-shaped views of the given star-schema tables.

The driver's tables stand in for robot telemetry so the production operators
run unchanged over data that grows with the scale factor:

* messages — ``events``: device ``user_id`` → farm, ``event_type`` → message
  type, ``ts`` → time, ``props`` (JSON ``{"k": int}``) → payload;
* loading activity — ``orders`` with their lines: load = order, farm = supplier
  of its first line, ration = order priority digit, start = order date, end =
  last ship date, one result per line (feed = return flag code, requested =
  quantity·1000 g, loaded = discounted price in g, completed = line status
  ``F``); some orders have an empty array, some none;
* name / configuration messages — derived from the same lines.

Every view is a lazy projection (plus one join for the activity), so column
pruning and filters still reach the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hayloft.functions.time import year_month
from hayloft.operators.shred import shred
from hayloft.sources import driver_tables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return driver_tables.read(spark, sf_dir, name)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped messages (plus ``event_id`` and ``value``)."""
    return as_messages(table(spark, sf_dir, "events"))


def as_messages(ev: DataFrame) -> DataFrame:
    """``events`` rows (batch or streaming) as bronze-shaped messages."""
    return ev.select(
        F.col("user_id").cast("string").alias("farm_license"),
        F.lit("robot").alias("device_type"),
        F.lit(1).alias("device_number"),
        F.upper("event_type").alias("msg_type"),
        F.col("ts").alias("time"),
        F.col("props").alias("data"),
        F.col("event_id"),
        F.col("value"),
    )


def load_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """silver0-shaped LOAD_START (clicks) and LOAD_DONE (purchases) per device.

    Ration and sequence number come from the payload and the value; a done message
    carries 0 to 3 results, or none at all (NULL) for every fifth ``k``.
    """
    msgs = messages(spark, sf_dir)
    seq_nr = (F.floor("value") % 2 + 1).cast("int").alias("seq_nr")
    keys = ["farm_license", "device_type", "device_number", (F.col("k") % 2 + 1).alias("ration_id"), seq_nr]
    start = shred(msgs, "CLICK", "k INT", {"k": "k"}).select(
        *keys, "time", year_month("time").alias("year_month"), F.col("k").alias("req_weight"), F.lit(0).alias("start_weight")
    )
    result = lambda i: F.struct(
        i.alias("feedId"), (F.col("k") * i).alias("reqWeight"), (F.col("k") + i).alias("weight"), (i % 2 == 1).alias("completed")
    )
    made = F.when(F.col("k") % 4 == 0, F.array().cast(RESULTS)).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.col("k") % 4, F.lit(1))), result).cast(RESULTS)
    )
    done = shred(msgs, "PURCHASE", "k INT", {"k": "k"}).select(
        *keys,
        "time",
        F.round(F.col("value") * 100).cast("int").alias("total_weight"),
        F.when(F.col("k") % 5 != 0, made).alias("results"),
    )
    return start, done


RESULTS = "array<struct<feedId:int,reqWeight:int,weight:int,completed:boolean>>"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def _loads(spark: SparkSession, sf_dir: str, *, names: bool = True) -> DataFrame:
    """One row per order: its lines as an array in line order, farm = supplier of the first line.

    Every 17th order has no array (NULL), every 19th an empty one. The lines are dealt by
    order before they are grouped: an order has few, so that combining them beforehand
    takes a sort and saves nothing. ``names``: with the feed's name in each line.
    """
    feed, done = F.ascii("l_returnflag"), F.col("l_linestatus") == "F"
    flags = ["l_returnflag", "l_linestatus"] if names else [feed.alias("feed"), done.alias("done")]
    req, got = F.col("req"), F.col("got")
    name = F.concat(F.lit("feed "), F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus")).alias("name")
    line = F.struct(
        F.col("l_linenumber").alias("nr"),
        (feed if names else F.col("feed")).alias("feedId"),
        req.alias("reqWeight"),
        got.alias("weight"),
        (done if names else F.col("done")).alias("completed"),
        *([name] if names else []),
    )
    loads = (
        _lines(spark, sf_dir)
        .select(
            "l_orderkey", "l_suppkey", "l_linenumber", *flags, "l_shipdate",
            (F.col("l_quantity") * 1000).cast("int").alias("req"),
            F.round(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("int").alias("got"),
        )
        .repartition("l_orderkey")
        .groupBy("l_orderkey")
        .agg(
            F.min_by("l_suppkey", F.struct("l_linenumber", "l_suppkey")).cast("string").alias("farm_license"),
            F.max("l_shipdate").alias("end_time"),
            F.count(F.lit(1)).cast("int").alias("seq_nr"),
            F.sum(req).cast("int").alias("req_g"),
            F.sum(got).cast("int").alias("got_g"),
            F.sort_array(F.collect_list(line)).alias("lines"),
        )
    )
    lines = (
        F.when(F.col("l_orderkey") % 17 == 0, F.lit(None))
        .when(F.col("l_orderkey") % 19 == 0, F.filter("lines", lambda x: F.lit(False)))
        .otherwise(F.col("lines"))
    )
    return loads.withColumn("lines", lines)


def _results(lines: str = "lines"):
    fields = ("feedId", "reqWeight", "weight", "completed")
    return F.transform(lines, lambda x: F.struct(*[x[f].alias(f) for f in fields])).cast(RESULTS)


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver_loading_activity-shaped rows, one load per order."""
    loads = _loads(spark, sf_dir, names=False)
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    joined = loads.join(od, loads["l_orderkey"] == od["o_orderkey"], "inner")
    start, end = F.col("o_orderdate"), F.col("end_time")
    duration = F.unix_seconds(end) - F.unix_seconds(start)
    return joined.select(
        "farm_license",
        F.lit(1).alias("device_number"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("ration_id"),
        "seq_nr",
        year_month(start).alias("year_month"),
        F.col("l_orderkey").cast("string").alias("loading_uuid"),
        start.alias("start_time"),
        end,
        F.col("req_g").alias("req_weight_ration_g"),
        F.lit(0).alias("weight_at_load_start_g"),
        F.col("got_g").alias("loaded_weight_ration_g"),
        _results().alias("results"),
        duration.alias("duration_s"),
        F.try_divide("got_g", duration).alias("loading_speed_ration_g_per_s"),
    )


def kitchen_feed_name_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kitchen_feed_names-shaped rows: a name per (supplier, feed) at each ship date."""
    li = _lines(spark, sf_dir)
    return li.select(
        F.col("l_suppkey").cast("string").alias("farm_license"),
        F.lit(1).alias("device_number"),
        F.col("l_shipdate").alias("time"),
        F.ascii("l_returnflag").alias("feed_id"),
        F.concat(F.lit("feed "), F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus")).alias("name"),
        year_month("l_shipdate").alias("year_month"),
    )


def ration_name_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ration_names-shaped rows: a name per (supplier, ration) at each order date."""
    li = _lines(spark, sf_dir).select("l_orderkey", "l_suppkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    joined = li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner")
    return joined.select(
        F.col("l_suppkey").cast("string").alias("farm_license"),
        F.lit(1).alias("device_number"),
        F.col("o_orderdate").alias("time"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("ration_id"),
        F.concat(F.lit("ration "), F.col("o_orderstatus")).alias("name"),
        year_month("o_orderdate").alias("year_month"),
    )


def robot_config_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """robot_config-shaped rows: two robots per supplier, settings from line flags."""
    li = _lines(spark, sf_dir)
    return li.select(
        F.col("l_suppkey").cast("string").alias("farm_license"),
        F.lit("robot").alias("device_type"),
        ((F.col("l_linenumber") % 2) + 1).alias("device_number"),
        F.col("l_shipdate").alias("time"),
        F.when(F.col("l_tax") >= 0.04, "THREE_PHASE").otherwise("ONE_PHASE").alias("phases"),
        F.when(F.col("l_returnflag") == "A", "SCHNEIDER")
        .when(F.col("l_returnflag") == "N", "COMMSK")
        .otherwise("OTHER")
        .alias("freq_type_mixer"),
        F.when(F.col("l_linestatus") == "F", "SCHNEIDER").otherwise("COMMSK").alias("freq_type_roller"),
        F.when(F.col("l_discount") >= 0.09, "UNKNOWN").otherwise("RELAY").alias("relays_type"),
        year_month("l_shipdate").alias("year_month"),
    )


def _load_envelope(msg_type: str):
    return [
        F.col("farm_license"),
        F.lit("robot").alias("device_type"),
        F.lit(1).alias("device_number"),
        F.lit(msg_type).alias("msg_type"),
        F.col("end_time").alias("time"),
    ]


def load_done_messages(spark: SparkSession, sf_dir: str, *, varied: bool = False) -> DataFrame:
    """LOAD_DONE messages with JSON payloads (one per order, one result per line), bronze-shaped.

    ``varied``: the ration comes from the order's key instead of its number of lines.
    """
    return _loads(spark, sf_dir, names=False).select(*_load_envelope("LOAD_DONE"), F.to_json(_done(varied)).alias("data"))


def _done(varied: bool):
    return F.struct(
        _ration(varied).alias("rationId"), F.col("got_g").alias("weight"), _results().alias("results"), F.col("seq_nr").alias("seqNr")
    )


def load_start_messages(spark: SparkSession, sf_dir: str, *, varied: bool = False) -> DataFrame:
    """LOAD_START messages with JSON payloads (one per order), bronze-shaped.

    ``varied``: rations as in :func:`load_done_messages`, sent before the load is done by
    2**6 to 2**15 seconds, as the weight requested has it (powers of two, so that sums of
    speeds are exact in any order).
    """
    loads = _loads(spark, sf_dir, names=False)
    if varied:
        loads = loads.withColumn("end_time", _start_time())
    return loads.select(*_load_envelope("LOAD_START"), F.to_json(_start(varied)).alias("data"))


def _start(varied: bool):
    return F.struct(
        _ration(varied).alias("rationId"), F.col("req_g").alias("reqWeight"), F.lit(0).alias("startWeight"), F.col("seq_nr").alias("seqNr")
    )


def _start_time():
    ahead = F.pow(F.lit(2), F.floor(F.col("req_g") / 1000) % 10 + 6).cast("long")
    return F.timestamp_seconds(F.unix_seconds(F.col("end_time").cast("timestamp")) - ahead)


def order_messages(spark: SparkSession, sf_dir: str, *, varied: bool = False) -> DataFrame:
    """All messages of an order (done, start, feed names, ration names) out of one grouping of its lines.

    The rows of :func:`load_done_messages`, :func:`load_start_messages`,
    :func:`kitchen_feed_name_payloads` and :func:`ration_name_payloads`; without ``varied`` the
    start is sent 90 minutes before the load is done.
    """
    started = _start_time() if varied else F.col("end_time") - F.expr("INTERVAL 90 MINUTES")
    kinds = {
        "LOAD_DONE": (F.col("end_time"), _done(varied)),
        "LOAD_START": (started, _start(varied)),
        "KITCHEN_FEED_NAMES": (F.col("end_time"), F.struct(_feed_names().alias("feedNames"))),
        "RATION_NAMES": (F.col("end_time"), F.struct(_ration_names().alias("rationNames"))),
    }
    each = F.array(
        *[
            F.struct(F.lit(kind).alias("msg_type"), time.cast("timestamp").alias("time"), F.to_json(payload).alias("data"))
            for kind, (time, payload) in kinds.items()
        ]
    )
    envelope = [F.col("farm_license"), F.lit("robot").alias("device_type"), F.lit(1).alias("device_number")]
    return _loads(spark, sf_dir).select(*envelope, F.inline(each))


def _ration(varied: bool):
    return (F.col("l_orderkey") % 3 + 1).cast("int") if varied else F.col("seq_nr")


def _feed_names():
    return F.transform("lines", lambda x: F.struct(x["feedId"].alias("feedId"), x["name"].alias("name")))


def _ration_names():
    return F.transform("lines", lambda x: F.struct(x["nr"].alias("rationId"), x["name"].alias("name")))


def kitchen_feed_name_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KITCHEN_FEED_NAMES messages with a JSON ``feedNames`` array (a name per line of the order), bronze-shaped."""
    return _loads(spark, sf_dir).select(
        *_load_envelope("KITCHEN_FEED_NAMES"), F.to_json(F.struct(_feed_names().alias("feedNames"))).alias("data")
    )


def ration_name_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RATION_NAMES messages with a JSON ``rationNames`` array, bronze-shaped."""
    return _loads(spark, sf_dir).select(
        *_load_envelope("RATION_NAMES"), F.to_json(F.struct(_ration_names().alias("rationNames"))).alias("data")
    )


def robot_config_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROBOT_CONFIG messages with JSON payloads, one per line, bronze-shaped."""
    msgs = robot_config_messages(spark, sf_dir)
    payload = F.struct(
        "phases",
        F.col("freq_type_mixer").alias("freqTypeMixer"),
        F.col("freq_type_roller").alias("freqTypeRoller"),
        F.col("relays_type").alias("relaysType"),
    )
    return msgs.select(
        "farm_license", "device_type", "device_number", F.lit("ROBOT_CONFIG").alias("msg_type"), "time", F.to_json(payload).alias("data")
    )
