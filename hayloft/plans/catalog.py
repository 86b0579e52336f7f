"""Registered queries over the given tables, each with an equivalent DuckDB SQL.

Every query reads whole tables (no id subsets or row caps); the only ``LIMIT``
is the top-k preview, where the limit is the feature. Computed columns carry the same alias on both sides. Doubles that come out of sums of
doubles are rounded (Spark's HALF_UP on the decimal value, emulated in SQL
through a DECIMAL cast) because the summation order differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hayloft import schemas
from hayloft.functions.names import make_mojibake, repair_mojibake
from hayloft.operators import dedup, fill_days, pair_events, point_in_time_join, scd2, shred, split_intervals
from hayloft.operators.shred import rejected
from hayloft.plans import checks, gold, kpi, parsers, silver, standins
from hayloft.plans.contract import constraint_findings
from hayloft.functions.time import to_timestamp_columns
from hayloft.session import scratch_path, shuffles_released
from hayloft.sources.calendar import calendar_of
from hayloft.plans.medallion import run_layers
from hayloft.sources.files import read_csv_messages, read_table, split_csv_messages, write_table
from hayloft.streaming.ingest import ingest, with_lineage

Query = Callable[[SparkSession, str], DataFrame]


def _round_cols(df: DataFrame, cols, digits: int) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(c, digits))
    return df


# --------------------------------------------------------------------------- Spark side
def q_shred_json(spark, sf):
    msgs = standins.messages(spark, sf)
    parsed = shred(msgs, "CLICK", "k INT", {"k": "k"})
    return parsed.select(
        "farm_license", "event_id", "time", "k", F.date_format("time", "yyyy-MM").alias("year_month")
    )


def q_dedup_first(spark, sf):
    ev = standins.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    kept = dedup(ev.select("user_id", "event_type", "day", "event_id", "ts", "value"),
                 ["user_id", "event_type", "day"], order_by=["ts", "event_id"])
    return kept


def _events_dim(spark, sf):
    ev = standins.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return scd2(ev, ["user_id"], ["event_type"], orderby_col="ts")


def q_scd2_events(spark, sf):
    return _events_dim(spark, sf)


def q_scd2_nested(spark, sf):
    ev = standins.table(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.when(F.col("value") >= 25, "HIGH").otherwise("LOW").alias("band"),
    )
    level1 = scd2(ev, ["user_id"], ["event_type", "band"], orderby_col="ts")
    level2 = scd2(level1, ["user_id"], ["event_type"], orderby_col="ts")
    return level2.select("user_id", "ts", "event_type", "end_time", "duration_s")


def _activity_events(spark, sf):
    start, done = standins.load_messages(spark, sf)
    return silver.loading_activity(start, done)


def q_pair_events_12h(spark, sf):
    """All columns; the results array as its size and total (NULL for a NULL array)."""
    act = _activity_events(spark, sf)
    total = F.aggregate("results", F.lit(0), lambda a, r: a + r["weight"])
    return act.withColumns(
        {"n_results": F.when(F.col("results").isNotNull(), F.size("results")), "results_weight": total}
    ).drop("results")


def _pairs(spark, sf):
    return _activity_events(spark, sf).select("farm_license", "start_time", "end_time")


def q_split_intervals_day(spark, sf):
    return split_intervals(_pairs(spark, sf), "start_time", "end_time", 86400, pos_col="pos")


def q_split_intervals_hour(spark, sf):
    return split_intervals(_pairs(spark, sf), "start_time", "end_time", 3600, pos_col="pos")


def q_split_intervals_5h(spark, sf):
    """A step that does not divide a day: boundaries count from the epoch."""
    return split_intervals(_pairs(spark, sf), "start_time", "end_time", "5 hours", pos_col="pos")


def q_split_intervals_week(spark, sf):
    """Closed configuration periods, cut at the weeks all rows share."""
    periods = _robot_config_dim(spark, sf).where("end_time < TIMESTAMP'2099-01-01'")
    periods = periods.select("farm_license", "device_number", "start_time", "end_time")
    return split_intervals(periods, "start_time", "end_time", "1 week", pos_col="pos")


def q_interval_join_generic(spark, sf):
    """Start/end pairing on a key only (no sequence number): the bucketed join."""
    ev = standins.table(spark, sf, "events")
    starts = ev.where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("start_time"), F.col("event_id").alias("start_id"))
    ends = ev.where(F.col("event_type") == "signup").select(
        "user_id", F.col("ts").alias("end_time"), F.col("event_id").alias("end_id"))
    return pair_events(starts, ends, ["user_id"], max_gap_seconds=6 * 3600)


def _daily_events(spark, sf):
    ev = standins.table(spark, sf, "events")
    return ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_events"))


def q_pit_join_closed_open(spark, sf):
    return point_in_time_join(_daily_events(spark, sf), _events_dim(spark, sf), ["user_id"], "day",
                              {"event_type": "state"}, bounds="[)", start_col="ts")


def q_pit_join_each_event(spark, sf):
    """Many facts per key and time zone day: each event with the state of its user at its own instant."""
    ev = standins.table(spark, sf, "events").select("event_id", "user_id", F.col("ts").alias("at"))
    return point_in_time_join(ev, _events_dim(spark, sf), ["user_id"], "at", {"event_type": "state"}, bounds="(]", start_col="ts")


def q_pit_join_two_devices(spark, sf):
    """Farm-only lookup of robots whose configuration periods overlap and end."""
    periods = _robot_lookup(spark, sf).where("end_time < TIMESTAMP'2099-01-01'")
    days = standins.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("farm_license"), F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_linenumber"
    )
    return point_in_time_join(
        days, periods, ["farm_license"], "day", {"phases": "phases", "device_number": "device"}, bounds="(]", tie_break=["device_number"]
    )


def q_pit_join_open_closed(spark, sf):
    return point_in_time_join(_daily_events(spark, sf), _events_dim(spark, sf), ["user_id"], "day",
                              {"event_type": "state"}, bounds="(]", start_col="ts")


def q_fill_days_supplier(spark, sf):
    li = standins.table(spark, sf, "lineitem")
    daily = li.groupBy("l_suppkey", F.to_date("l_shipdate").alias("date")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"))
    return fill_days(daily, ["l_suppkey"], "date", ["n_lines", "qty"], pos_col="pos")


def q_explode_results(spark, sf):
    return gold.load_lines(standins.activity(spark, sf)).select(
        "farm_license", "load", "seq_nr", "feed_id", "requested_g", "loaded_g", "completed", "off_g", "accuracy")


def _feed_names_dim(spark, sf):
    return silver.kitchen_feed_names_dim(standins.kitchen_feed_name_messages(spark, sf))


def _ration_names_dim(spark, sf):
    return silver.ration_names_dim(standins.ration_name_messages(spark, sf))


def _robot_config_dim(spark, sf):
    return silver.robot_config_dim(standins.robot_config_messages(spark, sf))


def _no_month(messages):
    """Messages for a lookup, which does not read the partition column of the stored dimension."""
    return messages.drop("year_month")


def _robot_lookup(spark, sf):
    return silver.robot_config_dim(_no_month(standins.robot_config_messages(spark, sf)))


def q_feed_names_dim(spark, sf):
    return _feed_names_dim(spark, sf)


def q_ration_names_dim(spark, sf):
    return _ration_names_dim(spark, sf)


def q_robot_config_dim(spark, sf):
    return _robot_config_dim(spark, sf)


def q_controller_periods(spark, sf):
    periods = gold.controller_periods(_robot_lookup(spark, sf))
    return periods.select("farm_license", "device_number", "start_time", "freq_controller_type_mixer",
                          "freq_controller_type_dosing_roller", "end_time", "duration_s", "schneider", "commsk")


def _stored(df, name):
    """A table below the checkpoint folder, as the layered run stores its levels."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_table(df, path, cluster=False)
    return read_table(spark, path, df.schema)


def _feed_names_lookup(spark, sf):
    return silver.kitchen_feed_names_dim(_no_month(standins.kitchen_feed_name_messages(spark, sf)))


def _feed_fact(spark, sf):
    return gold.feed_daily_fact(standins.activity(spark, sf), _feed_names_lookup(spark, sf))


def _ration_fact(spark, sf):
    names = silver.ration_names_dim(_no_month(standins.ration_name_messages(spark, sf)))
    return gold.ration_daily_fact(standins.activity(spark, sf), names)


def _farm_fact(spark, sf):
    return gold.farm_daily_fact(standins.activity(spark, sf), _robot_lookup(spark, sf))


def q_feed_fact_full(spark, sf):
    return _feed_fact(spark, sf)


def q_ration_fact_full(spark, sf):
    return _ration_fact(spark, sf)


def q_farm_fact_full(spark, sf):
    return _farm_fact(spark, sf)


def q_calendar(spark, sf):
    return calendar_of(standins.table(spark, sf, "lineitem"), "l_shipdate")


def q_missing_days(spark, sf):
    """Days without a cancelled-priority order; whole tables have a row on every day."""
    orders = standins.table(spark, sf, "orders").select(F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")).alias("day"))
    return checks.missing_days(orders, "day")


def q_missing_days_supplier(spark, sf):
    li = standins.table(spark, sf, "lineitem")
    return checks.missing_days(li, "l_shipdate", keys=["l_suppkey"])


def q_missing_days_null_key(spark, sf):
    """Some suppliers unknown: NULL is an entity like any other."""
    li = standins.table(spark, sf, "lineitem").select(
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey")).alias("supplier"), "l_shipdate", "l_returnflag")
    return checks.missing_days(li, "l_shipdate", keys=["supplier", "l_returnflag"])


def q_missing_days_feed_fact(spark, sf):
    """Gaps of the feed fact before they are filled."""
    return checks.missing_days(gold.FEED.daily(standins.activity(spark, sf)), "date", keys=["farm_license", "feed_id"])


def q_ration_bins_distinct(spark, sf):
    """Distinct loads per farm, day and ration, counted as such (the fact derives them from its two levels)."""
    lines = gold.load_lines(standins.activity(spark, sf))
    return lines.groupBy("farm_license", "date", "ration_id").agg(F.count_distinct("load").alias("n_bins"))


def q_row_count_check(spark, sf):
    return checks.row_counts({name: standins.table(spark, sf, name)
                              for name in ("lineitem", "orders", "events")}, min_rows=1)


def q_date_bounds(spark, sf):
    li = standins.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    return checks.date_bounds(li, "date")


def q_entity_list(spark, sf):
    lines = standins.table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("farm_license"))
    return checks.entity_list(lines, "farm_license")


def q_kpi_farm(spark, sf):
    """The chart's series over the stored fact, as the dashboard reads it."""
    return kpi.farm_kpi(_stored(_farm_fact(spark, sf), "farm-fact"), "loaded_weight_kg")


def q_kpi_farm_selected(spark, sf):
    """Chosen farms of the stored fact."""
    return kpi.farm_kpi(_stored(_farm_fact(spark, sf), "farm-fact"), "nr_schneider_freq_control", farms=["1", "3", "7", "nowhere"])


def q_kpi_feed(spark, sf):
    return kpi.feed_kpi(_stored(_feed_fact(spark, sf), "feed-fact"), "nr_times_loaded")


def q_kpi_farm_range(spark, sf):
    """KPI series with inclusive date bounds (the chart's date picker)."""
    return kpi.farm_kpi(_stored(_farm_fact(spark, sf), "farm-fact"), "nr_of_loading_activities_per_day",
                        start="1997-01-01", end="1998-12-31")


def q_kpi_ration(spark, sf):
    return kpi.ration_kpi(_stored(_ration_fact(spark, sf), "ration-fact"), "total_nr_of_feed_per_load")


def q_topk_preview(spark, sf):
    act = standins.activity(spark, sf).select(
        "farm_license", "loading_uuid", "seq_nr", "start_time", "end_time",
        "req_weight_ration_g", "loaded_weight_ration_g")
    return act.orderBy(*act.columns).limit(10)


def q_name_repair(spark, sf):
    docs = standins.table(spark, sf, "documents").select("doc_id", "text")
    return docs.select("doc_id", repair_mojibake(make_mojibake("text")).alias("text"))


def q_name_repair_keeps_texts(spark, sf):
    """Texts that must stay: undamaged ones, damage mixed with other scripts, and bytes that are no UTF-8."""
    return _kept_names(standins.table(spark, sf, "documents"), F.col("text"))


def _kept_names(docs, name):
    kinds = F.array(
        F.struct(F.lit("plain").alias("kind"), name.alias("name")),
        F.struct(F.lit("mixed").alias("kind"), F.concat(make_mojibake(name), F.lit("日")).alias("name")),
        F.struct(F.lit("not utf-8").alias("kind"), F.concat(name, F.lit("\u00e9"), F.lit("x")).alias("name")),
        F.struct(F.lit("damaged").alias("kind"), make_mojibake(F.concat(name, F.lit("\u00ef"))).alias("name")),
    )
    each = docs.select("doc_id", F.explode(kinds).alias("n"))
    return each.select("doc_id", "n.kind", repair_mojibake("n.name").alias("name"))


_AGG_DOUBLES = {
    "feed": ["avg_loading_speed_kg_per_h", "requested_weight_kg", "loaded_weight_kg",
             "avg_loading_deviation_kg", "total_loading_deviation_kg", "loading_accuracy_perc"],
    "ration": ["avg_loading_speed_kg_per_h", "requested_weight_kg", "loaded_weight_kg",
               "avg_loading_deviation_kg", "total_loading_deviation_kg", "loading_accuracy_perc"],
    "farm": ["avg_loading_speed_kg_per_h", "requested_weight_kg", "loaded_weight_kg",
             "avg_loading_deviation_kg", "total_loading_deviation_kg", "loading_accuracy_perc"],
}


def q_feed_daily_agg(spark, sf):
    return _round_cols(gold.FEED.daily(standins.activity(spark, sf)), _AGG_DOUBLES["feed"], 6)


def q_ration_two_level(spark, sf):
    return _round_cols(gold.RATION.daily(standins.activity(spark, sf)), _AGG_DOUBLES["ration"], 6)


def q_farm_daily_agg(spark, sf):
    return _round_cols(gold.FARM.daily(standins.activity(spark, sf)), _AGG_DOUBLES["farm"], 6)


_BRONZE_COLS = ["farm_license", "device_type", "device_number", "msg_type", "time", "data"]


def q_bronze_partition_roundtrip(spark, sf):
    """Bronze written partitioned by message type, read back with a pruned filter."""
    path = scratch_path(spark, "bronze-roundtrip")
    write_table(standins.messages(spark, sf).select(*_BRONZE_COLS), path, partition_by=["msg_type"])
    clicks = read_table(spark, path).where(F.col("msg_type") == "CLICK")
    return shred(clicks, "CLICK", "k INT", {"k": "k"}).select("farm_license", "time", "k")


def q_bronze_stream_ingest(spark, sf):
    """The events file ingested as a stream into a bronze table (availableNow)."""
    base = scratch_path(spark, "bronze-stream")
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    # a one-file glob keeps the stream's base path at the table folder
    source = spark.readStream.schema(schema).parquet(f"{sf}/[e]vents.parquet")
    query = ingest(
        source, f"{base}/table", f"{base}/checkpoint",
        transform=lambda df: with_lineage(standins.as_messages(to_timestamp_columns(df)).select(*_BRONZE_COLS)),
    )
    query.awaitTermination()
    return read_table(spark, f"{base}/table").select(*_BRONZE_COLS)


def q_shred_load_done(spark, sf):
    """LOAD_DONE messages built into their table (B3) with the results exploded (G1)."""
    done = parsers.LOAD_DONE.build(standins.load_done_messages(spark, sf))
    return done.select(
        "farm_license", "time", "ration_id", "seq_nr", "total_weight", "year_month", F.posexplode("results").alias("nth", "r")
    ).select("farm_license", "time", "ration_id", "seq_nr", "total_weight", "year_month", "nth", "r.*")


def q_shred_load_start(spark, sf):
    start = parsers.LOAD_START.build(standins.load_start_messages(spark, sf))
    return start.select("farm_license", "time", "ration_id", "req_weight", "start_weight", "seq_nr", "year_month")


def q_shred_robot_config(spark, sf):
    configs = parsers.ROBOT_CONFIG.build(standins.robot_config_payloads(spark, sf))
    return configs.select("farm_license", "device_type", "device_number", "time", "phases", "freq_type_mixer",
                          "freq_type_roller", "relays_type", "year_month")


def q_shred_feed_names(spark, sf):
    """KITCHEN_FEED_NAMES payloads parsed with the array exploded (B4)."""
    names = parsers.KITCHEN_FEED_NAMES.parse(standins.kitchen_feed_name_payloads(spark, sf)).withColumn(
        "year_month", F.date_format("time", "yyyy-MM"))
    return names.select("farm_license", "time", "feed_id", "name", "year_month")


def q_shred_ration_names(spark, sf):
    names = parsers.RATION_NAMES.build(standins.ration_name_payloads(spark, sf))
    return names.select("farm_license", "time", "ration_id", "name", "year_month")


def q_message_table_dedup(spark, sf):
    """silver0 message table build (parse, ``year_month``, de-duplication on the message key)."""
    table = parsers.KITCHEN_FEED_NAMES.build(standins.kitchen_feed_name_payloads(spark, sf))
    return table.select(*parsers.KITCHEN_FEED_NAMES.keys, "name", "year_month")


CSV_RECORDS = 250_000


def _bronze_csv(spark, sf, *messages):
    """Messages written as CSV files with a header, as the robots deliver them.

    The files are gzipped. Such a file is read by one task, so they are cut by their number of records.
    """
    path = scratch_path(spark, "bronze-csv")
    columns = ["farm_license", "device_type", "device_number", "msg_type", "time", "data"]
    rows = [m.select(*[F.col(c).cast("string") for c in columns]) for m in messages]
    options = {"header": True, "escape": '"', "compression": "gzip", "maxRecordsPerFile": CSV_RECORDS}
    with shuffles_released(spark):
        reduce(DataFrame.unionByName, rows).write.options(**options).csv(path)
    return path


def q_csv_scan_lineage(spark, sf):
    """The CSV read back whole, with its lineage columns."""
    path = _bronze_csv(spark, sf, standins.load_done_messages(spark, sf))
    read = read_csv_messages(spark, path)
    return read.select(
        "farm_license", "device_type", "device_number", "msg_type", "time", "data",
        F.col("source_path").contains("bronze-csv").alias("has_source"),
        F.col("processing_time").isNotNull().alias("has_time"),
    )


def q_pipeline_medallion(spark, sf):
    """CSV → bronze → silver0 → silver1 → gold with all contracts and checks; returns the feed fact.

    Every order is a load whose start message is sent a while before its done message."""
    messages = [standins.order_messages(spark, sf), standins.robot_config_payloads(spark, sf)]
    dirs = run_layers(spark, _bronze_csv(spark, sf, *messages), scratch_path(spark, "warehouse"))
    return read_table(spark, f"{dirs['gold']}/feed_daily_fact", schemas.FEED_DAILY_FACT)


_LAYERED: dict[tuple[str, str], dict] = {}


def _layered(spark, sf):
    """One layered run for the queries of a session: rations and durations differ from load to load."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LAYERED:
        messages = [standins.order_messages(spark, sf, varied=True), standins.robot_config_payloads(spark, sf)]
        _LAYERED[key] = run_layers(spark, _bronze_csv(spark, sf, *messages), scratch_path(spark, "layered"))
    return _LAYERED[key]


def _layer_table(layer, table, schema):
    def query(spark, sf):
        return read_table(spark, f"{_layered(spark, sf)[layer]}/{table}", schema)

    query.__doc__ = f"The {layer} table {table} of a layered run."
    return query


def q_pipeline_loading_activity(spark, sf):
    """Silver loads of a layered run; the results array as its size and total."""
    loads = _layer_table("silver", "silver_loading_activity", schemas.SILVER_LOADING_ACTIVITY)(spark, sf)
    total = F.aggregate("results", F.lit(0).cast("long"), lambda a, r: a + r["weight"])
    sized = {"n_results": F.when(F.col("results").isNotNull(), F.size("results")), "results_weight": total}
    return loads.withColumns(sized).drop("results")


def q_rejected_records(spark, sf):
    """Delivered CSV with broken times and device numbers: what fits the layout, and the rest as rejects."""
    event = F.col("event_id")
    rows = standins.messages(spark, sf).select(
        "farm_license", "device_type", F.when(event % 13 == 0, "x1").otherwise("1").alias("device_number"), "msg_type",
        F.when(event % 11 == 0, "soon").otherwise(F.col("time").cast("string")).alias("time"), "data")
    messages, rejects = split_csv_messages(spark, _bronze_csv(spark, sf, rows))
    field = F.split("record", ",", 6)
    good = messages.select(F.lit("message").alias("part"), "farm_license", "msg_type", "time")
    bad = rejects.where(F.col("source_path").isNotNull() & F.col("processing_time").isNotNull()).select(
        F.lit("rejected").alias("part"), field[0].alias("farm_license"), field[3].alias("msg_type"),
        F.when(field[4] == "soon", "soon").otherwise(field[2]).alias("wrong"))
    return good.unionByName(bad, allowMissingColumns=True)


def q_rejected_payloads(spark, sf):
    """Cut, mistyped, empty and missing payloads: every message is parsed or rejected."""
    event = F.col("event_id") % 8
    damage = F.when(event == 0, F.substring("data", 1, 5)).when(event == 1, '{"k": "many"}').when(event == 2, "")
    msgs = standins.messages(spark, sf).withColumn("data", damage.when(event > 3, F.col("data")))
    good = shred(msgs, "CLICK", "k INT", {"k": "k"}, malformed="drop").select(F.lit("parsed").alias("part"), "event_id", "k")
    bad = rejected(msgs, "CLICK", "k INT").select(F.lit("rejected").alias("part"), "event_id", "data")
    return good.unionByName(bad, allowMissingColumns=True)


def q_table_rewrites(spark, sf):
    """One partition replaced, then the whole table rewritten from itself without another."""
    path = scratch_path(spark, "rewrites")
    messages = standins.messages(spark, sf).select(*_BRONZE_COLS)
    write_table(messages, path, partition_by=["msg_type"])
    clicks = messages.where("msg_type = 'CLICK'").withColumn("device_number", F.lit(2))
    write_table(clicks, path, partition_by=["msg_type"], mode="partitions")
    write_table(read_table(spark, path).where("msg_type <> 'PURCHASE'"), path, partition_by=["msg_type"])
    return read_table(spark, path).select("farm_license", "device_number", "msg_type", "time", "data")


def q_written_counts(spark, sf):
    """Rows counted by the writes themselves."""
    counts = [(name, write_table(standins.table(spark, sf, name), scratch_path(spark, name))) for name in ("lineitem", "orders", "events")]
    return spark.createDataFrame(counts, "table string, n_rows long")


def q_reconcile_feed_days(spark, sf):
    """A feed fact that lost days and has a farm that never loaded, held against the loads."""
    loads = _stored(standins.activity(spark, sf), "loads")  # read for the fact and for its check
    fact = gold.feed_daily_fact(loads, _feed_names_lookup(spark, sf))
    lost = fact.where("NOT (CAST(farm_license AS INT) % 3 = 0 AND day(date) = 13)")
    added = fact.where("farm_license = '5'").withColumn("farm_license", F.lit("5x"))
    stored = _stored(lost.unionByName(added), "damaged-fact")
    return checks.reconcile_days(gold.FEED.observed_days(loads), stored, gold.FEED.keys, list(gold.FEED.measures))


def q_contract_findings(spark, sf):
    """NULLs in a required column and a key that names several rows."""
    lines = standins.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), (F.col("l_linenumber") % 3).alias("nr"), F.when(F.col("l_tax") <= 0.07, F.col("l_tax")).alias("tax"))
    return constraint_findings(lines, "order_key LONG NOT NULL, nr INT NOT NULL, tax DOUBLE NOT NULL", ["order_key", "nr"])


def q_split_intervals_century(spark, sf):
    """An interval of a century for each order status, cut by hours; summed up by year."""
    orders = standins.table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.min("o_orderdate").cast("timestamp").alias("since"))
    spans = orders.withColumn("until", F.col("since") + F.expr("INTERVAL '36525 01:30:00' DAY TO SECOND"))
    pieces = split_intervals(spans, "since", "until", "1 hours", spread=True)
    seconds = F.unix_seconds("until") - F.unix_seconds("since")
    return pieces.groupBy("o_orderstatus", F.year("since").alias("year")).agg(
        F.count(F.lit(1)).alias("n_pieces"), F.sum(seconds).alias("seconds"))


QUERIES: dict[str, Query] = {
    "pipeline_loading_activity": q_pipeline_loading_activity,
    "pipeline_robot_config_dim": _layer_table("silver", "silver_robot_config_dim", schemas.SILVER_ROBOT_CONFIG_DIM),
    "pipeline_feed_names_dim": _layer_table("silver", "silver_kitchen_feed_names_dim", schemas.SILVER_KITCHEN_FEED_NAMES_DIM),
    "pipeline_ration_names_dim": _layer_table("silver", "silver_ration_names_dim", schemas.SILVER_RATION_NAMES_DIM),
    "pipeline_feed_fact": _layer_table("gold", "feed_daily_fact", schemas.FEED_DAILY_FACT),
    "pipeline_ration_fact": _layer_table("gold", "ration_daily_fact", schemas.RATION_DAILY_FACT),
    "pipeline_farm_fact": _layer_table("gold", "farm_daily_fact", schemas.FARM_DAILY_FACT),
    "rejected_records": q_rejected_records,
    "rejected_payloads": q_rejected_payloads,
    "table_rewrites": q_table_rewrites,
    "written_counts": q_written_counts,
    "reconcile_feed_days": q_reconcile_feed_days,
    "contract_findings": q_contract_findings,
    "split_intervals_century": q_split_intervals_century,
    "shred_json": q_shred_json,
    "shred_load_done": q_shred_load_done,
    "shred_load_start": q_shred_load_start,
    "shred_robot_config": q_shred_robot_config,
    "shred_ration_names": q_shred_ration_names,
    "csv_scan_lineage": q_csv_scan_lineage,
    "pipeline_medallion": q_pipeline_medallion,
    "shred_feed_names": q_shred_feed_names,
    "dedup_first": q_dedup_first,
    "message_table_dedup": q_message_table_dedup,
    "scd2_events": q_scd2_events,
    "scd2_nested": q_scd2_nested,
    "pair_events_12h": q_pair_events_12h,
    "split_intervals_5h": q_split_intervals_5h,
    "split_intervals_week": q_split_intervals_week,
    "pit_join_each_event": q_pit_join_each_event,
    "pit_join_two_devices": q_pit_join_two_devices,
    "ration_bins_distinct": q_ration_bins_distinct,
    "missing_days_null_key": q_missing_days_null_key,
    "kpi_farm_selected": q_kpi_farm_selected,
    "name_repair_keeps_texts": q_name_repair_keeps_texts,
    "interval_join_generic": q_interval_join_generic,
    "split_intervals_day": q_split_intervals_day,
    "split_intervals_hour": q_split_intervals_hour,
    "pit_join_closed_open": q_pit_join_closed_open,
    "pit_join_open_closed": q_pit_join_open_closed,
    "fill_days_supplier": q_fill_days_supplier,
    "explode_results": q_explode_results,
    "feed_names_dim": q_feed_names_dim,
    "ration_names_dim": q_ration_names_dim,
    "robot_config_dim": q_robot_config_dim,
    "controller_periods": q_controller_periods,
    "feed_daily_agg": q_feed_daily_agg,
    "ration_two_level": q_ration_two_level,
    "farm_daily_agg": q_farm_daily_agg,
    "feed_fact_full": q_feed_fact_full,
    "ration_fact_full": q_ration_fact_full,
    "farm_fact_full": q_farm_fact_full,
    "calendar": q_calendar,
    "missing_days": q_missing_days,
    "missing_days_supplier": q_missing_days_supplier,
    "missing_days_feed_fact": q_missing_days_feed_fact,
    "row_count_check": q_row_count_check,
    "date_bounds": q_date_bounds,
    "entity_list": q_entity_list,
    "kpi_farm": q_kpi_farm,
    "kpi_feed": q_kpi_feed,
    "kpi_ration": q_kpi_ration,
    "kpi_farm_range": q_kpi_farm_range,
    "topk_preview": q_topk_preview,
    "name_repair": q_name_repair,
    "bronze_partition_roundtrip": q_bronze_partition_roundtrip,
    "bronze_stream_ingest": q_bronze_stream_ingest,
}
