"""Silver1: loading activities and the three SCD2 dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hayloft.functions.measures import surrogate_key
from hayloft.functions.names import repair_mojibake
from hayloft.functions.time import epoch_seconds
from hayloft.operators.pairing import pair_events
from hayloft.operators.scd import CONFIGURATION_BUCKET_SECONDS, scd2

# Columns of the message envelope, keys that pair messages, the longest load, and
# the controllers' names in the dimension.
ENVELOPE_COLUMNS = ("device_type", "msg_type", "processing_time", "data", "source_path")
ACTIVITY_KEYS = ("farm_license", "device_number", "ration_id", "seq_nr")
MAX_LOADING_SECONDS = 12 * 3600
CONTROLLER_NAMES = {"freq_type_mixer": "freq_controller_type_mixer", "freq_type_roller": "freq_controller_type_dosing_roller"}
# Fixed value: phase labels mapped to the number of phases.
PHASES_MAP = {"THREE_PHASE": "3", "ONE_PHASE": "1"}
# Fixed value: settings whose change begins a configuration period.
TRACKED_SETTINGS = ("freq_type_mixer", "freq_type_roller", "relays_type", "phases")


def loading_activity(
    load_start: DataFrame, load_done: DataFrame, *, id_mode: str = "hash"
) -> DataFrame:
    """Pair LOAD_START with LOAD_DONE messages into loading activities.

    Pairs share farm, device, ration and sequence number and end less than
    12 h after they start; every match is kept. ``loading_uuid`` is made on
    the start side, so all ends paired with one start share it. Speed is
    ``loaded / duration_s`` and NULL for a zero duration (no ANSI error).
    """
    # all keys that a start message is distinct on, the device type too where it is known
    message_keys = [c for c in (*ACTIVITY_KEYS, "device_type") if c in load_start.columns]
    # a hash follows from the start's own columns, which are shorter than it: it is made of them once they are paired
    late = id_mode == "hash"
    carried = [c for c in message_keys if c not in ACTIVITY_KEYS]
    starts = load_start.select(
        *ACTIVITY_KEYS,
        F.col("time").alias("start_time"),
        "year_month",
        F.col("req_weight").alias("req_weight_ration_g"),
        F.col("start_weight").alias("weight_at_load_start_g"),
        *(carried if late else [surrogate_key(*message_keys, F.unix_micros("time"), mode=id_mode).alias("loading_uuid")]),
    )
    ends = load_done.select(
        *ACTIVITY_KEYS,
        F.col("time").alias("end_time"),
        F.col("total_weight").alias("loaded_weight_ration_g"),
        "results",
    )
    paired = pair_events(starts, ends, ACTIVITY_KEYS, max_gap_seconds=MAX_LOADING_SECONDS)
    duration = epoch_seconds("end_time") - epoch_seconds("start_time")
    load_id = surrogate_key(*message_keys, F.unix_micros("start_time")).alias("loading_uuid")
    return paired.select(
        *ACTIVITY_KEYS,
        "year_month",
        load_id if late else "loading_uuid",
        "start_time",
        "end_time",
        "req_weight_ration_g",
        "weight_at_load_start_g",
        "loaded_weight_ration_g",
        "results",
        duration.alias("duration_s"),
        F.try_divide(F.col("loaded_weight_ration_g"), duration).alias("loading_speed_ration_g_per_s"),
    )


def robot_config_dim(robot_config: DataFrame, *, id_mode: str = "hash") -> DataFrame:
    """Configuration periods per robot (farm, device)."""
    return with_config_id(_config_periods(robot_config), id_mode=id_mode)


def _config_periods(robot_config: DataFrame, *, one_per_state: bool = False) -> DataFrame:
    configs = (
        robot_config.where(F.col("device_type") == "robot")
        .where(F.col("relays_type") != "UNKNOWN")
        .drop(*ENVELOPE_COLUMNS)
    )
    return _periods(configs, ["farm_license", "device_number"], list(TRACKED_SETTINGS), one_per_state)


def with_config_id(periods: DataFrame, *, id_mode: str = "hash") -> DataFrame:
    """The periods with their id, the dimension's names of controllers and numbers of phases."""
    key = surrogate_key("farm_license", "device_number", F.unix_micros("start_time"), *TRACKED_SETTINGS, mode=id_mode)
    return periods.withColumn("config_uuid", key).withColumnsRenamed(CONTROLLER_NAMES).replace(PHASES_MAP, subset=["phases"])


def _periods(messages: DataFrame, keys: list[str], tracked: list[str], one_per_state: bool) -> DataFrame:
    return scd2(
        messages, keys, tracked,
        bucket_seconds=CONFIGURATION_BUCKET_SECONDS, time_columns=["year_month"], one_per_state=one_per_state,
    )


def _names_dim(names: DataFrame, id_col: str, *, one_per_state: bool = False) -> DataFrame:
    cleaned = (
        names.where(F.col(id_col) != 0)
        .withColumn("name", repair_mojibake("name"))
        .drop("device_number", *ENVELOPE_COLUMNS)
    )
    return _periods(cleaned, ["farm_license", id_col], ["name"], one_per_state)


def kitchen_feed_names_dim(kitchen_feed_names: DataFrame) -> DataFrame:
    """Name periods per (farm, feed); all devices of a farm share one timeline."""
    return _names_dim(kitchen_feed_names, "feed_id")


def ration_names_dim(ration_names: DataFrame) -> DataFrame:
    """Name periods per (farm, ration)."""
    return _names_dim(ration_names, "ration_id")


# Of silver0 tables: those hold one message per device and time, so that a timeline has as many rows of
# one time as a farm has devices, and grouping them beforehand would only move them once more.
def stored_config_periods(robot_config: DataFrame) -> DataFrame:
    """:func:`robot_config_dim` of the silver0 table, without what :func:`with_config_id` adds."""
    return _config_periods(robot_config, one_per_state=True)


def stored_feed_names_dim(kitchen_feed_names: DataFrame) -> DataFrame:
    """:func:`kitchen_feed_names_dim` of the silver0 table."""
    return _names_dim(kitchen_feed_names, "feed_id", one_per_state=True)


def stored_ration_names_dim(ration_names: DataFrame) -> DataFrame:
    """:func:`ration_names_dim` of the silver0 table."""
    return _names_dim(ration_names, "ration_id", one_per_state=True)
