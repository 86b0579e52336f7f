"""Table contracts of the layers, as DDL.

Fixed values: table layouts that must equal the reference's for the layer
contracts to hold (column names, order, types and NOT NULL flags).
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# ---- fixed values: bronze / silver0 -------------------------------------------------
BRONZE = """
    farm_license STRING, device_type STRING, device_number INTEGER, msg_type STRING,
    time TIMESTAMP, data STRING, processing_time TIMESTAMP, source_path STRING
"""

# ---- fixed values: JSON payloads per message type (camelCase field names) ------------
PAYLOAD_ROBOT_CONFIG = (
    "phases STRING, freqTypeMixer STRING, freqTypeRoller STRING, relaysType STRING"
)
PAYLOAD_LOAD_START = "rationId INT, reqWeight INT, startWeight INT, seqNr INT"
PAYLOAD_LOAD_DONE = (
    "rationId INT, weight INT, "
    "results ARRAY<STRUCT<feedId: INT, reqWeight: INT, weight: INT, completed: BOOLEAN>>, "
    "seqNr INT"
)
PAYLOAD_KITCHEN_FEED_NAMES = "feedNames ARRAY<STRUCT<feedId: INT, name: STRING>>"
PAYLOAD_RATION_NAMES = "rationNames ARRAY<STRUCT<rationId: INT, name: STRING>>"

# ---- fixed values: silver1 ----------------------------------------------------------
SILVER_LOADING_ACTIVITY = """
    farm_license STRING, device_number INTEGER, ration_id INTEGER, seq_nr INTEGER,
    year_month STRING, loading_uuid STRING NOT NULL, start_time TIMESTAMP,
    end_time TIMESTAMP, req_weight_ration_g INTEGER, weight_at_load_start_g INTEGER,
    loaded_weight_ration_g INTEGER,
    results ARRAY<STRUCT<feedId: INTEGER, reqWeight: INTEGER, weight: INTEGER, completed: BOOLEAN>>,
    duration_s LONG, loading_speed_ration_g_per_s DOUBLE
"""

SILVER_ROBOT_CONFIG_DIM = """
    farm_license STRING, device_number INTEGER, start_time TIMESTAMP, phases STRING,
    freq_controller_type_mixer STRING, freq_controller_type_dosing_roller STRING,
    relays_type STRING, year_month STRING, end_time TIMESTAMP, duration_s LONG,
    config_uuid STRING NOT NULL
"""

SILVER_KITCHEN_FEED_NAMES_DIM = """
    farm_license STRING, start_time TIMESTAMP, feed_id INTEGER, name STRING,
    year_month STRING, end_time TIMESTAMP, duration_s LONG
"""

SILVER_RATION_NAMES_DIM = """
    farm_license STRING, start_time TIMESTAMP, ration_id INTEGER, name STRING,
    year_month STRING, end_time TIMESTAMP, duration_s LONG
"""

# ---- fixed values: gold -------------------------------------------------------------
FEED_DAILY_FACT = """
    farm_license STRING, feed_id INTEGER, date DATE NOT NULL, nr_times_loaded LONG,
    avg_loading_speed_kg_per_h DOUBLE, requested_weight_kg DOUBLE, loaded_weight_kg DOUBLE,
    avg_loading_deviation_kg DOUBLE, total_loading_deviation_kg DOUBLE,
    loading_accuracy_perc DOUBLE, feed_name STRING
"""

RATION_DAILY_FACT = """
    farm_license STRING, ration_id INTEGER, date DATE NOT NULL,
    avg_loading_speed_kg_per_h DOUBLE, requested_weight_kg DOUBLE, loaded_weight_kg DOUBLE,
    avg_loading_deviation_kg DOUBLE, total_loading_deviation_kg DOUBLE,
    total_nr_of_feed_per_load LONG, total_nr_bins_loaded LONG, loading_accuracy_perc DOUBLE,
    ration_name STRING
"""

FARM_DAILY_FACT = """
    farm_license STRING, date DATE NOT NULL, avg_loading_speed_kg_per_h DOUBLE,
    requested_weight_kg DOUBLE, loaded_weight_kg DOUBLE, avg_loading_deviation_kg DOUBLE,
    total_loading_deviation_kg DOUBLE, nr_of_loading_activities_per_day LONG,
    loading_accuracy_perc DOUBLE, nr_schneider_freq_control INTEGER,
    nr_commsk_freq_control INTEGER
"""

CALENDAR = "date DATE NOT NULL"
# ---- end of fixed values ------------------------------------------------------------


def silver0_ddl(payload: str, typed: str) -> str:
    """Bronze with ``data`` parsed, the typed columns, and the partition column."""
    parsed = BRONZE.replace("data STRING", f"data STRUCT<{payload}>")
    return f"{parsed}, {typed}, year_month STRING"


SILVER0_ROBOT_CONFIG = silver0_ddl(
    PAYLOAD_ROBOT_CONFIG, "phases STRING, freq_type_mixer STRING, freq_type_roller STRING, relays_type STRING"
)
SILVER0_LOAD_START = silver0_ddl(
    PAYLOAD_LOAD_START, "ration_id INTEGER, req_weight INTEGER, start_weight INTEGER, seq_nr INTEGER"
)
SILVER0_LOAD_DONE = silver0_ddl(
    PAYLOAD_LOAD_DONE,
    "ration_id INTEGER, total_weight INTEGER, "
    "results ARRAY<STRUCT<feedId: INTEGER, reqWeight: INTEGER, weight: INTEGER, completed: BOOLEAN>>, seq_nr INTEGER",
)
SILVER0_RATION_NAMES = silver0_ddl(PAYLOAD_RATION_NAMES, "ration_id INTEGER, name STRING")
SILVER0_KITCHEN_FEED_NAMES = silver0_ddl(PAYLOAD_KITCHEN_FEED_NAMES, "feed_id INTEGER, name STRING")


def struct(ddl: str) -> StructType:
    """Parse a DDL column list into a ``StructType``."""
    return StructType.fromDDL(" ".join(ddl.split()))
