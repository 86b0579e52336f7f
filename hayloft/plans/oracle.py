"""DuckDB SQL equal in result to each registered query (the correctness gate).

Views ``lineitem orders events documents …`` are the raw parquet tables.
Helpers below keep the SQL in step with Spark's semantics:

* ``_sec(ts)``: whole epoch seconds, floored like ``unix_seconds``;
* ``_r(x, d)``: Spark's ``round`` of a DOUBLE is HALF_UP on its shortest
  decimal text, so the value goes through VARCHAR → DECIMAL before rounding;
* ``_scd2(...)``: lag → filter → lead with the open end, ordered by
  ``(time, fingerprint)`` like :func:`hayloft.operators.scd.scd2`.
"""

from __future__ import annotations

OPEN_END = "TIMESTAMP '2099-12-31 23:59:59'"


def _sec(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000000)"


def _r(x: str, d: int) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {d}) AS DOUBLE)"


def _scd2(src: str, keys: str, fp: str, t: str, name: str) -> str:
    """CTEs ``{name}_x``, ``{name}_k`` and ``{name}`` (with end_time, duration_s)."""
    return f"""
{name}_x AS (SELECT *, {fp} AS _fp,
                    lag({fp}) OVER (PARTITION BY {keys} ORDER BY {t}, {fp}) AS _prev FROM {src}),
{name}_k AS (SELECT * EXCLUDE (_prev) FROM {name}_x WHERE _prev IS NULL OR _prev <> _fp),
{name}_e AS (SELECT * EXCLUDE (_fp),
                    lead({t}, 1, {OPEN_END}) OVER (PARTITION BY {keys} ORDER BY {t}, _fp) AS end_time
             FROM {name}_k),
{name} AS (SELECT *, {_sec('end_time')} - {_sec(t)} AS duration_s FROM {name}_e)"""


def _fill(src: str, keys: str, measures: list[str], round2: list[str], name: str) -> str:
    """Daily gap fill: CTE ``{name}`` with ``date`` dense per key, measures at day 0 only."""
    cases = ", ".join(
        f"CASE WHEN _d = date THEN {_r(m, 2) if m in round2 else m} END AS {m}" for m in measures
    )
    return f"""
{name}_n AS (SELECT *, lead(date) OVER (PARTITION BY {keys} ORDER BY date) AS _n FROM {src}),
{name}_s AS (SELECT *, unnest(generate_series(CAST(date AS TIMESTAMP), CAST(coalesce(_n - 1, date) AS TIMESTAMP),
                                              INTERVAL 1 DAY)) AS _ts
             FROM {name}_n WHERE _n IS NULL OR _n > date),
{name}_d AS (SELECT * EXCLUDE (_ts, _n), CAST(_ts AS DATE) AS _d FROM {name}_s),
{name} AS (SELECT * EXCLUDE (date, _d, {', '.join(measures)}), _d AS date, {cases},
                  datediff('day', date, _d) AS pos FROM {name}_d)"""


# ------------------------------------------------------------------ shared stand-ins
EVENTS_DIM = _scd2("(SELECT event_id, ts, user_id, event_type FROM events)", "user_id",
                   "concat_ws(', ', event_type)", "ts", "edim")

PAIRS = f"""
msg AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(floor(value) % 2 + 1 AS INTEGER) AS seq_nr
        FROM events),
ls AS (SELECT CAST(user_id AS VARCHAR) AS farm_license, ts AS start_time, k % 2 + 1 AS ration_id, seq_nr,
              strftime(ts, '%Y-%m') AS year_month, k AS req_weight_ration_g,
              sha256(concat_ws(chr(1), user_id, 1, k % 2 + 1, seq_nr, 'robot', epoch_us(ts))) AS loading_uuid
       FROM msg WHERE upper(event_type) = 'CLICK'),
ld AS (SELECT CAST(user_id AS VARCHAR) AS farm_license, ts AS end_time, k % 2 + 1 AS ration_id, seq_nr,
              CAST(round(value * 100) AS INTEGER) AS loaded_weight_ration_g,
              CASE WHEN k % 5 <> 0 THEN k % 4 END AS n_results,
              CASE WHEN k % 5 <> 0 THEN list_sum(list_transform(range(1, k % 4 + 1), lambda i : k + i)) END AS weights
       FROM msg WHERE upper(event_type) = 'PURCHASE'),
pairs AS (SELECT ls.farm_license, 1 AS device_number, ration_id, seq_nr, year_month, loading_uuid,
                 start_time, end_time, req_weight_ration_g, 0 AS weight_at_load_start_g,
                 loaded_weight_ration_g,
                 {_sec('end_time')} - {_sec('start_time')} AS duration_s, CAST(n_results AS INTEGER) AS n_results,
                 CAST(CASE WHEN n_results = 0 THEN 0 ELSE weights END AS INTEGER) AS results_weight
          FROM ls JOIN ld USING (farm_license, ration_id, seq_nr)
          WHERE start_time < end_time AND {_sec('end_time')} - {_sec('start_time')} < 43200)"""

LOADS = """
lines AS (SELECT l_orderkey, l_linenumber AS nr, l_suppkey, l_shipdate, ascii(l_returnflag) AS feed_id,
                 CAST(l_quantity * 1000 AS INTEGER) AS req_g,
                 CAST(round(l_extendedprice * (1 - l_discount)) AS INTEGER) AS got_g, l_linestatus = 'F' AS completed,
                 concat('feed ', l_returnflag, '-', l_linestatus) AS name FROM lineitem),
loads AS (SELECT l_orderkey, CAST(arg_min(l_suppkey, nr * 100000000 + l_suppkey) AS VARCHAR) AS farm_license, max(l_shipdate) AS end_time,
                 CAST(count(*) AS INTEGER) AS seq_nr, CAST(sum(req_g) AS INTEGER) AS load_req_g,
                 CAST(sum(got_g) AS INTEGER) AS load_g,
                 strftime(max(l_shipdate), '%Y-%m') AS year_month
          FROM lines GROUP BY l_orderkey),
sent AS (SELECT * FROM lines WHERE l_orderkey % 17 <> 0 AND l_orderkey % 19 <> 0)"""

FEEDS = f"""
{LOADS},
act AS (SELECT loads.*, CAST(substring(o.o_orderpriority, 1, 1) AS INTEGER) AS ration_id,
               CAST(l_orderkey AS VARCHAR) AS loading_uuid, o.o_orderdate AS start_time,
               {_sec('end_time')} - {_sec('o.o_orderdate')} AS duration_s
        FROM loads JOIN orders o ON l_orderkey = o.o_orderkey),
feeds AS (SELECT act.*, feed_id, req_g, got_g, completed, load_g / NULLIF(duration_s, 0) AS speed, got_g - req_g AS dev_g,
                 least(req_g, got_g) / greatest(req_g, got_g) * 100 AS acc,
                 CAST(start_time AS DATE) AS date
          FROM act JOIN sent USING (l_orderkey) WHERE req_g > 0)"""

FEED_MEASURES_SQL = """
fd AS (SELECT farm_license, date, feed_id,
              count(farm_license) AS nr_times_loaded,
              avg(speed) / 3.6 AS avg_loading_speed_kg_per_h,
              CAST(sum(req_g) AS BIGINT) / 1000 AS requested_weight_kg,
              CAST(sum(got_g) AS BIGINT) / 1000 AS loaded_weight_kg,
              avg(dev_g) / 1000 AS avg_loading_deviation_kg,
              CAST(sum(dev_g) AS BIGINT) / 1000 AS total_loading_deviation_kg,
              avg(CASE WHEN completed THEN (CASE WHEN acc <= 0 THEN 0 ELSE acc END) END) AS loading_accuracy_perc
       FROM feeds WHERE speed > 0 AND duration_s > 1 GROUP BY farm_license, date, feed_id)"""

RATION_MEASURES_SQL = f"""
rl AS (SELECT farm_license, date, loading_uuid, min(speed) AS spd, min(ration_id) AS ration_id,
              CAST(sum(req_g) AS BIGINT) AS req_g, CAST(sum(got_g) AS BIGINT) AS got_g,
              avg(dev_g) AS avg_dev_g, CAST(sum(dev_g) AS BIGINT) AS sum_dev_g,
              sum(CASE WHEN acc <= 0 THEN 0 ELSE acc END) AS acc, count(feed_id) AS n_feed,
              CAST(CASE WHEN loading_uuid IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS bins
       FROM feeds WHERE duration_s > 1 AND load_g > 0 AND load_g < 1200000
       GROUP BY farm_license, date, loading_uuid),
rd AS (SELECT farm_license, date, ration_id,
              avg(spd) / 3.6 AS avg_loading_speed_kg_per_h,
              CAST(sum(req_g) AS BIGINT) / 1000 AS requested_weight_kg,
              CAST(sum(got_g) AS BIGINT) / 1000 AS loaded_weight_kg,
              avg(avg_dev_g) / 1000 AS avg_loading_deviation_kg,
              CAST(sum(sum_dev_g) AS BIGINT) / 1000 AS total_loading_deviation_kg,
              CAST(sum(n_feed) AS BIGINT) AS total_nr_of_feed_per_load,
              CAST(sum(bins) AS BIGINT) AS total_nr_bins_loaded,
              {_r('sum(acc) / NULLIF(sum(n_feed), 0)', 2)} AS loading_accuracy_perc
       FROM rl GROUP BY farm_license, date, ration_id)"""

FARM_MEASURES_SQL = """
fa AS (SELECT farm_license, date,
              avg(speed) / 3.6 AS avg_loading_speed_kg_per_h,
              CAST(sum(req_g) AS BIGINT) / 1000 AS requested_weight_kg,
              CAST(sum(got_g) AS BIGINT) / 1000 AS loaded_weight_kg,
              avg(dev_g) / 1000 AS avg_loading_deviation_kg,
              avg(dev_g) / 1000 AS total_loading_deviation_kg,
              count(loading_uuid) AS nr_of_loading_activities_per_day,
              sum(CASE WHEN acc <= 0 THEN 0 ELSE acc END) / NULLIF(count(feed_id), 0) AS loading_accuracy_perc
       FROM feeds GROUP BY farm_license, date)"""

FEED_DIM = """
fnm AS (SELECT CAST(l_suppkey AS VARCHAR) AS farm_license, l_shipdate AS time,
               ascii(l_returnflag) AS feed_id, concat('feed ', l_returnflag, '-', l_linestatus) AS name,
               strftime(l_shipdate, '%Y-%m') AS year_month
        FROM lineitem WHERE ascii(l_returnflag) <> 0),""" + _scd2(
    "fnm", "farm_license, feed_id", "concat_ws(', ', name)", "time", "fdim")

RATION_DIM = """
rnm AS (SELECT CAST(l.l_suppkey AS VARCHAR) AS farm_license, o.o_orderdate AS time,
               CAST(substring(o.o_orderpriority, 1, 1) AS INTEGER) AS ration_id,
               concat('ration ', o.o_orderstatus) AS name, strftime(o.o_orderdate, '%Y-%m') AS year_month
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        WHERE CAST(substring(o.o_orderpriority, 1, 1) AS INTEGER) <> 0),""" + _scd2(
    "rnm", "farm_license, ration_id", "concat_ws(', ', name)", "time", "rdim")

ROBOT_MESSAGES = """
rcm AS (SELECT CAST(l_suppkey AS VARCHAR) AS farm_license, (l_linenumber % 2) + 1 AS device_number,
               l_shipdate AS time,
               CASE WHEN l_tax >= 0.04 THEN 'THREE_PHASE' ELSE 'ONE_PHASE' END AS phases,
               CASE l_returnflag WHEN 'A' THEN 'SCHNEIDER' WHEN 'N' THEN 'COMMSK' ELSE 'OTHER' END AS freq_type_mixer,
               CASE WHEN l_linestatus = 'F' THEN 'SCHNEIDER' ELSE 'COMMSK' END AS freq_type_roller,
               CASE WHEN l_discount >= 0.09 THEN 'UNKNOWN' ELSE 'RELAY' END AS relays_type,
               strftime(l_shipdate, '%Y-%m') AS year_month
        FROM lineitem),"""

ROBOT_PERIODS = """
rcf AS (SELECT * FROM rcm WHERE relays_type <> 'UNKNOWN'),""" + _scd2(
    "rcf", "farm_license, device_number",
    "concat_ws(', ', freq_type_mixer, freq_type_roller, relays_type, phases)", "time", "cfg") + """,
cdim AS (SELECT sha256(concat_ws(chr(1), farm_license, device_number, epoch_us(time), freq_type_mixer, freq_type_roller,
                                   relays_type, phases)) AS config_uuid,
                farm_license, device_number, time AS start_time,
                CASE phases WHEN 'THREE_PHASE' THEN '3' WHEN 'ONE_PHASE' THEN '1' ELSE phases END AS phases,
                freq_type_mixer AS freq_controller_type_mixer,
                freq_type_roller AS freq_controller_type_dosing_roller,
                relays_type, year_month, end_time, duration_s
         FROM cfg),""" + _scd2(
    "(SELECT * EXCLUDE (end_time, duration_s) FROM cdim)", "farm_license, device_number",
    "concat_ws(', ', freq_controller_type_mixer, freq_controller_type_dosing_roller)", "start_time", "ctl") + """,
cc AS (SELECT *,
              CAST(freq_controller_type_mixer = 'SCHNEIDER' AS INTEGER)
                + CAST(freq_controller_type_dosing_roller = 'SCHNEIDER' AS INTEGER) AS schneider,
              CAST(freq_controller_type_mixer = 'COMMSK' AS INTEGER)
                + CAST(freq_controller_type_dosing_roller = 'COMMSK' AS INTEGER) AS commsk
       FROM ctl)"""

ROBOT_DIM = ROBOT_MESSAGES + ROBOT_PERIODS

FEED_FACT_TAIL = """
fdn AS (SELECT f.*, d.name AS feed_name FROM fd f LEFT JOIN fdim d
          ON f.farm_license = d.farm_license AND f.feed_id = d.feed_id
         AND CAST(f.date AS TIMESTAMP) >= d.time AND CAST(f.date AS TIMESTAMP) < d.end_time),""" + _fill(
    "fdn", "farm_license, feed_id",
    ["nr_times_loaded", "avg_loading_speed_kg_per_h", "requested_weight_kg", "loaded_weight_kg",
     "avg_loading_deviation_kg", "total_loading_deviation_kg", "loading_accuracy_perc"],
    ["avg_loading_speed_kg_per_h", "requested_weight_kg", "loaded_weight_kg",
     "avg_loading_deviation_kg", "total_loading_deviation_kg", "loading_accuracy_perc"], "feedfact")

FEED_FACT = f"{FEEDS},{FEED_MEASURES_SQL},{FEED_DIM},{FEED_FACT_TAIL}"

# The layered run: of done messages with equal keys the smallest stays; each meets its
# start message 90 minutes earlier, the day before.
KEPT_LOADS = """
kept AS (SELECT * FROM (SELECT loads.*, row_number() OVER (
           PARTITION BY farm_license, end_time, seq_nr ORDER BY load_g, l_orderkey % 17 <> 0, l_orderkey) AS rn FROM loads)
         WHERE rn = 1)"""

LAYERED_FEED_FACT = f"""
{LOADS},{KEPT_LOADS},
feeds AS (SELECT farm_license, CAST(end_time - INTERVAL 90 MINUTE AS DATE) AS date, feed_id, req_g, got_g, completed,
                 load_g / 5400 AS speed, 5400 AS duration_s, got_g - req_g AS dev_g,
                 least(req_g, got_g) / greatest(req_g, got_g) * 100 AS acc
          FROM kept JOIN sent USING (l_orderkey) WHERE req_g > 0),{FEED_MEASURES_SQL},
nm AS (SELECT farm_license, feed_id, end_time AS time, min(name) AS name FROM loads JOIN sent USING (l_orderkey)
       GROUP BY farm_license, feed_id, end_time),{_scd2("nm", "farm_license, feed_id", "concat_ws(', ', name)", "time", "fdim")},
{FEED_FACT_TAIL}"""

RATION_FACT_TAIL = """
rdn AS (SELECT r.*, d.name AS ration_name FROM rd r LEFT JOIN rdim d
          ON r.farm_license = d.farm_license AND r.ration_id = d.ration_id
         AND CAST(r.date AS TIMESTAMP) > d.time AND CAST(r.date AS TIMESTAMP) <= d.end_time),""" + _fill(
    "rdn", "farm_license, ration_id",
    ["avg_loading_speed_kg_per_h", "requested_weight_kg", "loaded_weight_kg", "avg_loading_deviation_kg",
     "total_loading_deviation_kg", "total_nr_of_feed_per_load", "total_nr_bins_loaded", "loading_accuracy_perc"],
    ["avg_loading_speed_kg_per_h", "requested_weight_kg", "loaded_weight_kg", "avg_loading_deviation_kg",
     "total_loading_deviation_kg", "loading_accuracy_perc"], "rationfact")

RATION_FACT = f"{FEEDS},{RATION_MEASURES_SQL},{RATION_DIM},{RATION_FACT_TAIL}"

FARM_FACT_TAIL = """
fj AS (SELECT f.*, c.schneider AS nr_schneider_freq_control, c.commsk AS nr_commsk_freq_control,
              row_number() OVER (PARTITION BY f.farm_license, f.date
                                 ORDER BY c.start_time DESC NULLS LAST, c.device_number DESC NULLS LAST,
                                          c.end_time DESC NULLS LAST) AS _rn
       FROM fa f LEFT JOIN cc c ON f.farm_license = c.farm_license
        AND CAST(f.date AS TIMESTAMP) > c.start_time AND CAST(f.date AS TIMESTAMP) <= c.end_time),
fj1 AS (SELECT * EXCLUDE (_rn) FROM fj WHERE _rn = 1),""" + _fill(
    "fj1", "farm_license",
    ["avg_loading_speed_kg_per_h", "requested_weight_kg", "loaded_weight_kg", "avg_loading_deviation_kg",
     "total_loading_deviation_kg", "nr_of_loading_activities_per_day", "loading_accuracy_perc",
     "nr_schneider_freq_control", "nr_commsk_freq_control"],
    ["avg_loading_speed_kg_per_h", "requested_weight_kg", "loaded_weight_kg", "avg_loading_deviation_kg",
     "total_loading_deviation_kg", "loading_accuracy_perc"], "farmfact")

FARM_FACT = f"{FEEDS},{FARM_MEASURES_SQL},{ROBOT_DIM},{FARM_FACT_TAIL}"

# The layered run with rations and durations from the data: message tables keep one row per
# key (of done messages the lightest, of others the smallest values), start and done messages of
# equal farm, ration and number pair within 12 hours.
LAYERED = f"""
{LOADS},
dones AS (SELECT * FROM (SELECT loads.*, CAST(l_orderkey % 3 + 1 AS INTEGER) AS ration_id, row_number() OVER (
            PARTITION BY farm_license, end_time, l_orderkey % 3, seq_nr ORDER BY load_g, l_orderkey % 17 <> 0, l_orderkey) AS rn FROM loads)
          WHERE rn = 1),
starts AS (SELECT farm_license, CAST(l_orderkey % 3 + 1 AS INTEGER) AS ration_id, seq_nr,
                  CAST(end_time AS TIMESTAMP) - to_seconds(1 << CAST(load_req_g // 1000 % 10 + 6 AS INTEGER)) AS start_time, min(load_req_g) AS load_req_g
           FROM loads GROUP BY ALL),
act AS (SELECT d.l_orderkey, s.farm_license, 1 AS device_number, s.ration_id, s.seq_nr, strftime(s.start_time, '%Y-%m') AS year_month,
               sha256(concat_ws(chr(1), s.farm_license, 1, s.ration_id, s.seq_nr, 'robot', epoch_us(s.start_time))) AS loading_uuid,
               s.start_time, CAST(d.end_time AS TIMESTAMP) AS end_time, s.load_req_g, d.load_g,
               {_sec('CAST(d.end_time AS TIMESTAMP)')} - {_sec('s.start_time')} AS duration_s
        FROM starts s JOIN dones d ON s.farm_license = d.farm_license AND s.ration_id = d.ration_id AND s.seq_nr = d.seq_nr
         AND s.start_time < d.end_time AND {_sec('CAST(d.end_time AS TIMESTAMP)')} - {_sec('s.start_time')} < 43200),
feeds AS (SELECT act.*, feed_id, req_g, got_g, completed, load_g / NULLIF(duration_s, 0) AS speed, got_g - req_g AS dev_g,
                 least(req_g, got_g) / greatest(req_g, got_g) * 100 AS acc, CAST(start_time AS DATE) AS date
          FROM act JOIN sent USING (l_orderkey) WHERE req_g > 0)"""

LAYERED_FEED_DIM = """
nm AS (SELECT farm_license, feed_id, end_time AS time, min(name) AS name, year_month FROM loads JOIN sent USING (l_orderkey)
       GROUP BY farm_license, feed_id, end_time, year_month),""" + _scd2("nm", "farm_license, feed_id", "concat_ws(', ', name)", "time", "fdim")

LAYERED_RATION_DIM = """
rn AS (SELECT farm_license, nr AS ration_id, end_time AS time, min(name) AS name, year_month FROM loads JOIN sent USING (l_orderkey)
       WHERE nr <> 0 GROUP BY farm_license, nr, end_time, year_month),""" + _scd2(
    "rn", "farm_license, ration_id", "concat_ws(', ', name)", "time", "rdim")

LAYERED_ROBOT_DIM = ROBOT_MESSAGES.replace("rcm AS", "rca AS") + """
rcm AS (SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY farm_license, device_number, time
          ORDER BY phases, freq_type_mixer, freq_type_roller, relays_type) AS nth FROM rca) WHERE nth = 1),""" + ROBOT_PERIODS

FEED_FACT_COLS = ("farm_license, feed_id, date, nr_times_loaded, avg_loading_speed_kg_per_h, requested_weight_kg, "
                  "loaded_weight_kg, avg_loading_deviation_kg, total_loading_deviation_kg, "
                  "loading_accuracy_perc, feed_name")
RATION_FACT_COLS = ("farm_license, ration_id, date, avg_loading_speed_kg_per_h, requested_weight_kg, "
                    "loaded_weight_kg, avg_loading_deviation_kg, total_loading_deviation_kg, "
                    "total_nr_of_feed_per_load, total_nr_bins_loaded, loading_accuracy_perc, ration_name")
FARM_FACT_COLS = ("farm_license, date, avg_loading_speed_kg_per_h, requested_weight_kg, loaded_weight_kg, "
                  "avg_loading_deviation_kg, total_loading_deviation_kg, nr_of_loading_activities_per_day, "
                  "loading_accuracy_perc, nr_schneider_freq_control, nr_commsk_freq_control")


def _r6(cols: list[str]) -> str:
    return ", ".join(f"{_r(c, 6)} AS {c}" for c in cols)


_AGG6 = ["avg_loading_speed_kg_per_h", "requested_weight_kg", "loaded_weight_kg",
         "avg_loading_deviation_kg", "total_loading_deviation_kg", "loading_accuracy_perc"]

ORACLE_SQL: dict[str, str] = {
    "shred_json": """
SELECT CAST(user_id AS VARCHAR) AS farm_license, event_id, ts AS time,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, strftime(ts, '%Y-%m') AS year_month
FROM events WHERE upper(event_type) = 'CLICK'""",

    "shred_load_done": f"""WITH {LOADS},{KEPT_LOADS}
SELECT farm_license, end_time AS time, seq_nr AS ration_id, seq_nr, load_g AS total_weight, year_month,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY nr, feed_id, req_g, got_g, completed) - 1 AS INTEGER) AS nth,
       feed_id AS feedId, req_g AS reqWeight, got_g AS weight, completed
FROM kept JOIN sent USING (l_orderkey)""",

    "shred_load_start": f"""WITH {LOADS}
SELECT farm_license, end_time AS time, seq_nr AS ration_id, min(load_req_g) AS req_weight, 0 AS start_weight, seq_nr,
       year_month
FROM loads GROUP BY farm_license, end_time, seq_nr, year_month""",

    "shred_robot_config": """
SELECT farm_license, 'robot' AS device_type, device_number, time, phases, freq_type_mixer, freq_type_roller, relays_type,
       year_month
FROM (SELECT *, row_number() OVER (PARTITION BY farm_license, device_number, time
                                   ORDER BY phases, freq_type_mixer, freq_type_roller, relays_type) AS rn FROM (
  SELECT CAST(l_suppkey AS VARCHAR) AS farm_license, (l_linenumber % 2) + 1 AS device_number, l_shipdate AS time,
         CASE WHEN l_tax >= 0.04 THEN 'THREE_PHASE' ELSE 'ONE_PHASE' END AS phases,
         CASE l_returnflag WHEN 'A' THEN 'SCHNEIDER' WHEN 'N' THEN 'COMMSK' ELSE 'OTHER' END AS freq_type_mixer,
         CASE WHEN l_linestatus = 'F' THEN 'SCHNEIDER' ELSE 'COMMSK' END AS freq_type_roller,
         CASE WHEN l_discount >= 0.09 THEN 'UNKNOWN' ELSE 'RELAY' END AS relays_type,
         strftime(l_shipdate, '%Y-%m') AS year_month FROM lineitem)) WHERE rn = 1""",

    "shred_feed_names": f"""WITH {LOADS}
SELECT farm_license, end_time AS time, feed_id, name, year_month FROM loads JOIN sent USING (l_orderkey)""",

    "shred_ration_names": f"""WITH {LOADS}
SELECT farm_license, end_time AS time, nr AS ration_id, min(name) AS name, year_month
FROM loads JOIN sent USING (l_orderkey) GROUP BY farm_license, end_time, nr, year_month""",

    "message_table_dedup": f"""WITH {LOADS}
SELECT farm_license, 'robot' AS device_type, 1 AS device_number, end_time AS time, feed_id, min(name) AS name, year_month
FROM loads JOIN sent USING (l_orderkey) GROUP BY farm_license, end_time, feed_id, year_month""",

    "csv_scan_lineage": f"""WITH {LOADS},
payload AS (SELECT l_orderkey, string_agg(concat('{{"feedId":', feed_id, ',"reqWeight":', req_g, ',"weight":', got_g,
                     ',"completed":', completed, '}}'), ',' ORDER BY nr, feed_id, req_g, got_g, completed) AS results FROM lines GROUP BY l_orderkey)
SELECT farm_license, 'robot' AS device_type, 1 AS device_number, 'LOAD_DONE' AS msg_type, end_time AS time,
       concat('{{"rationId":', seq_nr, ',"weight":', load_g,
              CASE WHEN l_orderkey % 17 = 0 THEN '' WHEN l_orderkey % 19 = 0 THEN ',"results":[]'
                   ELSE concat(',"results":[', results, ']') END, ',"seqNr":', seq_nr, '}}') AS data,
       true AS has_source, true AS has_time
FROM loads JOIN payload USING (l_orderkey)""",

    "dedup_first": """
SELECT user_id, event_type, day, event_id, ts, value FROM (
  SELECT user_id, event_type, CAST(ts AS DATE) AS day, event_id, ts, value,
         row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn = 1""",

    "scd2_events": f"WITH {EVENTS_DIM} SELECT * FROM edim",

    "scd2_nested": "WITH " + _scd2(
        "(SELECT event_id, ts, user_id, event_type, CASE WHEN value >= 25 THEN 'HIGH' ELSE 'LOW' END AS band "
        "FROM events)", "user_id", "concat_ws(', ', event_type, band)", "ts", "lvl1") + "," + _scd2(
        "(SELECT * EXCLUDE (end_time, duration_s) FROM lvl1)", "user_id", "concat_ws(', ', event_type)",
        "ts", "lvl2") + " SELECT user_id, ts, event_type, end_time, duration_s FROM lvl2",

    "pair_events_12h": f"""WITH {PAIRS}
SELECT *, loaded_weight_ration_g / NULLIF(duration_s, 0) AS loading_speed_ration_g_per_s FROM pairs""",

    "split_intervals_5h": f"""WITH {PAIRS},
p AS (SELECT farm_license, start_time, end_time, {_sec('start_time')} // 18000 AS k0,
             unnest(range({_sec('start_time')} // 18000, {_sec('end_time')} // 18000 + 1)) AS k FROM pairs),
q AS (SELECT farm_license, greatest(start_time, make_timestamp(k * 18000 * 1000000)) AS ps,
             least(make_timestamp((k + 1) * 18000 * 1000000), end_time) AS pe, k - k0 AS pos FROM p)
SELECT farm_license, ps AS start_time, pe AS end_time, CAST(ps AS DATE) AS start_date,
       CAST(pe AS DATE) AS end_date, CAST(pos AS INTEGER) AS pos
FROM q WHERE {_sec('pe')} > {_sec('ps')}""",

    "split_intervals_week": f"""WITH {ROBOT_DIM},
p AS (SELECT farm_license, device_number, start_time, end_time,
             datediff('day', DATE '1970-01-01', CAST(start_time AS DATE)) // 7 AS k0,
             unnest(range(datediff('day', DATE '1970-01-01', CAST(start_time AS DATE)) // 7,
                          datediff('day', DATE '1970-01-01', CAST(end_time AS DATE)) // 7 + 1)) AS k
      FROM cdim WHERE end_time < TIMESTAMP '2099-01-01'),
q AS (SELECT farm_license, device_number,
             greatest(start_time, CAST(DATE '1970-01-01' + CAST(7 * k AS INTEGER) AS TIMESTAMP)) AS ps,
             least(CAST(DATE '1970-01-01' + CAST(7 * (k + 1) AS INTEGER) AS TIMESTAMP), end_time) AS pe, k - k0 AS pos FROM p)
SELECT farm_license, device_number, ps AS start_time, pe AS end_time, CAST(ps AS DATE) AS start_date,
       CAST(pe AS DATE) AS end_date, CAST(pos AS INTEGER) AS pos
FROM q WHERE {_sec('pe')} > {_sec('ps')}""",

    "interval_join_generic": f"""
SELECT s.user_id, s.ts AS start_time, s.event_id AS start_id, e.ts AS end_time, e.event_id AS end_id
FROM events s JOIN events e ON s.user_id = e.user_id AND s.event_type = 'view' AND e.event_type = 'signup'
 AND s.ts < e.ts AND {_sec('e.ts')} - {_sec('s.ts')} < 21600""",

    "split_intervals_day": f"""WITH {PAIRS},
p AS (SELECT farm_license, start_time, end_time,
             unnest(range(0, datediff('day', CAST(start_time AS DATE), CAST(end_time AS DATE)) + 1)) AS k
      FROM pairs),
q AS (SELECT farm_license,
             greatest(start_time, CAST(CAST(start_time AS DATE) + CAST(k AS INTEGER) AS TIMESTAMP)) AS ps,
             least(CAST(CAST(start_time AS DATE) + CAST(k + 1 AS INTEGER) AS TIMESTAMP), end_time) AS pe,
             CAST(k AS INTEGER) AS pos
      FROM p)
SELECT farm_license, ps AS start_time, pe AS end_time, CAST(ps AS DATE) AS start_date,
       CAST(pe AS DATE) AS end_date, pos
FROM q WHERE {_sec('pe')} > {_sec('ps')}""",

    "split_intervals_hour": f"""WITH {PAIRS},
m AS (SELECT farm_license, start_time, end_time, date_trunc('day', start_time) AS mid FROM pairs),
p AS (SELECT *, ({_sec('start_time')} - {_sec('mid')}) // 3600 AS k0,
             unnest(range(({_sec('start_time')} - {_sec('mid')}) // 3600,
                          ({_sec('end_time')} - {_sec('mid')}) // 3600 + 1)) AS k
      FROM m),
q AS (SELECT farm_license, greatest(start_time, mid + to_hours(k)) AS ps,
             least(mid + to_hours(k + 1), end_time) AS pe, k - k0 AS pos
      FROM p)
SELECT farm_license, ps AS start_time, pe AS end_time, CAST(ps AS DATE) AS start_date,
       CAST(pe AS DATE) AS end_date, CAST(pos AS INTEGER) AS pos
FROM q WHERE {_sec('pe')} > {_sec('ps')}""",

    "pit_join_closed_open": f"""WITH {EVENTS_DIM},
f AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_events FROM events GROUP BY user_id, CAST(ts AS DATE))
SELECT f.user_id, f.day, f.n_events, d.event_type AS state FROM f LEFT JOIN edim d
  ON f.user_id = d.user_id AND CAST(f.day AS TIMESTAMP) >= d.ts AND CAST(f.day AS TIMESTAMP) < d.end_time""",

    "pit_join_open_closed": f"""WITH {EVENTS_DIM},
f AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_events FROM events GROUP BY user_id, CAST(ts AS DATE))
SELECT f.user_id, f.day, f.n_events, d.event_type AS state FROM f LEFT JOIN edim d
  ON f.user_id = d.user_id AND CAST(f.day AS TIMESTAMP) > d.ts AND CAST(f.day AS TIMESTAMP) <= d.end_time""",

    "pit_join_each_event": f"""WITH {EVENTS_DIM}
SELECT e.event_id, e.user_id, e.ts AS at, d.event_type AS state FROM events e LEFT JOIN edim d
  ON e.user_id = d.user_id AND e.ts > d.ts AND e.ts <= d.end_time""",

    "pit_join_two_devices": f"""WITH {ROBOT_DIM},
f AS (SELECT CAST(l_suppkey AS VARCHAR) AS farm_license, CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber FROM lineitem),
days AS (SELECT DISTINCT farm_license, day FROM f),
hit AS (SELECT d.farm_license, d.day, c.phases, c.device_number, row_number() OVER (
               PARTITION BY d.farm_license, d.day ORDER BY c.start_time DESC, c.device_number DESC) AS rn
        FROM days d JOIN cdim c ON d.farm_license = c.farm_license AND CAST(d.day AS TIMESTAMP) > c.start_time
         AND CAST(d.day AS TIMESTAMP) <= c.end_time WHERE c.end_time < TIMESTAMP '2099-01-01')
SELECT f.farm_license, f.day, f.l_orderkey, f.l_linenumber, h.phases, h.device_number AS device
FROM f LEFT JOIN (SELECT * FROM hit WHERE rn = 1) h ON f.farm_license = h.farm_license AND f.day = h.day""",

    "ration_bins_distinct": f"""WITH {FEEDS}
SELECT farm_license, date, ration_id, count(DISTINCT loading_uuid) AS n_bins FROM feeds GROUP BY farm_license, date, ration_id""",

    "fill_days_supplier": """WITH
dl AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, count(*) AS n_lines, sum(l_quantity) AS qty
       FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)),""" + _fill(
        "dl", "l_suppkey", ["n_lines", "qty"], ["qty"], "fl") + """
SELECT l_suppkey, date, n_lines, qty, CAST(pos AS INTEGER) AS pos FROM fl""",

    "explode_results": f"""WITH {FEEDS}
SELECT farm_license, loading_uuid AS load, seq_nr, feed_id, req_g AS requested_g, got_g AS loaded_g, completed,
       dev_g AS off_g, acc AS accuracy
FROM feeds""",

    "feed_names_dim": f"WITH {FEED_DIM} SELECT farm_license, time AS start_time, feed_id, name, year_month, "
                      "end_time, duration_s FROM fdim",

    "ration_names_dim": f"WITH {RATION_DIM} SELECT farm_license, time AS start_time, ration_id, name, "
                        "year_month, end_time, duration_s FROM rdim",

    "robot_config_dim": f"WITH {ROBOT_DIM} SELECT * FROM cdim",

    "controller_periods": f"""WITH {ROBOT_DIM}
SELECT farm_license, device_number, start_time, freq_controller_type_mixer,
       freq_controller_type_dosing_roller, end_time, duration_s, schneider, commsk FROM cc""",

    "feed_daily_agg": f"WITH {FEEDS},{FEED_MEASURES_SQL} SELECT farm_license, date, feed_id, nr_times_loaded, "
                      f"{_r6(_AGG6)} FROM fd",

    "ration_two_level": f"WITH {FEEDS},{RATION_MEASURES_SQL} SELECT farm_license, date, ration_id, "
                        f"total_nr_of_feed_per_load, total_nr_bins_loaded, {_r6(_AGG6)} FROM rd",

    "farm_daily_agg": f"WITH {FEEDS},{FARM_MEASURES_SQL} SELECT farm_license, date, "
                      f"nr_of_loading_activities_per_day, {_r6(_AGG6)} FROM fa",

    "pipeline_medallion": f"WITH {LAYERED_FEED_FACT} SELECT {FEED_FACT_COLS} FROM feedfact",
    "feed_fact_full": f"WITH {FEED_FACT} SELECT {FEED_FACT_COLS} FROM feedfact",
    "ration_fact_full": f"WITH {RATION_FACT} SELECT {RATION_FACT_COLS} FROM rationfact",
    "farm_fact_full": f"WITH {FARM_FACT} SELECT {FARM_FACT_COLS} FROM farmfact",

    "calendar": """WITH b AS (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi
                        FROM lineitem),
s AS (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS ts
      FROM b WHERE lo IS NOT NULL)
SELECT CAST(ts AS DATE) AS date FROM s""",

    "missing_days": """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'P'),
b AS (SELECT min(d) AS lo, max(d) AS hi FROM o),
s AS (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS ts
      FROM b WHERE lo IS NOT NULL)
SELECT CAST(ts AS DATE) AS date FROM s WHERE CAST(ts AS DATE) NOT IN (SELECT d FROM o)""",

    "missing_days_null_key": """WITH
l AS (SELECT CASE WHEN l_suppkey % 5 <> 0 THEN l_suppkey END AS supplier, l_returnflag, CAST(l_shipdate AS DATE) AS d
      FROM lineitem),
b AS (SELECT supplier, l_returnflag, min(d) AS lo, max(d) AS hi FROM l GROUP BY supplier, l_returnflag),
e AS (SELECT supplier, l_returnflag,
             CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT e.* FROM e ANTI JOIN l ON e.supplier IS NOT DISTINCT FROM l.supplier AND e.l_returnflag = l.l_returnflag
  AND e.date = l.d""",

    "missing_days_supplier": """WITH b AS (SELECT l_suppkey, min(CAST(l_shipdate AS DATE)) AS lo,
                               max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem GROUP BY l_suppkey),
s AS (SELECT l_suppkey, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS ts
      FROM b WHERE lo IS NOT NULL),
e AS (SELECT l_suppkey, CAST(ts AS DATE) AS date FROM s)
SELECT e.l_suppkey, e.date FROM e ANTI JOIN lineitem l
  ON e.l_suppkey IS NOT DISTINCT FROM l.l_suppkey AND e.date = CAST(l.l_shipdate AS DATE)""",

    "missing_days_feed_fact": f"""WITH {FEEDS},{FEED_MEASURES_SQL},
b AS (SELECT farm_license, feed_id, min(date) AS lo, max(date) AS hi FROM fd GROUP BY farm_license, feed_id),
s AS (SELECT farm_license, feed_id, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                                                 INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT s.* FROM s ANTI JOIN fd ON s.farm_license = fd.farm_license AND s.feed_id = fd.feed_id AND s.date = fd.date""",

    "rejected_records": """
SELECT CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 'rejected' ELSE 'message' END AS part,
       CAST(user_id AS VARCHAR) AS farm_license, upper(event_type) AS msg_type,
       CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN ts END AS time,
       CASE WHEN event_id % 11 = 0 THEN 'soon' WHEN event_id % 13 = 0 THEN 'x1' END AS wrong
FROM events""",

    "rejected_payloads": """
SELECT CASE WHEN event_id % 8 < 3 THEN 'rejected' ELSE 'parsed' END AS part, event_id,
       CASE WHEN event_id % 8 > 3 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       CASE event_id % 8 WHEN 0 THEN props[1:5] WHEN 1 THEN '{"k": "many"}' WHEN 2 THEN '' END AS data
FROM events WHERE upper(event_type) = 'CLICK'""",

    "table_rewrites": """
SELECT CAST(user_id AS VARCHAR) AS farm_license, CASE WHEN upper(event_type) = 'CLICK' THEN 2 ELSE 1 END AS device_number,
       upper(event_type) AS msg_type, ts AS time, props AS data
FROM events WHERE upper(event_type) <> 'PURCHASE'""",

    "written_counts": """
SELECT 'lineitem' AS "table", count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events""",

    "reconcile_feed_days": f"""WITH {FEEDS},{FEED_MEASURES_SQL}
SELECT farm_license, feed_id, date, 'missing' AS finding FROM fd WHERE CAST(farm_license AS INTEGER) % 3 = 0 AND day(date) = 13
UNION ALL SELECT '5x', feed_id, date, 'unobserved' FROM fd WHERE farm_license = '5'""",

    "contract_findings": """
SELECT 'tax NOT NULL' AS "constraint", count(*) AS n_rows FROM lineitem WHERE NOT coalesce(l_tax <= 0.07, false) HAVING count(*) > 0
UNION ALL SELECT 'unique order_key, nr', CAST(sum(n) AS BIGINT)
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber % 3) WHERE n > 1 HAVING count(*) > 0""",

    "split_intervals_century": """WITH spans AS (
  SELECT o_orderstatus, CAST(min(o_orderdate) AS TIMESTAMP) AS since,
         CAST(min(o_orderdate) AS TIMESTAMP) + INTERVAL 36525 DAY + INTERVAL 90 MINUTE AS until FROM orders GROUP BY o_orderstatus),
hours AS (SELECT o_orderstatus, until, unnest(generate_series(since, until - INTERVAL 1 SECOND, INTERVAL 1 HOUR)) AS a FROM spans)
SELECT o_orderstatus, CAST(year(a) AS INTEGER) AS year, count(*) AS n_pieces,
       CAST(sum(epoch(least(a + INTERVAL 1 HOUR, until)) - epoch(a)) AS BIGINT) AS seconds
FROM hours GROUP BY o_orderstatus, year(a)""",

    "pipeline_loading_activity": f"""WITH {LAYERED},
sums AS (SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n, CAST(sum(got_g) AS BIGINT) AS g FROM sent GROUP BY l_orderkey)
SELECT farm_license, device_number, ration_id, seq_nr, year_month, loading_uuid, start_time, end_time,
       load_req_g AS req_weight_ration_g, 0 AS weight_at_load_start_g, load_g AS loaded_weight_ration_g, duration_s,
       load_g / duration_s AS loading_speed_ration_g_per_s,
       CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE coalesce(n, 0) END AS n_results,
       CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE coalesce(g, 0) END AS results_weight
FROM act LEFT JOIN sums USING (l_orderkey)""",

    "pipeline_robot_config_dim": f"WITH {LAYERED_ROBOT_DIM} SELECT * FROM cdim",
    "pipeline_feed_names_dim": f"""WITH {LOADS},{LAYERED_FEED_DIM}
SELECT farm_license, time AS start_time, feed_id, name, year_month, end_time, duration_s FROM fdim""",
    "pipeline_ration_names_dim": f"""WITH {LOADS},{LAYERED_RATION_DIM}
SELECT farm_license, time AS start_time, ration_id, name, year_month, end_time, duration_s FROM rdim""",
    "pipeline_feed_fact": f"WITH {LAYERED},{FEED_MEASURES_SQL},{LAYERED_FEED_DIM},{FEED_FACT_TAIL} SELECT {FEED_FACT_COLS} FROM feedfact",
    "pipeline_ration_fact": f"WITH {LAYERED},{RATION_MEASURES_SQL},{LAYERED_RATION_DIM},{RATION_FACT_TAIL} SELECT {RATION_FACT_COLS} FROM rationfact",
    "pipeline_farm_fact": f"WITH {LAYERED},{FARM_MEASURES_SQL},{LAYERED_ROBOT_DIM},{FARM_FACT_TAIL} SELECT {FARM_FACT_COLS} FROM farmfact",

    "row_count_check": """
SELECT 'lineitem' AS "table", count(*) AS n_rows, count(*) > 1 AS ok FROM lineitem
UNION ALL SELECT 'orders', count(*), count(*) > 1 FROM orders
UNION ALL SELECT 'events', count(*), count(*) > 1 FROM events""",

    "date_bounds": """SELECT min(CAST(l_shipdate AS DATE)) AS min_date, max(CAST(l_shipdate AS DATE)) AS max_date
FROM lineitem""",

    "entity_list": """SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS farm_license
FROM lineitem WHERE l_suppkey IS NOT NULL ORDER BY 1""",

    "kpi_farm_selected": f"""WITH {FARM_FACT}
SELECT farm_license, date, CAST(coalesce(sum(nr_schneider_freq_control), 0) AS BIGINT) AS nr_schneider_freq_control
FROM farmfact WHERE farm_license IN ('1', '3', '7', 'nowhere') AND date IS NOT NULL
GROUP BY farm_license, date ORDER BY farm_license, date""",

    "name_repair_keeps_texts": """
SELECT doc_id, kind, CASE kind
    WHEN 'plain' THEN n WHEN 'not utf-8' THEN n || 'éx' WHEN 'damaged' THEN n || 'ï'
    ELSE array_to_string(list_transform(string_split(n, ''), lambda c : CASE
           WHEN ord(c) < 128 THEN c
           WHEN ord(c) < 2048 THEN chr(192 + ord(c) // 64) || chr(128 + ord(c) % 64)
           WHEN ord(c) < 65536 THEN chr(224 + ord(c) // 4096) || chr(128 + ord(c) // 64 % 64) || chr(128 + ord(c) % 64)
           ELSE chr(240 + ord(c) // 262144) || chr(128 + ord(c) // 4096 % 64) || chr(128 + ord(c) // 64 % 64) || chr(128 + ord(c) % 64) END), '') || '日' END AS name
FROM (SELECT doc_id, text AS n FROM documents), (VALUES ('plain'), ('mixed'), ('not utf-8'), ('damaged')) AS k(kind)""",

    "kpi_farm": f"""WITH {FARM_FACT}
SELECT farm_license, date, coalesce(sum(loaded_weight_kg), 0) AS loaded_weight_kg FROM farmfact
WHERE farm_license IS NOT NULL AND date IS NOT NULL GROUP BY farm_license, date ORDER BY farm_license, date""",

    "kpi_feed": f"""WITH {FEED_FACT}
SELECT farm_license, feed_name, date, CAST(coalesce(sum(nr_times_loaded), 0) AS BIGINT) AS nr_times_loaded
FROM feedfact WHERE farm_license IS NOT NULL AND feed_name IS NOT NULL AND date IS NOT NULL
GROUP BY farm_license, feed_name, date ORDER BY farm_license, feed_name, date""",

    "kpi_ration": f"""WITH {RATION_FACT}
SELECT farm_license, ration_name, date,
       CAST(coalesce(sum(total_nr_of_feed_per_load), 0) AS BIGINT) AS total_nr_of_feed_per_load
FROM rationfact WHERE farm_license IS NOT NULL AND ration_name IS NOT NULL AND date IS NOT NULL
GROUP BY farm_license, ration_name, date ORDER BY farm_license, ration_name, date""",

    "kpi_farm_range": f"""WITH {FARM_FACT}
SELECT farm_license, date,
       CAST(coalesce(sum(nr_of_loading_activities_per_day), 0) AS BIGINT) AS nr_of_loading_activities_per_day
FROM farmfact WHERE farm_license IS NOT NULL AND date IS NOT NULL
  AND date >= DATE '1997-01-01' AND date <= DATE '1998-12-31'
GROUP BY farm_license, date ORDER BY farm_license, date""",

    "topk_preview": f"""WITH {LOADS}
SELECT farm_license, CAST(l_orderkey AS VARCHAR) AS loading_uuid, seq_nr, o.o_orderdate AS start_time, end_time,
       load_req_g AS req_weight_ration_g, load_g AS loaded_weight_ration_g
FROM loads JOIN orders o ON l_orderkey = o.o_orderkey
ORDER BY 1, 2, 3, 4, 5, 6, 7 LIMIT 10""",

    "name_repair": "SELECT doc_id, text FROM documents",

    "bronze_partition_roundtrip": """
SELECT CAST(user_id AS VARCHAR) AS farm_license, ts AS time,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events WHERE upper(event_type) = 'CLICK'""",

    "bronze_stream_ingest": """
SELECT CAST(user_id AS VARCHAR) AS farm_license, 'robot' AS device_type, 1 AS device_number,
       upper(event_type) AS msg_type, ts AS time, props AS data
FROM events""",
}
