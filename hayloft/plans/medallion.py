"""Layer registries and the bronze → silver0 → silver1 → gold run."""

from __future__ import annotations

import logging
import os
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hayloft import schemas
from hayloft.plans import checks, gold, silver
from hayloft.plans.contract import TableRun, Transformation, check_schema
from hayloft.plans.parsers import MESSAGE_TABLES, MessageTable
from hayloft.session import together
from hayloft.sources.files import DEFAULT_FORMAT, RECORD, read_csv_messages, read_table, split_csv_messages, write_table

log = logging.getLogger("hayloft")

BRONZE_TABLE = "bronze_table"
REJECTED_RECORDS, REJECTED_PAYLOADS = "rejected_records", "rejected_payloads"
SILVER1_READ_SCHEMAS = {
    "silver_loading_activity": schemas.SILVER_LOADING_ACTIVITY,
    "silver_robot_config_dim": schemas.SILVER_ROBOT_CONFIG_DIM,
    "silver_kitchen_feed_names_dim": schemas.SILVER_KITCHEN_FEED_NAMES_DIM,
    "silver_ration_names_dim": schemas.SILVER_RATION_NAMES_DIM,
}


def silver1_transformations() -> list[Transformation]:
    return [
        Transformation("silver_loading_activity", silver.loading_activity, schemas.SILVER_LOADING_ACTIVITY),
        Transformation(
            "silver_robot_config_dim", silver.stored_config_periods, schemas.SILVER_ROBOT_CONFIG_DIM, finish=silver.with_config_id
        ),
        Transformation(
            "silver_kitchen_feed_names_dim", silver.stored_feed_names_dim, schemas.SILVER_KITCHEN_FEED_NAMES_DIM
        ),
        Transformation("silver_ration_names_dim", silver.stored_ration_names_dim, schemas.SILVER_RATION_NAMES_DIM),
    ]


def gold_transformations() -> list[Transformation]:
    return [
        Transformation(
            "feed_daily_fact", gold.feed_daily_fact, schemas.FEED_DAILY_FACT,
            partition_columns=gold.DEALT_BY, input_schemas=SILVER1_READ_SCHEMAS, dealt=True,
        ),
        Transformation(
            "ration_daily_fact", gold.ration_daily_fact, schemas.RATION_DAILY_FACT,
            partition_columns=gold.DEALT_BY, input_schemas=SILVER1_READ_SCHEMAS, dealt=True,
        ),
        Transformation(
            "farm_daily_fact", gold.farm_daily_fact, schemas.FARM_DAILY_FACT,
            partition_columns=gold.DEALT_BY, input_schemas=SILVER1_READ_SCHEMAS, dealt=True,
        ),
    ]


class LayerRun(dict):
    """``{layer: directory}`` of a run; ``rows`` has the number of rows written, by table."""

    def __init__(self, dirs: dict[str, str], runs: list[TableRun]):
        super().__init__(dirs)
        self.rows = {r.table: r.n_rows for r in runs}


def load_bronze(spark: SparkSession, csv_path: str, bronze_dir: str, *, fmt: str = DEFAULT_FORMAT) -> list[TableRun]:
    """CSV messages → bronze table, partitioned by message type.

    Records that do not fit the layout go to a table of their own; they are counted
    while bronze is written, and read again only if there are any.
    """
    path = os.path.join(bronze_dir, BRONZE_TABLE)
    rejects = Observation()
    rows = read_csv_messages(spark, csv_path, keep_record=True)
    rows = rows.observe(rejects, F.count(RECORD).alias("rejects")).where(F.col(RECORD).isNull())
    names = schemas.struct(schemas.BRONZE).fieldNames()
    # message types are few, and a file holds many records: each task writes its own into their folders
    n_rows = write_table(rows.select(*names), path, partition_by=("msg_type",), fmt=fmt, cluster=False)
    runs = [TableRun(BRONZE_TABLE, path, n_rows)]
    if rejects.get.get("rejects"):
        path = os.path.join(bronze_dir, REJECTED_RECORDS)
        runs.append(TableRun(REJECTED_RECORDS, path, write_table(split_csv_messages(spark, csv_path)[1], path, fmt=fmt)))
    return runs


def bronze_to_silver0(
    spark: SparkSession, bronze_path: str, silver_dir: str, *, fmt: str = DEFAULT_FORMAT, rejects_dir: str | None = None
) -> list[TableRun]:
    """One silver0 table per message type.

    Each table re-reads bronze with its own ``msg_type`` filter, which prunes
    to one partition directory (no cache of the whole bronze table). Messages whose
    payload does not fit go to a table of their own, partitioned by message type.
    """
    def load(table: MessageTable) -> tuple[TableRun, DataFrame | None]:
        bronze = read_table(spark, bronze_path, schemas.BRONZE, fmt=fmt)
        path = os.path.join(silver_dir, table.result_table)
        rejects = Observation()
        picked = table.pick(bronze, malformed="drop", counted=rejects)
        check_schema(table.complete(picked), table.schema_ddl, table.result_table)
        n_rows = write_table(picked, path, partition_by=table.partition_columns, fmt=fmt, finish=table.complete)
        return TableRun(table.result_table, path, n_rows), table.rejects(bronze) if rejects.get.get("rejects") else None

    loaded = together(spark, [partial(load, table) for table in MESSAGE_TABLES])
    runs, bad = [run for run, _ in loaded], [rejected for _, rejected in loaded if rejected is not None]
    if bad:
        path = os.path.join(rejects_dir or silver_dir, REJECTED_PAYLOADS)
        found = reduce(DataFrame.unionByName, bad)
        runs.append(TableRun(REJECTED_PAYLOADS, path, write_table(found, path, partition_by=("msg_type",), fmt=fmt)))
    return runs


# Gaps are filled behind the shuffle that a fact is written from: its tasks make many times the rows that they read.
FILLED = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m"}
FACTS = {"feed_daily_fact": gold.FEED, "ration_daily_fact": gold.RATION, "farm_daily_fact": gold.FARM}


def run_layers(
    spark: SparkSession,
    csv_path: str,
    warehouse: str,
    *,
    fmt: str = DEFAULT_FORMAT,
) -> LayerRun:
    """The full layered run with its checks; returns ``{layer: directory}`` and the rows written.

    Layers are coupled only through stored tables, so every step restarts
    from durable data (lineage cut at each table). The stored gold tables are
    checked last, against their contracts and against the days of the stored loads; a
    finding raises :class:`hayloft.plans.checks.CheckFailed`.
    """
    dirs = {layer: os.path.join(warehouse, layer) for layer in ("bronze", "silver", "gold")}
    runs = load_bronze(spark, csv_path, dirs["bronze"], fmt=fmt)
    runs += bronze_to_silver0(spark, runs[0].path, dirs["silver"], fmt=fmt, rejects_dir=dirs["bronze"])
    runs += together(spark, [partial(t.run, spark, dirs["silver"], dirs["silver"], fmt=fmt) for t in silver1_transformations()])
    runs += together(spark, [partial(t.run, spark, dirs["silver"], dirs["gold"], fmt=fmt) for t in gold_transformations()], FILLED)
    result = LayerRun(dirs, runs)
    check_run(spark, result, fmt=fmt)
    return result


def check_run(spark: SparkSession, run: LayerRun, *, fmt: str = DEFAULT_FORMAT) -> None:
    """The checks of a run on its stored gold tables."""
    loads_schema = SILVER1_READ_SCHEMAS["silver_loading_activity"]
    loads = read_table(spark, os.path.join(run["silver"], "silver_loading_activity"), loads_schema, fmt=fmt)
    made = {t.result_table: t for t in gold_transformations()}
    checks.check_gold(
        {name: read_table(spark, os.path.join(run["gold"], name), t.schema, fmt=fmt) for name, t in made.items()},
        {name: fact.keys for name, fact in FACTS.items()},
        counts={name: n for name, n in run.rows.items() if name in FACTS},
        observed={name: fact.observed_days(loads) for name, fact in FACTS.items()},
        measures={name: list(fact.measures) for name, fact in FACTS.items()},
        contracts={name: t.schema_ddl for name, t in made.items()},
    )
