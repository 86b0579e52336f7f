"""Routing of typed messages and shredding of their JSON payload."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


BAD = "_hl_bad"


def _parsed(payload_col: str, payload_schema: StructType | str) -> Column:
    """The payload parsed, with the text of a malformed one in an additional field."""
    schema = payload_schema if isinstance(payload_schema, StructType) else StructType.fromDDL(payload_schema)
    marked = StructType([*schema.fields]).add(BAD, "string")
    return F.from_json(F.col(payload_col).cast("string"), marked, {"columnNameOfCorruptRecord": BAD})


def _is_bad(payload_col: str, parsed: str) -> Column:
    """A payload is there, but is no JSON object or has a value of another type."""
    return F.col(payload_col).isNotNull() & (F.col(parsed).isNull() | F.col(f"{parsed}.{BAD}").isNotNull())


def rejected(
    df: DataFrame, msg_type: str, payload_schema: StructType | str, *, type_col: str = "msg_type", payload_col: str = "data"
) -> DataFrame:
    """Messages of one type whose payload does not fit ``payload_schema``, unchanged.

    With ``shred(..., malformed="drop")`` every message of the type is in exactly one of the two.
    """
    own = df.where(F.col(type_col) == F.lit(msg_type)).withColumn("_hl_parsed", _parsed(payload_col, payload_schema))
    return own.where(_is_bad(payload_col, "_hl_parsed")).drop("_hl_parsed")


def shred(
    df: DataFrame,
    msg_type: str,
    payload_schema: StructType | str,
    fields: Mapping[str, str],
    *,
    explode: str | None = None,
    type_col: str = "msg_type",
    payload_col: str = "data",
    malformed: str = "keep",
    counted: Observation | None = None,
) -> DataFrame:
    """Keep messages of one type and expose payload fields as columns.

    * ``type_col == msg_type`` (a partition filter when the table is
      partitioned by ``type_col``);
    * ``payload_col`` is replaced in place by ``from_json(payload, schema)``
      (bad or missing values parse to NULL);
    * with ``explode`` naming an array field of the payload, one row per
      element (NULL and empty arrays give no row);
    * ``fields`` maps output column → path in the payload (or in the exploded
      element when ``explode`` is given), appended in that order;
    * with ``malformed="drop"`` messages whose payload does not fit are left to
      :func:`rejected`; ``counted`` then observes their number (``rejects``).
    All other columns are kept.
    """
    if malformed not in ("keep", "drop"):
        raise ValueError("malformed must be 'keep' or 'drop'")
    own = df.where(F.col(type_col) == F.lit(msg_type))
    schema = payload_schema if isinstance(payload_schema, StructType) else StructType.fromDDL(payload_schema)
    if malformed == "keep":
        parsed = own.withColumn(payload_col, F.from_json(F.col(payload_col).cast("string"), schema))
    else:
        judged = own.withColumn("_hl_parsed", _parsed(payload_col, payload_schema))
        judged = judged.withColumn("_hl_reject", _is_bad(payload_col, "_hl_parsed"))
        if counted is not None:
            judged = judged.observe(counted, F.count_if("_hl_reject").alias("rejects"))
        fields_of = F.struct(*[F.col(f"_hl_parsed.{f}").alias(f) for f in schema.fieldNames()])
        payload = F.when(F.col("_hl_parsed").isNotNull(), fields_of)
        parsed = judged.where(~F.col("_hl_reject")).withColumn(payload_col, payload).drop("_hl_parsed", "_hl_reject")
    if explode:
        parsed = parsed.withColumn("_hl_item", F.explode(F.col(f"{payload_col}.{explode}")))
        source = "_hl_item"
    else:
        source = payload_col
    for out, path in fields.items():
        parsed = parsed.withColumn(out, F.col(f"{source}.{path}"))
    return parsed.drop("_hl_item") if explode else parsed
