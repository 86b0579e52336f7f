"""Shared helpers of the training-data operators: row keys, stored tables, session options."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hayloft.session import scratch_path

# Rows handed to a Python task at a time: long texts are common, so a batch is
# kept to a few hundred rows to bound a task's memory.
ARROW_BATCH_ROWS = 256

LAST_ID = (1 << 63) - 1  # a NULL id is ordered after every other id

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# words of a text: runs of anything but ASCII whitespace
WORD = r"[^\x20\x09-\x0D]+"
# words of a lower-cased text: ASCII letters and digits, and every non-ASCII character
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def tune(spark: SparkSession) -> None:
    """Run-time SQL options of the Arrow operators."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_BATCH_ROWS))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # hot keys are dealt anew even where that costs another shuffle
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the cluster's shared checkpoint folder and read back.

    Cuts the lineage: what is read from it survives the loss of an executor
    and is not computed again by each of its readers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: str | Column) -> Column:
    """A-Z lower-cased, every other character unchanged."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def order_id(column: str = "doc_id") -> Column:
    """The id as an ordering value; NULL comes after every other id."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def text_key(column: str = "text") -> Column:
    """Tells apart rows that share an id; rows equal in both are interchangeable."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))
