"""File sources and sinks: typed CSV messages, layer tables by path."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hayloft import schemas
from hayloft.session import TEXT_PARTITIONS, listing, options, shuffles_released

DEFAULT_FORMAT = "parquet"
RECORD = "_corrupt_record"  # the text of a CSV row that does not fit its schema
# Folders on a local or mounted disk (no other file system is meant by these): a checksum file beside each data file
# takes as long to make as the data file, where tables have a file per farm. Pages of parquet have checksums of their own.
WITHOUT_CHECKSUM_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def read_csv_messages(
    spark: SparkSession,
    path: str,
    schema: StructType | str = schemas.BRONZE,
    *,
    escape: str = '"',
    keep_record: bool = False,
) -> DataFrame:
    """Typed CSV scan (header row, ``"`` as escape, explicit schema).

    Columns of the schema that the file lacks come out NULL; ``source_path``
    and ``processing_time`` are then set as lineage columns (file path from
    the scan's ``_metadata``; ingest time from ``current_timestamp``).

    A value that does not fit its type comes out NULL. With ``keep_record`` the
    column ``_corrupt_record`` holds the text of such rows, and of rows with more or
    fewer values than columns, and is NULL for all others. The scan judges a row
    by the columns that are read: use :func:`split_csv_messages` to have all judged.
    """
    struct = schema if isinstance(schema, StructType) else schemas.struct(schema)
    reader = spark.read.option("header", True).option("escape", escape).option("mode", "PERMISSIVE")
    if keep_record:
        missing = {"source_path", "processing_time"}  # lineage, in no file
        struct = StructType([f for f in struct.fields if f.name not in missing]).add(RECORD, "string")
        reader = reader.option("columnNameOfCorruptRecord", RECORD)
    df = reader.schema(struct).csv(path)
    return df.withColumn("source_path", F.col("_metadata.file_path")).withColumn(
        "processing_time", F.current_timestamp()
    )


def split_csv_messages(
    spark: SparkSession, path: str, schema: StructType | str = schemas.BRONZE, *, escape: str = '"'
) -> tuple[DataFrame, DataFrame]:
    """``(messages, rejects)``: rows that fit the schema, and the others as they were delivered.

    Rejects keep the record's text, its file and the ingest time. Every row of the
    files is in exactly one of the two.
    """
    rows = read_csv_messages(spark, path, schema, escape=escape, keep_record=True)
    names = (schema if isinstance(schema, StructType) else schemas.struct(schema)).fieldNames()
    # names every column, as the scan judges a row by the columns that are read
    own = [c for c in names if c not in ("source_path", "processing_time")]
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in own]
    broken = F.when(F.col(RECORD).isNotNull(), F.concat(RECORD, *values))
    messages = rows.where(broken.isNull()).select(*names)
    rejects = rows.where(broken.isNotNull())
    return messages, rejects.select(F.col(RECORD).alias("record"), "source_path", "processing_time")


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    fmt: str = DEFAULT_FORMAT,
) -> DataFrame:
    """Read a layer table by path.

    With ``schema`` the declared layout is applied (partition values keep the
    declared type) and the columns come back in declared order. Without one,
    partition values come back as the strings they were stored as, whatever
    the session infers elsewhere (a license ``007`` must not become 7).
    """
    recover_table(spark, path)
    reader = spark.read.format(fmt)
    if schema is None:
        with options(spark, {**listing(spark), **TEXT_PARTITIONS}):
            return reader.load(path)
    struct = schema if isinstance(schema, StructType) else schemas.struct(schema)
    with options(spark, listing(spark)):
        return reader.schema(struct).load(path).select(*struct.fieldNames())


def _exists(spark: SparkSession, path: str, child: str = "") -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path, child) if child else spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def has_stream_log(spark: SparkSession, path: str) -> bool:
    """Whether a streaming file sink owns ``path``: readers then follow its log only."""
    return _exists(spark, path, "_spark_metadata")


def refuse_batch_table(spark: SparkSession, path: str) -> None:
    """A stream must not append to a table that batch writes made: its log would hide their files."""
    if _exists(spark, path, "_SUCCESS") and not has_stream_log(spark, path):
        raise ValueError(f"{path} holds a batch-written table; give the stream a path of its own")


def _sibling(path: str, kind: str, suffix: str) -> str:
    """A hidden folder beside ``path``, so that renames stay within its file system."""
    parent, name = os.path.split(path.rstrip("/"))
    return os.path.join(parent, f".{name}.{kind}-{suffix}")


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish a swap of tables that was interrupted between its two renames: the earlier table comes back."""
    if _exists(spark, path):
        return
    pattern = spark._jvm.org.apache.hadoop.fs.Path(_sibling(path, "earlier", "*"))
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern) or []
    if found:
        latest = max(found, key=lambda f: f.getModificationTime())
        fs.rename(latest.getPath(), spark._jvm.org.apache.hadoop.fs.Path(path))


def _swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """The staged folder takes the place of the table at ``path``."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    target, new = jvm_path(path), jvm_path(staged)
    earlier = jvm_path(_sibling(path, "earlier", uuid.uuid4().hex[:12]))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(target)
    if had and not fs.rename(target, earlier):
        raise OSError(f"{path} cannot be moved aside")
    if not fs.rename(new, target):
        if had:
            fs.rename(earlier, target)
        raise OSError(f"{staged} cannot be moved to {path}")
    if had:
        fs.delete(earlier, True)


def write_table(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    fmt: str = DEFAULT_FORMAT,
    mode: str = "overwrite",
    cluster: bool = True,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Write ``df``, hive-partitioned by ``partition_by``; returns the number of rows written.

    ``mode``: ``overwrite`` replaces the table; ``partitions`` replaces only those
    partitions that ``df`` has rows of; any other is Spark's. A write that fails
    leaves the table as it was: a replacement is written beside it and takes its
    place when complete, and partitions are committed together at the end. So ``df``
    may also read the table it replaces. Rows are counted while they are written.

    With ``cluster`` the rows are first rebalanced on the partition columns
    (``REBALANCE`` hint), so each task writes few partition directories
    instead of every task writing a small file into every directory; AQE
    splits a skewed value (one farm with a third of the rows) over several
    tasks and merges small ones. ``finish`` makes the table's rows of those of ``df`` behind
    that: a column that follows from others (an id, a constant) then does not travel.
    """
    spark = df.sparkSession
    if has_stream_log(spark, path):
        raise ValueError(f"{path} is written by a stream; rows of a batch write would not be read back")
    recover_table(spark, path)
    out = df
    partition_by = list(partition_by)
    if partition_by and cluster:
        out = out.hint("rebalance", *partition_by)
    out = finish(out) if finish else out
    counted = Observation()
    writer = out.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(fmt).options(**WITHOUT_CHECKSUM_FILES)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "partitions" and not partition_by:
        raise ValueError("only a partitioned table has partitions to replace")
    with shuffles_released(spark):
        if mode == "partitions":
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
        elif mode == "overwrite":
            staged = _sibling(path, "staged", uuid.uuid4().hex[:12])
            writer.save(staged)
            _swap_in(spark, staged, path)
        else:
            writer.mode(mode).save(path)
    return int(counted.get.get("rows", 0))


def load_inputs(
    spark: SparkSession,
    location: str,
    names: Iterable[str],
    *,
    fmt: str = DEFAULT_FORMAT,
    schemas_by_name: Mapping[str, StructType | str] | None = None,
) -> dict[str, DataFrame]:
    """``{name: table}`` for every table ``name`` below ``location``."""
    schemas_by_name = schemas_by_name or {}
    return {
        name: read_table(spark, os.path.join(location, name), schemas_by_name.get(name), fmt=fmt)
        for name in names
    }
