"""Session settings the library relies on.

The library never creates a session when one is handed in; ``tune`` only sets
SQL options that are safe to change at run time, and ``checkpoint_root`` reads
the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

# Options the pipeline expects; all are runtime-settable SQL confs.
RECOMMENDED_SQL_CONF = {
    # Day keys, year_month and midnight promotion are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition values such as farm_license must stay strings on read-back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def tune(spark: SparkSession, **overrides: str) -> SparkSession:
    """Apply the recommended SQL options (plus ``overrides``) to ``spark``."""
    for key, value in {**RECOMMENDED_SQL_CONF, **overrides}.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def options(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """SQL options that hold inside the ``with`` block only."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffles_released(spark: SparkSession):
    """Inside the block, an execution's shuffle files are removed when it ends, and parquet is written with zstd.

    For writes: what was written is read from there on, and the files of a run of many steps
    would otherwise all stay on disk until the driver happens to collect garbage. The tables of a run
    stay beside each other; snappy, the default, leaves their hexadecimal ids as long as they are.
    """
    return options(spark, WRITING)


# What the library sets while it writes, and while it lists a table. A table by farm has thousands of folders; by
# default each is listed by a task of its own.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
TEXT_PARTITIONS = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}


def listing(spark: SparkSession) -> dict[str, str]:
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}


def together(spark: SparkSession, steps: Sequence[Callable[[], T]], held: Mapping[str, str] = {}, *, at_once: int = 2) -> list[T]:
    """Results of independent steps, in their order; ``at_once`` of them run at a time.

    A step alone leaves cores idle in the last tasks of each stage, and all of them while it plans, lists or commits.
    Few run at a time, as each has its shuffle files on disk. Options belong to the session, so those that steps set for
    themselves are set around all of them, and ``held`` with them: a step that ends takes none from the others.
    A step that fails is raised once the others have ended.
    """
    with options(spark, {**WRITING, **TEXT_PARTITIONS, **listing(spark), **held}), ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hayloft")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("HAYLOFT_DRIVER_MEMORY", "4g"))
    )
    for key, value in RECOMMENDED_SQL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from ``spark.checkpoint.dir``. A local session (tests, bench) that leaves
    it unset gets a fresh private folder; on a cluster executors and driver
    share no local disk, so an unset folder is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="hayloft-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


_SCRATCH: dict[str, list[str]] = {}  # by application, in the order of their making


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the checkpoint root for written intermediates.

    An intermediate must outlive the DataFrames that read it; :func:`release_scratch` removes
    those that are no longer needed, once a result that rests on them is written.
    """
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_mark(spark: SparkSession) -> int:
    """Says which intermediates are made from now on."""
    return len(_SCRATCH.get(spark.sparkContext.applicationId, []))


def release_scratch(spark: SparkSession, mark: int = 0, *, but_last: bool = False) -> int:
    """Remove the intermediates made since ``mark`` (all of this application by default).

    ``but_last`` keeps the newest, the written result itself. Returns how many were removed.
    """
    made = _SCRATCH.get(spark.sparkContext.applicationId, [])
    gone = made[mark : -1 if but_last else None]
    kept = made[-1:] if but_last and len(made) > mark else []
    made[mark:] = kept
    for path in gone:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return len(gone)
