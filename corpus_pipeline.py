"""The corpus pipeline: filter, de-duplicate, decontaminate, mix and shard ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
applies them in order, each over the written result of the one before. All but
the last return the columns of ``documents``.

Defined cases, in every stage: rows with a NULL, empty or very long text, repeated rows
and NULL ids are handled as the stage's operator states, and no row is lost or changed but
by the stage's decision; further columns are carried, whatever they are called; an
empty table gives an empty table. What a stage wrote for itself is removed once its result
is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hayloft.llm import decontam, mixing, quality, sharding, simhash
from hayloft.llm.tables import read, stored, tune
from hayloft.session import release_scratch, scratch_mark


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the trained model reject go."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs, model).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (4-word shingles, at most 4 bits)."""
    tune(spark)
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words stand in benchmark windows go."""
    found = decontam.contamination(docs, read(spark, sf_dir, "benchmark"))
    return found.where(~decontam.is_contaminated()).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; those that it does not take go."""
    tune(spark)
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their place in it (in place of columns of these names)."""
    tune(spark)
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    return sharding.assign_shards(docs).select(*[f"row.{c}" for c in own], "shard", "slot")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: the trained model and the 64-bit fingerprints have no SQL form; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        mark = scratch_mark(spark)
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
            release_scratch(spark, mark, but_last=True)
    return docs
