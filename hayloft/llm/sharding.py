"""Sharding by jump consistent hashing.

A row's key alone fixes its shard: the key is hashed to 64 bits and jumps
through the shard counts at which it would move, so no ring table is kept and one
more shard takes 1 / (n + 1) of the rows and moves no others. Slots number the
rows of a shard without gaps: rows are numbered within hash buckets of the shard,
and the buckets' counts, summed up in bucket order, give each its first slot. A
shard is therefore never ordered in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hayloft.llm.tables import text_key

SHARDS = 8
SLOT_BUCKETS = 4096  # buckets of one shard; at 10**10 rows a bucket holds some 300,000


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key (Lamping and Veach, 2014), all keys at once."""
    if shards < 1:
        raise ValueError("there must be a shard")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    at = np.zeros(len(state), np.int64)
    while len(moving):
        shard[moving] = at
        state = state * np.uint64(2862933555777941757) + np.uint64(1)
        draw = ((state >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        at = ((at + 1) * (float(1 << 31) / draw)).astype(np.int64)
        go = at < shards
        moving, state, at = moving[go], state[go], at[go]
    return shard


def shard_of(*key: str, shards: int = SHARDS) -> Column:
    """The shard of the key columns' 64-bit hash; NULL keys hash like any other value."""

    @F.pandas_udf("int")
    def shard(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(hashed.to_numpy().view(np.uint64), shards).astype(np.int32))

    return shard(F.xxhash64(*key))


def with_slots(rows: DataFrame, *identity: str, buckets: int = SLOT_BUCKETS) -> DataFrame:
    """``slot``: 0, 1, 2, ... within ``shard``. Rows equal in the identity columns may swap slots."""
    keyed = rows.withColumn("slot_bucket", F.pmod(F.xxhash64(*identity), F.lit(buckets)).cast("int"))
    place = Window.partitionBy("shard", "slot_bucket").orderBy(*identity)
    numbered = keyed.withColumn("slot", F.row_number().over(place).cast("long") - 1)
    # at most `buckets` rows a shard
    first = (
        keyed.groupBy("shard", "slot_bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "shard",
            "slot_bucket",
            (F.sum("n").over(Window.partitionBy("shard").orderBy("slot_bucket")) - F.col("n")).alias("first_slot"),
        )
    )
    return (
        numbered.join(first, ["shard", "slot_bucket"])
        .withColumn("slot", F.col("slot") + F.col("first_slot"))
        .drop("slot_bucket", "first_slot")
    )


def assign_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """``row`` (all of ``docs``' columns), ``shard``, ``slot`` and ``grown_shard`` (with one shard more).

    Defined cases: a NULL key is a key like any other; repeated keys share a
    shard but not a slot; a NULL text counts as empty; a very long text is only
    hashed; an empty table gives an empty table. The input's columns are nested, so no name can clash.
    """
    keyed = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
        F.col(key).alias("slot_key"),
        text_key(text).alias("slot_text"),
        shard_of(key, shards=shards).alias("shard"),
        shard_of(key, shards=shards + 1).alias("grown_shard"),
    )
    return with_slots(keyed, "slot_key", "slot_text").drop("slot_key", "slot_text")
