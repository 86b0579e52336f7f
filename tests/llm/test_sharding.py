import numpy as np

import llm_texts as texts
from hayloft.llm import sharding


def jump(key, n):
    """The published algorithm, one key at a time."""
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one():
    keys = np.random.default_rng(3).integers(0, 1 << 63, 500).astype(np.uint64)
    for n in (1, 2, 7, 8, 100):
        assert sharding.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]


def test_one_more_shard_takes_rows_only_into_itself():
    keys = np.arange(20000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for n in (1, 4, 8):
        old, new = sharding.jump_hash(keys, n), sharding.jump_hash(keys, n + 1)
        moved = old != new
        assert (new[moved] == n).all()
        assert abs(moved.mean() - 1 / (n + 1)) < 0.02
        assert np.bincount(new).min() > 0.9 * len(keys) / (n + 1)


def test_slots_are_gapless_and_rows_whole(spark):
    rows = texts.document_rows(2)
    df = texts.with_clashing_columns(spark.createDataFrame(rows, texts.SCHEMA)).repartition(4)
    got = sharding.assign_shards(df).select("row.doc_id", "row.shard", "shard", "grown_shard", "slot").collect()
    assert sorted((str(r[0]) for r in got)) == sorted(str(r[0]) for r in rows)
    keys = {}
    for doc_id, clash, shard, grown, _ in got:
        assert clash == "clash"
        assert keys.setdefault(doc_id, (shard, grown)) == (shard, grown)
        assert grown in (shard, sharding.SHARDS)
    for s in range(sharding.SHARDS):
        slots = sorted(r[4] for r in got if r[2] == s)
        assert slots == list(range(len(slots)))
    assert sharding.assign_shards(spark.createDataFrame([], texts.SCHEMA)).collect() == []


def test_hot_key_spreads_over_slot_buckets(spark):
    docs = spark.range(3000).selectExpr("CAST(NULL AS LONG) AS doc_id", "concat('t', id) AS text")
    got = sharding.assign_shards(docs).collect()
    assert len({r.shard for r in got}) == 1
    assert sorted(r.slot for r in got) == list(range(3000))
