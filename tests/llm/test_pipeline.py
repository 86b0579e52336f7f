import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import llm_texts as texts
from hayloft.llm import decontam, quality, simhash
from hayloft.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_stages_apply_their_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, columns = docs, docs.columns
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF)
        if name != "shard":
            assert out.columns == columns
        out = frames[name] = spark.createDataFrame(out.collect(), out.schema)
    ids = {k: [r.doc_id for r in f.select("doc_id").collect()] for k, f in frames.items()}

    judged = quality.judge(docs, quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet")), ["doc_id"])
    assert sorted(ids["quality_rules"]) == sorted(r[0] for r in judged.where("kept").select("row.doc_id").collect())
    groups = simhash.near_groups(frames["quality_rules"]).groupBy("root").agg(F.min("doc_id")).collect()
    assert sorted(ids["near_dedup"]) == sorted(r[1] for r in groups)
    found = decontam.contamination(frames["near_dedup"], spark.read.parquet(f"{SF}/benchmark.parquet"), carry=["doc_id"])
    clean = found.where(~decontam.is_contaminated()).select("row.doc_id").collect()
    assert sorted(ids["decontaminate"]) == sorted(r[0] for r in clean)
    assert set(ids["mix"]) <= set(ids["decontaminate"]) and max(Counter(ids["mix"]).values()) <= 2
    assert Counter(ids["shard"]) == Counter(ids["mix"])


@pytest.mark.parametrize("empty", [False, True])
def test_stages_handle_awkward_rows(spark, empty):
    """NULLs, empty and long texts, ties, repeated rows, clashing extra columns, empty tables."""
    rows = [] if empty else texts.document_rows(7)
    docs = texts.with_clashing_columns(spark.createDataFrame(rows, texts.SCHEMA)).selectExpr(
        "*", "1 AS slot", "'x' AS row", "0 AS copies", "1 AS kept", "'y' AS own_id"
    )
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        got = out.collect()
        assert set(out.columns) == set(docs.columns)
        assert not got if empty else got or name == "quality_rules"
        docs = docs if name == "quality_rules" else spark.createDataFrame(got, out.schema)


def test_run_equals_its_stages_and_reruns_agree(spark):
    rows = [Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).drop("text").collect()) for _ in range(2)]
    assert rows[0] == rows[1] and sum(rows[0].values()) > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_every_query_returns_all_rows(spark, name):
    conversations = name.startswith(("op3_", "op11_"))
    got = QUERIES[name](spark, SF)
    every = spark.read.parquet(f"{SF}/{'conversations' if conversations else 'documents'}.parquet")
    planted = name.startswith("op3_")  # one conversation more than the table has
    n = every.select("conv_id").distinct().count() + planted if conversations else every.count()
    assert got.count() == n


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
