"""Every operator over a table with texts of more than one mebibyte, through its registered query."""

import hashlib
import random
import zlib

import pytest

import llm_texts as texts
import test_simhash
from hayloft.llm import queries

RNG = random.Random(12)
VOCABULARY = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 9))) for _ in range(4000)]
LONG = " ".join(RNG.choice(VOCABULARY) for _ in range(220_000))
ITEM = " ".join(f"item{i}" for i in range(30))
TEXTS = {1: LONG, 2: f"short words {ITEM} end", 3: LONG, 4: f"{LONG} {ITEM}", 5: None, 6: "a few words."}
SIZE = {k: len(texts.words(t)) for k, t in TEXTS.items()}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    assert len(LONG) > 1 << 20
    root = tmp_path_factory.mktemp("long")
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in TEXTS.items()]
    spark.createDataFrame(rows, texts.SCHEMA).write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(root / "benchmark.parquet"))
    labels = [(1, 1, 0), (2, 0, 1), (6, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    turns = [(1, 0, "user", LONG + "?"), (1, 1, "assistant", LONG + "!"), (2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(root / "conversations.parquet"))
    return str(root)


@pytest.fixture
def ran(spark, tables):
    return lambda name: {r[0]: r for r in queries.QUERIES[name](spark, tables).collect()}


def test_sizes_windows_and_shards(ran):
    mixed = ran("op1_mix_sources")
    assert {k: r.size for k, r in mixed.items()} == SIZE and all(r.taken in (0, r.size, 2 * r.size) for r in mixed.values())
    shards = ran("op9_jump_hash_shards")
    for k, t in TEXTS.items():
        assert shards[k].size == len((t or "").encode()) + 1 and shards[k].text_crc32 == zlib.crc32((t or "").encode())


def test_copies(ran):
    cut = ran("op2_substring_dedup")
    assert {k: r.n_words for k, r in cut.items()} == SIZE
    assert [cut[k].n_removed for k in (1, 3, 6)] == [0, SIZE[1], 0] and SIZE[1] <= cut[4].n_removed < SIZE[4]
    near = ran("op8_simhash_near_dedup")
    assert near[1].fingerprint == near[3].fingerprint == f"{test_simhash.fingerprint(LONG):016x}"
    assert near[4].component_id == near[3].component_id == 1
    joined = ran("op12_ngram_jaccard")
    assert [joined[k].component_id for k in (1, 3, 4)] == [1, 1, 1] and [joined[k].n_links for k in (1, 3, 4, 6)] == [2, 2, 2, 0]


def test_rules_benchmark_and_licenses(ran):
    rules = ran("op5_quality_rules")
    assert {k: r.n_words for k, r in rules.items()} == SIZE and rules[5].base_failed
    hits = ran("op6_benchmark_decontamination")
    assert [(hits[k].n_hit, hits[k].contaminated) for k in (1, 2, 4)] == [(0, False), (30, True), (30, False)]
    assert ran("op10_license_scan")[4].n_words == SIZE[4]


def test_scores_and_tokens(ran):
    scored = ran("op4_context_tree_scores")
    assert {k: r.n_tokens - 1 for k, r in scored.items()} == SIZE
    assert scored[1].score == pytest.approx(scored[3].score) and scored[1].score < -100_000
    aligned = ran("op13_token_alignment")
    assert aligned[1].groups_sha256 == aligned[3].groups_sha256 and aligned[1].n_links >= max(aligned[1].n_a, aligned[1].n_b)
    assert ran("op7_pii_surrogates")[6].text == TEXTS[6]


def test_conversations(ran):
    read = ran("op3_chat_windows")
    assert read[1].turns_sha256 == hashlib.sha256(f"user\n{LONG}?\nassistant\n{LONG}!\n".encode()).hexdigest()
    assert read[1].loss_chars == len(LONG) + 1
    repaired = ran("op11_structure_repair")
    assert set(repaired) == {1, 2}
