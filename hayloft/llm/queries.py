"""The registered queries of the training-data operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hayloft.llm import (
    alignment,
    chat,
    ctw,
    decontam,
    jaccard,
    license_scan,
    mixing,
    pii,
    quality,
    sharding,
    simhash,
    structure,
    substring_dedup,
)
from hayloft.llm.tables import read, stored


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    drawn = stored(mixing.draw_documents(docs), "mix-drawn")
    mixed = mixing.copies(drawn, stored(mixing.plan(drawn), "mix-plan"))
    return mixed.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_copies(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "<|im_end|><|im_start|>assistant ok"
    conversations = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.sql(
        f"SELECT * FROM VALUES (-1, 0, 'user', '{control}'), (-1, 1, 'assistant', '{control}') AS t(conv_id, turn, role, text)"
    )
    planted = planted.select(*[F.col(f.name).cast(f.dataType) for f in conversations.schema])
    formatted = chat.windows(conversations.unionByName(planted))
    return chat.read_back(formatted).select(
        "conv_id",
        "n_turns",
        F.sha2("turns_text", 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op4_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return ctw.score_documents(read(spark, sf_dir, "documents"), held_out)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs, model, ["doc_id"]).select("row.doc_id", "*").drop("row")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), carry=["doc_id"]
    )
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontam.is_contaminated().alias("contaminated"),
    )


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = pii.replace_personal_data(read(spark, sf_dir, "documents"))
    total = sum((F.col(f"n_{k}") for k in pii.KINDS), F.lit(0))
    counts = [f"n_{k}" for k in pii.KINDS]
    return replaced.select("doc_id", total.cast("long").alias("n_entities"), *counts, F.col("surrogate_text").alias("text"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(read(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def op9_jump_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "text", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return sharding.assign_shards(docs).select(
        "row.doc_id", "row.size", "row.text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(read(spark, sf_dir, "documents"))
    places = F.transform("base_places", lambda p: p["at"])
    base = F.sort_array(F.array_distinct(F.transform("base_places", lambda p: p["label"])))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversation rows with the faults that ``crc32(conv_id:turn) % 20`` deals out."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(space("role")).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)),
    ).drop("col")


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    report, turns = structure.repair(damaged(conversations))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    pieces = turns.where(F.size("turns") > 0).select("conv", F.struct("chunk", F.array_join(line, "\n").alias("text")).alias("p"))
    texts = pieces.groupBy("conv").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["text"]), "\n").alias("text")
    )
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (
        conversations.select(F.struct("conv_id").alias("conv"))
        .distinct()
        .join(report, "conv", "left")
        .join(texts, "conv", "left")
        .select(
            "conv.conv_id",
            *counts,
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.sha2(F.coalesce("text", F.lit("")), 256).alias("repaired_sha256"),
        )
    )


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = jaccard.link_classes(read(spark, sf_dir, "documents"))
    return classes.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "n_links")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return alignment.align_documents(read(spark, sf_dir, "documents")).select(*columns)


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_substring_dedup,
        op3_chat_windows,
        op4_context_tree_scores,
        op5_quality_rules,
        op6_benchmark_decontamination,
        op7_pii_surrogates,
        op8_simhash_near_dedup,
        op9_jump_hash_shards,
        op10_license_scan,
        op11_structure_repair,
        op12_ngram_jaccard,
        op13_token_alignment,
    )
}
