import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_texts as texts
from hayloft.llm import ctw

HELD = "crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 1"


def kt(n0, n1):
    return math.lgamma(n0 + 0.5) + math.lgamma(n1 + 0.5) - math.log(math.pi) - math.lgamma(n0 + n1 + 1)


class Tree:
    """Context-tree weighting by its definition: block probabilities of whole trees."""

    def __init__(self, train):
        self.counts = Counter()
        for text in train:
            padded = bytes(ctw.DEPTH) + text
            for i, byte in enumerate(text):
                context = padded[i : i + ctw.DEPTH]
                for bit in range(8):
                    first = format(byte, "08b")[:bit]
                    for d in range(ctw.DEPTH + 1):
                        self.counts[context[ctw.DEPTH - d :], first, format(byte, "08b")[bit]] += 1
        self.contexts = {}
        for context, first, _ in self.counts:
            if context:
                self.contexts.setdefault((context[1:], first), set()).add(context)

    def weighted(self, context, first):
        estimate = kt(self.counts[context, first, "0"], self.counts[context, first, "1"])
        if len(context) == ctw.DEPTH:
            return estimate
        children = sum(self.weighted(c, first) for c in self.contexts.get((context, first), ()))
        return np.logaddexp(math.log(0.5) + estimate, math.log(0.5) + children)

    def chance(self, context, byte):
        """Ratio of block probabilities with and without the byte after the context."""
        bits, log = format(byte, "08b"), 0.0
        for bit in range(8):
            before = self.weighted(b"", bits[:bit])
            path = [context[ctw.DEPTH - d :] for d in range(ctw.DEPTH + 1)]
            new = [c for c in path if c and c not in self.contexts.get((c[1:], bits[:bit]), ())]
            for c in path:
                self.counts[c, bits[:bit], bits[bit]] += 1
            for c in new:
                self.contexts.setdefault((c[1:], bits[:bit]), set()).add(c)
            log += self.weighted(b"", bits[:bit]) - before
            for c in path:
                self.counts[c, bits[:bit], bits[bit]] -= 1
            for c in new:
                self.contexts[c[1:], bits[:bit]].discard(c)
        return log / math.log(10)

    def score(self, text):
        padded = bytes(ctw.DEPTH) + text
        return sum(self.chance(padded[i : i + ctw.DEPTH], b) for i, b in enumerate(text))


@pytest.mark.parametrize("group_bytes", [10, ctw.GROUP_BYTES])
def test_is_the_ratio_of_block_probabilities(spark, group_bytes):
    rows = [(1, "abracadabra", False), (2, "Abba é", False), (3, None, False), (4, "abrax", True), (5, "", True), (5, "zz", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h boolean")
    got = ctw.score_documents(df, F.col("h"), group_bytes=group_bytes).collect()
    tree = Tree([(t or "").lower().encode() for _, t, h in rows if not h])
    expected = sorted(tree.score((t or "").lower().encode()) for _, t, _ in rows)
    assert sorted(r.score for r in got) == pytest.approx(expected, abs=1e-9)


def test_chances_of_all_bytes_sum_to_one():
    rng = np.random.default_rng(5)
    keys = ctw.pack_grams(rng.integers(97, 103, 4000).astype(np.uint8), np.array([0, 4000]))
    context = int(keys[100]) >> 8 << 8
    every = context | np.arange(256)
    grams = np.concatenate([keys, every])
    n = np.concatenate([np.ones(len(keys)), np.zeros(256)])
    got, chance, _ = ctw._bundle_tree(grams, n, top=0)
    at = np.searchsorted(got, every)
    assert np.isclose(np.prod(chance[at], axis=1).sum(), 1.0)


def test_base_score_and_counts_match_brute_force(spark):
    rows = texts.document_rows(2)
    df = texts.with_clashing_columns(spark.createDataFrame(rows, texts.SCHEMA)).repartition(4)
    got = ctw.score_documents(df, F.expr(HELD), group_bytes=20000).collect()
    import zlib

    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = lambda t: [*texts.words(texts.lower(t)), ""]
    count = Counter(w for i, t, *_ in rows if not out(i) for w in tokens(t))
    total, kinds = sum(count.values()), len(count)
    expected = []
    for i, t, *_ in rows:
        ws = tokens(t)
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws)
        expected.append((i, out(i), len(ws), sum(count[w] > 0 for w in ws), total, round(base, 6)))
    assert sorted(((*r[:5], round(r.base_score, 6)) for r in got), key=str) == sorted(expected, key=str)


def test_deeper_contexts_pay_on_held_out_text(spark):
    import os

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = ctw.score_documents(docs, F.expr(HELD)).where("held_out").agg(F.sum("score")).first()[0]
    sizes = docs.where(HELD).agg(F.sum(F.octet_length("text"))).first()[0]
    assert -got / math.log10(2) / sizes < 3.6  # bits a byte; 8 without a model, about 4.3 for single bytes


def test_empty_table(spark):
    assert ctw.score_documents(spark.createDataFrame([], texts.SCHEMA), F.expr(HELD)).collect() == []
    only = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    r = ctw.score_documents(only, F.lit(True)).first()
    assert r.score == pytest.approx(16 * math.log10(0.5)) and r.train_tokens == 0


def test_learns_what_follows_five_bytes(spark):
    # the byte after "-sam" depends on the byte before it, the fifth back
    assert ctw.DEPTH >= 5
    train = [(i, "a-samx b-samy ", False) for i in range(40)]
    df = spark.createDataFrame([*train, (100, "a-samx", True), (101, "a-samy", True)], "doc_id long, text string, h boolean")
    score = {r.doc_id: r.score for r in ctw.score_documents(df, F.col("h")).where("held_out").collect()}
    assert score[100] - score[101] > 1.0  # five bytes tell x from y; four ("-sam") leave them alike


def test_packed_lists_come_back():
    rng = np.random.default_rng(3)
    for n in (0, 1, 1000):
        grams = np.sort(rng.integers(0, 1 << 55, n))
        assert np.array_equal(np.cumsum(ctw._unpacked(ctw._packed(np.diff(grams, prepend=0)))), grams)
        counts = rng.integers(-(1 << 45), 1 << 45, n)
        assert np.array_equal(ctw._unpacked(ctw._packed(counts)), counts)
