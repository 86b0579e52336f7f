import random

import numpy as np
import pytest

import llm_texts as texts
from hayloft.llm import jaccard


def shingles(text, k=3):
    ws = texts.words(texts.lower(text))
    return {tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set()


def brute(rows, percent=90):
    sets = [shingles(t) for _, t, *_ in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
                links[i] += 1
                links[j] += 1
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((r[0], len(sets[i]), least.get(find(i)), links[i]) for i, r in enumerate(rows)), key=str)


def ran(df, **options):
    return sorted((tuple(r) for r in jaccard.link_classes(df, **options).collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        rng.choice([lambda: words.pop(at), lambda: words.insert(at, "new"), lambda: words.__setitem__(at, "other")])()
    return " ".join(words)


def near_rows(seed, sizes=(4, 12, 30, 200), copies=25):
    """Families of edited copies on both sides of the threshold, some of them around one centre."""
    rng = random.Random(seed)
    rows, at = [], 1000
    for size in sizes:
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(copies):
            rows.append((at, edited(rng, base, rng.randint(0, max(1, size // 18))), "en", "s", 0))
            at += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [90, 70])
def test_matches_brute_force(spark, percent):
    rows = texts.document_rows(5) + near_rows(percent)
    df = texts.with_clashing_columns(spark.createDataFrame(rows, texts.SCHEMA)).repartition(5)
    assert ran(df, percent=percent) == brute(rows, percent)


def test_clusters_cut_into_row_blocks(spark):
    rows = near_rows(3, (150, 160), 40) + near_rows(4, (40,), 40)
    df = spark.createDataFrame([(i, t) for i, (_, t, *_) in enumerate(rows)], "doc_id long, text string").repartition(3)
    assert ran(df, block_rows=7) == brute([(i, t) for i, (_, t, *_) in enumerate(rows)])
    assert ran(df, block_shingles=400) == brute([(i, t) for i, (_, t, *_) in enumerate(rows)])


def test_linked_sets_share_a_signature():
    """Pigeonhole: any two sets at the threshold agree on a column block that is emitted."""
    rng = np.random.default_rng(1)
    levels = np.array(jaccard.size_levels(90))
    for _ in range(400):
        n = int(rng.integers(9, 120))
        base = rng.integers(0, 2**64, n, np.uint64, endpoint=False)
        for more in range(n // 9 + 1):
            other = np.concatenate([base, rng.integers(0, 2**64, more, np.uint64)])
            less = n // 9 - more
            other = other[min(less, len(other) - 1) // 2 :]
            a, b = np.unique(base), np.unique(other)
            both = len(np.intersect1d(a, b))
            if 100 * both >= 90 * (len(a) + len(b) - both) and not np.array_equal(a, b):
                found = [jaccard.block_signatures(x, levels, 90) for x in (a, b)]
                assert len(np.intersect1d(*found))


def test_overlaps_discard_no_link():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    side = lambda: [np.unique(np.append(rng.choice(base, 280, False), rng.integers(0, 2**63, 9).astype(np.uint64))) for _ in range(20)]
    left, right = side(), side() + [np.unique(base)]
    want = [[100 * (o := len(np.intersect1d(a, b))) >= 90 * (len(a) + len(b) - o) for b in right] for a in left]
    for columns in (4096, 50):
        assert jaccard.overlaps(left, right, 90, columns).tolist() == want


def test_long_texts(spark):
    rng = random.Random(8)
    long = [f"w{rng.randrange(10**7)}" for _ in range(160_000)]  # over one slice of 1 MiB
    rows = [(1, " ".join(long)), (2, edited(rng, long, 3000)), (3, edited(rng, long, 9000)), (4, "short text"), (None, " ".join(long))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ran(df) == brute(rows)


def test_empty_table(spark):
    assert jaccard.link_classes(spark.createDataFrame([], texts.SCHEMA)).collect() == []
