import random

import pytest
import xxhash

from hayloft.llm import simhash
import llm_texts as texts


def fingerprint(text, k=4):
    ws = texts.lower(text)
    ws = texts.words(ws)
    shingles = [" ".join(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))] if ws else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows, distance=4, groups=False):
    fps = [fingerprint(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    if groups:
        return sorted(((least.get(g)) for g in {find(i) for i in range(len(rows))}), key=str)
    return sorted(((r[0], fps[i], least.get(find(i))) for i, r in enumerate(rows)), key=str)


def ran(df, **options):
    got = simhash.near_groups(df, **options).collect()
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component) for r in got), key=str)


@pytest.mark.parametrize("crowd", [simhash.CROWD, 2])
def test_matches_brute_force(spark, crowd):
    rows = texts.document_rows(5)
    df = texts.with_clashing_columns(spark.createDataFrame(rows, texts.SCHEMA)).repartition(5)
    assert ran(df, crowd=crowd) == brute(rows)


@pytest.mark.parametrize("crowd,distance", [(64, 4), (8, 4), (8, 2)])
def test_links_of_clustered_fingerprints(spark, crowd, distance):
    """Clusters around random centres, distances on both sides of the limit."""
    rng = random.Random(crowd)
    fps = {0}
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.near_edges(spark.createDataFrame([(f,) for f in signed], "fp long"), distance, crowd).collect()
    root = {f: f for f in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        assert bin((a ^ b) % (1 << 64)).count("1") <= distance
        root[find(a)] = find(b)
    for a in signed:
        for b in signed:
            if bin((a ^ b) % (1 << 64)).count("1") <= distance:
                assert find(a) == find(b)


def test_one_of_each_keeps_one_row_of_every_group(spark):
    rows = texts.document_rows(6)
    df = spark.createDataFrame(rows, texts.SCHEMA).repartition(3)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == brute(rows, groups=True)


def test_empty_table(spark):
    empty = spark.createDataFrame([], texts.SCHEMA)
    assert simhash.near_groups(empty).collect() == []
    assert simhash.one_of_each(empty).collect() == []
