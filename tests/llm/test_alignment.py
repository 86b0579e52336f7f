import hashlib
import random
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
import sentencepiece
import tokenizers

import llm_texts as texts
from hayloft.llm import alignment as A


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(f"{A.TOKENIZERS}/{A.A_FILE}")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{A.TOKENIZERS}/{A.B_FILE}")


@lru_cache
def byte_table():
    """Byte-level characters back to bytes, by the published table."""
    shown = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    table, extra = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def byte_of(token):
    return bytes(byte_table()[c] for c in token)


def brute(rows, libraries):
    a_lib, b_lib = libraries
    aligned, holds, linked = [], Counter(), []
    for _, text, *_ in rows:
        groups = []
        if text:
            ids_a, ids_b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
            bytes_a = [byte_of(a_lib.id_to_token(i)) for i in ids_a]
            bytes_b = [
                bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in zip(ids_b, map(b_lib.id_to_piece, ids_b))
            ]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                i = j = end_a = end_b = 0
                group = ([], [])
                while i < len(ids_a) or j < len(ids_b):
                    if end_a <= end_b and i < len(ids_a):
                        end_a += len(bytes_a[i])
                        group[0].append(ids_a[i])
                        i += 1
                    else:
                        end_b += len(bytes_b[j])
                        group[1].append(ids_b[j])
                        j += 1
                    if end_a == end_b:
                        groups.append(group)
                        group = ([], [])
        aligned.append(groups)
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        linked.append(links)
        holds.update(links.keys())
    most = defaultdict(int)
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, *_), groups, links in zip(rows, aligned, linked):
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append(
            (
                doc_id,
                sum(len(g[0]) for g in groups),
                sum(len(g[1]) for g in groups),
                len(groups),
                sum(links.values()),
                sum(n for p, n in links.items() if holds[p] == most[p[0]]),
                sum(n * holds[p] for p, n in links.items()),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=str)


def ran(df, **options):
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r) for r in A.align_documents(df, **options).select(*columns).collect()), key=str)


AWKWARD = [
    (300, " leading and trailing  ", None, None, None),
    (301, "<|endoftext|> <s></s> <unk> <0x41> ▁ under", None, None, None),
    (302, "\x00\x01 tabs\t\t\n\n\r\n   end", None, None, None),
    (303, "é日本語 🏳️‍🌈 Ω ﬁ    ١٢٣ क्षि \U000e0041", None, None, None),
    (304, "a" * 5_000 + "=" * 2000 + " " * 1001 + "ab" * 900, None, None, None),
    (305, "😀" * 3000, None, None, None),
]


def test_matches_brute_force(spark, libraries):
    rows = texts.document_rows(4) + AWKWARD
    df = texts.with_clashing_columns(spark.createDataFrame(rows, texts.SCHEMA)).repartition(5)
    assert ran(df) == brute(rows, libraries)


def test_several_batches_in_a_task(spark, libraries):
    rows = texts.document_rows(6) + AWKWARD
    df = spark.createDataFrame(rows, texts.SCHEMA).coalesce(1)
    assert ran(df, batch_bytes=2000) == brute(rows, libraries)


def test_large_groups_count_equal_ids(monkeypatch):
    given = [t or "" for _, t, *_ in texts.document_rows(6) + AWKWARD]
    both = [f(f"{A.TOKENIZERS}/{n}") for f, n in ((A.byte_level, A.A_FILE), (A.piece_level, A.B_FILE))]
    listed = A.align(given, *both)
    monkeypatch.setattr(A, "LARGE_GROUP", 3)
    counted = A.align(given, *both)
    assert all(np.array_equal(listed[c], counted[c]) for c in listed)


def test_ranks_give_the_library_ids(libraries):
    """Random strings over many scripts, white space, controls and long runs."""
    rng = random.Random(5)
    encode, _ = A.byte_level(f"{A.TOKENIZERS}/{A.A_FILE}")
    pools = [(32, 127), (9, 14), (160, 600), (0x370, 0x590), (0x5D0, 0x700), (0x900, 0xA00), (0x2000, 0x2070), (0x3040, 0x3100), (0x4E00, 0x5000), (0x1F300, 0x1F700)]
    for _ in range(3000):
        pool = rng.sample(pools, rng.randint(1, 4))
        text = "".join(chr(rng.randrange(*rng.choice(pool))) * rng.choice([1, 1, 1, 2, 5]) for _ in range(rng.randint(1, 60)))
        assert encode(text) == libraries[0].encode(text, add_special_tokens=False).ids, ascii(text)


def test_groups_end_where_both_end():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        ends = [np.append(np.flatnonzero(rng.random(n - 1) < 0.5) + 1, n) for _ in range(2)]
        a, b = A.coalesce(*(np.diff(e, prepend=0) for e in ends))
        shared = np.intersect1d(*ends)
        assert a.tolist() == np.searchsorted(shared, ends[0], "left").tolist()
        assert b.tolist() == np.searchsorted(shared, ends[1], "left").tolist()


def test_text_over_one_slice(spark, libraries):
    rng = random.Random(2)
    rows = [(1, " ".join(str(rng.randrange(10**6)) for _ in range(200_000))), (2, "1 2 3"), (None, None)]
    assert ran(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows, libraries)


def test_empty_table(spark):
    assert A.align_documents(spark.createDataFrame([], texts.SCHEMA)).collect() == []
