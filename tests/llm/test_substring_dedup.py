import hashlib

import pytest

from hayloft.llm.substring_dedup import remove_copies
import llm_texts as texts


def brute(rows, window):
    first = {}
    last = (1 << 63) - 1
    for doc_id, text, *_ in rows:
        ws, key = texts.words(text), last if doc_id is None else doc_id
        for p in range(len(ws) - window + 1):
            w = tuple(ws[p : p + window])
            first[w] = min(first.get(w, key), key)
    out = []
    for doc_id, text, *_ in rows:
        ws, key = texts.words(text), last if doc_id is None else doc_id
        gone = set()
        for p in range(len(ws) - window + 1):
            if first[tuple(ws[p : p + window])] < key:
                gone.update(range(p, p + window))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((doc_id, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def ran(df, window):
    got = remove_copies(df, window=window).collect()
    for r in got:
        assert sum(s.n_words for s in r.spans) == r.n_removed
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got), key=str
    )


@pytest.mark.parametrize("window,seed", [(50, 1), (50, 2), (20, 3)])
def test_matches_brute_force(spark, window, seed):
    rows = texts.document_rows(seed)
    df = texts.with_clashing_columns(spark.createDataFrame(rows, texts.SCHEMA)).repartition(5)
    assert ran(df, window) == brute(rows, window)


def test_empty_table(spark):
    assert remove_copies(spark.createDataFrame([], texts.SCHEMA)).collect() == []


def test_given_documents(spark):
    import os

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    from hayloft.llm.queries import op2_substring_dedup

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op2_substring_dedup(spark, sf).collect()), key=str)
    assert got == brute(rows, 50)
    assert any(r[2] for r in got)
