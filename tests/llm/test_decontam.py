import random

import pytest

import llm_texts as texts
from hayloft.llm.decontam import contamination, is_contaminated


def brute(docs, items, window):
    windows = {}
    for item, text in items:
        ws = texts.ALNUM.findall(texts.lower(text))
        for p in range(max(1, len(ws) - window + 1)) if ws else ():
            windows.setdefault(tuple(ws[p : p + window]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text, *_ in docs:
        ws, hit, found = texts.ALNUM.findall(texts.lower(text)), set(), set()
        for n in lengths:
            for p in range(len(ws) - n + 1):
                if own := windows.get(tuple(ws[p : p + n])):
                    hit.update(range(p, p + n))
                    found |= own
        out.append((doc_id, len(ws), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(ws)))
    return sorted(out, key=str)


def items_from(docs, seed):
    rng = random.Random(seed)
    long = [r for r in docs if r[1] and len(r[1].split()) > 30]
    items = [(0, None), (1, ""), (2, "--"), (3, "ko"), (3, "never-seen-word")]
    for i in range(4, 30):
        ws = rng.choice(long)[1].split()
        at = rng.randrange(len(ws))
        items.append((i, " ".join(ws[at : at + rng.choice([1, 2, 4, 5, 6, 12, 13, 14, 40])]).upper()))
    items += [(100, items[8][1]), (101, "same " * 20), (102, "same same same")]  # shared windows, repeated words
    return items


@pytest.mark.parametrize("window,seed", [(13, 1), (13, 2), (6, 3)])
def test_matches_brute_force(spark, window, seed):
    rows = texts.document_rows(seed)
    items = items_from(rows, seed)
    docs = texts.with_clashing_columns(spark.createDataFrame(rows, texts.SCHEMA)).repartition(4)
    bench = texts.with_clashing_columns(spark.createDataFrame(items, "item_id long, text string"))
    got = contamination(docs, bench, window=window).select("row.doc_id", "n_words", "n_hit", "items", is_contaminated()).collect()
    assert sorted(((*r[:3], tuple(r[3]), r[4]) for r in got), key=str) == brute(rows, items, window)


def test_null_item_id_has_hits_but_no_name(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "B")], "item_id long, text string")
    r = contamination(docs, bench).select("n_hit", "items").first()
    assert tuple(r) == (1, [])


def test_empty_tables(spark):
    docs = spark.createDataFrame(texts.document_rows()[:5], texts.SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, none).where("n_hit > 0 OR size(items) > 0").collect() == []
    assert contamination(spark.createDataFrame([], texts.SCHEMA), none).collect() == []
