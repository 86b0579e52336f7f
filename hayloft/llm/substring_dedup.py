"""Substring de-duplication by looking up blocks and windows of words in the corpus.

The reference of a document is every document with a smaller id, held as
indexed *blocks*. Blocks are cut by content: the anchor of a window of
``window`` words is the smallest-hashed run of ``ANCHOR_WORDS`` words in it, and
a block is the stretch of windows that share one anchor. Two documents that
share a window therefore own blocks with the same anchor, so looking an anchor
up finds every reference block a copy could come from.

No greedy Relative Lempel-Ziv factor is extended; a window counts as copied exactly
when it stands in an earlier document:

* a block that is also, word for word, a block of an earlier document is
  copied whole;
* a block whose anchor an earlier document has too, but in other surroundings,
  is where a copy begins or ends. Its windows are looked up one by one among
  the windows of all reference blocks of that anchor, which settles the
  boundary exactly;
* every other block holds no copy.

Adjacent copies join, from whatever sources, so a span is a maximal run of copied
windows. Only anchors (about 2 in 36 words) are shuffled; single windows only around the
boundaries of copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hayloft.llm import words as W
from hayloft.llm.tables import order_id, stored, text_key

WINDOW_WORDS = 50
ANCHOR_WORDS = 16
_POSITION_BITS = np.uint64(24)
_POSITION = np.uint64((1 << 24) - 1)
# three independent hashes: anchors, whole blocks, single windows. Blocks and
# windows are looked up together with their anchor's hash, so equality is 128 bits.
_ANCHOR_BASE = 0xD6E8FEB86659FD93
_BLOCK_BASE = 0xA0761D6478BD642F
_WINDOW_BASE = 0xE7037ED1A0B428DB

_BLOCKS = "ord long, tkey long, anchor long, block long, start long, n int"
_WINDOWS = "ord long, tkey long, anchor long, win long, start long"


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    span = 1
    while span < width:
        step = min(span, width - span)
        keys = np.minimum(keys[:-step], keys[step:])
        span += step
    return keys


def _blocks(window: int):
    def run(batches):
        for batch in batches:
            ids, keys = batch.column("ord").to_numpy(), batch.column("tkey").to_numpy()
            for s in W.slices(batch.column("text")):
                words = W.find_words(s)
                ok = W.window_ok(words, window)
                if not ok.any():
                    continue
                hashes = W.word_hashes(s.data, words)
                grams = W.window_hashes(hashes, ANCHOR_WORDS, _ANCHOR_BASE)
                # hash first, position second: the leftmost of equal hashes wins.
                # Positions restart at each text, so equal windows choose alike.
                local = np.arange(len(grams)) - np.repeat(words.bounds[:-1], words.counts)[: len(grams)]
                packed = (grams & ~_POSITION) | (local.astype(np.uint64) & _POSITION)
                lowest = _sliding_min(packed, window - ANCHOR_WORDS + 1)[: len(ok)]
                at = np.flatnonzero(ok)
                text = words.text_of()[at]
                offset = local[at]
                anchor = (lowest[at] & _POSITION).astype(np.int64)
                # the position's low bits are enough: the anchor lies within the window
                anchor = offset + ((anchor - offset) & int(_POSITION))
                new = np.ones(len(at), bool)
                new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(at)))
                start = at[first]
                whole = W.range_hashes(hashes, start, start + n + window - 1, _BLOCK_BASE)
                # where the anchor stands in the block is part of the block
                whole = W.mix(whole + (anchor[first] - offset[first]).astype(np.uint64))
                owner = s.first + text[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[owner]),
                        pa.array(keys[owner]),
                        pa.array(W.signed(grams[start + anchor[first] - offset[first]])),
                        pa.array(W.signed(whole)),
                        pa.array(offset[first].astype(np.int64)),
                        pa.array(n.astype(np.int32)),
                    ],
                    names=["ord", "tkey", "anchor", "block", "start", "n"],
                )

    return run


def _boundary_windows(window: int):
    """The single windows of the listed blocks of each text."""

    def run(batches):
        for batch in batches:
            ids, keys = batch.column("ord").to_numpy(), batch.column("tkey").to_numpy()
            lists = batch.column("blocks").to_pylist()
            for s in W.slices(batch.column("text")):
                words = W.find_words(s)
                hashes = W.word_hashes(s.data, words)
                wins = W.window_hashes(hashes, window, _WINDOW_BASE)
                cols = [[], [], [], [], []]
                for t in range(s.n):
                    blocks = lists[s.first + t]
                    start = np.array([b["start"] for b in blocks], np.int64)
                    n = np.array([b["n"] for b in blocks], np.int64)
                    anchor = np.array([b["anchor"] for b in blocks], np.int64)
                    begin = np.repeat(np.cumsum(n) - n, n)
                    at = np.repeat(start, n) + np.arange(n.sum()) - begin
                    cols[0].append(np.full(len(at), ids[s.first + t]))
                    cols[1].append(np.full(len(at), keys[s.first + t]))
                    cols[2].append(np.repeat(anchor, n))
                    cols[3].append(W.signed(wins[words.bounds[t] + at]))
                    cols[4].append(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in cols], names=["ord", "tkey", "anchor", "win", "start"]
                )

    return run


def _cut(window: int, names: list[str]):
    """Drop the covered words of each text."""

    def run(batches):
        for batch in batches:
            lists = batch.column("runs")
            counts, removed, kept, spans = [], [], [], []
            for s in W.slices(batch.column("text")):
                for t in range(s.n):
                    words = s.data[s.bounds[t] : s.bounds[t + 1]].tobytes().split()
                    runs = lists[s.first + t].as_py()
                    found = []
                    for run_ in sorted((r["start"], r["start"] + r["n"] + window - 1) for r in runs or ()):
                        if found and run_[0] <= found[-1][1]:
                            found[-1][1] = max(found[-1][1], run_[1])
                        else:
                            found.append([*run_])
                    counts.append(len(words))
                    removed.append(sum(b - a for a, b in found))
                    for a, b in reversed(found):
                        del words[a:b]
                    kept.append(b" ".join(words).decode())
                    spans.append([{"start": a, "n_words": b - a} for a, b in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("n_words", pa.int64())]))),
                ],
                names=[*names, "n_words", "n_removed", "kept_text", "spans"],
            )

    return run


def copied_runs(base: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Runs of windows (``ord, tkey, start, n``) that stand in a document with a smaller id.

    ``base`` has ``ord`` (the ordering id), ``tkey`` and ``text``.
    """
    narrow = base.select("ord", "tkey", "text")
    blocks = stored(narrow.mapInArrow(_blocks(window), _BLOCKS), "rlz-blocks")

    # the index: anchors that more than one document owns, then their distinct blocks
    # (each side of a join is stored first: a join of two plain shuffles can split a hot anchor)
    anchors = stored(
        blocks.groupBy("anchor").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).where("lo < hi").select("anchor"),
        "rlz-anchors",
    )
    shared = stored(blocks.join(anchors, "anchor"), "rlz-shared")
    index = stored(shared.groupBy("anchor", "block").agg(F.min("ord").alias("source")), "rlz-index")
    variants = stored(index.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants")), "rlz-variants")
    index = stored(index.join(variants, "anchor"), "rlz-index")
    looked_up = stored(shared.join(index, ["anchor", "block"]), "rlz-lookup")

    whole = looked_up.where("source < ord").select("ord", "tkey", "start", "n")

    # factor boundaries: the first document of each block, where the anchor has other blocks too
    boundary = (
        looked_up.where("source = ord AND variants > 1")
        .groupBy("ord", "tkey")
        .agg(F.collect_set(F.struct("start", "n", "anchor")).alias("blocks"))
    )
    windows = stored(
        narrow.join(boundary, ["ord", "tkey"]).select("ord", "tkey", "text", "blocks").mapInArrow(
            _boundary_windows(window), _WINDOWS
        ),
        "rlz-windows",
    )
    earliest = windows.groupBy("anchor", "win").agg(F.min("ord").alias("source"), F.max("ord").alias("hi")).where(
        "source < hi"
    )
    earliest = stored(earliest.select("anchor", "win", "source"), "rlz-earliest")
    single = (
        windows.join(earliest, ["anchor", "win"])
        .where("source < ord")
        .select("ord", "tkey", "start", F.lit(1).alias("n"))
    )
    return whole.unionByName(single)


def remove_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS
) -> DataFrame:
    """Each document without the words that a smaller id's document has in the same ``window``-word run.

    Returns every input row: the id, ``n_words``, ``n_removed``, ``kept_text``
    (remaining words joined by one space) and ``spans`` (the removed factors as
    word offsets). Further input columns are not carried along.

    Defined cases: a NULL or empty text has no words and comes back empty; a
    text of fewer than ``window`` words is never cut; rows with equal ids do not
    count as smaller than each other; a NULL id is larger than every other id
    and equal to other NULL ids; ids must be whole numbers or castable to them (others
    fail); a very long text is cut whole, in one row; an empty table gives an empty table.
    """
    base = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        order_id(id_col).alias("ord"),
        text_key(text_col).alias("tkey"),
    )
    runs = (
        copied_runs(base, window)
        .groupBy("ord", "tkey")
        .agg(F.collect_set(F.struct("start", "n")).alias("runs"))
    )
    id_type = docs.schema[id_col].dataType.simpleString()
    return (
        base.join(runs, ["ord", "tkey"], "left")
        .select("id", "text", "runs")
        .mapInArrow(
            _cut(window, ["id"]),
            f"id {id_type}, n_words long, n_removed long, kept_text string, "
            "spans array<struct<start: long, n_words: long>>",
        )
        .withColumnRenamed("id", id_col)
    )
