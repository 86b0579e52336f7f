"""N-gram Jaccard join as a blocked product of the document-by-shingle incidence matrix.

Documents with equal shingle sets are one row of the matrix. Rows can only link if
they meet two bounds that follow from their sizes: sizes at least 9 to 10 (in
general ``percent`` to 100), and at most ``size / 9`` shingles that only one of
them has. The work is:

1. *Which blocks of the product can hold a link.* A row's shingles are cut by
   hash into two more column blocks than shingles may differ, so two linked rows agree on
   at least two whole column blocks. Rows that agree on one that is not empty (or
   have several empty ones) are put into one cluster, over one edge per row and
   column block: to the smallest row that has the same block.
2. *The product.* Within a cluster rows are dealt into row blocks by size, and
   each pair of row blocks whose sizes can link is one task. It takes the
   columns in blocks and accumulates overlap counts; a pair whose count cannot reach
   the bound of its sizes any more is discarded, and rows without pairs leave.
3. A task returns, per row, the number of documents linked and the smallest row
   it is connected to, never the pairs. Components follow from these.

Shingles and sets go by 64-bit hashes (among 10**9 distinct sets 0.03 pairs would
share one). The work of a cluster grows with the square of its different texts, in
tasks of bounded size; what is written grows with its rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hayloft.llm import words as W
from hayloft.llm.components import components
from hayloft.llm.tables import stored, text_key

SHINGLE_WORDS = 3
PERCENT = 90  # documents link when 100 * intersection >= PERCENT * union
BLOCK_ROWS = 256
BLOCK_SHINGLES = 1_000_000  # of all rows of a row block together
BLOCK_COLUMNS = 4096
FILTER_BITS = 22  # the filter of clustered rows has 2 ** 22 bits at any size, in words of 64
_U = np.uint64
_SET = _U(0xA0761D6478BD642F)


def size_levels(percent: int, largest: int = 1 << 40) -> list[int]:
    """Lower ends of size levels: a set links only with sets of its level and the two beside it."""
    ends = [1, 2]
    while ends[-1] < largest:
        ends.append(max((ends[-1] - 1) * 100 // percent, ends[-1]) + 1)
    return ends


def shingle_sets(s: W.Slice, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text of a slice: values, and bounds per text."""
    s = W.Slice(s.first, W.LOWER[s.data], s.bounds)
    words = W.find_words(s)
    hashes = W.word_hashes(s.data, words)
    inside = W.window_ok(words, shingle)
    text = words.text_of()[: len(inside)][inside]
    values = W.window_hashes(hashes, shingle)[inside]
    short = np.flatnonzero((words.counts > 0) & (words.counts < shingle))
    if len(short):  # the whole sequence as one shingle
        whole = W.range_hashes(hashes, words.bounds[short], words.bounds[short + 1], W.WORD_BASE)
        text, values = np.concatenate([text, short]), np.concatenate([values, whole])
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    if len(values):
        new = np.append(True, (text[1:] != text[:-1]) | (values[1:] != values[:-1]))
        text, values = text[new], values[new]
    return values, np.searchsorted(text, np.arange(s.n + 1))


@lru_cache(maxsize=256)
def _column_blocks(level: int, differ: int) -> tuple[np.ndarray, np.ndarray]:
    """Inner edges of the column blocks of one size level, and a tag for each block."""
    n = differ + 2
    edges = np.array([i * (1 << 64) // n for i in range(1, n)], _U)
    return edges, W.mix(np.arange(n, dtype=_U) + (_U(level + 1) << _U(40)))


def block_signatures(values: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of the column blocks of one sorted set, for its own level and the one below."""
    level = int(np.searchsorted(levels, len(values), "right")) - 1
    total = np.append(np.zeros(1, _U), np.cumsum(W.mix(values ^ _SET), dtype=_U))
    out = []
    for at in (level, level - 1):
        differ = int(levels[at + 1] - 1) * (100 - percent) // percent if at >= 0 else 0
        if not differ:
            continue  # only equal sets link
        edges, tags = _column_blocks(at, differ)
        cut = np.concatenate([[0], np.searchsorted(values, edges), [len(values)]])
        filled = np.diff(cut) > 0
        sums = W.mix((total[cut[1:]] - total[cut[:-1]]) ^ tags)
        out.append(sums[filled])
        if len(filled) - filled.sum() >= 2:
            out.append(W.mix(np.array([at], _U) ^ _SET))  # too sparse: meets all others of this kind
    return np.unique(np.concatenate(out)) if out else np.zeros(0, _U)


def _marks(shingle: int, percent: int):
    def run(batches):
        levels = np.array(size_levels(percent))
        for batch in batches:
            sizes, prints, signatures = [], [], []
            for s in W.slices(batch.column("text")):
                values, bounds = shingle_sets(s, shingle)
                n = np.diff(bounds)
                total = np.append(np.zeros(1, _U), np.cumsum(W.mix(values), dtype=_U))
                sizes.append(n)
                prints.append(W.mix((total[bounds[1:]] - total[bounds[:-1]]) + n.astype(_U)))
                signatures += [
                    W.signed(block_signatures(values[a:b], levels, percent)) if b > a else np.zeros(0, np.int64)
                    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
                ]
            if not sizes:
                continue
            n = np.concatenate(sizes).astype(np.int64)
            at = np.append(0, np.cumsum([len(x) for x in signatures])).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(signatures)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("tkey"),
                    pa.array(n),
                    pa.array(W.signed(np.concatenate(prints)), mask=n == 0),
                    lists,
                ],
                names=["id", "tkey", "n", "fp", "signatures"],
            )

    return run


def _sets(shingle: int):
    def run(batches):
        for batch in batches:
            found = []
            for s in W.slices(batch.column("text")):
                values, bounds = shingle_sets(s, shingle)
                found += [values[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("fp"), batch.column("copies"), pa.array(found, pa.binary())], names=["fp", "copies", "shingles"]
            )

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray], percent: int, columns: int = BLOCK_COLUMNS) -> np.ndarray:
    """Which pairs of sorted sets link, as a boolean matrix."""
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    both = sizes[0][:, None] + sizes[1][None, :]
    # 100 * overlap >= percent * (both - overlap)
    needed = -(-percent * both // (100 + percent))
    linked = np.zeros(both.shape, bool)
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    places = []
    for side, size in zip((left, right), sizes):
        row = np.repeat(np.arange(len(side)), size)
        column = np.searchsorted(shared, values := np.concatenate(side))
        known = column < len(shared)
        known[known] = shared[column[known]] == values[known]
        order = np.argsort(column[known], kind="stable")
        places.append((row[known][order], column[known][order]))
    counts = np.zeros(both.shape, np.int64)
    rest = [np.bincount(row, minlength=len(side)) for (row, _), side in zip(places, (left, right))]
    alive = np.minimum(rest[0][:, None], rest[1][None, :]) >= needed
    for start in range(0, len(shared), columns):
        rows = [np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))]
        if not len(rows[0]):
            break
        blocks = []
        for i, (row, column) in enumerate(places):
            a, b = np.searchsorted(column, [start, start + columns])
            block = np.zeros((len(sizes[i]), min(columns, len(shared) - start)), np.float32)
            block[row[a:b], column[a:b] - start] = 1
            rest[i] = rest[i] - np.bincount(row[a:b], minlength=len(sizes[i]))
            blocks.append(block[rows[i]])
        at = np.ix_(*rows)
        counts[at] += (blocks[0] @ blocks[1].T).astype(np.int64)
        alive &= counts + np.minimum(rest[0][:, None], rest[1][None, :]) >= needed
    np.logical_and(alive, counts >= needed, out=linked)
    return linked


def _product(percent: int):
    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy()
        first, second = table.column("first").to_numpy(), table.column("second").to_numpy()
        copies = table.column("copies").to_numpy()
        sets = [np.frombuffer(x.as_py(), _U) for x in table.column("shingles")]
        order = np.argsort(fps)  # the smallest row of a component is its label
        left, right = (order[side[order]] for side in (first, second))
        out = {"fp": fps, "root": fps.copy(), "links": np.zeros(len(fps), np.int64)}
        if len(left) and len(right):
            linked = overlaps([sets[i] for i in left], [sets[i] for i in right], percent)
            linked &= fps[left][:, None] != fps[right][None, :]
            out["links"][left] += linked @ copies[right]
            if not np.array_equal(left, right):
                out["links"][right] += linked.T @ copies[left]
            label = np.arange(len(fps))
            label[order] = np.arange(len(fps))
            while True:  # the smallest label of the neighbours, until nothing changes
                before = label.copy()
                for a, b, m in ((left, right, linked), (right, left, linked.T)):
                    label[a] = np.minimum(label[a], np.where(m, label[b][None, :], len(fps)).min(axis=1))
                if np.array_equal(before, label):
                    break
            out["root"] = fps[order][label]
        return pa.table({k: pa.array(v) for k, v in out.items()})

    return run


def _maybe_in(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``df`` without most rows whose key is not among ``wanted``: those outside a bitmap of hashed keys.

    The bitmap is broadcast; it has at most ``2 ** FILTER_BITS / 64`` rows. The fuller it is, the
    more rows stay, so an exact join has to follow.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(1 << FILTER_BITS))
    word, bit = F.floor(slot / 64).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    bitmap = wanted.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    bitmap = stored(bitmap, "jaccard-filter")
    marked = df.select("*", word, bit.alias("bit")).join(F.broadcast(bitmap), "word")
    return marked.where(F.col("bits").bitwiseAND(F.col("bit")) != 0).select(*df.columns)


def _tasks(rows: DataFrame, percent: int, block_rows: int, block_shingles: int) -> DataFrame:
    """``fp, n, cluster`` -> the pairs of row blocks each row takes part in: ``fp, task, first, second``."""
    ends = size_levels(percent)
    level = F.expr(f"size(filter(array({', '.join(f'{e}L' for e in ends)}), e -> e <= n))")
    whole = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    small = (F.col("rows") <= block_rows) & (F.col("shingles") <= block_shingles)
    placed = rows.join(whole, "cluster").select("fp", "cluster", F.when(small, 0).otherwise(level).alias("level"), "n")
    placed = stored(placed, "jaccard-placed")
    blocks = placed.groupBy("cluster", "level").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / block_rows, F.sum("n") / block_shingles)).cast("int").alias("blocks")
    )
    blocks = stored(blocks, "jaccard-blocks")
    own = placed.join(blocks, ["cluster", "level"]).select(
        "fp", "cluster", "level", F.pmod(F.xxhash64("fp"), "blocks").cast("int").alias("block")
    )
    beside = own.select("*", F.explode(F.array(*[F.col("level") + i for i in (-1, 0, 1)])).alias("other"))
    met = beside.join(blocks.withColumnRenamed("level", "other"), ["cluster", "other"])
    met = met.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other_block"))
    here, there = F.struct("level", "block"), F.struct(F.col("other").alias("level"), F.col("other_block").alias("block"))
    return met.select(
        "fp",
        F.struct("cluster", F.least(here, there).alias("a"), F.greatest(here, there).alias("b")).alias("task"),
        (here <= there).alias("first"),
        (here >= there).alias("second"),
    )


def link_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    block_rows: int = BLOCK_ROWS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``id, n_shingles, component, n_links`` for every row of ``docs``.

    ``component`` is the smallest id reachable over links, the row's own included;
    ``n_links`` is the number of other rows it links with. ``percent`` is from 50 to 99.

    Defined cases: a NULL or empty text, or one without words, has no shingles and
    links with nothing; equal sets always link, so repeated rows do; NULL ids are
    ignored for the smallest id (a component of NULL ids alone has component
    NULL); a very long text is one row of the matrix like any other, alone in its row
    block if it has more than ``block_shingles`` shingles; an empty table gives
    an empty table. Further columns are not carried.
    """
    base = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("tkey"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    marked = stored(
        base.mapInArrow(_marks(shingle, percent), f"id {kind}, tkey long, n long, fp long, signatures array<long>"),
        "jaccard-marks",
    )
    distinct = stored(
        marked.where("fp IS NOT NULL")
        .groupBy("fp")
        .agg(
            F.min(F.struct("id", "tkey")).alias("key"),
            F.min("id").alias("least"),
            F.max("n").alias("n"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "jaccard-sets",
    )
    entries = marked.select("fp", F.explode("signatures").alias("signature"))
    shared = (
        entries.groupBy("signature").agg(F.min("fp").alias("hub"), F.max("fp").alias("last")).where("hub < last").drop("last")
    )
    met = stored(entries.join(shared, "signature").where("fp <> hub").select("fp", "hub").distinct(), "jaccard-met")
    clusters = stored(
        components(met.select(F.col("fp").alias("a"), F.col("hub").alias("b"))).withColumnsRenamed({"node": "fp", "root": "cluster"}),
        "jaccard-clusters",
    )
    rows = stored(clusters.join(distinct, "fp").select("fp", "cluster", "n", "copies", "key"), "jaccard-rows")
    texts = _maybe_in(base.select(F.struct("id", "tkey").alias("key"), "text"), rows, "key")
    sets = stored(
        texts.join(rows.select("key", "fp", "copies").hint("merge"), "key")  # the same plan at every size
        .select("fp", "copies", "text")
        .mapInArrow(_sets(shingle), "fp long, copies long, shingles binary"),
        "jaccard-shingles",
    ).dropDuplicates(["fp"])  # rows repeated with id and text
    tasks = stored(_tasks(rows, percent, block_rows, block_shingles), "jaccard-tasks")
    found = stored(
        tasks.join(sets, "fp").groupBy("task").applyInArrow(_product(percent), "fp long, root long, links long"), "jaccard-found"
    )
    roots = components(found.where("fp <> root").select(F.col("fp").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("fp").agg(F.sum("links").alias("links"))
    of = (
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .join(links, "fp", "left")
        .select("fp", F.coalesce("root", "fp").alias("root"), "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    of = stored(of, "jaccard-roots")
    smallest = stored(of.groupBy("root").agg(F.min("least").alias("component")), "jaccard-components")
    named = of.join(smallest, "root").select("fp", "component", "n_links")
    return marked.join(named, "fp", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("fp").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
