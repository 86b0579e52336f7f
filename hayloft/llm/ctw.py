"""Language-model scoring by context-tree weighting over bytes.

Every byte is eight binary decisions, highest bit first. For each decision, given
the bits before it, the contexts of 0 to ``depth`` preceding bytes form a tree,
and each node holds how often a 0 and a 1 followed in the training texts. A node's
estimate is Krichevsky-Trofimov's; its weighted probability is half that of its
counts and half the product of its children's, down to the deepest contexts. A
byte's probability then mixes the estimates along its context path with the
posterior weight of stopping at each depth. The tree is fixed while scoring.

A text's score depends on its ``depth + 1``-byte grams alone, so Spark moves grams,
not positions:

1. documents are dealt into groups of about ``GROUP_BYTES`` of text; each group
   sorts its grams and lists the distinct ones with their training counts, as
   one packed list per bundle of contexts that share their two latest bytes. There
   are as many bundles as the corpus needs at ``BUNDLE_BYTES`` of text each;
2. counts are summed and the trees are built per bundle; only the top two levels,
   at most 65,535 nodes whatever the corpus, pass through the driver;
3. each group gets the probabilities of its grams, in the order of its own lists,
   and those of its tokens, lists its grams again and scores its documents.

Grams are packed as zstd over the byte planes of the differences of sorted keys.
Tokens go by a 64-bit hash (among 10**9 distinct tokens some 0.03 pairs would share one).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hayloft.llm import words as W
from hayloft.llm.tables import stored, text_key

DEPTH = 6
GROUP_BYTES = 20_000_000
BUNDLE_BYTES = 5_000_000
LEAST_BUNDLES, MOST_BUNDLES = 32, 1 << 14  # there are 65,536 contexts of two bytes
MERGE_GRAMS = 1 << 21  # listed grams that wait to be merged in a bundle
LOG_UNIT = 2.0**-34  # logs travel as multiples of it: less than 3e-11 off for a byte
END = 0  # the end token's key, the hash of no bytes

_HALF = np.log(0.5)


# --------------------------------------------------------------- numpy: trees
def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, shifted to arguments of 8 and more."""
    shift = np.zeros(x.shape)
    y = x.astype(float).copy()
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    inverse = 1 / (y * y)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def _log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log Krichevsky-Trofimov probability of any sequence with these counts."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - np.log(np.pi) - _log_gamma(n0 + n1 + 1.0)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal keys begin."""
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return np.flatnonzero(new)


def _sum_by(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of the columns."""
    if len(keys) and np.any(keys[1:] < keys[:-1]):
        order = np.argsort(keys, kind="stable")  # merges the sorted runs that most inputs consist of
        keys, columns = keys[order], tuple(c[order] for c in columns)
    if not len(keys):
        return keys, *columns
    at = _runs(keys)
    return keys[at], *(np.add.reduceat(c, at) for c in columns)


def _nodes(grams: np.ndarray, n: np.ndarray, bit: int):
    """Decision nodes of sorted ``context << 8 | byte`` keys: ``context << bit | the byte's first bits``, counts."""
    one = (grams >> (7 - bit)) & 1
    node = ((grams >> 8) << bit) | ((grams & 255) >> (8 - bit))
    return _sum_by(node, n * (1 - one), n * one)


def _parent(nodes: np.ndarray, bit: int) -> np.ndarray:
    """The node whose context lacks the oldest byte."""
    return ((nodes >> (8 + bit)) << bit) | (nodes & ((1 << bit) - 1))


def _weigh(n0, n1, below):
    """Log weighted probability of inner nodes and the posterior weight of stopping there."""
    stop = _HALF + _log_kt(n0, n1)
    weighted = np.logaddexp(stop, _HALF + below)
    return weighted, np.exp(stop - weighted)


def _levels(grams: np.ndarray, n: np.ndarray, top: int):
    """Per depth from the deepest to ``top``: ``context << 8 | byte`` keys with counts."""
    depth = DEPTH
    keys, n = _sum_by(grams, n.astype(float))
    out = {depth: (keys, n)}
    while depth > top:
        # the oldest context byte stands just above the predicted byte
        keys, n = _sum_by(((keys >> 16) << 8) | (keys & 255), n)
        depth -= 1
        out[depth] = (keys, n)
    return out


def _bundle_tree(grams: np.ndarray, n: np.ndarray, top: int = 2):
    """Probabilities and weighted sums of contexts with at least ``top`` bytes.

    Grams are packed newest context byte first, the predicted byte last. Returns
    the sorted distinct grams, for each the eight probabilities of its bits given
    depth ``top`` and deeper, and per bit the nodes at depth ``top`` with
    counts and log weighted probability.
    """
    levels = _levels(grams, n, top)
    keys = levels[DEPTH][0]
    chance = np.zeros((len(keys), 8))
    tops = []
    for bit in range(8):
        nodes, n0, n1 = _nodes(*levels[DEPTH], bit)
        weighted = _log_kt(n0, n1)
        parts = [(nodes, n0, n1, np.zeros(len(nodes)))]
        for depth in range(DEPTH - 1, top - 1, -1):
            below_nodes, below = _sum_by(_parent(nodes, bit), weighted)
            nodes, n0, n1 = _nodes(*levels[depth], bit)
            weighted, stop = _weigh(n0, n1, below)  # the same nodes, in the same order
            parts.append((nodes, n0, n1, stop))
        tops.append((nodes, n0, n1, weighted))
        one = ((keys >> (7 - bit)) & 1).astype(float)
        own = ((keys >> 8) << bit) | ((keys & 255) >> (8 - bit))
        for level, (nodes, n0, n1, stop) in enumerate(parts):
            at = np.searchsorted(nodes, own)
            kt = (np.where(one == 1, n1[at], n0[at]) + 0.5) / (n0[at] + n1[at] + 1.0)
            chance[:, bit] = kt if level == 0 else stop[at] * kt + (1 - stop[at]) * chance[:, bit]
            own = _parent(own, bit)
    return keys, chance, tops


# ------------------------------------------------------------ Arrow: documents
def pack_grams(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The gram that ends at each byte; before a text stand zero bytes."""
    text_start = np.repeat(bounds[:-1], np.diff(bounds))
    age = np.arange(len(data)) - text_start
    grams = np.zeros(len(data), np.int64)
    padded = np.concatenate([np.zeros(DEPTH, np.uint8), data])
    for back in range(1, DEPTH + 1):  # newest context byte first
        byte = padded[DEPTH - back : DEPTH - back + len(data)].astype(np.int64)
        grams = (grams << 8) | np.where(age >= back, byte, 0)
    return (grams << 8) | data


def _lowered(s: W.Slice) -> W.Slice:
    return W.Slice(s.first, W.LOWER[s.data], s.bounds)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]):
    keys = np.concatenate([k for k, _ in parts])
    return _sum_by(keys, np.concatenate([n for _, n in parts]).astype(float))


def _token_hashes(s: W.Slice) -> tuple[np.ndarray, W.Words]:
    words = W.find_words(s)
    return W.signed(W.word_hashes(s.data, words)), words


def _distinct_grams(table: pa.Table, held: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Sorted distinct grams of a group's texts and, given ``held``, how often each stands in its training texts."""
    sizes = pc.fill_null(pc.binary_length(table.column("text")), 0).to_numpy().astype(np.int64)
    counted = np.zeros(len(sizes), bool) if held is None else held
    n_train = int(sizes[~counted].sum())
    grams = np.empty(int(sizes.sum()), np.int64)  # those of training texts first
    at = {False: 0, True: n_train}
    for s in W.slices(table.column("text")):
        own = pack_grams(W.LOWER[s.data], s.bounds)
        out = np.repeat(counted[s.first : s.first + s.n], np.diff(s.bounds))
        for kind in (False, True):
            part = own[out == kind]
            grams[at[kind] : at[kind] + len(part)] = part
            at[kind] += len(part)
    train, other = grams[:n_train], grams[n_train:]
    train.sort()
    starts = _runs(train)
    keys = train[starts]
    if held is None:
        return keys, None
    n = np.diff(np.append(starts, n_train))
    other.sort()
    other = other[_runs(other)] if len(other) else other.copy()
    del grams, train, starts  # the largest arrays, before the lists are merged
    return _sum_by(np.concatenate([keys, other]), np.concatenate([n, np.zeros(len(other), np.int64)]))


def _by_bundle(grams: np.ndarray, bundles: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted grams in the order of bundles (by the two latest context bytes): places, and the bundles with their starts.

    Equal two bytes stand together in sorted grams, so whole stretches move.
    """
    if not len(grams):
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
    latest = grams >> (8 * (DEPTH - 1))
    starts = _runs(latest)
    bundle = (W.mix(latest[starts].astype(np.uint64)) % np.uint64(bundles)).astype(np.int32)
    lengths = np.diff(np.append(starts, len(grams)))
    order = np.argsort(bundle, kind="stable")
    starts, lengths, bundle = starts[order], lengths[order], bundle[order]
    before = np.cumsum(lengths) - lengths
    places = np.repeat(starts - before, lengths) + np.arange(len(grams))
    first = _runs(bundle)
    return places, bundle[first], before[first]


def _packed(values: np.ndarray) -> bytes:
    """64-bit values as zstd over their byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T
    return len(values).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    planes = pa.Codec("zstd").decompress(packed[8:], decompressed_size=8 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).view(np.int64).reshape(n)


def _list_group(bundles: int):
    """Distinct grams, packed by bundle, and tokens of a group of documents with their training counts."""

    def run(table: pa.Table) -> pa.Table:
        held = table.column("held_out").to_numpy()
        gid = table.column("gid")[0].as_py()
        found = [(np.array([END]), np.array([float((~held).sum())]))]
        for s in W.slices(table.column("text")):
            tokens, words = _token_hashes(_lowered(s))
            learn = (~held[s.first : s.first + s.n]).astype(float)
            found.append(_sum_by(tokens, np.repeat(learn, words.counts)))
            if len(found) > 8:
                found = [_merge(found)]
        tokens, n_tokens = _merge(found)
        grams, n_grams = _distinct_grams(table, held)
        places, own, starts = _by_bundle(grams, bundles)
        ends = np.append(starts[1:], len(grams)).astype(np.int64)
        lists = [(grams[places[a:b]], n_grams[places[a:b]]) for a, b in zip(starts.tolist(), ends.tolist())]
        n, none = len(tokens), len(own)
        return pa.table(
            {
                "gid": pa.array(np.full(none + n, gid, np.int32)),
                "bundle": pa.concat_arrays([pa.array(own.astype(np.int32)), pa.nulls(n, pa.int32())]),
                "grams": pa.array([_packed(np.diff(g, prepend=0)) for g, _ in lists] + [None] * n, pa.binary()),
                "counts": pa.array([_packed(c.astype(np.int64)) for _, c in lists] + [None] * n, pa.binary()),
                "key": pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(tokens)]),
                "n": pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(n_tokens.astype(np.int64))]),
            }
        )

    return run


def _score_group(total: int, distinct: int, bundles: int):
    """Score a group's documents with the looked-up values of its grams and tokens."""

    def run(table: pa.Table, looked_up: pa.Table) -> pa.Table:
        lists = looked_up.filter(pc.is_valid(looked_up.column("logs"))).sort_by("bundle")
        grams, _ = _distinct_grams(table)
        places, _, _ = _by_bundle(grams, bundles)
        logs = np.empty(len(grams))
        logs[places] = np.concatenate([np.zeros(0), *(_unpacked(v.as_py()) * LOG_UNIT for v in lists.column("logs"))])
        of_tokens = looked_up.filter(pc.is_null(looked_up.column("logs")))
        tokens, counts = of_tokens.column("key").to_numpy(), of_tokens.column("value").to_numpy()
        order = np.argsort(tokens)
        tokens, counts = tokens[order], counts[order]
        known = counts > 0
        base = np.log10((counts + 0.5) / (total + 0.5 * (distinct + 1)))
        end = np.searchsorted(tokens, END)
        out: dict[str, list] = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
        for s in W.slices(table.column("text")):
            s = _lowered(s)
            text = np.repeat(np.arange(s.n), np.diff(s.bounds))
            wanted = pack_grams(s.data, s.bounds)
            order = np.argsort(wanted)  # sorted values are found several times faster
            own = logs[np.searchsorted(grams, wanted[order])] if len(text) else np.zeros(0)
            out["score"].append(np.bincount(text[order], own, s.n))
            hashes, words = _token_hashes(s)
            at, text = np.searchsorted(tokens, hashes), words.text_of()
            out["n_tokens"].append(words.counts + 1)
            out["n_known"].append(np.bincount(text, known[at], s.n) + known[end])
            out["base_score"].append(np.bincount(text, base[at], s.n) + base[end])
        n = len(table)
        column = lambda c, kind: pa.array(np.concatenate(out[c]).astype(kind))
        return pa.table(
            {
                "id": table.column("id"),
                "held_out": table.column("held_out"),
                "n_tokens": column("n_tokens", np.int64),
                "n_known": column("n_known", np.int64),
                "train_tokens": pa.array(np.full(n, total, np.int64)),
                "base_score": column("base_score", float),
                "score": column("score", float),
            }
        )

    return run


# ------------------------------------------------------------ Arrow: the model
def _bundle_counts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of a bundle and their counts over all groups, merged as they are unpacked."""
    parts, waiting = [(np.zeros(0, np.int64), np.zeros(0))], 0
    for grams, counts in zip(table.column("grams"), table.column("counts")):
        parts.append((np.cumsum(_unpacked(grams.as_py())), _unpacked(counts.as_py())))
        waiting += len(parts[-1][0])
        if waiting > max(MERGE_GRAMS, len(parts[0][0])):
            parts, waiting = [_merge(parts)], 0
    return _merge(parts)


def _top_nodes(table: pa.Table) -> pa.Table:
    """What one bundle's contexts add to the one-byte contexts above them."""
    _, _, tops = _bundle_tree(*_bundle_counts(table))
    out = []
    for bit, (nodes, n0, n1, weighted) in enumerate(tops):
        up, n0, n1, weighted = _sum_by(_parent(nodes, bit), n0, n1, weighted)
        out.append((np.full(len(up), bit, np.int32), up, n0, n1, weighted))
    columns = [np.concatenate(c) for c in zip(*out)]
    return pa.table(dict(zip(("bit", "node", "n0", "n1", "weighted"), map(pa.array, columns))))


def _gram_logs(top):
    """log10 probability of the predicted byte of each gram in the lists of a bundle."""

    def run(table: pa.Table) -> pa.Table:
        keys, chance, _ = _bundle_tree(*_bundle_counts(table))
        logs = np.zeros(len(keys))
        for bit in range(8):
            p = chance[:, bit]
            one = (keys >> (7 - bit)) & 1
            first_bits = (keys & 255) >> (8 - bit)
            newest = keys >> (8 * DEPTH)
            for nodes, n0, n1, stop, own in (
                (*top.value[bit][0], (newest << bit) | first_bits),
                (*top.value[bit][1], first_bits),
            ):
                at = np.searchsorted(nodes, own)
                kt = (np.where(one == 1, n1[at], n0[at]) + 0.5) / (n0[at] + n1[at] + 1.0)
                p = stop[at] * kt + (1 - stop[at]) * p
            logs += np.log10(p)
        own = (np.cumsum(_unpacked(g.as_py())) for g in table.column("grams"))
        found = [_packed(np.rint(logs[np.searchsorted(keys, g)] / LOG_UNIT).astype(np.int64)) for g in own]
        return pa.table({"gid": table.column("gid"), "bundle": table.column("bundle"), "logs": pa.array(found, pa.binary())})

    return run


def _top_tree(rows) -> list:
    """Per bit: nodes of the one-byte contexts and of the empty context, with the weight of stopping."""
    out = []
    for bit in range(8):
        own = sorted((r.node, r.n0, r.n1, r.weighted) for r in rows if r.bit == bit)
        nodes = np.array([r[0] for r in own], np.int64)
        n0, n1, below = (np.array([r[i] for r in own], float) for i in (1, 2, 3))
        weighted, stop = _weigh(n0, n1, below)
        root, m0, m1, under = _sum_by(_parent(nodes, bit), n0, n1, weighted)
        out.append(((nodes, n0, n1, stop), (root, m0, m1, _weigh(m0, m1, under)[1])))
    return out


def model(lists: DataFrame) -> DataFrame:
    """``gid, bundle, grams, counts`` -> ``gid, bundle, logs``: the log10 probability of each listed gram's last byte after the bytes before it."""
    kinds = "bit int, node long, n0 double, n1 double, weighted double"
    tops = lists.groupBy("bundle").applyInArrow(_top_nodes, kinds)
    summed = tops.groupBy("bit", "node").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "weighted")))
    # one row per first bits of a byte and newest context byte: 255 * 256 at most
    top = lists.sparkSession.sparkContext.broadcast(_top_tree(summed.collect()))
    return lists.groupBy("bundle").applyInArrow(_gram_logs(top), "gid int, bundle int, logs binary")


def score_documents(
    docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """Score every document with a model of those for which ``held_out`` is false.

    Returns the id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (unigram over tokens) and ``score`` (log10 of the tree's
    probability of the lower-cased text). Code length per byte is
    ``-score / log10(2) / bytes``.

    Defined cases: a NULL or empty text has probability 1 (score 0) and the end
    token alone; a ``held_out`` that is NULL counts as false; without training
    texts every bit has probability 1/2; repeated rows all count and are scored
    alike; a very long text makes its group of texts as much larger; an empty table gives
    an empty table. Further columns are not carried.
    """
    base = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        text_key(text_col).alias("tkey"),
    )
    total_bytes = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    groups = int(total_bytes // group_bytes) + 1
    bundles = min(max(int(total_bytes // BUNDLE_BYTES), LEAST_BUNDLES), MOST_BUNDLES)
    dealt = base.withColumn("gid", F.pmod(F.xxhash64("id", "tkey"), F.lit(groups)).cast("int"))
    listed = stored(
        dealt.select("gid", "text", "held_out").groupBy("gid").applyInArrow(
            _list_group(bundles), "gid int, bundle int, grams binary, counts binary, key long, n long"
        ),
        "ctw-listed",
    )
    listed_tokens = listed.where("bundle IS NULL").select("gid", "key", "n")
    of_tokens = listed_tokens.groupBy("key").agg(F.sum("n").cast("double").alias("value"))
    of_tokens = stored(of_tokens, "ctw-counts")
    of_grams = model(listed.where("bundle IS NOT NULL").select("gid", "bundle", "grams", "counts"))
    size = of_tokens.agg(F.sum("value").alias("total"), F.sum((F.col("value") > 0).cast("long")).alias("distinct")).first()
    looked_up = of_grams.unionByName(listed_tokens.select("gid", "key").join(of_tokens, "key"), allowMissingColumns=True)
    id_type = docs.schema[id_col].dataType.simpleString()
    scored = (
        dealt.select("id", "text", "held_out", "gid")
        .groupBy("gid")
        .cogroup(looked_up.groupBy("gid"))
        .applyInArrow(
            _score_group(int(size.total or 0), int(size.distinct or 0), bundles),
            f"id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )
    return scored.withColumnRenamed("id", id_col)
