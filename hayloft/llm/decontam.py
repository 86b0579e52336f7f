"""Benchmark decontamination by a prefix-filtered set join.

Every window of a benchmark item (``WINDOW_WORDS`` consecutive words, or the whole
of a shorter item) is a set of word shingles, and a document contains the window
only if it contains all of them. Ordered by rarity in the corpus, the prefix that
such a join needs at full containment is one shingle: the rarest. So

1. the documents' counts of the benchmark's shingles are summed over the corpus;
2. each window's rarest shingle is its prefix token (a window with a shingle
   that no document has cannot occur);
3. documents emit only the positions of prefix tokens, with the words around
   them, and join the windows on the token;
4. the length and positional bounds must hold (the window fits into the
   document where the token's offset puts it), and the words must be equal.

Documents look shingles up in a bitmap of fixed size that is built by Spark and
broadcast: false positives only cost a row that the join then drops, so
neither the benchmark nor the corpus has a size limit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hayloft.llm import words as W
from hayloft.llm.tables import ALNUM_WORD, ascii_lower, stored, text_key

WINDOW_WORDS = 13
SHINGLE_WORDS = 5
SLICE_BYTES = 1 << 18  # of texts that a worker takes at a time
BITMAP_BITS_LOG2 = 24  # 2 MB, whatever the benchmark holds
_BUCKET_BITS = 32768  # bits that Spark's bitmap aggregate packs into one row


def _shingle_hash(words: list[str]) -> int:
    """The hash the documents' numpy code gives to the same words."""
    data = " ".join(words).encode()
    s = W.Slice(0, np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    hashes = W.word_hashes(s.data, W.find_words(s, W.IS_ALNUM_WORD))
    return int(W.signed(W.window_hashes(hashes, len(words)))[0])


def _window_shingles(window: int, shingle: int):
    """The shingles of each distinct window: ``window`` (its words), ``token`` (hash) and ``at`` (offset)."""

    def run(batches):
        for batch in batches:
            rows = {"window": [], "token": [], "at": []}
            for words in batch.column("window").to_pylist():
                k = min(shingle, len(words))
                for at in range(len(words) - k + 1):
                    rows["window"].append(words)
                    rows["token"].append(_shingle_hash(words[at : at + k]))
                    rows["at"].append(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["window"], pa.list_(pa.string())), pa.array(rows["token"], pa.int64()), pa.array(rows["at"], pa.int32())],
                names=["window", "token", "at"],
            )

    return W.giving_back(run)


def item_windows(benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``item_id, window``: the distinct windows of each item, as arrays of words."""
    words = F.regexp_extract_all(ascii_lower("text"), F.lit(f"({ALNUM_WORD})"), F.lit(1))
    split = benchmark.select("item_id", words.alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    return split.select(
        "item_id",
        F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, window))).alias("window"),
    ).distinct()


def _bit(token: np.ndarray) -> np.ndarray:
    return (W.mix(token.view(np.uint64)) >> np.uint64(64 - BITMAP_BITS_LOG2)).astype(np.int64)


def _bits(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_bit(batch.column("token").to_numpy()))], names=["bit"])


def _bitmap(tokens: DataFrame):
    """The tokens' bitmap, broadcast: ``2 ** BITMAP_BITS_LOG2`` bits however many tokens there are."""
    bits = tokens.select("token").mapInArrow(_bits, "bit long")
    parts = bits.groupBy((F.col("bit") / _BUCKET_BITS).cast("long").alias("part")).agg(
        F.bitmap_construct_agg((F.col("bit") % _BUCKET_BITS).cast("long")).alias("bits")
    )
    packed = np.zeros((1 << BITMAP_BITS_LOG2) // 8, np.uint8)
    for part, bits_ in parts.collect():  # at most 2 ** BITMAP_BITS_LOG2 / 32768 rows of 4 kB
        at = part * _BUCKET_BITS // 8
        packed[at : at + _BUCKET_BITS // 8] = np.frombuffer(bits_, np.uint8)
    return tokens.sparkSession.sparkContext.broadcast(packed)


def _token_positions(s: W.Slice, lengths: list[int], packed: np.ndarray):
    """Words of the lower-cased texts, and ``(positions, tokens)`` per shingle length that the bitmap has."""
    lowered = W.LOWER[s.data]
    words = W.find_words(W.Slice(s.first, lowered, s.bounds), W.IS_ALNUM_WORD)
    hashes = W.word_hashes(lowered, words)
    found = []
    for k in lengths:
        tokens = W.window_hashes(hashes, k)
        bit = _bit(tokens)
        hit = (packed[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
        at = np.flatnonzero((hit == 1) & W.window_ok(words, k))
        found.append((at, tokens[at]))
    return lowered, words, found


def _count_tokens(lengths: list[int], bitmap):
    def run(batches):
        for batch in batches:
            tokens = [np.zeros(0, np.uint64)]
            for s in W.slices(batch.column("text"), SLICE_BYTES):
                tokens += [t for _, t in _token_positions(s, lengths, bitmap.value)[2]]
            token, n = np.unique(np.concatenate(tokens), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(W.signed(token)), pa.array(n.astype(np.int64))], names=["token", "n"])

    return W.giving_back(run)


def _candidates(lengths: list[int], window: int, bitmap):
    """One row per text with its word count and the places where a prefix token may stand."""

    def run(batches):
        for batch in batches:
            counts, places = [], []
            for s in W.slices(batch.column("text"), SLICE_BYTES):
                lowered, words, found = _token_positions(s, lengths, bitmap.value)
                at = np.concatenate([a for a, _ in found])
                token = W.signed(np.concatenate([t for _, t in found]))
                text = np.searchsorted(words.bounds, at, "right") - 1
                own: list[list] = [[] for _ in range(s.n)]
                for p, h, t in zip(at.tolist(), token.tolist(), text.tolist()):
                    lo = max(int(words.bounds[t]), p - window + 1)
                    hi = min(int(words.bounds[t + 1]), p + window)
                    around = [lowered[a:b].tobytes().decode() for a, b in zip(words.starts[lo:hi], words.ends[lo:hi])]
                    own[t].append({"token": h, "at": p - int(words.bounds[t]), "before": p - lo, "words": around})
                counts += words.counts.tolist()
                places += own
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc"),
                    pa.array(counts, pa.int64()),
                    pa.array(places, _PLACES),
                ],
                names=["row", "doc", "n_words", "places"],
            )

    return W.giving_back(run)


_PLACES = pa.list_(
    pa.struct([("token", pa.int64()), ("at", pa.int64()), ("before", pa.int32()), ("words", pa.list_(pa.string()))])
)
_PLACES_SQL = "array<struct<token: long, at: long, before: int, words: array<string>>>"


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    carry: list[str] | None = None,
    window: int = WINDOW_WORDS,
    shingle: int = SHINGLE_WORDS,
) -> DataFrame:
    """``row`` (the carried columns, by default all), ``n_words``, ``n_hit`` and ``items`` of every document.

    ``n_hit`` counts the words inside any occurrence of a benchmark window;
    ``items`` are the items with an occurring window, sorted as strings.

    Defined cases: a NULL or empty text has no words and no hits; an item that
    is NULL or has no words has no windows; repeated items count under each of
    their ids, repeated rows are judged alike; empty tables give no hits or no
    rows; a very long text is searched whole. The input's columns are nested, so no name can clash.
    """
    windows = stored(item_windows(benchmark.select("item_id", "text"), window), "decontam-windows")
    shingles = stored(
        windows.select("window").distinct().mapInArrow(
            _window_shingles(window, shingle), "window array<string>, token long, at int"
        ),
        "decontam-shingles",
    )
    # shingle lengths: `shingle`, and those of the items that are shorter
    short = windows.where(F.size("window") < shingle).select(F.size("window").alias("k")).distinct().collect()
    lengths = sorted({shingle, *(r.k for r in short)})

    texts = docs.select(
        F.struct(*[F.col(c) for c in (carry if carry is not None else docs.columns)]).alias("row"),
        F.struct(F.col(id_col).cast("string").alias("id"), text_key().alias("tkey")).alias("doc"),
        F.col("text").alias("text"),
    )
    counted = texts.select("text").mapInArrow(_count_tokens(lengths, _bitmap(shingles)), "token long, n long")
    frequency = stored(counted.groupBy("token").agg(F.sum("n").alias("n")), "decontam-counts")

    # the rarest shingle of each window; one that no document has rules the window out
    ranked = shingles.join(frequency, "token", "left")
    prefix = stored(
        ranked.groupBy("window")
        .agg(
            F.min(F.coalesce("n", F.lit(0))).alias("rarest"),
            F.min_by(F.struct("token", "at"), F.struct("n", "token", "at")).alias("prefix"),
        )
        .where("rarest > 0")
        .select("window", "prefix.token", F.col("prefix.at").alias("offset")),
        "decontam-prefix",
    )
    row_kind, doc_kind = (texts.schema[c].dataType.simpleString() for c in ("row", "doc"))
    scanned = stored(
        texts.mapInArrow(
            _candidates(lengths, window, _bitmap(prefix)),
            f"row {row_kind}, doc {doc_kind}, n_words long, places {_PLACES_SQL}",
        ),
        "decontam-scanned",
    )
    places = scanned.select("doc", "n_words", F.explode("places").alias("p")).select("doc", "n_words", "p.*")
    start = F.col("at") - F.col("offset")
    length = F.size("window")
    matched = stored(
        places.join(prefix, "token")
        .where((start >= 0) & (start + length <= F.col("n_words")))  # length and positional bounds
        .where(F.slice("words", F.greatest(F.col("before") - F.col("offset") + 1, F.lit(1)), length) == F.col("window"))
        .select("doc", "window", start.alias("start"), length.alias("n"))
        .distinct(),
        "decontam-matched",
    )
    items = (
        matched.select("doc", "window").distinct().join(windows, "window").select("doc", "item_id").distinct()
        .groupBy("doc").agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    )
    runs = matched.groupBy("doc").agg(F.sort_array(F.collect_set(F.struct("start", "n"))).alias("runs"))
    # covered words: each run adds what lies beyond the furthest end so far
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit"))
    covered = F.aggregate(
        "runs",
        zero,
        lambda a, r: F.struct(
            F.greatest(a["end"], r["start"] + r["n"]).alias("end"),
            (a["hit"] + F.greatest(F.lit(0).cast("long"), r["start"] + r["n"] - F.greatest(a["end"], r["start"]))).alias("hit"),
        ),
        lambda a: a["hit"],
    )
    hits = items.join(runs.select("doc", covered.alias("n_hit")), "doc")
    return scanned.drop("places").join(hits, "doc", "left").select(
        "row",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def is_contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
