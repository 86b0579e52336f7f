"""Alignment of two tokenizers' tokens by interval coalescing, and counts of aligned id pairs.

Each text is encoded by a byte-level BPE (A, over space + text) and a piece BPE with
byte fallback (B, which adds the space itself). Every token covers a range of bytes. All
tokens of a slice of texts are sorted by start (``lexsort``), the running maximum of
their ends is taken (``maximum.accumulate``), and a group ends where the next
start reaches that maximum. Within a group every A token is linked with every
B token.

A batch of texts keeps, packed, the distinct id pairs of each text with their
numbers, and lists its own distinct pairs with the number of texts that hold
them. Spark sums the lists to corpus counts and the largest count of each A id,
and returns to every batch the counts of its own pairs, so the texts are encoded
once and what is shuffled are pairs per batch.

The byte-level vocabulary is read from its JSON file and run as merge ranks, which
gives the same ids as its own library at several times the speed.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hayloft.llm import words as W
from hayloft.llm.tables import stored

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
# how the byte-level tokenizer cuts a text before merging (fixed value)
A_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BATCH_BYTES = 8_000_000  # of text whose distinct pairs are listed together
LARGE_GROUP = 1 << 12  # links of a group from which on equal ids are counted instead of listed

_B_BITS = 32  # a pair is A id << 32 | B id
_NONE = np.zeros(0, np.int64)


# ------------------------------------------------------------------ tokenizers
def _byte_of_character() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Vocabulary:
    """Bytes of each id, and ids as decimal text followed by ``,``, ``|`` and ``;``."""

    def __init__(self, token_bytes: list[bytes]):
        self.bytes = pa.array(token_bytes, pa.large_binary())
        self.lengths = np.array([len(b) for b in token_bytes], np.int64)
        n = len(token_bytes)
        self.shown = pa.array([f"{i}{end}".encode() for end in ",|;" for i in range(n)], pa.large_binary())
        self.n = n


@lru_cache(maxsize=4)
def byte_level(path: str):
    """``(encode, vocabulary)`` of a byte-level BPE file; special tokens' strings are plain text."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    back = _byte_of_character()
    special = {t["id"] for t in described["added_tokens"] if t["special"]}
    vocabulary = described["model"]["vocab"]
    token_bytes = [b""] * (max([*vocabulary.values(), *special]) + 1)
    for token, i in vocabulary.items():
        if i not in special:
            token_bytes[i] = bytes(back[c] for c in token)
    ranks = {b: i for i, b in enumerate(token_bytes) if b}
    model = tiktoken.Encoding("byte-level", pat_str=A_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return model.encode_ordinary, _Vocabulary(token_bytes)


@lru_cache(maxsize=4)
def piece_level(path: str):
    """``(encode, vocabulary)`` of a piece model with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = model.id_to_piece(list(range(model.get_piece_size())))
    token_bytes = [
        bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
    ]
    return model.encode, _Vocabulary(token_bytes)


# ------------------------------------------------------------- numpy: alignment
def _concat(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts one after the other, and the bounds of each text."""
    bounds = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=bounds[1:])
    return np.fromiter((i for p in parts for i in p), np.int64, int(bounds[-1])), bounds


def _same_bytes(ids: np.ndarray, bounds: np.ndarray, vocabulary: _Vocabulary, wanted: list[bytes]) -> np.ndarray:
    """For each text: its tokens' bytes joined are the wanted ones."""
    joined = vocabulary.bytes.take(pa.array(ids)).buffers()[2]
    data = memoryview(joined).cast("B") if joined is not None else memoryview(b"")
    ends = np.append(0, np.cumsum(vocabulary.lengths[ids]))[bounds].tolist()
    return np.array([data[a:b] == w for a, b, w in zip(ends[:-1], ends[1:], wanted)], bool)


def coalesce(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and each B token, for token byte lengths over the same bytes."""
    ends = np.concatenate([np.cumsum(a_lengths), np.cumsum(b_lengths)])
    starts = ends - np.concatenate([a_lengths, b_lengths])
    order = np.lexsort((starts,))
    reached = np.maximum.accumulate(ends[order])
    new = np.ones(len(order), bool)
    new[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group[: len(a_lengths)], group[len(a_lengths) :]


def _expand(a_ids, b_ids, a_group, b_group, text_of_group):
    """Linked id pairs within groups: text, pair and number of links."""
    n_a, n_b = (np.bincount(g, minlength=len(text_of_group)) for g in (a_group, b_group))
    first_b = np.append(0, np.cumsum(n_b))[:-1]
    few = (n_a * n_b <= LARGE_GROUP)[a_group]
    at = np.flatnonzero(few)
    times = n_b[a_group[at]]
    from_a = np.repeat(at, times)
    nth = np.arange(len(from_a)) - np.repeat(np.cumsum(times) - times, times)
    group = a_group[from_a]
    parts = [(text_of_group[group], (a_ids[from_a] << _B_BITS) | b_ids[first_b[group] + nth], np.ones(len(from_a), np.int64))]
    first_a = np.append(0, np.cumsum(n_a))[:-1]
    for g in np.flatnonzero(n_a * n_b > LARGE_GROUP).tolist():
        a, times_a = np.unique(a_ids[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        b, times_b = np.unique(b_ids[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        pairs = ((a << _B_BITS)[:, None] | b[None, :]).ravel()
        parts.append((np.full(len(pairs), text_of_group[g]), pairs, np.outer(times_a, times_b).ravel()))
    return tuple(np.concatenate(column) for column in zip(*parts))


def _shown(ids: np.ndarray, group: np.ndarray, vocabulary: _Vocabulary, last: int) -> np.ndarray:
    """Index of each token's decimal text with the separator that follows it: ``,`` or, at the end of a group, ``last``."""
    ends = np.ones(len(ids), bool)
    ends[:-1] = group[1:] != group[:-1]
    return ids + vocabulary.n * np.where(ends, last, 0)


def align(texts: list[str], a: tuple, b: tuple) -> dict[str, np.ndarray | list]:
    """Alignment of a slice of texts.

    Returns per text ``n_a``, ``n_b``, ``n_groups``, ``n_links`` and ``digest``; and per
    distinct pair of a text ``text``, ``pair``, ``times``, in the order of texts and pairs.
    """
    (encode_a, of_a), (encode_b, of_b) = a, b
    n = len(texts)
    spaced = [" " + t if t else "" for t in texts]
    wanted = [t.encode() for t in spaced]
    sides = []
    for encode, vocabulary, given in ((encode_a, of_a, spaced), (encode_b, of_b, texts)):
        ids, bounds = _concat([encode(t) if t else [] for t in given])
        sides.append((ids, bounds, _same_bytes(ids, bounds, vocabulary, wanted)))
    ok = sides[0][2] & sides[1][2]
    (a_ids, a_text), (b_ids, b_text) = (
        (ids[np.repeat(ok, np.diff(bounds))], np.repeat(np.flatnonzero(ok), np.diff(bounds)[ok])) for ids, bounds, _ in sides
    )
    a_group, b_group = coalesce(of_a.lengths[a_ids], of_b.lengths[b_ids])
    n_groups = int(a_group[-1]) + 1 if len(a_group) else 0
    text_of_group = np.zeros(n_groups, np.int64)
    text_of_group[a_group] = a_text
    text, pair, times = _expand(a_ids, b_ids, a_group, b_group, text_of_group)
    order = np.lexsort((pair, text))
    text, pair, times = text[order], pair[order], times[order]
    new = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (pair[1:] != pair[:-1]))) if len(text) else _NONE
    times = np.add.reduceat(times, new) if len(new) else _NONE

    # a group's A ids, then its B ids: one take over both, in that order
    both = np.concatenate([_shown(a_ids, a_group, of_a, 1), 3 * of_a.n + _shown(b_ids, b_group, of_b, 2)])
    place = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
    shown = pa.concat_arrays([of_a.shown, of_b.shown]).take(pa.array(both[place]))
    ends = np.append(0, np.cumsum(pc.binary_length(shown).to_numpy(zero_copy_only=False)))
    of_text = np.bincount(a_text, minlength=n) + np.bincount(b_text, minlength=n)
    cut = ends[np.append(0, np.cumsum(of_text))].tolist()
    data = memoryview(shown.buffers()[2]).cast("B") if len(both) else memoryview(b"")
    digests = [hashlib.sha256(data[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(cut[:-1], cut[1:])]
    return {
        "n_a": np.bincount(a_text, minlength=n),
        "n_b": np.bincount(b_text, minlength=n),
        "n_groups": np.bincount(text_of_group, minlength=n),
        "n_links": np.bincount(text[new], times, n).astype(np.int64),
        "digest": digests,
        "text": text[new],
        "pair": pair[new],
        "times": times,
    }


# ------------------------------------------------------------- Arrow: the corpus
def _packed(values: np.ndarray, width: str) -> bytes:
    """Integers as zstd over their byte planes."""
    planes = np.ascontiguousarray(values.astype(width)).view(np.uint8).reshape(len(values), np.dtype(width).itemsize).T
    return len(values).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def _unpacked(packed: bytes, width: str) -> np.ndarray:
    n, size = int.from_bytes(packed[:8], "little"), np.dtype(width).itemsize
    planes = pa.Codec("zstd").decompress(packed[8:], decompressed_size=size * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(width).reshape(n)


_PER_TEXT = ("n_a", "n_b", "n_groups", "n_links")


def _align_batches(folder: str, batch_bytes: int):
    def run(batches):
        a, b = byte_level(f"{folder}/{A_FILE}"), piece_level(f"{folder}/{B_FILE}")
        task = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        listed: list[np.ndarray] = []
        done, size = 0, 0

        def schema(ids: pa.DataType) -> pa.Schema:
            kinds = {"gid": pa.int64(), "ids": pa.list_(ids)} | {c: pa.list_(pa.int64()) for c in _PER_TEXT}
            kinds |= {"digests": pa.list_(pa.string()), "n_pairs": pa.list_(pa.int64())}
            kinds |= {"places": pa.binary(), "times": pa.binary(), "pair": pa.int64(), "n": pa.int64()}
            return pa.schema(kinds)

        def flush():
            """The slices of a batch of texts, their pairs as places in the batch's own list, and that list."""
            gid = (task << 33) + done
            ids, s = held[0]["ids"].type, schema(held[0]["ids"].type)
            pairs, of = np.unique(np.concatenate(listed), return_inverse=True)
            often = np.bincount(of, minlength=len(pairs))
            rank = np.argsort(-often, kind="stable")  # frequent pairs get small places
            place = np.empty(len(pairs), np.int64)
            place[rank] = np.arange(len(pairs))
            at = 0
            for part in held:
                own = place[of[at : at + part["total"]]]
                at += part["total"]
                columns = {"gid": [gid], "ids": pa.array([part["ids"].to_pylist()], pa.list_(ids))}
                columns |= {c: [part[c].tolist()] for c in (*_PER_TEXT, "n_pairs")}
                columns |= {"digests": [part["digest"]], "places": [_packed(own, "u4")], "times": [_packed(part["times"], "u4")]}
                columns |= {"pair": pa.nulls(1, pa.int64()), "n": pa.nulls(1, pa.int64())}
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in s], schema=s)
            for start in range(0, len(pairs), 1 << 16):
                cut = rank[start : start + (1 << 16)]
                columns = {f.name: pa.nulls(len(cut), f.type) for f in s}
                columns |= {"gid": pa.array(np.full(len(cut), gid)), "pair": pa.array(pairs[cut]), "n": pa.array(often[cut])}
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in s], schema=s)

        for batch in batches:
            for s in W.slices(batch.column("text")):
                texts = pc.fill_null(batch.column("text").slice(s.first, s.n), "").to_pylist()
                found = align(texts, a, b)
                n_pairs = np.bincount(found["text"], minlength=s.n)
                own = {c: found[c] for c in (*_PER_TEXT, "digest", "times")}
                held.append(own | {"ids": batch.column("id").slice(s.first, s.n), "n_pairs": n_pairs, "total": len(found["pair"])})
                listed.append(found["pair"])
                size += len(s.data)
                if size >= batch_bytes:
                    yield from flush()
                    held, listed, size, done = [], [], 0, done + 1
        if held:
            yield from flush()

    return run


def _sum_links(table: pa.Table, looked_up: pa.Table) -> pa.Table:
    """Per text: links with the highest count of their A id, and the sum of counts, from the counts of the batch's pairs."""
    # places follow the list's own order: frequent pairs first, then by pair
    n, pair = looked_up.column("n").to_numpy(), looked_up.column("pair").to_numpy()
    order = np.lexsort((pair, -n))
    count = looked_up.column("count").to_numpy()[order]
    best = looked_up.column("best").to_numpy()[order]
    parts = []
    for row in table.to_pylist():
        n_pairs = np.array(row["n_pairs"], np.int64)
        places, times = _unpacked(row["places"], "u4"), _unpacked(row["times"], "u4").astype(np.int64)
        bounds = np.append(0, np.cumsum(n_pairs))
        total = lambda values: np.diff(np.append(0, np.cumsum(values))[bounds])  # noqa: E731, B023
        sums = {"n_best": total(times * best[places]), "count_sum": total(times * count[places])}
        parts.append(sums | {c: row[c] for c in _PER_TEXT} | {"digest": row["digests"], "ids": row["ids"]})
    ids = pa.concat_arrays([pa.array(p["ids"], table.schema.field("ids").type.value_type) for p in parts]) if parts else None
    columns = {"id": ids if parts else pa.nulls(0, table.schema.field("ids").type.value_type)}
    for c in (*_PER_TEXT, "n_best", "count_sum"):
        columns[c] = pa.array(np.concatenate([p[c] for p in parts] or [_NONE]).astype(np.int64))
    columns["digest"] = pa.array([d for p in parts for d in p["digest"]], pa.string())
    return pa.table(columns)


def align_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizers: str = TOKENIZERS,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Per row of ``docs``: the id, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``,
    ``n_best`` (links whose pair is held by as many rows as any pair of its A id),
    ``count_sum`` (over links, the number of rows that hold the pair) and ``groups_sha256``.

    ``tokenizers`` is a folder with both vocabularies, at the same path on every executor.

    Defined cases: a NULL or empty text, and one whose tokens do not join to space +
    text, has no tokens (zeros, empty digest); repeated rows count as rows of
    their own; NULL ids stay; a text longer than a slice is aligned whole, by
    itself; an empty table gives an empty table. Further columns are not carried.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    lists = ", ".join(f"{c} array<long>" for c in _PER_TEXT)
    aligned = stored(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
            _align_batches(tokenizers, batch_bytes),
            f"gid long, ids array<{kind}>, {lists}, digests array<string>, n_pairs array<long>, places binary, times binary, pair long, n long",
        ),
        "aligned",
    )
    listed = aligned.where("pair IS NOT NULL").select(F.col("gid").alias("batch"), "pair", "n")
    counts = stored(listed.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    a_id = F.shiftright("pair", _B_BITS)
    most = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("most"))
    judged = stored(
        counts.withColumn("a", a_id).join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best")),
        "pair-judged",
    )
    looked_up = listed.join(judged, "pair").select("batch", "pair", "n", "count", "best")
    slices = aligned.where("ids IS NOT NULL").drop("pair", "n")
    columns = ", ".join(f"{c} long" for c in (*_PER_TEXT, "n_best", "count_sum"))
    return (
        slices.groupBy("gid")
        .cogroup(looked_up.groupBy("batch"))
        .applyInArrow(_sum_links, f"id {kind}, {columns}, digest string")
        .withColumnsRenamed({"id": id_col, "digest": "groups_sha256"})
    )
