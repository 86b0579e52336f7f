"""SimHash near-duplicates by multi-index hashing.

Fingerprints are compared as distinct values (copies collapse first). Each is
cut into two 32-bit segments. At ``distance`` 4 or less either the first
segment differs in at most 2 bits or the second in at most 1 (2 + 1 + 2 > 4), so

* first segment: both sides enumerate the ball of radius 1 (33 values), which
  meet exactly when the segments differ in 2 bits or fewer;
* second segment: both sides enumerate the 32 values with one bit masked, which
  meet exactly when the segments differ in 1 bit or none.

These 65 rows per fingerprint are the index table. Entries with several
fingerprints are candidates, whose complete distance is verified.

An entry with more than ``CROWD`` fingerprints would give too many pairs. Its
members go another exact way instead: they enumerate the ball of radius 2
over all 64 bits and meet at shared points. Two fingerprints share such a point
exactly when they differ in 4 bits or fewer, and linking each to the smallest
fingerprint at the point keeps all connections without listing pairs. The work
per fingerprint is bounded either way, so it grows with the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hayloft.llm import words as W
from hayloft.llm.components import components
from hayloft.llm.tables import stored, text_key

SHINGLE_WORDS = 4
SLICE_BYTES = 1 << 18  # of texts that a worker takes at a time
DISTANCE = 4
SEED = 42
CROWD = 64
INDEXED_AT_ONCE = 1 << 15  # fingerprints that one task makes 65 index entries of
POINTS_AT_ONCE = 1 << 10  # and 2081 points


def _fingerprints(shingle: int, names: list[str]):
    digest = xxhash.xxh64_intdigest

    def run(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for s in W.slices(batch.column("text"), SLICE_BYTES):
                for t in range(s.n):
                    words = W.LOWER[s.data[s.bounds[t] : s.bounds[t + 1]]].tobytes().split()
                    if not words:
                        continue
                    joined = b" ".join(words)
                    ends = np.cumsum([len(w) + 1 for w in words]) - 1
                    starts = np.append(0, ends[:-1] + 1)
                    k = min(shingle, len(words))
                    spans = zip(starts.tolist(), ends[k - 1 :].tolist())
                    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - k + 1)
                    votes = np.zeros(64, np.int64)
                    for at in range(0, len(hashes), 1 << 16):  # 64 bytes a shingle while counting
                        part = hashes[at : at + (1 << 16)]
                        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                        votes += bits.sum(axis=0, dtype=np.int64)
                    on = np.flatnonzero(2 * votes > len(hashes)).astype(np.uint64)
                    out[s.first + t] = np.bitwise_or.reduce(np.uint64(1) << on) if len(on) else 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(out.view(np.int64))], names=[*names, "fp"]
            )

    return W.giving_back(run)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``id, text`` -> ``id, tkey, fp``: the 64-bit SimHash of lower-cased word shingles, as a long."""
    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", text_key().alias("tkey"), "text").mapInArrow(
        _fingerprints(shingle, ["id", "tkey"]), f"id {kind}, tkey long, fp long"
    )


def _index(fps: DataFrame) -> DataFrame:
    """``(entry, fp)``: 33 entries of the first segment's ball, 32 masked entries of the second."""
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    bits = F.sequence(F.lit(0), F.lit(31))
    # the entry's top half tells the kind apart: 0 for the ball, 1 + bit for a masked segment
    ball = F.transform(bits, lambda i: high.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    masked = F.transform(
        bits,
        lambda i: low.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), i))).bitwiseOR(
            F.call_function("shiftleft", (i + 1).cast("long"), F.lit(32))
        ),
    )
    return fps.select("fp", F.explode(F.concat(F.array(high), ball, masked)).alias("entry"))


def _near_points(fps: DataFrame, radius: int) -> DataFrame:
    """``(point, fp)``: every 64-bit value within ``radius`` (1 or 2) bits of ``fp``: 65 or 2081 points."""
    one = F.lit(1).cast("long")
    # bit pairs (i, j) with i <= j, where i = j flips one bit; a last mask flips none
    masks = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(63)),
            lambda i: F.transform(
                F.sequence(i, F.lit(63) if radius == 2 else i),
                lambda j: F.call_function("shiftleft", one, i).bitwiseOR(F.call_function("shiftleft", one, j)),
            ),
        )
    )
    points = F.transform(F.concat(masks, F.array(F.lit(0).cast("long"))), lambda m: F.col("fp").bitwiseXOR(m))
    return fps.select("fp", F.explode(points).alias("point"))


def _dealt(fps: DataFrame, at_once: int) -> DataFrame:
    """Stored fingerprints in as many tasks as their number needs: they are few bytes, but become many rows."""
    return fps.repartition(fps.count() // at_once + 1, "fp")


def near_edges(fps: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints at most ``distance`` (2 or 4) bits apart that connect all such.

    For every pair within the distance the two ends are connected through the
    edges; every edge is itself such a pair.
    """
    if distance not in (2, 4):
        raise ValueError("distance must be 2 or 4: points half way must exist, and the index reaches 4")
    index = stored(_index(_dealt(fps, INDEXED_AT_ONCE)), "simhash-index")
    counts = index.groupBy("entry").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = stored(index.join(counts, "entry"), "simhash-met")

    few = met.where(F.col("members") <= crowd).select("entry", "fp")
    pairs = (
        few.select("entry", F.col("fp").alias("a"))
        .join(few.select("entry", F.col("fp").alias("b")), "entry")
        .where((F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
        .select("a", "b")
    )
    crowded = stored(met.where(F.col("members") > crowd).select("fp").distinct(), "simhash-crowded")
    points = stored(_near_points(_dealt(crowded, POINTS_AT_ONCE), distance // 2), "simhash-points")
    least = points.groupBy("point").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hubs = points.join(least.select("point", "b"), "point").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(hubs).distinct()


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    distance: int = DISTANCE,
    crowd: int = CROWD,
) -> DataFrame:
    """``id, tkey, fp, root, component`` for every row; ``component`` is the smallest id reachable
    and ``root`` the smallest fingerprint reachable, which names the group.

    Defined cases: a NULL or empty text, or one without words, has fingerprint
    zero and links like any other; repeated rows share a fingerprint and so a
    component; a NULL id is ignored for the smallest id (a component of NULL
    ids alone has component NULL); a very long text is hashed whole, its votes
    being counted in parts; an empty table gives an empty table. Further columns
    are not carried, whatever they are called.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = stored(fingerprints(docs, shingle), "simhash-fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = components(near_edges(distinct.select("fp"), distance, crowd))
    of = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    of = stored(of, "simhash-roots")
    # stored, so that the join is one of two plain shuffles and a very large component splits
    smallest = stored(of.groupBy("root").agg(F.min("least").alias("component")), "simhash-components")
    named = of.join(smallest, "root").select("fp", "root", "component")
    return marked.join(named, "fp").withColumnRenamed("id", id_col)


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: its smallest id.

    Where several rows carry that id, the one with the smallest text hash stays,
    and of identical rows one. NULL ids come after all others.
    """
    groups = near_groups(docs, **options)
    first = F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"), F.col("tkey").alias("tkey"))
    keep = groups.groupBy("root").agg(F.min(first).alias("first"))
    keep = keep.select(F.col("first.id").alias("keep_id"), F.col("first.tkey").alias("keep_key")).distinct()
    keyed = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col("doc_id").alias("own_id"), text_key().alias("own_key")
    )
    same = keyed["own_id"].eqNullSafe(keep["keep_id"]) & (keyed["own_key"] == keep["keep_key"])
    return keyed.join(keep, same, "left_semi").dropDuplicates(["own_id", "own_key"]).select("row.*")
