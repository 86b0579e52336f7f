"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: the budget is shared over the sources by weight; a source's target
stops at ``max_epochs`` times its size and the excess is shared again by weight,
which ends at one common level (water-filling).

Selection: each document draws an exponential key ``-ln(u) / quality`` from a
keyed hash, so sorting by it samples without replacement with the quality as
weight and reruns agree. Complete epochs take every document; what is left of
the target takes documents in key order while the prefix sum of sizes reaches
it. No source is sorted as a whole: sizes are summed per source and key bucket
(geometric buckets, so one holds at most about 0.1 % of a source whatever the
qualities are), a prefix sum over buckets finds the one in which the target
falls, and only its rows are ordered, equal ones as one place with a count. Where the
target falls among equal rows, as many of them are taken as it asks for. All of it is
DataFrame code, and the text is shuffled for such equal rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hayloft.llm.tables import WORD, stored

SOURCE_WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = "mix"
BUCKETS_PER_OCTAVE = 512
#: the per-source plan is broadcast up to this many sources, joined by a shuffle beyond it
BROADCAST_SOURCES = 1000
#: equal rows that a split group is written out in at a time
PIECE = 4096


def size_in_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: str = "text") -> Column:
    """Share of letters and whitespace in the text, at least 0.05; 1 for an empty text."""
    letters = F.length(F.regexp_replace(F.col(text), r"[^\p{L}\x20\x09-\x0D]", ""))
    share = letters / F.length(text).cast("double")
    return F.when(F.length(text) > 0, F.greatest(share, F.lit(0.05))).otherwise(1.0)


def draw(quality: Column, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """``key`` (exponential, smaller is drawn earlier) and the tie-breaks ``id`` and ``digest``.

    A quality that is NULL counts as 1; zero, negative or NaN ones are drawn last.
    """
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("-")), digest)
    # 52 bits of a keyed hash, centred so that u is never 0 or 1
    u = (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    quality = F.coalesce(quality.cast("double"), F.lit(1.0))
    key = F.when((quality > 0) & ~F.isnan(quality), -F.ln(u) / quality).otherwise(F.lit(1e300))
    return [key.alias("key"), F.col(id_col).alias("id"), digest.alias("digest")]


def _targets(sizes: DataFrame, weights: Sequence[float], budget: float, max_epochs: int) -> DataFrame:
    """``source, source_size`` -> with ``target``. One row per source: the only whole-table window."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sized = sizes.withColumn("weight", F.element_at(cycle, (rank % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * F.lit(float(max_epochs))
    by_fill = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum(cap).over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    onward = F.sum("weight").over(by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.partitionBy(F.lit(1))
    total = F.sum("source_size").over(everything) * F.lit(float(budget))
    # the level if all sources before this one are full; the true level is the highest of them
    levelled = sized.withColumn("level", (total - before) / onward)
    level = F.max("level").over(everything)
    return levelled.withColumn("target", F.least(cap, level * F.col("weight"))).select("source", "source_size", "target")


def plan(
    drawn: DataFrame,
    weights: Sequence[float] = SOURCE_WEIGHTS,
    budget: float = BUDGET,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """One row per source: size, target, complete epochs, and where the fractional selection ends.

    ``drawn`` has ``source, size, key, id, digest, bucket`` and should be stored:
    it is read twice.
    """
    sums = drawn.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    sizes = sums.groupBy("source").agg(F.sum("n").alias("source_size"))
    targets = _targets(sizes, weights, budget, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("epochs", epochs.cast("int")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size")
    )
    in_order = Window.partitionBy("source").orderBy("bucket")
    level = sums.withColumn("upto", F.sum("n").over(in_order)).withColumnRenamed("source", "of")
    ends = (
        targets.join(level, F.col("source").eqNullSafe(F.col("of")))
        .where((F.col("upto") - F.col("n") < F.col("rest")) & (F.col("rest") <= F.col("upto")))
        .select("of", F.col("bucket").alias("end_bucket"), (F.col("upto") - F.col("n")).alias("base"), "rest")
    )
    # only the places of the last bucket are put in order; rows equal in place are counted before
    order = Window.partitionBy("of").orderBy("key", F.col("id").asc_nulls_last(), "digest")
    places = (
        drawn.join(ends, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("end_bucket")))
        .groupBy("of", "base", "rest", "key", "id", "digest")
        .agg(F.count("*").alias("rows"), F.sum("size").alias("words"))
        .withColumn("left", F.col("rest") - F.col("base") - (F.sum("words").over(order) - F.col("words")))
    )
    # a row is taken if its middle lies before the end
    fits = F.ceil(F.try_divide(F.col("left") * F.col("rows"), F.col("words")) - 0.5).cast("long")
    fits = F.when(F.col("words") > 0, F.least("rows", F.greatest(F.lit(0), fits)))
    taken = F.coalesce(fits, F.when(F.col("left") > 0, F.col("rows")), F.lit(0)).cast("long")
    last = (
        places.withColumn("taken", taken)
        .where("taken > 0")
        .groupBy("of")
        .agg(
            F.max(F.when(F.col("taken") == F.col("rows"), _place())).alias("last"),
            F.max(F.when(F.col("taken") < F.col("rows"), F.struct(_place().alias("place"), "taken", "rows"))).alias("split"),
        )
    )
    ends = ends.join(last.withColumnRenamed("of", "of2"), F.col("of").eqNullSafe(F.col("of2")), "left")
    ends = ends.select("of", "end_bucket", "last", "split")
    return targets.join(ends, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")


def _place() -> Column:
    """A row's place in its source's order, comparable as a struct."""
    return F.struct(F.col("key"), F.col("id").isNull().alias("null"), F.col("id"), F.col("digest"))


def bucket_of_key() -> Column:
    return F.floor(F.log2("key") * BUCKETS_PER_OCTAVE).alias("bucket")


def copies(drawn: DataFrame, plans: DataFrame) -> DataFrame:
    """``drawn`` with ``source_size``, ``target`` and ``copies``: how often the mix takes the document."""
    plans = plans.withColumnRenamed("source", "of")
    sources, splits = plans.agg(F.count("*"), F.count("split")).first()
    if sources <= BROADCAST_SOURCES:
        plans = F.broadcast(plans)
    partly = (F.col("bucket") < F.col("end_bucket")) | (
        (F.col("bucket") == F.col("end_bucket")) & (_place() <= F.col("last"))
    )
    planned = drawn.join(plans, F.col("source").eqNullSafe(F.col("of")))
    counted = planned.withColumn("copies", F.col("epochs") + F.coalesce(partly, F.lit(False)).cast("int"))
    columns = [*drawn.columns, "source_size", "target", "copies"]
    if not splits:
        return counted.select(*columns)
    is_split = F.coalesce((F.col("bucket") == F.col("end_bucket")) & (_place() == F.col("split.place")), F.lit(False))
    return counted.where(~is_split).select(*columns).unionByName(_split_rows(planned.where(is_split), drawn.columns))


def _split_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The rows at the places where the fractional selection ends, one copy more for the part it takes.

    Equal rows are counted and written out again, so no row needs a number. Where rows of a
    place differ in carried columns, each kind gives its share, rounded by a hash.
    """
    kinds = rows.groupBy(*columns, "source_size", "target", "epochs", "split").count()
    share = F.col("count") * F.col("split.taken") / F.col("split.rows")
    turn = F.pmod(F.xxhash64(F.to_json(F.struct(*columns))), F.lit(1 << 20)) / float(1 << 20)
    parts = F.array(
        F.struct((F.col("epochs") + 1).alias("copies"), F.col("more").alias("n")),
        F.struct(F.col("epochs").alias("copies"), (F.col("count") - F.col("more")).alias("n")),
    )
    pieces = (
        kinds.withColumn("more", F.floor(share + turn))
        .select(*columns, "source_size", "target", F.explode(parts).alias("part"))
        .where("part.n > 0")
        .withColumn("piece", F.explode(F.expr(f"sequence(0, (part.n - 1) div {PIECE})")))
        .repartition("piece", "id", "digest")
    )
    rest = F.least(F.lit(PIECE), F.col("part.n") - F.col("piece") * PIECE).cast("int")
    out = pieces.withColumn("copies", F.col("part.copies")).withColumn("row_number", F.explode(F.sequence(F.lit(1), rest)))
    return out.select(*columns, "source_size", "target", "copies")


def draw_documents(docs: DataFrame, *carry: Column, seed: str = SEED, quality: Column | None = None) -> DataFrame:
    """``source, size, key, id, digest, bucket`` of each document, and the columns to carry."""
    quality = quality_weight() if quality is None else quality
    return docs.select(
        F.col("source"), size_in_words().alias("size"), *draw(quality, seed), *carry
    ).withColumn("bucket", bucket_of_key())


def mix_plan(docs: DataFrame, **options) -> DataFrame:
    """The stored plan of a mix over ``docs``; see :func:`plan` for the options."""
    return stored(plan(stored(draw_documents(docs), "mix-drawn"), **options), "mix-plan")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it (rows taken 0 times go).

    Defined cases: a NULL source is a source of its own, last in order; a NULL or
    empty text has size 0 and follows the selection of its place; a source
    without words has target 0 and none of its rows are taken; of rows equal in id,
    text and source as many are taken as the target asks for (rows that differ in other
    columns give their shares, rounded); a very long text counts whole, and a source ends
    within half a document of its target; an empty table gives an empty table.
    """
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    taken = copies(draw_documents(docs, row), mix_plan(docs, **options))
    return (
        taken.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
    )
