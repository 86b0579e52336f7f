"""Data-quality checks on gold tables; each returns a DataFrame of findings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hayloft.plans.contract import count_constraints, counted_findings, required_columns
from hayloft.session import scratch_path, shuffles_released, together


def row_counts(tables: Mapping[str, DataFrame], min_rows: int = 1) -> DataFrame:
    """``(table, n_rows, ok)`` with ``ok = n_rows > min_rows`` — one Spark job for all tables."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, df in tables.items()
    ]
    counts = reduce(DataFrame.unionByName, parts)
    return counts.withColumn("ok", F.col("n_rows") > F.lit(min_rows))


def date_bounds(df: DataFrame, date_col: str = "date") -> DataFrame:
    """First and last date in one aggregation."""
    return df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))


def missing_days(df: DataFrame, date_col: str = "date", keys: Sequence[str] = ()) -> DataFrame:
    """Days without any row between the first and the last date, over the table or per entity.

    One pass over the distinct ``(keys, day)``: a gap is what lies between a day
    and the next one. NULL dates do not count; NULL keys form an entity like any
    other. The window holds one row per day (and entity).
    """
    day = F.to_date(date_col)
    days = df.select(*keys, day.alias("date")).where(F.col("date").isNotNull()).distinct()
    return _gap_days(_with_next_day(days, keys), keys)


def _with_next_day(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``days`` (one row per key and day) with the key's next day."""
    return days.withColumn("_hl_next", F.lead("date").over(Window.partitionBy(*keys).orderBy("date")))


def _gap_days(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The days between a day and the next one of its key."""
    missing = F.sequence(F.date_add("date", 1), F.date_sub("_hl_next", 1))
    return days.where(F.date_diff("_hl_next", "date") > 1).select(*keys, F.explode(missing).alias("date"))


def reconcile_days(observed: DataFrame, fact: DataFrame, keys: Sequence[str], measures: Sequence[str], date_col: str = "date") -> DataFrame:
    """Days on which the source and a dense fact differ: ``keys``, ``date``, ``finding``.

    ``observed`` has a row for every ``keys`` and day that the source has data of. A day
    of the fact counts as observed when a measure is there (filled days have none).
    ``missing``: observed, but not in the fact; ``unobserved``: measured in the fact
    without a source. The days of both are grouped together, combined before the shuffle, so each
    side is read once and nothing is sorted; NULL keys are compared as values.
    """
    def days(df: DataFrame, seen: bool) -> DataFrame:
        sides = F.lit(seen).alias("_hl_seen"), F.lit(not seen).alias("_hl_held")
        return df.select(*[F.col(k) for k in keys], F.to_date(date_col).alias("date"), *sides).where("date IS NOT NULL")

    both = days(observed, True).unionByName(days(fact.where(_measured(measures)), False))
    sides = both.groupBy(*keys, "date").agg(F.max("_hl_seen").alias("_hl_seen"), F.max("_hl_held").alias("_hl_held"))
    finding = F.when(~F.col("_hl_held"), "missing").when(~F.col("_hl_seen"), "unobserved").alias("finding")
    return sides.where("NOT (_hl_seen AND _hl_held)").select(*keys, "date", finding)


def _measured(measures: Sequence[str]) -> Column:
    return F.greatest(*[F.col(m).isNotNull() for m in measures]) if len(measures) > 1 else F.col(measures[0]).isNotNull()


class CheckFailed(Exception):
    """A quality check on the gold tables found something."""


def check_gold(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    min_rows: int = 1,
    *,
    counts: Mapping[str, int] | None = None,
    observed: Mapping[str, DataFrame] | None = None,
    measures: Mapping[str, Sequence[str]] | None = None,
    contracts: Mapping[str, str] | None = None,
) -> None:
    """Raise :class:`CheckFailed` unless every table passes:

    * more than ``min_rows`` rows (``counts`` from the writes; counted here if not given);
    * no missing day between the first and the last of an entity;
    * the days of ``observed``, and no others, have ``measures`` (:func:`reconcile_days`);
    * nothing that ``contracts`` forbid (NOT NULL, one row per key and day).
    """
    if counts is None:
        counts = {r.table: r.n_rows for r in row_counts(tables, min_rows).collect()}
    problems = [f"{name} has {n} rows" for name, n in counts.items() if name in tables and n <= min_rows]

    def check(name: str, df: DataFrame) -> list[str]:
        found = []
        contract = contracts[name] if contracts and name in contracts else StructType([])
        notable = _notable_days(df, keys[name], measures[name] if observed and name in observed else (), contract)
        n = _gap_days(notable, keys[name]).count()
        if n:
            found.append(f"{name} lacks {n} days")
        if observed and name in observed:
            differing = reconcile_days(observed[name], notable, keys[name], [MEASURED]).groupBy("finding").count()
            found += [f"{name} has {r['count']} {r.finding} days" for r in differing.orderBy("finding").collect()]
        if contract:
            broken = counted_findings(notable, contract, [*keys[name], "date"])
            found += [f"{name}: {r.constraint} broken by {r.n_rows} rows" for r in broken.collect()]
        return found

    if tables:
        spark = next(iter(tables.values())).sparkSession
        for found in together(spark, [partial(check, name, df) for name, df in tables.items()]):
            problems += found
    if problems:
        raise CheckFailed("; ".join(problems))


MEASURED = "_hl_measured"  # not NULL where a day of a fact has a measure
REPEATED = "_hl_repeated"  # some of the days gathered with a day are there more than once
# Days that are counted together, as the bits of a BIGINT without its sign.
DAYS_AT_ONCE = 60


def _notable_days(fact: DataFrame, keys: Sequence[str], measures: Sequence[str], contract: StructType | str) -> DataFrame:
    """The keys and days of a fact that its checks look at, out of one pass over the table.

    A row per key and day with what the contract counts (:func:`count_constraints`),
    whether it was measured, and the key's next day; kept are days that were measured, that have a
    gap after them or that break the contract. What is kept is stored, as each check reads it.

    Filled days, most of a dense fact, are judged in that pass only: the days of a key are gathered as
    bits, ``DAYS_AT_ONCE`` to a row, combined before the shuffle. Of them the measured ones are told apart again, and
    the first and the last of each run of days, between which no gap lies. As many rows as bits mean that no
    day is there twice; where there are more, these days are counted out of the fact once more. NULLs
    of required columns are counted with the first of the days gathered.
    """
    spark = fact.sparkSession
    measured = F.when(_measured(measures), True) if measures else F.lit(None).cast("boolean")
    # of the measures only whether there is one is kept, of other required columns whether they are NULL
    own = [F.to_date("date").alias("date") if c == "date" else F.col(c) for c in [*keys, "date"]]
    required = [F.when(F.col(c).isNotNull(), True).alias(c) for c in required_columns(contract) if c not in (*keys, "date")]
    number = F.unix_date("date")
    days = fact.select(*own, *required, measured.alias(MEASURED)).withColumns(
        {"_hl_block": F.floor(number / DAYS_AT_ONCE), "_hl_bit": F.expr(f"shiftleft(1L, pmod(unix_date(date), {DAYS_AT_ONCE}))")}
    )
    gathered = [F.bit_or("_hl_bit").alias("_hl_days"), F.bit_or(F.when(F.col(MEASURED), F.col("_hl_bit"))).alias("_hl_held")]
    dated = F.col("_hl_block").isNotNull()
    blocks = count_constraints(days, contract, [*keys, "_hl_block"], *gathered)
    bits, nulls = F.col("_hl_days"), [c for c in blocks.columns if c.startswith("_hl_null")]
    first = bits.bitwiseAND(F.bitwise_not(F.shiftleft(bits, 1)))
    last = bits.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(bits, 1)))
    picked = first.bitwiseOR(last).bitwiseOR(F.coalesce("_hl_held", F.lit(0).cast("long")))
    nth = F.explode(F.when(dated, F.sequence(F.lit(0), F.lit(DAYS_AT_ONCE - 1))).otherwise(F.array(F.lit(0)))).alias("_hl_nth")
    bit = F.expr("shiftleft(1L, _hl_nth)")
    told = blocks.withColumns({"_hl_picked": picked, "_hl_lasts": last}).select("*", nth).where(~dated | (F.col("_hl_picked").bitwiseAND(bit) != 0))
    lowest = ~dated | (bits.bitwiseAND(-bits) == bit)
    told = told.select(
        *keys,
        F.date_from_unix_date((F.col("_hl_block") * DAYS_AT_ONCE + F.col("_hl_nth")).cast("int")).alias("date"),
        F.when(dated, F.lit(1)).otherwise(F.col("_hl_n")).cast("long").alias("_hl_n"),
        *[F.when(lowest, F.col(c)).otherwise(0).alias(c) for c in nulls],
        F.when(F.col("_hl_held").bitwiseAND(bit) != 0, True).alias(MEASURED),
        (F.col("_hl_lasts").bitwiseAND(bit) != 0).alias("_hl_ends"),
        (dated & lowest & (F.col("_hl_n") > F.bit_count("_hl_days"))).alias(REPEATED),
    )
    told = _with_next_day(told, keys).withColumn("_hl_next", F.when(F.col("_hl_ends"), F.col("_hl_next"))).drop("_hl_ends")
    broken = F.greatest(F.col("_hl_n") - 1, F.lit(0), *[F.col(c) for c in nulls]) > 0
    gap = F.coalesce(F.date_diff("_hl_next", "date") > 1, F.lit(False))
    kept = _kept(told.where(F.col(MEASURED).isNotNull() | gap | broken | F.col(REPEATED)))
    if not kept.where(REPEATED).isEmpty():
        again = days.where(F.col("date").isNotNull()).groupBy(*keys, "date").agg(F.count(F.lit(1)).alias("_hl_n"))
        kept = kept.unionByName(_kept(again.where("_hl_n > 1")), allowMissingColumns=True)
    return kept.drop(REPEATED)


def _kept(days: DataFrame) -> DataFrame:
    spark = days.sparkSession
    path = scratch_path(spark, "checked-days")
    with shuffles_released(spark):
        days.write.parquet(path)
    return spark.read.schema(days.schema).parquet(path)


def entity_list(df: DataFrame, col: str = "farm_license") -> DataFrame:
    """Sorted distinct values of ``col`` (sorted in Spark, not on the driver)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)
