"""Chat formatting in budgeted windows, DataFrame functions only.

Turns are written ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a
backslash is doubled and ``<|`` becomes ``<\\|`` (a line break inside a role
``<\\n|``), so control strings occur nowhere else and reading back is exact.

A conversation becomes one or more windows. The prefix sum of its turns' tokens,
cut into strides, chooses which whole turns a window adds; a window further
repeats the system turn and as much of the window before as fits the history
budget. Only a turn's first appearance counts for the loss: the loss mask
covers assistant texts that are new in the window, repeated ones are masked.

Prefix sums run over runs of ``TURNS_PER_RUN`` turn numbers and then over the
runs' totals, so a very long conversation is not ordered in one task; a window
holds a bounded number of turns because every turn costs tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hayloft.llm.tables import LAST_ID, WORD

BUDGET = 512  # tokens a window holds, unless a single turn is longer than its stride
HISTORY = 64  # of them, tokens of repeated history at most
TURN_TOKENS = 4  # what the template adds to the words of a turn
TURNS_PER_RUN = 256

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("<\\n|")) if role else out


def unescape(text: Column, role: bool = False) -> Column:
    # a lone backslash only stands in what escape() put in; doubled ones come last
    text = F.replace(text, F.lit("<\\n|"), F.lit("\n")) if role else text
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _placed_turns(conversations: DataFrame) -> DataFrame:
    """Each turn with its position and the tokens before it in the conversation."""
    text = F.coalesce(F.col("text"), F.lit(""))
    turns = conversations.select(
        F.struct(F.col("conv_id")).alias("conv"),  # a struct, so that NULL ids join
        F.coalesce(F.floor(F.col("turn") / TURNS_PER_RUN), F.lit(LAST_ID)).cast("long").alias("run"),
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        text.alias("text"),
        (F.regexp_count(text, F.lit(WORD)) + TURN_TOKENS).cast("long").alias("tokens"),
    )
    in_run = Window.partitionBy("conv", "run").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    upto = in_run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over_runs = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv")
    runs = (
        turns.groupBy("conv", "run")
        .agg(F.sum("tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_turns"))
        .select(
            "conv",
            "run",
            F.coalesce(F.sum("n_tokens").over(over_runs), F.lit(0)).alias("tokens_before"),
            F.coalesce(F.sum("n_turns").over(over_runs), F.lit(0)).alias("turns_before"),
            F.sum("n_tokens").over(whole).alias("conv_tokens"),
        )
    )
    return (
        turns.withColumns({"upto": F.sum("tokens").over(upto), "nth": F.row_number().over(in_run)})
        .join(runs, ["conv", "run"])
        .select(
            "conv",
            (F.col("turns_before") + F.col("nth") - 1).alias("pos"),
            "role",
            "text",
            "tokens",
            (F.col("tokens_before") + F.col("upto") - F.col("tokens")).alias("before"),
            "conv_tokens",
        )
    )


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Training windows of ``conversations(conv_id, turn, role, text)``.

    Returns ``conv_id``, ``window`` (ascending, not gapless), ``formatted``,
    ``n_repeated`` (leading turns that repeat earlier ones), ``n_tokens`` and
    ``loss_spans`` (start and length in characters of ``formatted``).

    Defined cases: NULL texts and roles are empty; NULL turns come last, ties
    are ordered by role and text, repeated rows are turns of their own; NULL ids
    form one conversation; a turn longer than a stride stands whole in a window that
    exceeds the budget; an empty table gives an empty table. Further columns are not carried.
    """
    turns = _placed_turns(conversations)
    system = turns.where("pos = 0 AND role = 'system'").select(
        "conv", F.col("text").alias("system_text"), F.col("tokens").alias("system_tokens")
    )
    stride = F.greatest(
        F.floor((F.lit(budget - history) - F.coalesce("system_tokens", F.lit(0))) / 2), F.lit(max(1, budget // 8))
    )
    slotted = turns.join(system.select("conv", "system_tokens"), "conv", "left").withColumn("stride", stride)
    slotted = slotted.withColumn("slot", F.floor(F.col("before") / F.col("stride")))
    same = Window.partitionBy("conv", "slot")
    slotted = slotted.withColumns(
        {"slot_end": F.max(F.col("before") + F.col("tokens")).over(same), "slot_pos": F.min("pos").over(same)}
    )
    is_system = (F.col("pos") == 0) & (F.col("role") == "system")

    def piece(order: int, loss: Column) -> Column:
        return F.struct(
            F.lit(order).alias("order"),
            F.col("pos").alias("pos"),
            (F.concat(F.lit(START), escape(F.col("role"), role=True), F.lit("\n"))).alias("head"),
            escape(F.col("text")).alias("body"),
            loss.alias("loss"),
            F.col("tokens").alias("tokens"),
        )

    # every turn is new once, and history of the next window if near enough to its start
    again = (F.col("slot_end") < F.col("conv_tokens")) & (F.col("slot_end") - F.col("before") <= history) & ~is_system
    new = F.struct(F.col("slot").alias("slot"), piece(2, F.col("role") == "assistant").alias("piece"))
    old = F.struct(
        F.floor(F.col("slot_end") / F.col("stride")).alias("slot"), piece(1, F.lit(False)).alias("piece")
    )
    placed = slotted.select("conv", F.explode(F.when(again, F.array(new, old)).otherwise(F.array(new))).alias("p")).select(
        "conv", "p.slot", "p.piece"
    )
    retained = (
        slotted.where((F.col("pos") == F.col("slot_pos")) & (F.col("slot") > 0))
        .select("conv", "slot")
        .join(system, "conv")
        .withColumns({"pos": F.lit(0).cast("long"), "role": F.lit("system"), "text": F.col("system_text"), "tokens": F.col("system_tokens")})
        .select("conv", "slot", piece(0, F.lit(False)).alias("piece"))
    )
    pieces = placed.unionByName(retained).groupBy("conv", "slot").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    size = lambda p: F.length(p["head"]) + F.length(p["body"]) + len(END)
    empty = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,n:int>>").alias("spans")
    )
    spans = F.aggregate(
        "pieces",
        empty,
        lambda a, p: F.struct(
            (a["at"] + size(p)).alias("at"),
            F.when(
                p["loss"],
                F.array_append(
                    a["spans"],
                    F.struct((a["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).alias("n")),
                ),
            )
            .otherwise(a["spans"])
            .alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return pieces.select(
        "conv.conv_id",
        F.col("slot").alias("window"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        F.size(F.filter("pieces", lambda p: p["order"] < 2)).alias("n_repeated"),
        F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("n_tokens"),
        spans.alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: its turns, the text under the loss mask, and the size.

    ``turns_text`` is role, line break, text, line break for each turn;
    ``loss_text`` all text under the mask, unescaped, in order.
    """
    parts = F.split("formatted", r"<\|im_end\|>\n", -1)
    new = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        text = F.substring(part, F.length(role) + 2, F.length(part))
        return F.concat(
            unescape(F.substring(role, F.lit(len(START) + 1), F.length(role)), role=True), F.lit("\n"), unescape(text), F.lit("\n")
        )

    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["n"])))
    read = formatted.select(
        "conv_id",
        "window",
        F.transform(new, turn).alias("turns"),
        F.array_join(loss, "").alias("loss"),
        F.length("formatted").cast("long").alias("n_chars"),
    )
    joined = lambda field: F.array_join(F.transform("all", lambda w: w[field]), "")
    return (
        read.select(
            "conv_id",
            F.struct("window", F.array_join("turns", "").alias("turns"), "loss").alias("w"),
            F.size("turns").cast("long").alias("n"),
            "n_chars",
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("w")).alias("all"), F.sum("n").alias("n_turns"), F.sum("n_chars").alias("formatted_chars"))
        .select(
            "conv_id", "n_turns", joined("turns").alias("turns_text"), joined("loss").alias("loss_text"), "formatted_chars"
        )
    )
