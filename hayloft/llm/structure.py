"""Conversation structure repair: a grammar-compressed dynamic program over roles and faults.

Each row of a conversation is one symbol: the initial of its role, and whether it must be
deleted or is truncated. Rows may be kept, given another role, deleted, and empty rows
inserted, until the roles read ``(s?(ua)+)?``; of the cheapest edit sequences
the one whose initials (``D I K R``) sort first is taken.

A symbol is a min-plus transfer matrix between the four states of that
expression; an entry holds a cost and, as a rope, the edits' initials. Re-Pair
replaces frequent pairs of symbols by new ones, over the sequences of all
conversations at once. A rule's matrix is the product of its two symbols',
computed once, bottom up, and shared by every conversation in which it stands.

Rows are ordered by one range-partitioned sort, and taken in chunks of at most
``CHUNK_ROWS``; a conversation is then a short product of chunk matrices: costs to the end
are summed backwards, and going forwards each chunk gets its own edits. Every edit
sequence of a chunk ends in a row's initial, so of two with equal cost none is
the beginning of the other and comparing chunk by chunk is exact.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hayloft.llm.tables import stored

CHUNK_BITS = 8
CHUNK_ROWS = 1 << CHUNK_BITS
RULES = 24
RULES_PER_ROUND = 8
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED = 3  # for a truncated row that stays
DELETE = "d"  # symbol of a blank or duplicate row
SPACE = " \t\n\x0b\x0c\r"

# states of (s?(ua)+)?: nothing yet, after s, after u, after a
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_STATES = range(4)
_END = {0: "", 1: "II", 2: "I", 3: ""}  # what completes a sequence at its end


# ------------------------------------------------------- matrices, ropes, rules
def flat(rope) -> str:
    """The text of a rope: a string, or a pair of ropes."""
    out, todo = [], [rope]
    while todo:
        at = todo.pop()
        if isinstance(at, str):
            out.append(at)
        else:
            todo += (at[1], at[0])
    return "".join(out)


def _better(entry, than):
    """The cheaper of two entries; of equal cost the one whose text sorts first."""
    if than is None or entry is None:
        return entry or than
    if entry[0] != than[0]:
        return min(entry, than, key=lambda e: e[0])
    return entry if flat(entry[1]) < flat(than[1]) else than


def product(left, right):
    """Min-plus product of two transfer matrices."""
    out = [[None] * 4 for _ in _STATES]
    for p in _STATES:
        for q in _STATES:
            for r in _STATES:
                a, b = left[p][r], right[r][q]
                if a and b:
                    out[p][q] = _better((a[0] + b[0], (a[1], b[1])), out[p][q])
    return out


def _inserts():
    """Inserted rows before a row; longer insertions only return to a state."""
    out = [[None] * 4 for _ in _STATES]
    for p in _STATES:
        out[p][p] = (0, "")
        at, text = p, ""
        for _ in range(2):
            at, text = _STEP.get((at, "u")) or _STEP[(at, "a")], text + "I"
            out[p][at] = _better((COST["I"] * len(text), text), out[p][at])
    return out


def _row(symbol: str):
    out = [[None] * 4 for _ in _STATES]
    extra = TRUNCATED if symbol.isupper() else 0
    for p in _STATES:
        out[p][p] = (COST["D"], "D")
        if symbol == DELETE:
            continue
        for role in "ua":
            if (p, role) in _STEP:
                q = _STEP[(p, role)]
                out[p][q] = _better((COST["R"] + extra, "R"), out[p][q])
        if (p, symbol.lower()) in _STEP:
            q = _STEP[(p, symbol.lower())]
            out[p][q] = _better((COST["K"] + extra, "K"), out[p][q])
    return out


SYMBOLS = {s: product(_inserts(), _row(s)) for s in "suaxSUAX" + DELETE}


def rule_matrices(rules: list[tuple[str, str]]) -> dict[str, list]:
    """``(pair, new symbol)`` rules, in the order they were made -> the matrix of every symbol."""
    found = dict(SYMBOLS)
    for pair, symbol in rules:
        found[symbol] = product(found[pair[0]], found[pair[1]])
    return found


def compressed(symbols: str, rules: list[tuple[str, str]]) -> str:
    for pair, symbol in rules:
        symbols = symbols.replace(pair, symbol)
    return symbols


def learn_rules(sequences: DataFrame, most: int = RULES, per_round: int = RULES_PER_ROUND) -> list[tuple[str, str]]:
    """Re-Pair over ``(symbols, n)``: the most frequent pairs become symbols, while one occurs twice.

    A round takes pairs without common symbols, which do not change each other's places.
    Only the counts of pairs reach the driver, at most ``4 * per_round`` of them.
    """
    rules: list[tuple[str, str]] = []
    while len(rules) < most:
        text = reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), rules, F.col("symbols"))
        pairs = F.transform(F.sequence(F.lit(1), F.length("now") - 1), lambda i: F.substring(F.col("now"), i, 2))
        counts = (
            sequences.select(text.alias("now"), "n")
            .where(F.length("now") > 1)
            .select(F.explode(pairs).alias("pair"), "n")
            .groupBy("pair")
            .agg(F.sum("n").alias("n"))
            .where("n > 1")
        )
        taken: set[str] = set()
        before = len(rules)
        for row in counts.orderBy(F.desc("n"), "pair").limit(4 * per_round).collect():
            if len(rules) < min(most, before + per_round) and not taken & set(row.pair):
                taken |= set(row.pair)
                rules.append((row.pair, chr(0x100 + len(rules))))
        if len(rules) == before:
            break
    return rules


# ----------------------------------------------------------------- Arrow: chunks
def _edits(rules: list[tuple[str, str]], memory: int = 100_000):
    """Chunks in order of conversation and place -> each chunk's edits."""

    def run(batches):
        matrices = rule_matrices(rules)
        known: dict[str, list] = {}

        def matrix(symbols: str):
            if symbols not in known:
                if len(known) >= memory:
                    known.clear()
                known[symbols] = reduce(product, (matrices[s] for s in compressed(symbols, rules)))
            return known[symbols]

        def finish(chunks):
            """``(chunk, symbols, roles)`` of one conversation."""
            togo = [{q: COST["I"] * len(end) for q, end in _END.items()}]
            for _, symbols, _ in reversed(chunks):
                m = matrix(symbols)
                costs = {p: [m[p][q][0] + c for q, c in togo[-1].items() if m[p][q]] for p in _STATES}
                togo.append({p: min(c) for p, c in costs.items() if c})
            togo.reverse()
            state, last = 0, ""
            for nth, (chunk, symbols, roles) in enumerate(chunks):
                m, best, to = matrix(symbols), None, 0
                for q, c in togo[nth + 1].items():
                    if m[state][q]:
                        # the cost of the rest decides too; the entry's own is kept for the report
                        entry = (m[state][q][0] + c, m[state][q][1])
                        if best is None or _better(entry, best) is entry:
                            best, to = entry, q
                tail = _END[to] if nth == len(chunks) - 1 else ""
                own = m[state][to][0] + COST["I"] * len(tail)
                line = last + roles
                illegal = sum(line[i : i + 2] not in ("su", "ua", "au") for i in range(len(line) - 1))
                yield chunk, state, flat(best[1]) + tail, own, illegal
                state, last = to, roles[-1]

        def table(conv, rows, kind):
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array([conv] * len(rows), kind), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            return pa.RecordBatch.from_arrays(arrays, names=["conv", "chunk", "state", "edits", "cost", "illegal"])

        conv, chunks, kind, out = None, [], None, []
        for batch in batches:
            kind = batch.column("conv").type
            columns = (batch.column(c).to_pylist() for c in ("conv", "chunk", "symbols", "roles"))
            for own, *chunk in zip(*columns):
                if chunks and own != conv:
                    out.append(table(conv, list(finish(chunks)), kind))
                    chunks = []
                conv = own
                chunks.append(chunk)
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
                out = []
        if chunks:
            yield table(conv, list(finish(chunks)), kind)

    return run


def _apply_edits(batches):
    """Rows of a chunk and its edits -> the repaired turns."""
    step = {"u": "user", "a": "assistant"}
    for batch in batches:
        repaired = []
        for rows, edits, state in zip(*(batch.column(c).to_pylist() for c in ("rows", "edits", "state"))):
            turns, at = [], iter(rows)
            for edit in edits:
                row = None if edit == "I" else next(at)
                if edit == "D":
                    continue
                if edit == "K":
                    initial, role = row["role"][:1], row["role"]
                else:
                    initial = "a" if state == 2 else "u"
                    role = step[initial]
                state = _STEP[(state, initial)]
                turns.append({"role": role, "text": row["text"] if row else "", "edit": edit})
            repaired.append(turns)
        turn = pa.struct([("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("chunk"), pa.array(repaired, pa.list_(turn))], names=["conv", "chunk", "turns"]
        )


# ------------------------------------------------------------------- the operator
def place_rows(conversations: DataFrame) -> DataFrame:
    """Rows with ``seq``, ascending by conversation and turn; no conversation is gathered for it."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    rows = conversations.select(F.struct("conv_id").alias("conv"), "turn", space("role").alias("role"), space("text").alias("text"))
    tie = F.concat("role", F.lit("\n"), "text")
    turn = F.col("turn").asc_nulls_first()
    # the range bounds are sampled by the driver, so they hold the beginning of a text only
    dealt = rows.repartitionByRange(F.col("conv").asc(), turn, F.substring(tie, 1, 64).asc())
    ordered = dealt.sortWithinPartitions(F.col("conv").asc(), turn, tie.asc(), F.col("role").asc())
    return stored(ordered.withColumn("seq", F.monotonically_increasing_id()), "structure-rows")


def fault_marks(placed: DataFrame) -> DataFrame:
    """``conv, turn, seq, fault, role_letter, symbol`` of each row; texts go no further."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    narrow = placed.select(
        "conv",
        "turn",
        "seq",
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("content"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("role_letter"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    first = narrow.groupBy("conv", "content").agg(F.min("seq").alias("seq")).select("seq", F.lit(True).alias("first"))
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("truncated"), "truncated")
    )
    symbol: Column = (
        F.when(F.col("fault").isin("blank", "duplicate"), DELETE)
        .when(F.col("fault") == "truncated", F.upper("role_letter"))
        .otherwise(F.col("role_letter"))
    )
    marked = narrow.join(first, "seq", "left").withColumn("fault", fault)
    return marked.select("conv", "turn", "seq", "fault", "role_letter", symbol.alias("symbol"))


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repair ``conversations(conv_id, turn, role, text)``: a report, and the repaired turns.

    The report has, per conversation: ``conv`` (a struct of the id, so that NULL ids join),
    ``gaps`` (turn numbers missing between the smallest and the largest), ``blank``,
    ``duplicate``, ``truncated``, ``illegal``, ``cost`` and ``audit``. The turns come by
    ``conv`` and ``chunk`` (ascending, not gapless), an array of role, text and edit each;
    a chunk whose rows are all deleted has an empty one.

    Defined cases: NULL roles and texts are one space (so the row is blank); rows are ordered by
    turn, NULL first, and ties by role, line break and text; repeated rows are rows of
    their own, and duplicates; NULL ids form one conversation; a role that is empty or has
    another initial is not legal anywhere; very long texts are compared by
    SHA-256; an empty table gives empty tables. Further columns are not carried.
    Only an audit as long as its conversation, one value of the report, is ever gathered.
    """
    placed = place_rows(conversations)
    marks = stored(fault_marks(placed), "structure-marks")
    chunk = F.shiftright("seq", CHUNK_BITS).alias("chunk")
    rows = F.sort_array(F.collect_list(F.struct("seq", "symbol", "role_letter")))
    chunks = stored(
        marks.groupBy("conv", chunk)
        .agg(rows.alias("rows"))
        .select(
            "conv",
            "chunk",
            F.array_join(F.transform("rows", lambda r: r["symbol"]), "").alias("symbols"),
            F.array_join(F.transform("rows", lambda r: r["role_letter"]), "").alias("roles"),
        ),
        "structure-chunks",
    )
    rules = learn_rules(stored(chunks.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "structure-sequences"))
    conv = f"conv {placed.schema['conv'].dataType.simpleString()}"
    edits = stored(
        chunks.repartition("conv")
        .sortWithinPartitions("conv", "chunk")
        .mapInArrow(_edits(rules), f"{conv}, chunk long, state int, edits string, cost long, illegal long"),
        "structure-edits",
    )
    count = lambda fault: F.count_if(F.col("fault") == fault).alias(fault)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    of_rows = marks.groupBy("conv").agg(gaps.alias("gaps"), count("blank"), count("duplicate"), count("truncated"))
    of_edits = edits.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "edits"))), lambda e: e["edits"]), "").alias("audit"),
    )
    taken = F.sort_array(F.collect_list(F.struct("seq", "role", "text")))
    turns = (
        placed.groupBy("conv", chunk)
        .agg(taken.alias("rows"))
        .join(edits.select("conv", "chunk", "state", "edits"), ["conv", "chunk"])
        .mapInArrow(_apply_edits, f"{conv}, chunk long, turns array<struct<role:string,text:string,edit:string>>")
    )
    return of_rows.join(of_edits, "conv"), turns
