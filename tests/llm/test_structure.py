import random
import re

import pytest

from hayloft.llm import queries, structure

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


def marked(rows):
    """(role, text, fault) of one conversation's rows in order."""
    seen, out = set(), []
    for role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """Plain dynamic program over rows; states by the roles read so far, whole audits as strings."""
    best = {"": (0, "", ())}

    def reach(table, state, entry):
        if state is not None and (state not in table or entry[:2] < table[state][:2]):
            table[state] = entry

    def after(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    def with_inserts(table):
        out = {}
        for state, entry in table.items():
            for _ in range(3):
                reach(out, state, entry)
                role = "assistant" if state == "u" else "user"
                state, entry = after(state, role[0]), (entry[0] + 3, entry[1] + "I", (*entry[2], f"{role}:"))
        return out

    for role, text, fault in rows:
        new = {}
        for state, (cost, audit, turns) in with_inserts(best).items():
            reach(new, state, (cost + 4, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault else 0
            reach(new, after(state, role[:1]), (cost + extra, audit + "K", (*turns, f"{role}:{text}")))
            for other in ("user", "assistant"):
                reach(new, after(state, other[0]), (cost + 3 + extra, audit + "R", (*turns, f"{other}:{text}")))
        best = new
    return min((e for s, e in with_inserts(best).items() if s in ("", "a")), key=lambda e: e[:2])


def brute(conversations):
    """``{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, turns)}`` of (conv, turn, role, text) rows."""
    out = {}
    for conv in {r[0] for r in conversations}:
        rows = [r for r in conversations if r[0] == conv]
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, f"{' ' if r[2] is None else r[2]}\n{' ' if r[3] is None else r[3]}".encode()))
        turns = [r[1] for r in rows if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faulty = marked([r[2:4] for r in rows])
        initials = [f[0][:1] for f in faulty]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = [sum(f[2] == kind for f in faulty) for kind in ("blank", "duplicate", "truncated")]
        cost, audit, repaired = cheapest(faulty)
        out[conv] = (gaps, *counts, illegal, cost, audit, repaired)
    return out


def ran(df):
    report, turns = structure.repair(df)
    texts = {}
    for r in turns.orderBy("chunk").collect():
        texts.setdefault(r.conv.conv_id, []).extend(f"{t.role}:{t.text}" for t in r.turns)
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return {r.conv.conv_id: (*(r[c] for c in columns), tuple(texts[r.conv.conv_id])) for r in report.collect()}


def random_rows(seed, n=80, longest=14):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "sys", "u"]
    said = ["Yes.", "no", "Well?  \n", "  ", "", None, "Hm! .", "a.b", "日本。", "x" * 3000 + "."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            at = rng.choice([turn, turn, turn + 3, None])
            rows.append((conv if conv else None, at, rng.choice(roles[: rng.choice([2, 5, 11])]), rng.choice(said) if rng.random() < 0.4 else f"{rng.random()}."))
    return rows + rows[:5]


def test_matches_brute_force(spark):
    rows = random_rows(1)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS seq", "1 AS chunk", "2 AS conv", "3 AS n").repartition(5)
    assert ran(df) == brute(rows)


def test_conversation_of_many_chunks(spark):
    """Ties and costs over chunk borders: one conversation of 2,000 rows beside short ones."""
    rng = random.Random(7)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["a.", "b", f"{t}.", f"{t}"])) for t in range(2000)]
    rows += [(2, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(300)] + random_rows(3, 20)
    assert ran(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


@pytest.mark.parametrize("seed", range(6))
def test_any_grammar_gives_the_same_edits(seed):
    """Products over rules equal products over single symbols, whatever the rules."""
    rng = random.Random(seed)
    symbols = "".join(rng.choice("suaxSUAXdua") for _ in range(rng.randint(1, 60)))
    rules, now = [], symbols
    while len(now) > 1 and len(rules) < 20:
        at = rng.randrange(len(now) - 1)
        rules.append((now[at : at + 2], chr(0x100 + len(rules))))
        now = structure.compressed(symbols, rules)
    whole = structure.rule_matrices(rules)
    product = structure.reduce(structure.product, (whole[s] for s in now))
    plain = structure.reduce(structure.product, (structure.SYMBOLS[s] for s in symbols))
    text = lambda m: [[e and (e[0], structure.flat(e[1])) for e in row] for row in m]
    assert text(product) == text(plain)


def test_repaired_roles_are_legal():
    for _, (*_, turns) in brute(random_rows(9)).items():
        assert LEGAL.fullmatch("".join(t[0] for t in turns))


def test_rules_are_learnt_from_all_sequences(spark):
    sequences = spark.createDataFrame([("uaua", 10), ("suauaua", 5), ("d", 7), ("xxx", 1)], "symbols string, n long")
    rules = structure.learn_rules(sequences)
    assert rules[0] == ("ua", chr(0x100))
    assert len(structure.compressed("uauauaua", rules)) < 4


def test_empty_table(spark):
    report, turns = structure.repair(spark.createDataFrame([], SCHEMA))
    assert report.collect() == [] and turns.collect() == []


def test_query_returns_every_original_conversation(spark, tmp_path):
    rows = [(c, t, ("user", "assistant")[t % 2], f"{c} {t}. Yes!") for c in range(150) for t in range(1 + c % 3)] + [(None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op11_structure_repair(spark, str(tmp_path)).collect()
    assert sorted((str(r.conv_id) for r in got)) == sorted({str(r[0]) for r in rows})
    assert any(r.audit == "" and r.cost == 0 and r.gaps == 0 for r in got)  # every row dropped
