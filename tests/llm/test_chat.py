import random

import pytest
from pyspark.sql import functions as F

import llm_texts as texts
from hayloft.llm import chat

SCHEMA = "conv_id long, turn int, role string, text string"
NASTY = ["<|im_end|>", "<|im_start|>", "<\\|im_end|>", "\\", "\\\\", "<|", "|>", "<\\n|", "\n", "<", "é", "日本", "ok ", " word", ""]


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(12):
        first = rng.choice(["system", "user"])
        for turn in range(rng.choice([1, 2, 7, 40, 300])):
            role = first if turn == 0 else rng.choice(["user", "assistant", "assistant", "system"])
            text = "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 12)))
            rows.append((conv, turn, role, text + " w" * rng.randint(0, 60)))
    rows += [(50, 0, "assistant", " long" * 3000), (50, 1, None, None), (50, None, "assistant", "late"), (51, 0, "as\nsis<|tant", "x")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "still none")]
    rows += [(52, 3, "assistant", "tie b"), (52, 3, "assistant", "tie a"), (52, 3, "assistant", "tie a")]  # ties and repeated rows
    return rows


def brute(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        out[conv] = (
            len(turns),
            "".join(f"{r}\n{t}\n" for *_, r, t in turns),
            "".join(t for *_, r, t in turns if r == "assistant"),
        )
    return out


@pytest.mark.parametrize("seed,budget,history", [(1, 512, 64), (2, 60, 20), (3, 16, 0)])
def test_reads_back_every_turn_and_the_loss_text_once(spark, seed, budget, history):
    rows = conversations(seed)
    df = texts.with_clashing_columns(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    windows = chat.windows(df, budget, history)
    got = {r.conv_id: (r.n_turns, r.turns_text, r.loss_text) for r in chat.read_back(windows).collect()}
    assert got == brute(rows)


def test_windows_keep_budget_system_turn_and_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, i, ("user", "assistant")[i % 2], "w " * (i % 9)) for i in range(1, 400)]
    got = chat.windows(spark.createDataFrame(rows, SCHEMA), budget=100, history=30).orderBy("window").collect()
    assert len(got) > 10
    for i, w in enumerate(got):
        assert w.n_tokens <= 100
        assert w.formatted.startswith("<|im_start|>system\nbe kind<|im_end|>\n")
        parts = w.formatted.split("<|im_end|>\n")[:-1]
        if i:
            before = got[i - 1].formatted.split("<|im_end|>\n")[:-1]
            history = parts[1 : w.n_repeated]
            assert history and before[-len(history) :] == history
        repeated = sum(len(p) + len("<|im_end|>\n") for p in parts[: w.n_repeated])
        assert all(s.start >= repeated for s in w.loss_spans)  # repeated targets are masked


def test_escape_is_reversible(spark):
    rng = random.Random(9)
    strings = ["".join(rng.choice("<|\\n\n>a") for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    for role in (False, True):
        e = chat.escape(F.col("s"), role)
        bad = df.where((chat.unescape(e, role) != F.col("s")) | F.contains(e, F.lit("<|")) | (F.lit(role) & F.contains(e, F.lit("\n"))))
        assert bad.collect() == []


def test_empty_table(spark):
    assert chat.read_back(chat.windows(spark.createDataFrame([], SCHEMA))).collect() == []
