"""Small document tables with the awkward cases every operator must define."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate(UPPER_TO_LOWER)


def document_rows(seed=1, n=60):
    """Random prose with copies, edited copies, shared passages, ties, NULLs, empty and long texts."""
    rng = random.Random(seed)
    vocab = [
        "".join(rng.choice(["ba", "ko", "é", "ri", "Tu", "x", "9", "ß", "日", "-", "."]) for _ in range(rng.randint(1, 4)))
        for _ in range(300)
    ]
    prose = lambda k: rng.choice([" ", "\n", "  "]).join(rng.choice(vocab) for _ in range(k))
    shared = [prose(k) for k in (49, 50, 51, 80, 200)]
    rows = []
    for i in range(n):
        kind = i % 6
        text = prose(rng.randint(1, 250))
        if kind == 1 and rows:
            text = rng.choice(rows)[1]
        elif kind == 2 and rows:
            parts = (rng.choice(rows)[1] or "a").split(" ")
            parts[rng.randrange(len(parts))] = "edit"
            text = " ".join(parts)
        elif kind in (3, 4):
            text = " ".join([prose(rng.randint(0, 70)), rng.choice(shared), prose(rng.randint(0, 70)), rng.choice(shared)])
        rows.append((i * 7 % 101, text, "en", f"src{i % 4}", len(text or "")))
    rows += [
        (200, None, None, None, None),
        (201, "", "en", "src0", 0),
        (202, " \n\t ", "en", "src1", 4),
        (203, "Ab", "en", "src1", 2),
        (204, "same " * 400, "en", "src2", 2000),  # one word over and over: every window equal
        (205, prose(6000), "en", "src2", 0),  # long
        (205, prose(70), "en", "src2", 0),  # two texts under one id
        (None, shared[4], "en", None, 0),  # NULL id
        (206, "x" * 50000, "en", "src3", 50000),  # one long word
    ]
    return rows + rows[3:6]  # repeated rows


def with_clashing_columns(df):
    """Extra columns whose names operators might want for themselves."""
    for name in ("id", "ord", "tkey", "fp", "root", "word", "size", "n", "h", "shard", "start", "target", "weight"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df
