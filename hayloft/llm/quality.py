"""Quality rules: counts of a text, and a hashed n-gram logistic regression.

The model has two heads, trained on the labelled rows: good quality and toxic
language. Features are the relative frequencies of hashed word 1- and 2-grams
(lower-cased letters and digits) and of character grams of 3 and 7 bytes, so one
weight vector of fixed size is all that is broadcast. Scores become probabilities by
Platt scaling on a held-out part of the training rows and are compared with
fixed thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hayloft.llm import words as W
from hayloft.llm.tables import stored, text_key

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MIN_QUALITY = 0.5  # a document stays at this probability of good quality or more ...
MAX_TOXIC = 0.5  # ... and below this probability of toxic language

DIMENSIONS_LOG2 = 20
#: the classifier is fitted on at most this many labelled rows (those with the smallest
#: hashed ids) and this many non-zero features; scoring covers every document
SAMPLE_ROWS = 4000
SAMPLE_FEATURES = 16_000_000
EPOCHS = 15
#: what a worker holds beside its rows grows with these two: bytes of texts, and cells
SLICE_BYTES = 1 << 18
CELLS_AT_ONCE = 1 << 16
L2 = 1e-4
HEADS = ("quality", "toxic")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


# ----------------------------------------------------------------- features
def _byte_grams(cells: list, bounds: list, data: np.ndarray, text_bounds: np.ndarray, n: int) -> None:
    """Append the cells of all runs of ``n`` bytes within a text, and the bounds of each text's runs."""
    sizes = np.diff(text_bounds)
    runs = len(data) - n + 1
    if runs > 0:
        grams = np.full(runs, n, np.uint64)
        for i in range(n):
            grams = grams << np.uint64(8) | data[i : i + runs]
        inside = np.arange(runs) + n <= np.repeat(text_bounds[1:], sizes)[:runs]
        cells.append((W.mix(grams[inside]) >> np.uint64(64 - DIMENSIONS_LOG2)).astype(np.int64))
    else:
        cells.append(np.zeros(0, np.int64))
    bounds.append(np.append(0, np.cumsum(np.maximum(sizes - n + 1, 0))))


def _gram_cells(s: W.Slice) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per block of features: the cell of each gram, and the bounds of each text's grams."""
    shift = np.uint64(64 - DIMENSIONS_LOG2)
    cells, bounds = [], []
    lowered = W.Slice(s.first, W.LOWER[s.data], s.bounds)
    words = W.find_words(lowered, W.IS_ALNUM_WORD)
    hashes = W.word_hashes(lowered.data, words)
    cells.append((hashes >> shift).astype(np.int64))
    bounds.append(words.bounds)
    pairs = W.window_hashes(hashes, 2)
    ok = W.window_ok(words, 2)
    cells.append((pairs[ok] >> shift).astype(np.int64))
    bounds.append(np.append(0, np.cumsum(np.maximum(words.counts - 1, 0))))
    _byte_grams(cells, bounds, s.data, s.bounds, 3)
    # whole words show here by their first letters: everything between words is one space
    _byte_grams(cells, bounds, np.where(W.IS_ALNUM_WORD[lowered.data], lowered.data, 32), s.bounds, 7)
    return cells, bounds


#: A feature is a gram's count over the block's total to this power, times the block's
#: scale. The square root for words: a text of any length then weighs the noise of its many
#: neutral words alike, and a few telling words stand out.
_POWERS = (0.5, 0.5, 1.0, 0.5)
_SCALES = (4.0, 2.0, 10.0, 2.0)
#: A head only uses grams whose presence goes with its label: the log-likelihood ratio of the
#: training rows' two-by-two table must reach this. Rare grams cannot be learnt by heart.
MIN_LIKELIHOOD_RATIO = 20.0


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _scores(s: W.Slice, weights: np.ndarray) -> np.ndarray:
    """``texts x heads`` linear scores, without intercept."""
    out = np.zeros((s.n, weights.shape[1]))
    for cells, bounds, power, scale in zip(*_gram_cells(s), _POWERS, _SCALES):
        out += scale * _sums(weights[cells], bounds) / np.maximum(np.diff(bounds), 1)[:, None] ** power
    return out


def _features(batches):
    """Sparse features of each labelled text, as parallel arrays of cells and values."""
    for batch in batches:
        cells_out, values_out = [], []
        for s in W.slices(batch.column("text"), SLICE_BYTES):
            cells, bounds = _gram_cells(s)
            for t in range(s.n):
                dense: dict[str, list] = {"c": [], "v": []}
                for c, b, power, scale in zip(cells, bounds, _POWERS, _SCALES):
                    own = c[b[t] : b[t + 1]]
                    if len(own):
                        dense["c"].append(own)
                        dense["v"].append(np.full(len(own), scale / len(own) ** power))
                if dense["c"]:
                    cell, where = np.unique(np.concatenate(dense["c"]), return_inverse=True)
                    value = np.bincount(where, np.concatenate(dense["v"]))
                else:
                    cell, value = np.zeros(0, np.int64), np.zeros(0)
                cells_out.append(cell.astype(np.int32))
                values_out.append(value.astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("quality"),
                batch.column("toxic"),
                pa.array(cells_out, pa.list_(pa.int32())),
                pa.array(values_out, pa.list_(pa.float32())),
            ],
            names=["quality", "toxic", "cells", "values"],
        )


# ----------------------------------------------------------------- training
@dataclass
class Model:
    """``weights[:, head]`` and, per head, the calibrated probability ``sigmoid(slope * score + offset)``."""

    weights: np.ndarray
    slope: np.ndarray
    offset: np.ndarray

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(scores * self.slope + self.offset, -60, 60)))


def fit(cells: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Logistic regression by AdaGrad over small batches, then Platt scaling on every fifth row.

    A head whose labels are all alike gets that share, smoothed, as a constant probability.
    The lists are used up: a row is cut to its telling cells, and its former arrays are let go.
    """
    size, heads = 1 << DIMENSIONS_LOG2, labels.shape[1]
    weights = np.zeros((size, heads), np.float32)
    bias = np.zeros(heads)
    speed = np.full((size, heads), 1e-6, np.float32)
    bias_speed = np.full(heads, 1e-6)
    held = np.arange(len(cells)) % 5 == 4
    train = np.flatnonzero(~held)
    telling = np.stack([_telling([cells[r] for r in train], labels[train, h], size) for h in range(heads)], axis=1)
    usual = telling.any(axis=1)
    for r, c in enumerate(cells):
        use = usual[c]
        cells[r], values[r] = c[use], values[r][use]
    draw = np.random.default_rng(17)
    share = np.clip(labels.mean(axis=0) if len(labels) else np.full(heads, 0.5), 1e-3, 1 - 1e-3)
    # both classes of a head weigh the same
    balance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) if len(labels) else labels
    for _ in range(epochs if len(train) else 0):
        order = draw.permutation(train)
        for at in range(0, len(order), 32):
            rows = order[at : at + 32]
            c = np.concatenate([cells[r] for r in rows])
            v = np.concatenate([values[r] for r in rows])[:, None]
            of = np.repeat(np.arange(len(rows)), [len(cells[r]) for r in rows])
            bounds = np.append(0, np.cumsum([len(cells[r]) for r in rows]))
            score = _sums(weights[c] * v, bounds) + bias
            error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[rows]) * balance[rows] / len(rows)
            where, back = np.unique(c, return_inverse=True)
            step = np.stack([np.bincount(back, (error[of, h] * v[:, 0])) for h in range(heads)], axis=1)
            step = (step + L2 * weights[where]) * telling[where]
            speed[where] += step**2
            weights[where] -= (0.1 * step / np.sqrt(speed[where])).astype(np.float32)
            step = error.sum(axis=0)
            bias_speed += step**2
            bias -= 0.1 * step / np.sqrt(bias_speed)
    slope, offset = np.zeros(heads), np.log(share / (1 - share))
    check = np.flatnonzero(held)
    for h in range(heads):
        y = labels[check, h] if len(check) else np.zeros(0)
        if len(np.unique(y)) < 2 or len(np.unique(labels[train, h])) < 2:
            if len(np.unique(labels[:, h])) > 1:  # too few rows to calibrate on: the raw score
                slope[h], offset[h] = 1.0, bias[h]
            continue
        x = np.array([float(weights[cells[r], h] @ values[r]) for r in check]) + bias[h]
        a, b = _platt(x, y)
        slope[h], offset[h] = a, a * bias[h] + b
    return Model(weights, slope, offset)


def _telling(cells: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Which cells' presence in a row goes with the row's label. A row's cells are distinct."""

    def count(y: int) -> np.ndarray:
        rows_with = np.zeros(size)
        for c, own in zip(cells, labels):
            if own == y:
                rows_with[c] += 1
        return rows_with

    rows = np.array([(labels == y).sum() for y in (0, 1)], float)
    telling = np.zeros(size, bool)
    if rows.min() == 0:
        return telling
    with_cell = np.stack([count(0), count(1)])
    for at in range(0, size, CELLS_AT_ONCE):
        having = with_cell[:, at : at + CELLS_AT_ONCE]
        ratio = np.zeros(having.shape[1])
        for seen, there in ((having, having.sum(axis=0)), (rows[:, None] - having, rows.sum() - having.sum(axis=0))):
            expected = rows[:, None] / rows.sum() * there
            ratio += 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0).sum(axis=0)
        telling[at : at + CELLS_AT_ONCE] = ratio >= MIN_LIKELIHOOD_RATIO
    return telling


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps on Platt's smoothed targets."""
    positive, negative = y.sum(), len(y) - y.sum()
    goal = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    spread = max(float(np.std(x)), 1e-6)
    z = np.stack([x / spread, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - goal) + 1e-3 * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / spread), float(w[1])


def _trainer(batches):
    cells, values, labels, room = [], [], [], SAMPLE_FEATURES
    for batch in batches:
        for c, v, q, t in zip(
            batch.column("cells"), batch.column("values"), batch.column("quality").to_pylist(), batch.column("toxic").to_pylist()
        ):
            if len(c.values) <= room:
                room -= len(c.values)
                cells.append(c.values.to_numpy())
                values.append(v.values.to_numpy())
                labels.append((q, t))
    model = fit(cells, values, np.array(labels, float).reshape(-1, len(HEADS)))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([model.weights.astype(np.float32).tobytes()], pa.binary()),
            pa.array([model.slope.tolist()], pa.list_(pa.float64())),
            pa.array([model.offset.tolist()], pa.list_(pa.float64())),
        ],
        names=["weights", "slope", "offset"],
    )


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model:
    """The model fitted on a bounded sample of labelled rows, in one task.

    Labels that are NULL or neither 0 nor 1 do not count; of several labels of one id the largest counts.
    Without labelled rows every probability is 0.5.
    """
    known = (
        labels.where("quality IN (0, 1) AND toxic IN (0, 1)")
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic"))
    )
    # the sample is drawn by id first, so that only its texts move
    drawn = (
        docs.select(F.col(id_col).alias("id"), text_key().alias("tkey"))
        .join(known, "id")
        .select("id", "tkey", "quality", "toxic", F.xxhash64(F.lit("sample"), "id", "tkey").alias("turn"))
        .dropDuplicates(["id", "tkey"])
        .orderBy("turn")
        .limit(sample_rows)
    )
    drawn = stored(drawn, "quality-sample")
    texts = docs.select(F.col(id_col).alias("id"), F.col("text"), text_key().alias("tkey"))
    labelled = (
        texts.join(F.broadcast(drawn), ["id", "tkey"])  # at most sample_rows rows
        .select("turn", "quality", "toxic", "text")
        .dropDuplicates(["turn"])  # repeated rows count once
        .select("quality", "toxic", "text")
        .mapInArrow(W.giving_back(_features), "quality int, toxic int, cells array<int>, values array<float>")
    )
    by_content = labelled.repartition(1).sortWithinPartitions(F.xxhash64("cells", "values"), "quality", "toxic")
    row = by_content.mapInArrow(W.giving_back(_trainer), "weights binary, slope array<double>, offset array<double>").first()
    if row is None:
        return Model(np.zeros((1 << DIMENSIONS_LOG2, len(HEADS)), np.float32), np.zeros(len(HEADS)), np.zeros(len(HEADS)))
    return Model(
        np.frombuffer(row.weights, np.float32).reshape(-1, len(HEADS)), np.array(row.slope), np.array(row.offset)
    )


# ----------------------------------------------------------------- rules
def _repeated_words(words: W.Words, hashes: np.ndarray) -> np.ndarray:
    """Per text: words in 3-word windows that stand at least twice in it."""
    out = np.zeros(len(words.bounds) - 1, np.int64)
    ok = W.window_ok(words, 3)
    if not ok.any():
        return out
    text = words.text_of()
    at = np.flatnonzero(ok)
    keys = W.mix(W.window_hashes(hashes, 3)[at] + text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    twice = at[order[same[1:] | same[:-1]]]
    covered = np.zeros(len(text), bool)
    for step in range(3):
        covered[twice + step] = True
    return np.bincount(text[covered], minlength=len(out))


def _repeated_lines(s: W.Slice, words: W.Words) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line."""
    breaks = np.flatnonzero(s.data == 10)
    starts = np.sort(np.concatenate([s.bounds[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, s.bounds[1:]]))
    has_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    lines = W.Words(starts, ends, np.searchsorted(starts, s.bounds, "left"))
    if not len(starts):
        return np.zeros(s.n, np.int64)
    text = lines.text_of()
    keys = W.mix(W.word_hashes(s.data, lines) + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = np.unique(keys, return_index=True)[1]
    return lines.counts - np.bincount(text[first], minlength=s.n)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _judge(names: list[str], model):
    def run(batches):
        fitted = Model(*(np.asarray(x) for x in model.value))
        for batch in batches:
            counts: dict[str, list] = {c: [] for c in _COUNTS}
            chances = []
            for s in W.slices(batch.column("text"), SLICE_BYTES):
                words = W.find_words(s)
                total = lambda hit: np.diff(np.append(0, np.cumsum(hit))[s.bounds])  # noqa: E731, B023
                hashes = W.word_hashes(s.data, words)
                counts["n_words"].append(words.counts)
                counts["word_chars"].append(total(W.IS_WORD[s.data] & ((s.data & 0xC0) != 0x80)))
                counts["n_symbols"].append(total(_SYMBOL[s.data]))
                counts["n_dup_lines"].append(_repeated_lines(s, words))
                counts["n_repeat_words"].append(_repeated_words(words, hashes))
                chances.append(fitted.probabilities(_scores(s, fitted.weights)))
            n = {c: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for c, v in counts.items()}
            chance = np.concatenate(chances) if chances else np.zeros((0, len(HEADS)))
            failed = (n["n_words"] < MIN_WORDS) | (100 * n["n_repeat_words"] > MAX_REPEATED_PERCENT * n["n_words"])
            kept = ~failed & (chance[:, 0] >= MIN_QUALITY) & (chance[:, 1] < MAX_TOXIC)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [pa.array(n[c]) for c in _COUNTS]
                + [pa.array(failed), pa.array(kept), pa.array(chance[:, 0]), pa.array(chance[:, 1])],
                names=[*names, *_COUNTS, "base_failed", "kept", "quality_probability", "toxic_probability"],
            )

    return W.giving_back(run)


def judge(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns, by default all) with the counts, ``base_failed``, ``kept`` and both probabilities.

    Defined cases: a NULL or empty text has no words, all counts 0, and fails the
    base rule; repeated rows are judged alike; a very long text is counted and scored
    whole; an empty table gives an empty table.
    The input's columns are nested, so no name can clash.
    """
    carry = carry if carry is not None else docs.columns
    rows = docs.select(F.struct(*[F.col(c) for c in carry]).alias("row"), F.col("text").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.slope, model.offset))
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return rows.mapInArrow(
        _judge(["row"], shared),
        f"row {kind}, {counts}, base_failed boolean, kept boolean, quality_probability double, toxic_probability double",
    )
