"""Words, word hashes and rolling hashes of whole Arrow columns, in numpy.

A column of texts is taken in slices of whole texts (about ``SLICE_BYTES``, or
one longer text); everything below works on all texts of a slice at once.
Rolling hashes are polynomials modulo 2**64 over well-mixed word hashes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_U = np.uint64

BYTE_BASE = 0x9E3779B97F4A7C15  # odd, so powers have inverses modulo 2**64
WORD_BASE = 0xD6E8FEB86659FD93

_values = np.arange(256)
IS_WORD = ~((_values == 0x20) | ((_values >= 0x09) & (_values <= 0x0D)))
IS_ALNUM_WORD = (
    (_values >= 0x80)
    | ((_values >= 0x30) & (_values <= 0x39))
    | ((_values >= 0x41) & (_values <= 0x5A))
    | ((_values >= 0x61) & (_values <= 0x7A))
)
LOWER = np.where((_values >= 0x41) & (_values <= 0x5A), _values + 32, _values).astype(np.uint8)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i in [0, n)."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        have = tuple(
            np.cumprod(np.concatenate([np.ones(1, _U), np.full(size - 1, b, _U)]), dtype=_U) for b in (base, inverse)
        )
        _powers[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of ``values[s:e]``, the same wherever that range stands."""
    up, down = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))


@dataclass
class Slice:
    """Whole texts ``first .. first + n`` of a batch: one byte array with text bounds."""

    first: int
    data: np.ndarray  # uint8, the texts one after the other
    bounds: np.ndarray  # n + 1 byte offsets

    @property
    def n(self) -> int:
        return len(self.bounds) - 1


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of an Arrow string column; NULL counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        part = offsets[first : last + 1]
        yield Slice(first, data[part[0] : part[-1]], part - part[0])
        first = last


@dataclass
class Words:
    """Word ``i`` is ``data[starts[i]:ends[i]]``; text ``t`` has words ``bounds[t] .. bounds[t+1]``."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def find_words(s: Slice, table: np.ndarray = IS_WORD) -> Words:
    if not len(s.data):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(s.n + 1, np.int64))
    inside = table[s.data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = s.bounds[1:-1]
    edges = edges[edges < len(s.data)]
    begins[edges] = inside[edges]  # a word never runs on from the text before
    ends = np.zeros(len(inside) + 1, bool)
    ends[1:] = inside
    ends[1:-1] &= ~inside[1:] | begins[1:]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(ends), np.searchsorted(starts, s.bounds, "left"))


def word_hashes(data: np.ndarray, words: Words, piece: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of each word's bytes, in pieces of about ``piece`` bytes."""
    out = np.empty(len(words.starts), _U)
    at = 0
    while at < len(out):
        begin = words.starts[at]
        to = max(at + 1, int(np.searchsorted(words.ends, begin + piece, "right")))
        chunk = data[begin : words.ends[to - 1]].astype(_U) + _U(1)
        out[at:to] = range_hashes(chunk, words.starts[at:to] - begin, words.ends[at:to] - begin, BYTE_BASE)
        at = to
    return out


def window_hashes(hashes: np.ndarray, length: int, base: int = WORD_BASE) -> np.ndarray:
    """Hash of each run of ``length`` consecutive words (across texts too: callers mask those)."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, _U)
    at = np.arange(n)
    return range_hashes(hashes, at, at + length, base)


def window_ok(words: Words, length: int) -> np.ndarray:
    """For each start ``0 .. n - length``: the run of ``length`` words stays in one text."""
    n = int(words.bounds[-1]) - length + 1
    if n <= 0:
        return np.zeros(0, bool)
    end_of_text = np.repeat(words.bounds[1:], words.counts)
    return np.arange(n) + length <= end_of_text[:n]


def give_back() -> None:
    """Free memory goes back to the system: a worker lives on between tasks, beside those that are busy."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # no glibc
        pass


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of Arrow batches that gives free memory back when its task ends."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as the int64 of the same bits, Spark's long."""
    return x.view(np.int64)
