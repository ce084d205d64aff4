"""Whole texts to arrays of 64-bit hashes, a block of texts at a time, in numpy.

All functions are deterministic, so a task that is run again gives the same.
Hashes stand for words and shingles; two different ones share a hash with a
chance of about 2**-64.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(PRIME), -1, 1 << 64))
U64 = np.uint64


class Empty(dict):
    """A cache that is sent to executors without what it holds."""

    def __reduce__(self):
        return Empty, ()


_powers = Empty()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all 64."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n at least."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        # Some more than asked for, as blocks differ a little in size.
        size = max(1 << 16, n + n // 8)
        steps = np.full(size, base, U64)
        steps[0] = 1
        known = _powers[int(base)] = np.cumprod(steps, dtype=U64)
    return known


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end, and where each text starts (n + 1 offsets). Null: empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    starts = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def code_points(data: np.ndarray) -> np.ndarray:
    """How many code points begin before each byte (n + 1 numbers): at each byte that does not continue one."""
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    return points


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, by one running sum over all bytes."""
    # In place, as each array here is eight times the text.
    sums = np.zeros(len(data) + 1, U64)
    terms = sums[1:]
    terms[:] = data
    terms += U64(1)
    terms *= powers(PRIME, len(data) + 1)[: len(data)]
    np.cumsum(terms, out=terms)
    return mix((sums[end] - sums[start]) * powers(INVERSE, len(data) + 1)[start] + (end - start).astype(U64))


FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True


def runs(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, first)``: the runs of bytes that are ``inside``; text i has the
    runs ``first[i]`` to ``first[i + 1]``. A run ends where its text does."""
    wide = np.zeros(len(inside) + 2, bool)
    wide[1:-1] = inside
    edge = wide[1:] & ~wide[:-1]
    stop = wide[:-1] & ~wide[1:]
    cut = starts[1:-1][(starts[1:-1] > 0) & (starts[1:-1] < len(inside))]
    cut = cut[wide[cut] & wide[cut + 1]]
    edge[cut] = stop[cut] = True
    start, end = np.flatnonzero(edge), np.flatnonzero(stop)
    return start, end, np.searchsorted(start, starts)


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of all texts, as ``runs``."""
    return runs(~_SPACE[data], starts)


def letter_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of letters and of all that is not ASCII, as ``runs``."""
    return runs(_LETTER[data], starts)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)`` of the words of each text, letters A-Z lowered."""
    data, starts = as_bytes(texts)
    data = FOLD[data]
    start, end, first = word_spans(data, starts)
    return span_hashes(data, start, end), first


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)``: the distinct shingles of n words of each text, sorted.

    A text of fewer words has one, its whole sequence; one without words none.
    """
    words, first = word_hashes(texts)
    many = np.diff(first)
    weights = powers(INVERSE, n)[:n]
    of = np.maximum(many - n + 1, (many > 0).astype(many.dtype))
    row = np.repeat(np.arange(len(many)), of)
    at = np.arange(len(row)) - np.repeat(np.cumsum(of) - of, of) + first[:-1][row]
    padded = np.concatenate([words, np.zeros(n, U64)])
    left = first[1:][row] - at
    got = np.minimum(left, n).astype(U64)
    for i in range(n):
        got = got + np.where(left > i, padded[at + i], U64(0)) * weights[i]
    return distinct_by_row(mix(got), row, len(many))


def distinct_by_row(values: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row, sorted, and where each row starts; ``row`` rises."""
    first = np.searchsorted(row, np.arange(rows + 1))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[new], np.searchsorted(row[new], np.arange(rows + 1))


def blocks(batches: Iterable[pa.RecordBatch], chars: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches dealt anew: each block holds about ``chars`` bytes of
    text, one long text at least."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = lengths[at - 1] if at else 0
            to = min(batch.num_rows, int(np.searchsorted(lengths, base + chars - size)) + 1)
            held.append(batch.slice(at, to - at))
            size += int(lengths[to - 1] - base)
            at = to
            if size >= chars:
                yield joined(held)
                held, size = [], 0
    if held:
        yield joined(held)


def give_back() -> None:
    """Return memory that this process has freed to the system: a worker stays for later stages, and so would what it freed."""
    pa.default_memory_pool().release_unused()
    # Only the C library of Linux has it; elsewhere freed memory stays.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
