"""Words and shingles of whole Arrow batches as 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2_000_000  # text worked on at once; a longer document is a chunk of its own
CHUNK_ROWS = 4_000  # short rows worked on at once

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEPS = [_U(0xD1B54A32D192ED03), _U(0x8CB92BA72F3D8DD7), _U(0xAEF17502108EF2D9), _U(0xF1357AEA2E62A9C5)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit number over all bits (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_CASED = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = _CASED[LOWER]
WHITE_SPACE = np.zeros(256, dtype=bool)
WHITE_SPACE[[32, *range(9, 14)]] = True
NO_WORD = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_powers = {"n": 0}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers up to the longest chunk so far are kept; those for a longer document go with it."""
    if n > CHUNK_BYTES:
        return np.cumprod(np.full(n, _BASE, dtype=np.uint64)), np.cumprod(np.full(n, _INVERSE, dtype=np.uint64))
    if _powers["n"] < n:
        most = min(CHUNK_BYTES, 1 << n.bit_length())
        _powers["up"] = np.cumprod(np.full(most, _BASE, dtype=np.uint64))
        _powers["down"] = np.cumprod(np.full(most, _INVERSE, dtype=np.uint64))
        _powers["n"] = most
    return _powers["up"][:n], _powers["down"][:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows (null: empty)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, at


def chunks(at: np.ndarray, most: int = CHUNK_BYTES, rows: int = CHUNK_ROWS) -> Iterator[tuple[int, int]]:
    """Ranges of at most `rows` rows with at most `most` bytes of text, or one longer row."""
    first, n = 0, len(at) - 1
    while first < n:
        last = int(np.searchsorted(at, at[first] + most, side="right")) - 1
        last = min(max(last, first + 1), first + rows, n)
        yield first, last
        first = last


def word_spans(raw: np.ndarray, at: np.ndarray, between: np.ndarray = WHITE_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The rows' bytes, the places of every word's first and last byte in them, and each row's range of words.

    `at` holds the rows' offsets in `raw`; words are split at the bytes in `between` and never reach over the end of a row.
    """
    begin = int(at[0])
    text = raw[begin : int(at[-1])]
    rows = len(at) - 1
    if not len(text):
        none = np.zeros(0, dtype=np.int64)
        return text, none, none, np.zeros(rows + 1, dtype=np.int64)
    space = between[text]
    word = ~space
    starts, ends = word.copy(), word.copy()
    starts[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    edges = at[:-1] - begin
    edges = edges[(edges > 0) & (edges < len(text))]
    starts[edges] |= word[edges]
    ends[edges - 1] |= word[edges - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    return text, first, last, np.searchsorted(first, at - begin)


def span_hashes(text: np.ndarray, first: np.ndarray, last: np.ndarray, cased: bool = False) -> np.ndarray:
    """Hash of the bytes from each `first` to its `last`, A-Z lower-cased unless `cased`."""
    if not len(first):
        return np.zeros(0, dtype=np.uint64)
    up, down = _power_tables(len(text))
    sums = np.cumsum((_CASED if cased else _BYTE)[text] * up)
    before = np.where(first > 0, sums[first - 1], _U(0))
    return mix((sums[last] - before) * down[first] + (last - first).astype(np.uint64) * _STEPS[3])


def word_hashes(raw: np.ndarray, at: np.ndarray, between: np.ndarray = WHITE_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lower-cased and split at the bytes in `between`, and each row's range in that array."""
    text, first, last, ranges = word_spans(raw, at, between)
    return span_hashes(text, first, last), ranges


def shingle_hashes(words: np.ndarray, ranges: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles, repeats included, and each row's range; fewer words give one shingle of all."""
    counts = np.diff(ranges)
    each = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_ranges = np.concatenate(([0], np.cumsum(each)))
    out = np.zeros(int(out_ranges[-1]), dtype=np.uint64)
    if not len(out):
        return out, out_ranges
    row = np.repeat(np.arange(len(counts)), each)
    at = ranges[row] + np.arange(len(out)) - out_ranges[row]
    size = np.minimum(counts, k)[row]
    for j in range(k):
        inside = j < size
        w = words[np.minimum(at + j, len(words) - 1)]
        out = out * _STEPS[0] + np.where(inside, w, _STEPS[1])
    return mix(out), out_ranges


def word_shingles(column: pa.Array, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For chunks of rows: the first row's number and each row's distinct shingle hashes in ascending order."""
    raw, at = buffers(column)
    for first, last in chunks(at):
        words, ranges = word_hashes(raw, at[first : last + 1])
        shingles, edges = shingle_hashes(words, ranges, k)
        yield first, [np.unique(shingles[edges[i] : edges[i + 1]]) for i in range(last - first)]
