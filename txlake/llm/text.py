"""Vectorised text helpers over the UTF-8 bytes of Arrow string columns.

A batch of texts is one byte array and the offsets where its texts begin; words, lines
and shingles are positions in it, so no Python object is made for any of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19  # arrays of a slice nearly fit a core's cache

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = tuple(np.uint64(m) for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: For folded words: every ASCII byte that is no letter or digit separates.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = False
NOT_ALNUM[0x80:] = False


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, and n + 1 offsets; null counts as empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[slice]:
    """Ranges of whole texts of about ``limit`` bytes; a longer text is alone in its range."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield slice(first, last)
        first = last


def text_slices(
    column: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """For each slice of a column: its rows, its bytes and its offsets."""
    data, offsets = utf8(column)
    for rows in slices(offsets, limit):
        at = offsets[rows.start : rows.stop + 1]
        yield rows, data[at[0] : at[-1]], at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x + _ODD
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLIERS[0]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLIERS[1]
    return x ^ (x >> np.uint64(31))


def spans(
    separator: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each maximal run of bytes that are no separator."""
    n = len(separator)
    inside = ~separator
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    texts = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, texts


def _power(kind: int, n: int) -> np.ndarray:
    held = _powers.get(kind)
    if held is None or len(held) < n:
        steps = np.full(n + n // 8, kind, np.uint64)
        steps[:1] = 1
        held = _powers[kind] = np.cumprod(steps)
    return held[:n]


_BYTE_VALUES = mix(np.arange(256, dtype=np.uint64) + np.uint64(0xA5A5))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, independent of where the span stands."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _power(_BASE, len(data)), out=total[1:])
    inside = (total[ends] - total[starts]) * _power(_BASE_INVERSE, len(data) + 1)[starts]
    return mix(inside ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def words_of(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the text of each word."""
    starts, ends, texts = spans(separators[data], offsets)
    return span_hashes(data, starts, ends), texts


def sequence_hashes(
    words: np.ndarray, texts: np.ndarray, n_texts: int, seed: int
) -> np.ndarray:
    """One 64-bit hash for the word sequence of each text."""
    first = np.searchsorted(texts, np.arange(n_texts))
    rank = (np.arange(len(words)) - first[texts]).astype(np.uint64)
    values = mix(words + mix(rank + np.uint64(seed)))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    last = np.append(first[1:], len(words))
    return mix(total[last] - total[first] + (last - first).astype(np.uint64))


def shingles_of(
    words: np.ndarray, texts: np.ndarray, n_texts: int, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each window of ``size`` words, in order of texts.

    A text with some but fewer words has one shingle, made of all its words.
    """
    n = max(0, len(words) - size + 1)
    whole = np.flatnonzero(texts[:n] == texts[size - 1 :][:n])
    value = words[whole]
    for k in range(1, size):
        value = mix(value) + words[whole + k]
    first = np.searchsorted(texts, np.arange(n_texts))
    counts = np.append(first[1:], len(words)) - first
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short) == 0:
        return mix(value), texts[whole]
    padded = np.append(words, np.uint64(0))
    brief = padded[first[short]]
    for k in range(1, size):
        at = np.where(k < counts[short], first[short] + k, len(words))
        brief = mix(brief) + padded[at]
    owners = np.concatenate([texts[whole], short])
    order = np.argsort(owners, kind="stable")
    return mix(np.concatenate([value, brief]))[order], owners[order]
