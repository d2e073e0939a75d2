"""Simple-8b: a selector of 4 bits says how many values share the other 60 bits.

Values are coded in blocks of `BLOCK` values; every block starts a new word, so
the blocks of a stream can be decoded on their own or all at once. Values of
more than 30 bits are escapes: their word holds an index into a list of whole
64-bit values.
"""

from __future__ import annotations

from array import array

import numpy as np

BLOCK = 4096

# Count and bits of the values of a word, by selector; 15 escapes.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 15


#: Bits of the values of up to 16 bits.
SHORT_BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.int8)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each value; anything over 30 counts as 31."""
    if values.max(initial=0) < len(SHORT_BITS):
        return SHORT_BITS[values.astype(np.uint16)]
    small = np.minimum(values, np.uint64(1 << 30)).astype(np.float64)
    return np.frexp(small)[1].astype(np.int8)


def _selectors(values: np.ndarray) -> np.ndarray:
    """The densest selector for a word that starts at each value.

    A row of the table is a block and zeros beyond its end, which fit any word.
    What fits a selector fits all sparser ones, so the selectors that don't fit
    are counted. The widest value of a window comes from two shorter windows
    that cover it.
    """
    n, beyond = len(values), int(COUNTS[0])
    n_blocks = -(-n // BLOCK)
    bits = np.zeros(n_blocks * BLOCK, np.int8)
    bits[:n] = _bit_lengths(values)
    widest = np.zeros((n_blocks, BLOCK + beyond), np.int8)
    widest[:, :BLOCK] = bits.reshape(n_blocks, BLOCK)
    misfits = (widest[:, :BLOCK] > WIDTHS[ESCAPE - 1]).astype(np.int8)  # too wide for any word
    window = 1
    for s in range(ESCAPE - 1, -1, -1):
        while window < COUNTS[s]:
            more = min(window, int(COUNTS[s]) - window)
            # Beyond the end lie zeros, so the last columns stay.
            widest = np.concatenate([np.maximum(widest[:, :-more], widest[:, more:]), widest[:, -more:]], axis=1)
            window += more
        wide = widest[:, :BLOCK] > WIDTHS[s]
        if wide.all():
            misfits += s + 1  # neither fits any denser one
            break
        misfits += wide.view(np.int8)
    return np.minimum(misfits, ESCAPE).reshape(-1)[:n]


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block, escaped values), all unsigned."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    chosen = _selectors(values)
    at = np.arange(n, dtype=np.int32)
    ends = np.minimum((at | (BLOCK - 1)) + 1, n)
    step = memoryview(np.minimum(at + COUNTS.astype(np.int32)[chosen], ends))
    starts, i = array("q"), 0
    while i < n:
        starts.append(i)
        i = step[i]
    first = np.frombuffer(starts, np.int64)
    selector = chosen[first]
    escapes = first[selector == ESCAPE]
    escaped = values[escapes]
    if len(escapes):
        values = values.copy()
        values[escapes] = np.arange(len(escapes), dtype=np.uint64)
    held = np.diff(np.append(first, n))
    at -= np.repeat(first.astype(np.int32), held)
    at *= np.repeat(WIDTHS[selector].astype(np.int32), held)
    words = np.bitwise_or.reduceat(values << at.astype(np.uint64), first)
    words |= selector.astype(np.uint64) << np.uint64(60)
    offsets = np.searchsorted(first, np.arange(0, n, BLOCK)).astype(np.uint32)
    return words, offsets, escaped


def decode(words: np.ndarray, offsets: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    """The `n` values of all blocks at once."""
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int8)
    count = COUNTS[selector]
    before = np.cumsum(count) - count
    block = np.repeat(np.arange(len(offsets)), np.diff(np.append(offsets.astype(np.int64), len(words))))
    first = block * BLOCK + before - before[offsets[block].astype(np.int64)]
    held = np.minimum(count, np.minimum((block + 1) * BLOCK, n) - first)
    width = WIDTHS[selector]
    mask = (np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)
    shift = (np.arange(n) - np.repeat(first, held)) * np.repeat(width, held)
    out = (np.repeat(words, held) >> shift.astype(np.uint64)) & np.repeat(mask, held)
    rows = np.flatnonzero(selector == ESCAPE)
    out[first[rows]] = escaped[out[first[rows]].astype(np.int64)]
    return out


def to_bytes(values: np.ndarray) -> bytes:
    """A stream that carries its own sizes."""
    words, offsets, escaped = encode(values)
    head = np.array([len(values), len(words), len(offsets), len(escaped)], "<u4")
    return b"".join(
        (head.tobytes(), offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes(), escaped.astype("<u8").tobytes())
    )


def from_bytes(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The values of the stream at `at`, and the place behind it."""
    n, n_words, n_offsets, n_escaped = (int(x) for x in np.frombuffer(data, "<u4", 4, at))
    at += 16
    offsets = np.frombuffer(data, "<u4", n_offsets, at)
    at += 4 * n_offsets
    words = np.frombuffer(data, "<u8", n_words, at)
    at += 8 * n_words
    escaped = np.frombuffer(data, "<u8", n_escaped, at)
    return decode(words, offsets, escaped, n), at + 8 * n_escaped
