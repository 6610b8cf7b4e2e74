"""Words of many texts at once, as numbers: numpy over the bytes of an Arrow column.

A word is a run of bytes of one class. UTF-8 keeps ASCII separators out of longer characters, so
byte classes give the same words as character classes. A word's code is a polynomial of its bytes
modulo 2**64, taken from running sums, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once; a longer text is handled alone.
CHUNK = 1 << 20
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: `[^\x20\x09-\x0D]+`
VISIBLE = ~SPACES
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after A-Z became a-z
ALNUM = np.isin(np.arange(256), [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEED = 20240607


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (two xor-shift and multiply rounds)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D) + np.uint64(_SEED))
_FOLDED = _LETTERS.copy()
_FOLDED[0x41:0x5B] = _LETTERS[0x61:0x7B]
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def rolled(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = int(_BASE)) -> np.ndarray:
    """A number for each run values[start:end] that depends on the run alone."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(_inverse(base), n + 1)[starts]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each row begins; null is as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    if data is None or at[-1] == at[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches whose texts are about `size` bytes, with their bytes and row offsets."""
    for batch in batches:
        data, at = flat(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
            end = min(end, batch.num_rows)
            yield batch.slice(row, end - row), data[at[row]:at[end]], at[row:end + 1] - at[row]
            row = end


class Words:
    """starts, ends: byte positions of the words; of: first word of each row (one more entry than rows)."""

    def __init__(self, data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> None:
        n = len(data)
        inside = kind[data]
        first = np.zeros(n + 1, bool)
        last = np.zeros(n + 1, bool)
        if n:
            first[:n] = inside
            first[1:n] &= ~inside[:-1]
            last[1:] = inside
            last[1:n] &= ~inside[1:]
            cut = at[(at > 0) & (at < n)]
            first[cut] = inside[cut]
            last[cut] = inside[cut - 1]
        self.data, self.at = data, at
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last)
        self.of = np.searchsorted(self.starts, at)

    def __len__(self) -> int:
        return len(self.starts)

    def per_row(self) -> np.ndarray:
        return np.diff(self.of)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.of) - 1), self.per_row())

    def codes(self, fold: bool = False) -> np.ndarray:
        """A 64-bit number for each word; with fold, A-Z count as a-z."""
        letters = (_FOLDED if fold else _LETTERS)[self.data]
        return mixed(rolled(letters, self.starts, self.ends) + (self.ends - self.starts).astype(np.uint64))
