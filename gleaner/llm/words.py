"""Words and windows of whole Arrow batches as numpy arrays, at the level of UTF-8 bytes.

All separators are ASCII bytes, which never occur inside a longer UTF-8 sequence, so words can be cut from the
bytes of a whole batch at once. Words and windows are named by 64-bit hashes. Two different words or windows
share a hash with a probability of about 1 in 1.8e19 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = U(0xD1342543DE82EF95)


def _mix_one(x: int) -> int:
    mask = (1 << 64) - 1
    x = (x + _BASE) & mask
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
    return x ^ (x >> 31)


_BYTE = np.array([_mix_one(b) for b in range(256)], dtype=U)
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words between spaces, tabs and line ends: [^\x20\x09-\x0D].
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words of letters, digits and whatever is not ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F], after lower-casing.
LETTERED = np.zeros(256, dtype=bool)
LETTERED[0x30:0x3A] = LETTERED[0x61:0x7B] = LETTERED[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _power_table(n: int, name: str, base: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, U(base), dtype=U)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 4 * SLICE_BYTES:
            _powers[name] = have
    return have[:n]


class Words(NamedTuple):
    data: np.ndarray  #: the bytes of the texts, one after the other, lower-cased if asked
    text_at: np.ndarray  #: where each text begins in the bytes, and the end
    start: np.ndarray  #: where each word begins in the bytes
    end: np.ndarray
    first: np.ndarray  #: for each text the number of its first word, and the number of all words
    hash: np.ndarray  #: one 64-bit hash per word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null is empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, data = texts.buffers()
    at = np.frombuffer(places, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def words(texts: pa.Array, letters: np.ndarray = SPACED, lower: bool = False) -> Words:
    data, at = buffers(texts)
    if lower:
        data = LOWER[data]
    n = len(data)
    inside = letters[data]
    begins = np.zeros(n + 1, dtype=bool)
    begins[at] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | begins[1:n]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | begins[1:n]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum(_BYTE[data] * _power_table(n, "up", _BASE), out=sums[1:])
    value = (sums[end] - sums[start]) * _power_table(n + 1, "down", _INVERSE)[start]
    value += (end - start).astype(U) * _STEP
    return Words(data, at, start, end, np.searchsorted(start, at), mix(value))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k consecutive words of the array; windows over a text's end have to be left out by the caller."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    value = hashes[:n].copy()
    for j in range(1, k):
        value *= _STEP
        value += hashes[j : j + n]
    return mix(value)


def text_of_word(w: Words) -> np.ndarray:
    return np.repeat(np.arange(len(w.first) - 1), w.counts)


def within_text(w: Words, k: int) -> np.ndarray:
    """For each window of k words whether it lies in one text."""
    n = len(w.hash) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    ends = np.repeat(w.first[1:], w.counts)[:n]
    return np.arange(n) + k <= ends


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about so many bytes of text, so that work arrays stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        length = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        block = np.cumsum(length) // most
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
