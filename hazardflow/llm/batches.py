"""Word arrays of Arrow text batches, for the operators that run numpy inside tasks.

Texts of one slice lie in one byte buffer; words (see ``columns``) are found, lower-cased and hashed
with whole-buffer array operations. A slice holds about ``SLICE_BYTES`` of text, or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
for _lo, _hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _IS_WORD[_lo:_hi] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values evenly (two multiply-xorshift rounds)."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n + 1:
        size = max(n + 1, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without nulls; offsets start at 0."""
    texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]: at[-1]], at - at[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield begin, i
            begin, held = i, 0
        held += int(size)
    if begin < len(sizes):
        yield begin, len(sizes)


class Words:
    """Words of some texts: ``hashes`` in order, ``first[d]:first[d + 1]`` those of text ``d``."""

    def __init__(self, texts: pa.Array):
        raw, offsets = text_buffer(texts)
        self.lower = _LOWER[raw]
        inside = _IS_WORD[raw]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        cuts = offsets[:-1][offsets[:-1] < len(raw)]
        begins = inside & ~before
        begins[cuts] = inside[cuts]
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = ~inside[1:] | begins[1:]
        after[-1:] = True
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(inside & after) + 1
        power, inverse = _power_tables(len(raw))
        sums = np.empty(len(raw) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((self.lower.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=sums[1:])
        self.hashes = mix((sums[self.end] - sums[self.start]) * inverse[self.start])
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)

    def text_at(self, begin: int, n: int) -> bytes:
        """``n`` words from word ``begin`` on, lower-cased, with one space between."""
        return b" ".join(self.lower[s:e].tobytes() for s, e in zip(self.start[begin: begin + n], self.end[begin: begin + n]))


def shingle_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text of each shingle, hash): all runs of ``n`` words; shorter texts with words are one shingle."""
    h, counts, first = words.hashes, words.counts, words.first[:-1]
    runs = np.where(counts >= n, counts - n + 1, (counts > 0).astype(counts.dtype))
    doc = np.repeat(np.arange(len(counts)), runs)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs)
    at = first[doc] + place
    out = np.zeros(len(doc), np.uint64)
    for k in range(n):
        here = k < counts[doc]
        step = np.where(here, h[np.minimum(at + k, max(len(h) - 1, 0))] if len(h) else np.uint64(0), np.uint64(0))
        out = out * np.uint64(0xD6E8FEB86659FD93) + step
    return doc, mix(out)
