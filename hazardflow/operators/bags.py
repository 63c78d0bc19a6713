"""Bootstrap weights of many rows in many trees at once, on arrays.

The weights are those of ``forest.bootstrap_weight``: the first 48 bits of the MD5 of ``bag:seed:tree:id`` against the
steps of a Poisson(1) distribution. A text of at most 55 bytes is one MD5 block of 16 words, of which only those with
digits of the id differ between rows; the 64 rounds are array operations over a few thousand rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa

_TURNS = [t for four in ([7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]) for t in four * 4]
_SINES = [int(abs(math.sin(i + 1)) * (1 << 32)) for i in range(64)]
_WORD = [i if i < 16 else (5 * i + 1) % 16 if i < 32 else (3 * i + 5) % 16 if i < 48 else 7 * i % 16 for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
#: Rows whose words stay in a core's cache.
_ROWS = 1 << 13


def _md5_48(words: Sequence[np.ndarray | int], n: int) -> np.ndarray:
    """The first 48 bits of the MD5 of ``n`` blocks, given by words that are arrays, or numbers where all rows are alike."""
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, high = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        word = words[_WORD[i]]
        if isinstance(word, np.ndarray):
            f += word
            f += np.uint32(_SINES[i])
        else:
            f += np.uint32((_SINES[i] + word) & 0xFFFFFFFF)
        np.left_shift(f, np.uint32(_TURNS[i]), out=high)
        f >>= np.uint32(32 - _TURNS[i])
        f |= high
        f += b
        a, d, c, b, f = d, c, b, f, a
    a += np.uint32(_START[0])
    b += np.uint32(_START[1])
    return a.byteswap().astype(np.uint64) << np.uint64(16) | (b.byteswap() >> np.uint32(16)).astype(np.uint64)


def _steps_reached(u: np.ndarray, steps: Sequence[int]) -> np.ndarray:
    out = np.zeros(len(u), np.uint8)
    for s in steps:
        out += u >= np.uint64(s)
    return out


def weights(seed: int, n_trees: int, tails: pa.Array | pa.ChunkedArray, steps: Sequence[int]) -> np.ndarray:
    """(trees x rows): Poisson(1) weights; ``tails`` are ``:id`` as text, empty without an id."""
    texts = [x.encode() for x in tails.to_pylist()]
    sizes = np.array([len(x) for x in texts], np.int64)
    out = np.zeros((n_trees, len(texts)), np.uint8)
    for size in np.unique(sizes):
        alike = np.flatnonzero(sizes == size)
        for begin in range(0, len(alike), _ROWS):
            at = alike[begin: begin + _ROWS]
            some = [texts[i] for i in at]
            blocks: dict[int, list] = {}
            for tree in range(n_trees):
                head = f"bag:{seed}:{tree}".encode()
                whole = len(head) + int(size)
                if whole > 55:  # more than one block
                    drawn = [int(hashlib.md5(head + x).hexdigest()[:12], 16) for x in some]
                    out[tree, at] = _steps_reached(np.array(drawn, np.uint64), steps)
                    continue
                if len(head) not in blocks:
                    raw = np.zeros((len(at), 64), np.uint8)
                    raw[:, len(head): whole] = np.frombuffer(b"".join(some), np.uint8).reshape(len(at), -1)
                    raw[:, whole] = 0x80
                    raw[:, 56], raw[:, 57] = 8 * whole & 0xFF, 8 * whole >> 8
                    blocks[len(head)] = [w.copy() if (w != w[0]).any() else int(w[0]) for w in raw.view("<u4").T]
                front = np.frombuffer(head.ljust(64, b"\0"), "<u4")
                words = [w + f if isinstance(w, np.ndarray) else w + int(f) for w, f in zip(blocks[len(head)], front)]  # no byte in both
                out[tree, at] = _steps_reached(_md5_48(words, len(at)), steps)
    return out
