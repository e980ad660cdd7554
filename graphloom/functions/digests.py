"""Digests of many short texts at once."""

from __future__ import annotations

import math

import numpy as np

# Fixed values of the algorithm (RFC 1321): start, rotations, and the constants of its steps.
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_TURNS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]


def md5_heads(texts: np.ndarray) -> np.ndarray:
    """The first 32 bits of the md5 of each row; rows are the bytes of texts of one length."""
    n, size = texts.shape
    padded = np.zeros((n, (size + 72) // 64 * 64), np.uint8)
    padded[:, :size] = texts
    padded[:, size] = 128
    padded[:, -8:] = np.frombuffer((8 * size).to_bytes(8, "little"), np.uint8)
    words = np.ascontiguousarray(padded.view("<u4").T)
    state = [np.full(n, v, np.uint32) for v in _START]
    for at in range(0, len(words), 16):
        a, b, c, d = state
        for i in range(64):
            if i < 16:
                f, g = d ^ (b & (c ^ d)), i
            elif i < 32:
                f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
            elif i < 48:
                f, g = b ^ c ^ d, (3 * i + 5) % 16
            else:
                f, g = c ^ (b | ~d), 7 * i % 16
            f += a
            f += words[at + g]
            f += _SINES[i]
            a, d, c, b = d, c, b, b + ((f << np.uint32(_TURNS[i])) | (f >> np.uint32(32 - _TURNS[i])))
        state = [x + y for x, y in zip(state, (a, b, c, d), strict=True)]
    return state[0].byteswap()
