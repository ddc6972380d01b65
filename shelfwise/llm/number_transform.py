"""Exact cyclic convolution of integer columns by a number-theoretic transform.

Values are taken modulo ``PRIME``, which has roots of unity of every power of two up
to 2**27. Arrays have the transformed axis first and one column for each convolution,
so short transforms of many columns are as fast as long ones of few.
"""

from __future__ import annotations

from functools import cache

import numpy as np

PRIME = 15 * 2**27 + 1
_GENERATOR = 31
_P = np.uint64(PRIME)


@cache
def _roots(half: int, inverse: bool) -> np.ndarray:
    root = pow(_GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    if inverse:
        root = pow(root, -1, PRIME)
    out = np.ones(half, np.uint64)
    size = 1
    while size < half:  # each step doubles the powers that are known
        step = np.uint64(pow(root, size, PRIME))
        out[size : 2 * size] = out[:size] * step % _P
        size *= 2
    return out[None, :, None]


def forward(x: np.ndarray) -> np.ndarray:
    """The transform of each column, in bit-reversed order."""
    size, columns = x.shape
    half = size // 2
    while half:
        x = x.reshape(-1, 2, half, columns)
        low, high = x[:, 0], x[:, 1]
        x = np.stack([(low + high) % _P, (low + _P - high) % _P * _roots(half, False) % _P], axis=1)
        half //= 2
    return x.reshape(size, columns)


def backward(x: np.ndarray) -> np.ndarray:
    """The columns whose transforms these are."""
    size, columns = x.shape
    half = 1
    while half < size:
        x = x.reshape(-1, 2, half, columns)
        low, high = x[:, 0], x[:, 1] * _roots(half, True) % _P
        x = np.stack([(low + high) % _P, (low + _P - high) % _P], axis=1)
        half *= 2
    return x.reshape(size, columns) * np.uint64(pow(size, -1, PRIME)) % _P


def correlation(window: np.ndarray, block: np.ndarray) -> np.ndarray:
    """sum(window[s + i] * block[i]) modulo PRIME of each column, for every s that the window's length allows.

    ``window`` has a power of two of rows, at least ``len(block) + s - 1`` for each s that is read.
    """
    turned = np.zeros_like(window)
    turned[-np.arange(len(block)) % len(window)] = block
    return backward(forward(window) * forward(turned) % _P)
