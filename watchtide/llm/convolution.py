"""Exact number-theoretic transforms of many integer rows at once."""

from __future__ import annotations

import functools

import numpy as np

#: A prime with roots of unity of every power of two up to 2**27; products of two residues fit 64 bits.
PRIME = 15 * 2**27 + 1
_GENERATOR = 31


@functools.lru_cache(maxsize=64)
def _roots(size: int, inverse: bool) -> np.ndarray:
    """The first half of the powers of a root of unity of order ``size``."""
    root = pow(_GENERATOR, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, -1, PRIME)
    powers = np.ones(1, np.int64)
    while len(powers) < size // 2:
        powers = np.concatenate([powers, powers * pow(root, len(powers), PRIME) % PRIME])
    return powers


def _forward(rows: np.ndarray) -> np.ndarray:
    """Transform of each row, in bit-reversed order. Overwrites ``rows``."""
    count, size = rows.shape
    half = size // 2
    while half:
        pairs = rows.reshape(count, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        turned = (low - high + PRIME) * _roots(2 * half, False) % PRIME
        low += high
        low -= PRIME * (low >= PRIME)
        high[:] = turned
        half //= 2
    return rows


def _backward(rows: np.ndarray) -> np.ndarray:
    """Rows from their transforms in bit-reversed order. Overwrites ``rows``."""
    count, size = rows.shape
    half = 1
    while half < size:
        pairs = rows.reshape(count, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        turned = high * _roots(2 * half, True) % PRIME
        high[:] = low - turned
        high += PRIME * (high < 0)
        low += turned
        low -= PRIME * (low >= PRIME)
        half *= 2
    rows *= pow(size, -1, PRIME)
    rows %= PRIME
    return rows


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences, modulo ``PRIME``, of each block with its window at every shift that fits.

    ``blocks`` is rows of ``L`` residues and ``windows`` rows of at most ``4 * L - 1``, ``L`` a power of two; the cross
    terms of all shifts come out of one convolution of the reversed block with the window.
    """
    count, length = blocks.shape
    shifts = windows.shape[1] - length + 1
    padded = np.zeros((2, count, 4 * length), np.int64)
    padded[0, :, :length] = blocks[:, ::-1]
    padded[1, :, : windows.shape[1]] = windows
    first, second = _forward(padded[0]), _forward(padded[1])
    cross = _backward(first * second % PRIME)[:, length - 1 : length - 1 + shifts]
    sums = np.zeros((count, windows.shape[1] + 1), np.int64)
    np.cumsum(windows * windows % PRIME, axis=1, out=sums[:, 1:])
    own = (blocks * blocks % PRIME).sum(axis=1)[:, None]
    return (own + sums[:, length : length + shifts] - sums[:, :shifts] - 2 * cross) % PRIME
