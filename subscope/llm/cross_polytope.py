"""Cross-polytope hashing: a unit vector goes to the nearest signed axis after a fast pseudo-random rotation.

A rotation is three rounds of random signs and a Hadamard transform. A hash function looks at the first `width` axes of
the rotated vector, so it has 2 * width values; a table joins several functions.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

ROUNDS = 3
#: Alternatives of one function that a sequence of probes looks at.
ALTERNATIVES = 512


def padded(dims: int) -> int:
    return 1 << max(1, (dims - 1).bit_length())


@lru_cache(maxsize=64)
def _signs(size: int, table: int, function: int) -> np.ndarray:
    return np.random.default_rng([size, table, function]).choice([-1.0, 1.0], (ROUNDS, size))


def rotated(x: np.ndarray, table: int, function: int) -> np.ndarray:
    """The rows of x in padded(dims) dimensions, turned; lengths and angles stay."""
    size = padded(x.shape[1])
    y = np.zeros((len(x), size))
    y[:, : x.shape[1]] = x
    for signs in _signs(size, table, function):
        y *= signs
        half = 1
        while half < size:
            pairs = y.reshape(len(x), -1, 2, half)
            y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), size)
            half *= 2
        y /= np.sqrt(size)
    return y


def widths(bits: int, dims: int) -> list[int]:
    """The axes that each function of a table with 2**bits buckets looks at."""
    most = (2 * padded(dims)).bit_length() - 1
    functions = -(-bits // most)
    return [1 << (bits // functions + (k < bits % functions) - 1) for k in range(functions)]


def _axes(x: np.ndarray, table: int, function: int, width: int) -> np.ndarray:
    """The coordinates of signed axes: first the positive ones, then the negative ones."""
    y = rotated(x, table, function)[:, :width]
    return np.hstack([y, -y])


def buckets(x: np.ndarray, table: int, bits: int) -> np.ndarray:
    code = np.zeros(len(x), dtype=np.int64)
    for k, width in enumerate(widths(bits, x.shape[1])):
        code = code * (2 * width) + _axes(x, table, k, width).argmax(axis=1)
    return code


def probes(x: np.ndarray, table: int, bits: int, most: int) -> np.ndarray:
    """Per row up to `most` buckets, nearest first: the own one, then those whose axes are little farther away.

    The cost of an axis is the square of what it lies behind the nearest one; costs of functions add up. The first
    `most` sums come from the first `most` of every prefix, so no nearer bucket is passed over while a function has at
    most ALTERNATIVES values.
    """
    code, cost = np.zeros((len(x), 1), dtype=np.int64), np.zeros((len(x), 1))
    for k, width in enumerate(widths(bits, x.shape[1])):
        axes = _axes(x, table, k, width)
        behind = (axes.max(axis=1, keepdims=True) - axes) ** 2
        order = np.argsort(behind, axis=1, kind="stable")[:, : min(most, ALTERNATIVES)]
        code = (code[:, :, None] * (2 * width) + order[:, None, :]).reshape(len(x), -1)
        cost = (cost[:, :, None] + np.take_along_axis(behind, order, axis=1)[:, None, :]).reshape(len(x), -1)
        first = np.argsort(cost, axis=1, kind="stable")[:, :most]
        code, cost = np.take_along_axis(code, first, axis=1), np.take_along_axis(cost, first, axis=1)
    return code
