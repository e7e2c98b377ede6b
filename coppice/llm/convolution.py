"""Exact places where blocks of integers recur, by number-theoretic transforms.

The sum of squared differences of a block and the text under it is zero where they are equal. It is
``sum(p²) + sum(t²) - 2·sum(p·t)``; the last sum is a correlation, taken modulo two primes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Primes with a power of two in p - 1, and a generator of each.
PRIMES = ((469762049, 3), (2013265921, 31))

#: Numbers transformed at once; bounds the memory of a call.
AT_ONCE = 1 << 18


@lru_cache(maxsize=64)
def _twiddles(prime: int, generator: int, size: int, inverse: bool) -> tuple[np.ndarray, ...]:
    """Powers of the root of unity for half-lengths 1, 2, 4, … up to ``size / 2``."""
    root = pow(generator, (prime - 1) // size, prime)
    if inverse:
        root = pow(root, prime - 2, prime)
    tables, half = [], 1
    while half < size:
        step, powers = pow(root, size // (2 * half), prime), [1]
        for _ in range(half - 1):
            powers.append(powers[-1] * step % prime)
        tables.append(np.array(powers, dtype=np.uint64))
        half *= 2
    return tuple(tables)


def _forward(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transform of every row; the result is in bit-reversed order."""
    p, size = np.uint64(prime), rows.shape[1]
    for powers in reversed(_twiddles(prime, generator, size, False)):
        parts = rows.reshape(len(rows), -1, 2, len(powers))
        low, high = parts[:, :, 0], parts[:, :, 1]
        rows = np.stack(((low + high) % p, (low + p - high) * powers % p), axis=2)
    return rows.reshape(-1, size)


def _backward(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Inverse of :func:`_forward`, from bit-reversed order."""
    p, size = np.uint64(prime), rows.shape[1]
    for powers in _twiddles(prime, generator, size, True):
        parts = rows.reshape(len(rows), -1, 2, len(powers))
        low, high = parts[:, :, 0], parts[:, :, 1] * powers % p
        rows = np.stack(((low + high) % p, (low + p - high) % p), axis=2)
    return rows.reshape(-1, size) * np.uint64(pow(size, prime - 2, prime)) % p


def _squared_differences(
    blocks: np.ndarray, windows: np.ndarray, prime: int, generator: int
) -> np.ndarray:
    """Modulo ``prime``, for every shift at which a block lies inside its window."""
    p, length = np.uint64(prime), blocks.shape[1]
    size = 1 << (windows.shape[1] - 1).bit_length()
    padded = np.zeros((2, len(blocks), size), dtype=np.uint64)
    padded[0, :, :length] = blocks[:, ::-1] % p
    padded[1, :, : windows.shape[1]] = windows % p
    product = _forward(padded[0], prime, generator) * _forward(padded[1], prime, generator) % p
    both = _backward(product, prime, generator)[:, length - 1 : windows.shape[1]]
    own = (padded[0] * padded[0] % p).sum(axis=1) % p
    sums = np.cumsum(padded[1, :, : windows.shape[1]] ** 2 % p, axis=1)
    sums = np.concatenate((np.zeros((len(sums), 1), dtype=np.uint64), sums), axis=1)
    under = (sums[:, length:] - sums[:, :-length]) % p
    return (own[:, None] + under + np.uint64(2) * (p - both)) % p


def recurrences(
    codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, least: int, most: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(i, distance)`` wherever block i recurs ``least`` to ``most`` places later, sorted.

    Block i is ``codes[starts[i] : starts[i] + length]``, and its text goes up to ``ends[i]``. Codes
    are not negative. The sums are below the primes' product up to a million different codes, so
    that two zero remainders mean zero; callers compare the words all the same.
    """
    shown = np.arange(least, most + length)
    size = 1 << (len(shown) - 1).bit_length()
    found = []
    for at in range(0, len(starts), step := max(1, AT_ONCE // size)):
        first, last = starts[at : at + step, None], ends[at : at + step, None]
        blocks = (codes[first + np.arange(length)] + 1).astype(np.uint64)
        places = first + shown
        inside = places < last
        windows = np.where(inside, codes[np.where(inside, places, 0)] + 1, 0).astype(np.uint64)
        zero = np.ones((len(blocks), most - least + 1), dtype=bool)
        for prime, generator in PRIMES:
            zero &= _squared_differences(blocks, windows, prime, generator) == 0
        which, shift = np.nonzero(zero)
        found.append((which + at, shift + least))
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
