"""Exact cyclic correlation of integer columns by number-theoretic transforms."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Primes k * 2^t + 1 below 2^31 with a generator each; products of residues fit 64 bits.
PRIMES = ((2013265921, 31), (1811939329, 13), (469762049, 3), (167772161, 3), (998244353, 3))


def primes_above(bound: int) -> list[tuple[int, int]]:
    """As many primes as make their product exceed ``bound``: a sum below it is 0 only if it is 0 modulo each."""
    product, out = 1, []
    for prime, generator in PRIMES:
        if product > bound:
            break
        out.append((prime, generator))
        product *= prime
    if product <= bound:
        raise OverflowError(f"sums up to {bound} need more primes")
    return out


@lru_cache(maxsize=256)
def _roots(prime: int, generator: int, half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a primitive root of unity of order ``2 * half``, as a column."""
    w = pow(generator, (prime - 1) // (2 * half), prime)
    if inverse:
        w = pow(w, prime - 2, prime)
    out = np.ones(half, np.uint64)
    step, have = w, 1
    while have < half:
        out[have:2 * have] = out[:have] * np.uint64(step) % np.uint64(prime)
        step, have = step * step % prime, 2 * have
    return out[:, None]


def _reduced(x: np.ndarray, p: np.uint64) -> np.ndarray:
    """``x`` below ``2 p`` brought below ``p``: the difference wraps round where it would be negative."""
    return np.minimum(x, x - p)


def forward(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transform of every column (length a power of two); the order of the result is bit-reversed."""
    p, n, m = np.uint64(prime), *x.shape
    half = n // 2
    while half:
        a = x.reshape(-1, 2, half, m)
        low, high = a[:, 0], a[:, 1]
        y = np.empty_like(a)
        y[:, 0] = _reduced(low + high, p)
        y[:, 1] = (low + (p - high)) * _roots(prime, generator, half, False) % p
        x, half = y, half // 2
    return x.reshape(n, m)


def backward(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Inverse of :func:`forward`, from bit-reversed to natural order."""
    p, n, m = np.uint64(prime), *x.shape
    half = 1
    while half < n:
        a = x.reshape(-1, 2, half, m)
        low, high = a[:, 0], a[:, 1] * _roots(prime, generator, half, True) % p
        y = np.empty_like(a)
        y[:, 0] = _reduced(low + high, p)
        y[:, 1] = _reduced(low + (p - high), p)
        x, half = y, half * 2
    return x.reshape(n, m) * np.uint64(pow(n, prime - 2, prime)) % p


def occurrences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Where each column of ``blocks`` (B values) occurs in its column of ``windows`` (2 B values).

    Row ``d`` of the boolean result, 0 <= d < B, tells whether the sum over i of
    (block[i] - window[d + i])^2 is 0. The sum is the two sums of squares less twice the
    correlation; every term is computed modulo as many primes as its largest value needs.
    Values lie in 0 .. 2^26.
    """
    size, _ = blocks.shape
    top = int(max(blocks.max(initial=0), windows.max(initial=0)))
    found = np.ones(blocks.shape, bool)
    reversed_block = np.zeros_like(windows)
    reversed_block[0], reversed_block[size + 1:] = blocks[0], blocks[:0:-1]
    for prime, generator in primes_above(size * top * top):
        p = np.uint64(prime)
        product = forward(reversed_block.astype(np.uint64), prime, generator) * forward(
            windows.astype(np.uint64), prime, generator) % p
        cross = backward(product, prime, generator)[:size]
        squares = np.zeros((2 * size + 1, blocks.shape[1]), np.uint64)
        np.cumsum(windows.astype(np.uint64) ** 2 % p, axis=0, out=squares[1:])
        own = (blocks.astype(np.uint64) ** 2 % p).sum(axis=0)
        found &= (own + squares[size:2 * size] - squares[:size]) % p == 2 * cross % p
    return found
