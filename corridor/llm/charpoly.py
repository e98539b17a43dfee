"""Exact characteristic polynomials and high-precision eigenpairs of integer Gram matrices."""

from __future__ import annotations

from fractions import Fraction
from math import isqrt, log2

import numpy as np

ROOT_BITS = 128            # relative precision of an isolated root
_WITNESSES = (2, 3, 5, 7)  # these decide primality below 3,215,031,751


def _is_prime(n: int) -> bool:
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for a in _WITNESSES:
        x = pow(a, odd, n)
        if x in (1, n - 1) or a == n:
            continue
        if not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def enough_primes(matrix: np.ndarray) -> list[int]:
    """Primes below 2^31 whose product exceeds every coefficient of the characteristic polynomial.

    The eigenvalues are not negative, so the coefficients' absolute values add up to the
    product of (1 + eigenvalue), which is at most (1 + trace / d)^d.
    """
    d, trace = len(matrix), int(sum(matrix[i, i] for i in range(len(matrix))))
    bits = d * (log2(trace // d + 2) + 1e-6) + 2
    out, candidate, have = [], 2**31 - 1, 0.0
    while have < bits:
        if _is_prime(candidate):
            out.append(candidate)
            have += log2(candidate)
        candidate -= 2
    return out


def _inverse(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.array([pow(int(a), int(q) - 2, int(q)) for a, q in zip(x, p)], np.int64)


def hessenberg(matrix: np.ndarray, primes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Similar upper Hessenberg matrices modulo each prime: (primes, d, d), and the primes as a column."""
    p = np.array(primes, np.int64)
    a = np.stack([(matrix % q).astype(np.int64) for q in primes])
    d, q, every = len(matrix), p[:, None, None], np.arange(len(primes))
    for j in range(d - 2):
        pivot = j + 1 + (a[:, j + 1:, j] != 0).argmax(axis=1)      # the first nonzero row, else j + 1
        for axis in (1, 2):
            b = a.swapaxes(1, axis)
            one, other = b[:, j + 1].copy(), b[every, pivot].copy()
            b[:, j + 1], b[every, pivot] = other, one
        u = a[:, j + 2:, j] * _inverse(a[:, j + 1, j], p)[:, None] % p[:, None]
        a[:, j + 2:] = (a[:, j + 2:] - u[:, :, None] * a[:, None, j + 1] % q) % q
        a[:, :, j + 1] = (a[:, :, j + 1] + (a[:, :, j + 2:] * u[:, None] % q).sum(axis=2)) % p[:, None]
    return a, p[:, None]


def modular_polynomials(matrix: np.ndarray, primes: list[int]) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo each prime, constant term first: (primes, d + 1)."""
    h, p = hessenberg(matrix, primes)
    d = len(matrix)
    rows = np.zeros((d + 1, len(primes), d + 1), np.int64)
    rows[0, :, 0] = 1
    for k in range(1, d + 1):
        rows[k, :, 1:] = rows[k - 1, :, :-1]
        below = np.ones(len(primes), np.int64)          # product of the subdiagonal entries passed
        for i in range(k, 0, -1):
            factor = h[:, i - 1, k - 1] * below % p[:, 0]
            rows[k] = (rows[k] - factor[:, None] * rows[i - 1] % p) % p
            if i > 1:
                below = below * h[:, i - 1, i - 2] % p[:, 0]
    return rows[d]


def remaindered(residues: np.ndarray, primes: list[int]) -> list[int]:
    """The integer polynomial (constant term first) of a positive semidefinite matrix by Chinese remaindering."""
    product = 1
    for q in primes:
        product *= q
    weights = [product // q * pow(product // q, -1, q) for q in primes]
    d, out = residues.shape[1] - 1, []
    for k in range(d + 1):
        sign = -1 if (d - k) % 2 else 1                  # signs alternate, so absolute values are enough
        out.append(sign * (sum(int(sign * r) % q * w for r, q, w in zip(residues[:, k], primes, weights)) % product))
    return out


def _above(poly: list[int], num: int, bits: int) -> int:
    """Roots above num / 2^bits, with multiplicity: sign changes of the shifted polynomial.

    By Descartes' rule, which counts exactly where all roots are real.
    """
    d = len(poly) - 1
    c = [a << bits * (d - k) for k, a in enumerate(poly)]
    for i in range(d):
        carry = c[d]
        for k in range(d - 1, i - 1, -1):
            carry = c[k] = c[k] + num * carry
    signs = [a > 0 for a in c if a]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(poly: list[int], num: int, bits: int) -> int:
    value, scale = 0, 0
    for a in reversed(poly):
        value = value * num + (a << scale)
        scale += bits
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], count: int) -> list[tuple[Fraction, int]]:
    """The ``count`` largest positive roots of a polynomial with real roots >= 0, falling, as (root, multiplicity).

    Intervals are halved until each holds one root, which is then halved by signs to ROOT_BITS
    relative bits. Roots that stay together up to there count as one of their multiplicity.
    """
    while len(poly) > 1 and poly[0] == 0:
        poly = poly[1:]
    top = max(1, -(-abs(poly[-2]) // poly[-1])) if len(poly) > 1 else 1     # the sum of the roots
    open_, out = [(0, 1 << top.bit_length(), 0, _above(poly, 0, 0), 0)], []
    taken = 0
    while open_ and taken < count:
        low, high, bits, n_low, n_high = open_.pop()        # (low, high] / 2^bits holds n_low - n_high roots
        if n_low == n_high:
            continue
        if (high - low) << ROOT_BITS <= low:
            out.append((Fraction(low + high, 2 << bits), n_low - n_high))
            taken += n_low - n_high
            continue
        low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        if n_low - n_high == 1 and low:
            # One simple root: the sign right of it is that of the polynomial with n_high roots still above.
            right = 1 if n_high % 2 == 0 else -1
            if _sign(poly, middle, bits) * right < 0:
                n_middle = n_low
            else:
                n_middle = n_high
        else:
            n_middle = _above(poly, middle, bits)
        open_.append((low, middle, bits, n_low, n_middle))
        open_.append((middle, high, bits, n_middle, n_high))
    return out


def null_vectors(matrix: np.ndarray, root: Fraction, multiplicity: int) -> np.ndarray:
    """Orthonormal eigenvectors of an integer matrix for a root, as rows, by inverse iteration.

    The elimination of matrix - root runs in fixed point with twice the root's precision
    beyond the entries' size, so a row is right to double precision however close other
    roots lie, as far as the root itself tells them apart.
    """
    d, bits = len(matrix), 4 * ROOT_BITS
    a = matrix.copy() * root.denominator
    for i in range(d):
        a[i, i] -= root.numerator
    scale = max(1, max(abs(int(v)) for v in a.ravel()))
    a = (a << bits) // scale
    rng = np.random.default_rng(11)
    starts = rng.integers(-(1 << 30), 1 << 30, (multiplicity, d)).astype(object)
    x = (starts << bits - 30).T.copy()
    pivots = []
    for k in range(d):
        i = k + max(range(d - k), key=lambda r: abs(a[k + r, k]))
        a[[k, i]] = a[[i, k]]
        if a[k, k] == 0:
            a[k, k] = 1
        f = (a[k + 1:, k] << bits) // a[k, k]
        a[k + 1:, k:] -= f[:, None] * a[None, k, k:] >> bits
        pivots.append((i, f))
    for _ in range(2):
        for k, (i, f) in enumerate(pivots):
            x[[k, i]] = x[[i, k]]
            x[k + 1:] -= f[:, None] * x[None, k] >> bits
        for k in range(d - 1, -1, -1):
            rest = (a[k, k + 1:, None] * x[k + 1:]).sum(axis=0) if k < d - 1 else 0
            x[k] = ((x[k] << bits) - rest) // a[k, k]
        x = _orthonormal(x, bits)
    rows = np.array([[float(Fraction(int(v), 1 << bits)) for v in column] for column in x.T])
    rows /= np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows * np.where(rows[np.arange(len(rows)), np.abs(rows).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]


def _orthonormal(x: np.ndarray, bits: int) -> np.ndarray:
    """Columns made orthonormal in fixed point."""
    columns: list[np.ndarray] = []
    for v in x.T:
        size = max(1, max(abs(int(c)) for c in v))
        v = (v << bits) // size
        for _ in range(2):
            for u in columns:
                v = v - (u * ((u * v).sum() >> bits) >> bits)
            norm = isqrt(int((v * v).sum())) or 1
            v = (v << bits) // norm
        columns.append(v)
    return np.stack(columns, axis=1)
