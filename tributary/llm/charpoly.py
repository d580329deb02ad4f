"""Eigenvalues and eigenvectors of an integer symmetric matrix from its exact characteristic polynomial.

The polynomial modulo a prime comes from a Hessenberg form of the matrix modulo that prime; enough primes give the integers by Chinese
remaindering. All roots are real, so Descartes' rule is exact: the sign changes in the coefficients of ``p(x + a)``
are the number of roots above ``a``. Bisection on that count isolates the roots, and on the sign of ``p`` narrows them.
Eigenvectors come from inverse iteration in fixed point, with the narrowed root as shift.

Everything here is bounded by the matrix, not by the rows it was gathered from.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import comb, isqrt

import numpy as np

#: Bits of a root behind those of the largest one, and fixed-point bits of the elimination.
ROOT_BITS, FIXED_BITS = 160, 320
#: Primes stay below 2^31, so a product of two residues fits a 64-bit integer.
PRIME_CEILING = 1 << 31


def primes_below(ceiling: int = PRIME_CEILING) -> Iterator[int]:
    """Primes downwards from ``ceiling``, each proved by Miller's test, whose bases 2, 3, 5 and 7 suffice below 3.2e9."""
    n = ceiling - 1 - ceiling % 2
    while True:
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        if all(pow(b, odd, n) == 1 or any(pow(b, odd << i, n) == n - 1 for i in range(twos)) for b in (2, 3, 5, 7)):
            yield n
        n -= 2


def coefficient_bound(matrix: Sequence[Sequence[int]]) -> int:
    """No coefficient of the polynomial is larger: each is a sum of minors, and a minor is at most a product of row lengths."""
    d = len(matrix)
    longest = max((isqrt(sum(v * v for v in row)) + 1 for row in matrix), default=1)
    return max(comb(d, k) * longest**k for k in range(d + 1))


def primes_for(matrix: Sequence[Sequence[int]]) -> list[int]:
    """Primes whose product exceeds twice the bound."""
    found, product, limit, source = [], 1, 2 * coefficient_bound(matrix) + 1, primes_below()
    while product < limit:
        found.append(next(source))
        product *= found[-1]
    return found


def polynomial_mod(matrix: Sequence[Sequence[int]], p: int) -> list[int]:
    """Coefficients of ``det(x - matrix)`` modulo ``p``, the constant first."""
    h = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(h)
    for k in range(d - 2):
        found = np.flatnonzero(h[k + 1 :, k])
        if not len(found):
            continue
        pivot = k + 1 + int(found[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factors = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factors[:, None] * h[k + 1] % p) % p
        # The similar column step: every factor of a row comes back to the pivot's column.
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factors % p).sum(axis=1)) % p
    polynomials = np.zeros((d + 1, d + 1), np.int64)
    polynomials[0, 0] = 1
    for m in range(1, d + 1):
        own = np.roll(polynomials[m - 1], 1)
        own[0] = 0
        own = (own - h[m - 1, m - 1] * polynomials[m - 1]) % p
        below = 1
        for i in range(1, m):
            below = below * int(h[m - i, m - i - 1]) % p
            own = (own - below * int(h[m - i - 1, m - 1]) % p * polynomials[m - i - 1]) % p
        polynomials[m] = own
    return polynomials[d].tolist()


def remainder_lift(residues: Sequence[Sequence[int]], primes: Sequence[int]) -> list[int]:
    """The integers of least size with the given residues, one row of residues for each prime."""
    product = 1
    for p in primes:
        product *= p
    weights = [product // p * pow(product // p % p, -1, p) for p in primes]
    out = []
    for column in zip(*residues, strict=True):
        value = sum(w * r for w, r in zip(weights, column, strict=True)) % product
        out.append(value - product if 2 * value > product else value)
    return out


def roots_above(coefficients: Sequence[int], a: int) -> int:
    """How many roots are above ``a``, each as often as its multiplicity, for a polynomial with real roots only."""
    shifted = list(coefficients)
    for i in range(len(shifted) - 1):
        for j in range(len(shifted) - 2, i - 1, -1):
            shifted[j] += a * shifted[j + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(s != t for s, t in zip(signs, signs[1:], strict=False))


def scaled(coefficients: Sequence[int], bits: int) -> list[int]:
    """The polynomial whose roots are those given times ``2 ** bits``."""
    d = len(coefficients) - 1
    return [c << bits * (d - i) for i, c in enumerate(coefficients)]


def value_sign(coefficients: Sequence[int], x: int) -> int:
    total = 0
    for c in reversed(coefficients):
        total = total * x + c
    return (total > 0) - (total < 0)


def largest_roots(coefficients: Sequence[int], wanted: int) -> tuple[list[tuple[int, int]], int]:
    """``(root, multiplicity)`` from the largest down until ``wanted`` are counted, and the bits by which roots are scaled.

    The polynomial has real, non-negative roots only. A root is the upper end of an interval one unit wide (``2 ** -bits``) that holds it; roots
    that share such an interval are one root of a higher multiplicity. ``bits`` gives the largest root ``ROOT_BITS`` bits.
    """
    d = len(coefficients) - 1
    top = 1
    while roots_above(coefficients, top):
        top <<= 1
    bits = max(0, ROOT_BITS - top.bit_length())
    fine = scaled(coefficients, bits)
    found: list[tuple[int, int]] = []
    # Intervals (low, high] with the number of roots above each end, those with larger roots first.
    open_ = [(-1, top << bits, d, 0)]
    while open_ and sum(m for _, m in found) < wanted:
        low, high, above_low, above_high = open_.pop()
        inside = above_low - above_high
        if inside == 0:
            continue
        if high - low == 1:
            found.append((high, inside))
        elif inside == 1:
            found.append((_narrow(fine, low, high), 1))
        else:
            middle = (low + high) // 2
            above = roots_above(fine, middle)
            open_ += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return found, bits


def _narrow(coefficients: Sequence[int], low: int, high: int) -> int:
    """Upper end of the unit interval in (low, high] that holds its one simple root."""
    upper = value_sign(coefficients, high)
    if upper == 0:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        sign = value_sign(coefficients, middle)
        if sign == 0:
            return middle
        if sign == upper:
            high = middle
        else:
            low = middle
    return high


def eigenvectors(matrix: Sequence[Sequence[int]], root: int, bits: int, multiplicity: int) -> np.ndarray:
    """Orthonormal columns that span the space of a root (scaled by ``2 ** bits``), in double precision.

    ``(matrix - root) v = b`` is solved twice in fixed point with full pivoting; pivots that vanish at that precision are replaced by the smallest number
    that does not, so the null space dominates. The ``multiplicity`` starting vectors are those of the last pivots.
    """
    d = len(matrix)
    size = max((abs(v) for row in matrix for v in row), default=1).bit_length() + 1
    # Entries are below one after division by 2 ** size.
    shift = FIXED_BITS - size
    a = np.array([[_moved(v, shift) for v in row] for row in matrix], dtype=object)
    for i in range(d):
        a[i, i] -= _moved(root, shift - bits)
    rows, columns = list(range(d)), list(range(d))
    tiny = 1 << (FIXED_BITS // 4)
    for k in range(d):
        rest = np.abs(a[k:, k:])
        i, j = divmod(int(rest.argmax()), d - k)
        if i:
            a[[k, k + i]] = a[[k + i, k]]
            rows[k], rows[k + i] = rows[k + i], rows[k]
        if j:
            a[:, [k, k + j]] = a[:, [k + j, k]]
            columns[k], columns[k + j] = columns[k + j], columns[k]
        if abs(a[k, k]) < tiny or k >= d - multiplicity:
            a[k, k] = tiny
            a[k + 1 :, k] = 0
            continue
        a[k + 1 :, k] = (a[k + 1 :, k] << FIXED_BITS) // a[k, k]
        a[k + 1 :, k + 1 :] -= (a[k + 1 :, k, None] * a[k, k + 1 :]) >> FIXED_BITS
    basis: list[np.ndarray] = []
    for m in range(multiplicity):
        v = np.array([0] * d, dtype=object)
        v[columns[d - 1 - m]] = 1 << FIXED_BITS
        for _ in range(2):
            v = _orthogonal(_solve(a, v[rows], columns), basis)
        basis.append(v)
    return np.array([[float(x) / float(1 << FIXED_BITS) for x in v] for v in basis]).T


def _moved(value: int, bits: int) -> int:
    return value << bits if bits >= 0 else value >> -bits


def _solve(lu: np.ndarray, b: np.ndarray, columns: list[int]) -> np.ndarray:
    d = len(lu)
    y = b.copy()
    for k in range(d):
        y[k + 1 :] -= (lu[k + 1 :, k] * y[k]) >> FIXED_BITS
    for k in range(d - 1, -1, -1):
        y[k] = (y[k] << FIXED_BITS) // lu[k, k]
        y[:k] -= (lu[:k, k] * y[k]) >> FIXED_BITS
    out = np.empty(d, dtype=object)
    out[columns] = y
    return out


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """A unit vector in fixed point, orthogonal to the basis."""
    v = _unit(v)
    for _ in range(2):
        for b in basis:
            v = v - ((b * ((v * b).sum() >> FIXED_BITS)) >> FIXED_BITS)
        v = _unit(v)
    return v


def _unit(v: np.ndarray) -> np.ndarray:
    length = isqrt(int((v * v).sum()))
    return (v << FIXED_BITS) // max(length, 1)
