"""Hashes of all words of a block of bytes at once, in numpy.

The hash of bytes b_0 ... b_n is the sum of t(b_i) r^i modulo 2^64, with a table t of random
64-bit numbers and an odd r, and then mixed. With running sums over a block, and powers of the
inverse of r, the hash of any stretch of it takes one subtraction and one product.
"""

from __future__ import annotations

import numpy as np

_RATIO = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_RATIO, -1, 1 << 64)

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grown(powers: np.ndarray, ratio: int, size: int) -> np.ndarray:
    factors = np.full(size, ratio & 0xFFFFFFFFFFFFFFFF, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def _ready(size: int) -> None:
    global _powers, _inverses
    if len(_powers) < size:
        size = 1 << (size - 1).bit_length()
        _powers, _inverses = _grown(_powers, _RATIO, size), _grown(_inverses, _INVERSE, size)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on all bits of x."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random number for each byte.
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_RATIO))
_lower = np.arange(256)
_lower[65:91] += 32
#: The same with A-Z as a-z.
LOWER_BYTES = BYTES[_lower]
#: Which bytes part words.
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def running(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Running sums for `stretches`."""
    _ready(len(data) + 1)
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(table[data] * _powers[: len(data)], out=out[1:])
    return out


def stretches(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes from each start to its end."""
    lengths = (ends - starts).astype(np.uint64)
    return mixed((sums[ends] - sums[starts]) * _inverses[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, separators: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a block."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(separators[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


# -- modulo primes -----------------------------------------------------------------------------
#
# Stretches that agree in the hash above can be written down: modulo 2^64 the Thue-Morse word of
# 1,024 letters agrees with its complement. The hash below is that sum modulo two primes below 2^31.

PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
_ROOTS = (0x2545F491 % PRIMES[0], 0x4F6CDD1D % PRIMES[1])
_prime_powers = [np.ones(1, np.uint64) for _ in PRIMES]
_prime_inverses = [np.ones(1, np.uint64) for _ in PRIMES]


def _powers_of(root: int, prime: int, size: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < size:
        out = np.concatenate([out, out * np.uint64(pow(root, len(out), prime)) % np.uint64(prime)])
    return out


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word of a block, as `table` has them."""
    out = np.zeros(len(begin), np.uint64)
    for i, (prime, root) in enumerate(zip(PRIMES, _ROOTS)):
        if len(_prime_powers[i]) <= len(data):
            size = 2 * len(data)
            _prime_powers[i] = _powers_of(root, prime, size)
            _prime_inverses[i] = _powers_of(pow(root, -1, prime), prime, size)
        p = np.uint64(prime)
        sums = np.zeros(len(data) + 1, np.uint64)
        # of fewer than 2^33 terms below 2^31
        np.cumsum((table % p)[data] * _prime_powers[i][: len(data)] % p, out=sums[1:])
        own = (sums[end] - sums[begin]) % p * _prime_inverses[i][begin] % p
        out = (out << np.uint64(31)) | own
    lengths = (end - begin).astype(np.uint64)
    return mixed(out + lengths * np.uint64(0xD6E8FEB86659FD93))
