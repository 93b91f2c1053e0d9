"""Integer expressions."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def divisors(n: Column) -> Column:
    """All divisors of a positive integer, ascending; work grows with its square root."""
    root = F.floor(F.sqrt(n)).cast("long")
    wide = n.cast("long")
    low = F.filter(F.sequence(F.lit(1).cast("long"), root), lambda d: wide % d == 0)
    # Every d divides, so this is exact also where a double is not.
    high = F.transform(low, lambda d: F.try_divide(wide.cast("decimal(20,0)"), d.cast("decimal(20,0)")).cast("long"))
    return F.when(n > 0, F.array_sort(F.array_union(low, high)))


def is_prime(n: Column) -> Column:
    """Exact trial division by 2 and the odd numbers up to the square root."""
    root = F.floor(F.sqrt(n.cast("double"))).cast("long")
    wide = n.cast("long")
    # `sequence(3, 1, 2)` would be an error, so small numbers take their own branch.
    odd = F.forall(F.sequence(F.lit(3).cast("long"), F.greatest(root, F.lit(3)), F.lit(2).cast("long")), lambda d: (wide % d != 0) | (d > root))
    return F.when(n < 2, False).when(n < 4, True).when(n % 2 == 0, False).otherwise(odd)


CANDIDATES = 1 << 20


def divisor_pairs(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every divisor of ascending, distinct, positive numbers, as (place of the number, divisor), in no order.

    Where it is less work than a trial of each number, the candidates' multiples between the first and the last number
    are looked up among them: a batch then costs one pass over the candidates and a few steps for each whole number in
    between. At most ``CANDIDATES`` candidates are held at once.
    """
    low, high = int(numbers[0]), int(numbers[-1])
    root, width = isqrt(high), high - low + 1
    together = len(numbers) * root > root + 16 * width
    found = _by_multiples(numbers, low, high, root) if together else _by_trial(numbers)
    places, divisors = zip(*found)
    return np.concatenate(places), np.concatenate(divisors)


def _by_multiples(numbers: np.ndarray, low: int, high: int, root: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    place = np.full(high - low + 1, -1, np.int32)
    place[numbers - low] = np.arange(len(numbers), dtype=np.int32)
    for begin in range(1, root + 1, CANDIDATES):
        d = np.arange(begin, min(begin + CANDIDATES, root + 1), dtype=np.int64)
        first = np.maximum(d, (low - 1) // d + 1)
        times = np.maximum(high // d - first + 1, 0)
        small = np.repeat(d, times)
        large = np.arange(len(small)) + np.repeat(first - (np.cumsum(times) - times), times)
        at = place[small * large - low]
        there = at >= 0
        at, small, large = at[there], small[there], large[there]
        yield at, small
        yield at[large != small], large[large != small]


def _by_trial(numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for i, n in enumerate(numbers.tolist()):
        root = isqrt(n)
        for begin in range(1, root + 1, CANDIDATES):
            d = np.arange(begin, min(begin + CANDIDATES, root + 1), dtype=np.int64)
            small = d[n % d == 0]
            large = n // small
            both = np.concatenate([small, large[large != small]])
            yield np.full(len(both), i, np.int32), both
