"""Repeatable pseudo-random draws from a row's id, independent of partitioning.

One SHA-256 per row gives ten draws of six hexadecimal digits. Unlike ``rand()`` the values
do not depend on which task computes a row, so a retried task repeats them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits per draw and the number of values a draw can take.
DIGITS = 6
RANGE = 16**DIGITS


def digest(seed: int, *parts: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *[part.cast("string") for part in parts]), 256)


def draw(digest_text: Column, number: int) -> Column:
    """Whole number in ``[0, RANGE)``; ``number`` 0..9 picks the digits."""
    piece = F.substring(digest_text, number * DIGITS + 1, DIGITS)
    return F.conv(piece, 16, 10).cast("bigint")


def below(drawn: Column, limit: int | Column) -> Column:
    """Whole number in ``[0, limit)`` from a draw."""
    return F.floor(drawn * limit / RANGE).cast("bigint")


def between(drawn: Column, low: Column | float, high: Column | float) -> Column:
    """Real number in ``[low, high)`` from a draw."""
    low = F.lit(low) if isinstance(low, (int, float)) else low
    high = F.lit(high) if isinstance(high, (int, float)) else high
    return low + (high - low) * (drawn / RANGE)


def weighted(drawn: Column, weights: dict[str, float]) -> Column:
    """One of the keys, with the given probabilities (they add up to 1)."""
    names = list(weights)
    picked, upto = None, 0.0
    for name in names[:-1]:
        upto += weights[name]
        test = drawn < int(round(upto * RANGE))
        picked = F.when(test, name) if picked is None else picked.when(test, name)
    return F.lit(names[0]) if picked is None else picked.otherwise(names[-1])
