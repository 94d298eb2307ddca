"""Similar strings (the search behind J5, D1 and J7), and rare segments of a string.

The pairs that may be similar come from ``title_blocks``; here they are compared exactly.

``cut`` takes a string into disjoint rare segments: two strings whose indel distance is at most D share at least
one of D + 1 of them.  Short segments of titles are too common to search by (the rows of such a join grow with
the square of the titles, each far dearer than a comparison in a block), so the search does not use them.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import max_indel_fraction, title_ratio_once
from . import title_blocks

#: Longest segment, and the bits of a frequency table's slots.
LONGEST, SLOT_BITS = 4, 16
#: Characters that are cut into segments together.
STRETCH = 64


def slots(text: str) -> list[np.ndarray]:
    """By length from 1 to LONGEST: the frequency slot of the substring at each place."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    out, h = [], np.zeros(len(c), dtype=np.uint64)
    for q in range(min(LONGEST, len(c))):
        h = (h[: len(c) - q] ^ (c[q:] + np.uint64(q + 1))) * np.uint64(0x9E3779B97F4A7C15)
        out.append((h >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
    return out


def rarest(cost: list[np.ndarray], start: int, end: int, k: int) -> list[tuple[int, int]]:
    """``k`` disjoint (place, length) in [start, end) of least summed cost; ``k`` is at most the length."""
    n = end - start
    best = np.full((n + 1, k + 1), np.inf)
    best[:, 0] = 0
    for i in range(1, n + 1):
        row = best[i]
        np.minimum(row, best[i - 1], out=row)
        for q in range(1, min(len(cost), i) + 1):
            np.minimum(row[1:], best[i - q, :-1] + cost[q - 1][start + i - q], out=row[1:])
    out, i = [], n
    while k:
        if best[i, k] == best[i - 1, k]:
            i -= 1
            continue
        q = next(q for q in range(1, min(len(cost), i) + 1) if best[i - q, k - 1] + cost[q - 1][start + i - q] == best[i, k])
        i, k = i - q, k - 1
        out.append((start + i, q))
    return out[::-1]


def cut(text: str, k: int, frequency: np.ndarray) -> list[tuple[int, int]]:
    """``k`` disjoint rare segments (place, length); long texts are cut stretch by stretch."""
    cost = [frequency[s] + 1.0 for s in slots(text)]
    n, out = len(text), []
    edges = [*range(0, max(1, n - STRETCH // 2), STRETCH), n]
    for a, b in zip(edges, edges[1:]):
        out += rarest(cost, a, b, k * b // n - k * a // n)
    return out


def lengths_in_reach(threshold: int, column: str = "n") -> Column:
    """The lengths that a similar string may have, shorter or longer."""
    d = max_indel_fraction(threshold)
    return F.expr(f"sequence(CAST(floor({column} * {(1 - d) / (1 + d)!r}) AS INT), CAST(ceil({column} * {(1 + d) / (1 - d)!r}) AS INT))")


def exact(pairs: DataFrame, threshold: int) -> DataFrame:
    """(a, b, ratio) of the pairs with ratio >= threshold.  The ratio is marked as not deterministic, so the
    optimizer cannot move it below the candidates' count into the join."""
    return pairs.withColumn("ratio", title_ratio_once("a", "b")).where(F.col("ratio") >= threshold)


def self_pairs(titles: DataFrame, threshold: int) -> DataFrame:
    """(a, b, ratio), a < b, of similar titles (distinct, column t; materialised by the caller)."""
    found = title_blocks.self_candidates(titles, threshold)
    return exact(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), threshold)


def cross_pairs(new: DataFrame, known: DataFrame, threshold: int) -> DataFrame:
    """(a, b, ratio) with a from ``new`` and b from ``known``, a != b (distinct titles each; materialised by the caller)."""
    return exact(title_blocks.cross_candidates(new, known, threshold).where("a != b"), threshold)
