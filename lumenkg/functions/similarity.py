"""Title similarity (D2): the indel ratio on a 0..100 integer scale.

``ratio(a, b) = round(100 * (1 - (len a + len b - 2 * LCS) / (len a + len b)))``
with round-half-to-even, 100 for equal strings and 0 when exactly one
side is empty.  LCS uses a bit-parallel recurrence on Python integers
(one machine-word-like operation per character of ``b``), called from an
Arrow-batched pandas UDF only on candidate pairs of the segment index.
"""
from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence (bit-parallel)."""
    if not a or not b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def ratio(a: str | None, b: str | None) -> int | None:
    if a is None or b is None:
        return None
    if a == b:
        return 100
    if not a or not b:
        return 0
    s = len(a) + len(b)
    dist = s - 2 * lcs_length(a, b)
    return int(round(100 * (1.0 - dist / s)))


@F.pandas_udf(T.IntegerType())
def title_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b)], dtype="Int32")


def title_ratio(a, b) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return title_ratio_udf(a, b)


def title_ratio_once(a: str, b: str) -> Column:
    """The ratio, never moved by the optimizer: it runs where it stands, after all cheaper tests."""
    once = F.pandas_udf(title_ratio_udf.func, T.IntegerType()).asNondeterministic()
    return once(F.col(a), F.col(b))


def max_indel_fraction(threshold: int) -> float:
    """delta such that ratio >= threshold implies dist <= delta * (la + lb)."""
    return (100.5 - threshold) / 100.0


def max_edit(total_len: Column, threshold: int) -> Column:
    """Upper bound on the edit distance of a qualifying pair (lossless)."""
    return F.floor(total_len * F.lit(max_indel_fraction(threshold)) + F.lit(1e-9)).cast("int")
