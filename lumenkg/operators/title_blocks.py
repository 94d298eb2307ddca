"""All pairs of similar strings, block against block (the search behind J5, D1 and J7).

The strings are dealt by hash to blocks, a block is packed into one row of a partition of its own, and every
pair of blocks is a task of a Cartesian product, which reads the two blocks where they lie.  So a task holds two
blocks whatever the table's size, and what is shuffled is each string twice, however many blocks there are.
Inside a task the strings are sorted by length and
compared tile by tile, each test only on what the one before it left; none of them loses a pair:

* tiles whose lengths are out of reach are skipped;
* character counts, by hash bucket: an indel changes one count by one.  In unary form the counts' common part
  is a matrix product;
* bigrams, as bits by hash: an indel takes two and adds one, or the reverse;
* the longest common subsequence, bit-parallel over many pairs at once (characters by their low seven bits, so
  it is never too short); a pair is dropped once the characters left cannot make up for those that have no
  partner in reach; strings over ``64 * WORDS`` characters skip this test.

What is left is compared exactly by the caller.
"""
from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import max_indel_fraction

#: Strings of a block: at least, at most, and the number of blocks aimed at in between.
SMALLEST, LARGEST, BLOCKS = 8192, 32768, 24
#: Strings of a tile, and pairs that the later tests take at once.
TILE, CHUNK = 1024, 16384
#: Hash buckets of the character counts, their largest unary count, 64-bit words of the bigram bits.
BUCKETS, LEVELS, BIGRAMS = 32, 15, 8
#: 64-bit words of the longest string in the subsequence test; code of the places past a string's end; characters
#: after which pairs are dropped again.
WORDS, END, STEP = 8, 128, 8


class _Tile:
    """Up to ``TILE`` strings of similar length with what the tests need."""

    def __init__(self, at: np.ndarray, texts: list[str], delta: float):
        self.at, self.n = at, np.array([len(t) for t in texts], dtype=np.int64)
        code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        row = np.repeat(np.arange(len(texts)), self.n)
        bucket = (code * np.uint32(0x9E3779B1) >> np.uint32(27)).astype(np.int64)
        counts = np.bincount(row * BUCKETS + bucket, minlength=len(texts) * BUCKETS).reshape(-1, BUCKETS)
        self.unary = (np.minimum(counts, LEVELS)[:, :, None] > np.arange(LEVELS)).reshape(len(texts), -1)
        # a pair is in reach while common + spare of both >= 0
        self.spare = (delta * self.n - self.unary.sum(axis=1)) / 2
        pair = code[:-1] * np.uint32(0x85EBCA6B) + code[1:] * np.uint32(0xC2B2AE35)
        pair = ((pair ^ pair >> np.uint32(15)) * np.uint32(0x9E3779B1) >> np.uint32(23)).astype(np.int64)
        inside = row[:-1] == row[1:]
        bits = np.zeros((len(texts), 64 * BIGRAMS), dtype=np.uint8)
        bits[row[:-1][inside], pair[inside]] = 1
        self.bits = np.packbits(bits, axis=1).view(np.uint64)
        self.wide = len(texts) > 0 and int(self.n.max()) > 64 * WORDS
        if self.wide:
            return
        longest = max(1, int(self.n.max()))
        place = np.arange(len(code)) - np.repeat(np.cumsum(self.n) - self.n, self.n)
        # by place, and by 64-bit word: one character of many strings is read at a time
        self.code = np.full((longest, len(texts)), END, dtype=np.uint8)
        self.code[place, row] = code & np.uint32(127)
        self.mask = np.zeros((-(-longest // 64), len(texts), END + 1), dtype=np.uint64)
        for i in range(longest):
            r = np.flatnonzero(self.n > i)
            self.mask[i >> 6, r, self.code[i, r]] |= np.uint64(1) << np.uint64(i & 63)


def _matched(v: list[np.ndarray], reach: np.ndarray | None = None) -> np.ndarray:
    """Characters that have a partner so far, of the first ``reach`` ones."""
    out = 0
    for w, bits in enumerate(v):
        bits = ~bits
        if reach is not None:
            n = np.clip(reach - 64 * w, 0, 64)
            bits &= np.where(n == 64, ~np.uint64(0), (np.uint64(1) << np.minimum(n, 63).astype(np.uint64)) - np.uint64(1))
        out = out + np.bitwise_count(bits).astype(np.int64)
    return out


def _alike(x: _Tile, y: _Tile, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which of the strings ``i`` of ``x`` and ``j`` of ``y`` have a common subsequence so long that at most ``most``
    indels are left: places in ``i``, in order."""
    left = np.arange(len(i))
    v = [np.full(len(i), ~np.uint64(0)) for _ in x.mask]
    masks = [m.reshape(-1) for m in x.mask]
    base, m, n = i * (END + 1), x.n[i], y.n[j]
    longest = int(n.max(initial=0))
    for k in range(longest):
        if k and k % STEP == 0 and 2 * k >= longest:
            # the first k characters of y have their partners among the first ``reach`` of x, or too many indels are needed
            reach = np.maximum(np.minimum(m, k + (most + m - n) // 2), 0)
            keep = np.flatnonzero((m + n - 2 * (_matched(v, reach) + np.maximum(n - k, 0)) <= most) | (n < k))
            if 8 * len(keep) < 7 * len(left):
                v = [a[keep] for a in v]
                left, base, j, m, n, most = left[keep], base[keep], j[keep], m[keep], n[keep], most[keep]
                if not len(left):
                    return left
        at = base + y.code[k].take(j)
        carry = None
        for w, mask in enumerate(masks):
            old = v[w]
            u = mask.take(at)
            u &= old
            total = old + u
            if len(masks) > 1:
                out = total < old
                if carry is not None:
                    total += carry
                    out |= total < carry
                carry = out.astype(np.uint64)
            total |= old - u
            v[w] = total
    return left[m + n - 2 * _matched(v) <= most]


def _pairs(x: _Tile, y: _Tile, delta: float, same: bool):
    """(rows of x, rows of y) of the pairs that may be similar, in chunks."""
    used = np.flatnonzero(x.unary.any(axis=0) & y.unary.any(axis=0))
    one = np.float32(1)
    a = np.empty((len(x.n), len(used) + 2), dtype=np.float32)
    a[:, :-2], a[:, -2], a[:, -1] = x.unary[:, used], x.spare, one
    b = np.empty((len(y.n), len(used) + 2), dtype=np.float32)
    b[:, :-2], b[:, -2], b[:, -1] = y.unary[:, used], one, y.spare
    slack = 1e-2 + 1e-5 * float(x.n.max() + y.n.max())
    hit = np.flatnonzero((a @ b.T).ravel() >= -slack)
    for start in range(0, len(hit), CHUNK):
        i, j = np.divmod(hit[start: start + CHUNK], len(y.n))
        if same:
            i, j = i[i < j], j[i < j]
        most = np.floor(delta * (x.n[i] + y.n[j]) + 1e-9)
        apart = np.bitwise_count(x.bits[i] ^ y.bits[j]).sum(axis=1, dtype=np.int64)
        keep = (np.abs(x.n[i] - y.n[j]) <= most) & (apart <= 3 * most)
        i, j, most = i[keep], j[keep], most[keep]
        if len(i) and not (x.wide or y.wide):
            keep = _alike(x, y, i, j, most.astype(np.int64))
            i, j = i[keep], j[keep]
        if len(i):
            yield i, j


def _parts(texts: list[str]) -> list[list[int]]:
    """The places of the strings by length, in parts of a tile; those too long for the subsequence test apart."""
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    short = bisect_right(order, 64 * WORDS, key=lambda i: len(texts[i]))
    return [part[k: k + TILE] for part in (order[:short], order[short:]) for k in range(0, len(part), TILE)]


def _tiles(texts: list[str], delta: float):
    for part in _parts(texts):
        yield _Tile(np.array(part), [texts[i] for i in part], delta)


def _compare(xs: pa.Array, ys: pa.Array | None, delta: float):
    """(a, b) of one pair of blocks, or of one block with itself; of the second block one tile is held at a time."""
    left = list(_tiles(xs.to_pylist(), delta))
    b = xs if ys is None else ys
    for q, y in enumerate(left if ys is None else _tiles(ys.to_pylist(), delta)):
        for p, x in enumerate(left if ys is not None else left[: q + 1]):
            low, high = (x, y) if x.n[0] <= y.n[0] else (y, x)
            gap = int(high.n.min() - low.n.max())
            if gap > delta * int(high.n.min() + low.n.max()) + 1e-9:
                continue
            for i, j in _pairs(x, y, delta, ys is None and p == q):
                yield pa.RecordBatch.from_arrays([xs.take(pa.array(x.at[i])), b.take(pa.array(y.at[j]))], names=["a", "b"])


def _packed(titles: DataFrame, blocks: int) -> DataFrame:
    """(block, ts): the strings dealt to blocks by hash, one row and one partition a block."""
    dealt = titles.groupBy(F.pmod(F.xxhash64("t"), F.lit(blocks)).cast("int").alias("block")).agg(F.collect_list("t").alias("ts"))
    return dealt.repartitionById(blocks, F.col("block"))


def _blocks(n: int) -> int:
    return max(1, -(-n // min(LARGEST, max(SMALLEST, n // BLOCKS))))


def _joined(left: DataFrame, right: DataFrame, threshold: int, within: bool) -> DataFrame:
    """(a, b) from the blocks ``left`` and ``right``; ``within``: they are the same, and each pair of them is compared once."""
    delta = max_indel_fraction(threshold)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                xs, ys = batch.column(2)[k].values, batch.column(3)[k].values
                yield from _compare(xs, None if within and batch.column(0)[k].as_py() == batch.column(1)[k].as_py() else ys, delta)

    x = left.select(F.col("block").alias("x"), F.col("ts").alias("xs"))
    y = right.select(F.col("block").alias("y"), F.col("ts").alias("ys")).hint("shuffle_replicate_nl")
    # of two blocks one order, in turns, so that no block has all its pairs
    once = F.when((F.col("x") + F.col("y")) % 2 == 0, F.col("x") <= F.col("y")).otherwise(F.col("x") > F.col("y"))
    rows = x.join(y, once) if within else x.crossJoin(y)
    return rows.select("x", "y", "xs", "ys").mapInArrow(run, "a string, b string")


def self_candidates(titles: DataFrame, threshold: int) -> DataFrame:
    """(a, b), each pair once in any order, of distinct strings (column t; materialised by the caller) that may be similar."""
    dealt = _packed(titles, _blocks(titles.count()))
    return _joined(dealt, dealt, threshold, True)


def cross_candidates(new: DataFrame, known: DataFrame, threshold: int) -> DataFrame:
    """(a, b) with a from ``new`` and b from ``known`` (distinct strings each; materialised) that may be similar."""
    return _joined(_packed(new, _blocks(new.count())), _packed(known, _blocks(known.count())), threshold, False)
