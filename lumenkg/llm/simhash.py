"""SimHash near-duplicates by pigeonring filtering (operator 9).

A fingerprint is the bitwise majority of the XXH64 values of a document's word shingles.  Two
fingerprints within ``max_bits`` link.  The 64 bits are cut into ``max_bits + 1`` segments on a ring;
if two fingerprints differ in at most ``max_bits`` places, then from some segment on every chain of l
consecutive segments holds at most floor(l * max_bits / segments) = l - 1 differences (pigeonring
principle).  So the first segment is equal and the second differs in one bit at most: each distinct
fingerprint is filed under its first segment together with the second, as it is and with each one bit
flipped.  Pairs in one bucket then face the longer chains, and last the full Hamming distance.

Equal fingerprints are one node, so copies are never paired.  A bucket gives links that span its
components, not all its pairs; a bucket beyond ``BLOCK`` fingerprints is cut into blocks whose pairs
are compared in tasks of their own.  Nothing is capped.

Null or empty text has no words: fingerprint zero, linked like any other.  Rows with a null doc_id
take part and carry a null; repeated rows share a fingerprint; an empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, components, id_text, map_batches, spanning_links, utf8, written

#: Fingerprints of one bucket that one task compares.
BLOCK = 4096


def fingerprint(raw: bytes, shingle: int = 4) -> int:
    """The 64-bit SimHash of a UTF-8 text, as a signed long."""
    words = raw.translate(LOWER).split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n < shingle:
        hashes = xxhash.xxh64_digest(joined, 42)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest, last = xxhash.xxh64_digest, n - shingle + 1
        hashes = b"".join([digest(joined[a:b], 42) for a, b in zip(starts[:last].tolist(), ends[shingle - 1:].tolist())])
    bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(bits), 255):  # sums of so many bits fit a byte
        ones += bits[at: at + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > len(bits)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long, th long), one row per document; th is a hash of the text."""
    def run(batch):
        return {"doc_id": batch.column(0), "fp": [fingerprint(t, shingle) for t in utf8(batch)], "th": batch.column(2)}

    texts = id_text(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    return map_batches(texts, run, "doc_id long, fp long, th long")


class Ring:
    """Segments of the 64 bits, and the masks and budgets of the chains from each segment on."""

    def __init__(self, max_bits: int):
        self.m = max_bits + 1
        cuts = [64 * i // self.m for i in range(self.m + 1)]
        self.spans = [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(self.m)]
        mask = [((1 << w) - 1) << s for s, w in self.spans]
        self.chains = np.zeros((self.m, self.m), dtype=np.uint64)  # [first segment, length - 1]
        for first in range(self.m):
            total = 0
            for n in range(self.m):
                total |= mask[(first + n) % self.m]
                self.chains[first, n] = total

    def keys(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, position of its fingerprint): per segment, the segment and the next one with at most
        one bit flipped."""
        out, who = [], []
        for first, (s, w) in enumerate(self.spans):
            s2, w2 = self.spans[(first + 1) % self.m]
            head = (fps >> np.uint64(s)) & np.uint64((1 << w) - 1)
            after = (fps >> np.uint64(s2)) & np.uint64((1 << w2) - 1) if self.m > 1 else np.zeros_like(fps)
            for flip in [0] + [1 << b for b in range(w2)] * (self.m > 1):
                out.append((((head << np.uint64(w2)) | (after ^ np.uint64(flip))) << np.uint64(4)) | np.uint64(first))
                who.append(np.arange(len(fps)))
        return np.concatenate(out), np.concatenate(who)

    def linked(self, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs pass every chain from segment ``first`` on; the longest is the Hamming check."""
        x = a ^ b
        ok = np.ones(len(x), dtype=bool)
        for n in range(1, self.m):
            at = np.flatnonzero(ok)
            ok[at] = np.bitwise_count(x[at] & self.chains[first[at], n]) <= n
        return ok


def bucket_links(ring: Ring, keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of every bucket in rows sorted by key."""
    us, vs = [], []
    at, d = np.arange(len(keys)), 1
    while True:
        at = at[at + d < len(keys)]
        at = at[keys[at] == keys[at + d]]
        if not len(at):
            break
        ok = ring.linked((keys[at] & np.uint64(15)).astype(np.int64), fps[at], fps[at + d])
        us.append(fps[at[ok]])
        vs.append(fps[at[ok] + d])
        d += 1
    if not us:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return spanning_links(np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64))


def fingerprint_links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """(u, v) links between fingerprints (column fp, distinct): they have the components of all pairs
    within ``max_bits``."""
    if not 0 <= max_bits <= 14:
        raise ValueError("max_bits must be from 0 to 14")
    if max_bits == 0:  # distinct fingerprints differ
        return distinct.sparkSession.createDataFrame([], "u long, v long")
    ring = Ring(max_bits)

    def file(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 2048):
                keys, who = ring.keys(fps[at: at + 2048])
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(fps[at + who].view(np.int64))], names=["k", "fp"])

    def out(u, v, block):
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(np.full(len(u), block), pa.int64())], names=["u", "v", "block"])

    def scan(batches):
        """Rows come sorted by key.  The last bucket of a batch is carried on; one that outgrows BLOCK
        leaves in blocks (u: fingerprint, v: key, block >= 0) instead of links (block -1)."""
        keys, fps, block = np.zeros(0, np.uint64), np.zeros(0, np.uint64), 0
        opened = None  # key of the open blocks; they may end with a batch and carry nothing
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(keys) and keys[0] != opened:
                block = 0
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            sizes = np.diff(np.concatenate([starts, [len(keys)]]))
            small = np.ones(len(keys), dtype=bool)
            for j in range(len(starts)):
                s, n, last = starts[j], sizes[j], j == len(starts) - 1
                if j and block:
                    block = 0
                if n > BLOCK or block:
                    opened = keys[s]
                    small[s: s + n] = False
                    whole = n // BLOCK * BLOCK if last else n
                    for p in range(0, whole, BLOCK):
                        q = min(p + BLOCK, whole)
                        yield out(fps[s + p: s + q].view(np.int64), np.full(q - p, keys[s], np.uint64).view(np.int64), block)
                        block += 1
                    rest = s + whole if last else s + n
                elif last:
                    small[s:] = False
                    rest = s
                else:
                    rest = s + n
            if small.any():
                yield out(*bucket_links(ring, keys[small], fps[small]), -1)
            if len(starts):
                keys, fps = keys[rest:], fps[rest:]
        if len(keys):
            if block:
                yield out(fps.view(np.int64), keys.view(np.int64), block)
            else:
                yield out(*bucket_links(ring, keys, fps), -1)

    filed = distinct.select("fp").mapInArrow(file, "k long, fp long")
    found = written(filed.repartition("k").sortWithinPartitions("k").mapInArrow(scan, "u long, v long, block long"))

    # Buckets beyond BLOCK: every pair of blocks is a group, of 2 * BLOCK rows at most.
    rows = found.where("block >= 0").select(F.col("v").alias("k"), F.col("u").alias("fp"), "block")
    blocks = rows.groupBy("k").agg((F.max("block") + 1).alias("n"))
    pairs = rows.join(blocks, "k").select("k", "fp", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("other"))

    def compare(pdf):
        fps = pdf.fp.to_numpy().view(np.uint64)
        first = np.int64(pdf.k.iloc[0] & 15)
        us, vs = [], []
        mine, others = (fps[pdf.block.to_numpy() == b] for b in (pdf.i.iloc[0], pdf.j.iloc[0]))
        for a in mine:
            hit = others[ring.linked(np.full(len(others), first), np.full(len(others), a), others)]
            hit = hit[hit != a]
            us.append(np.full(len(hit), a))
            vs.append(hit)
        u, v = spanning_links(np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64))
        return pd.DataFrame({"u": u, "v": v})

    crossed = pairs.select("k", "fp", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return found.where("block < 0").select("u", "v").unionByName(crossed.groupBy("k", "i", "j").applyInPandas(compare, "u long, v long"))


def grouped(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, fp, th, component_id) of every row."""
    fps = written(fingerprints(docs, shingle, id_col, text_col))
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(fingerprint_links(nodes, max_bits))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(ids, "root").select("fp", "root", "component_id")
    return fps.join(by_fp, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id): component_id is the smallest doc_id that
    links reach, the document's own included."""
    return grouped(docs, shingle, max_bits, id_col, text_col).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` of each near-duplicate group: that of the smallest id, of its texts that with
    the smallest hash, of rows equal in both the one whose columns' hash is smallest.  Rows that repeat
    an id with texts of different groups are judged apart.  Rows with a null id stay."""
    near = grouped(docs, shingle, max_bits, id_col, text_col).where("doc_id = component_id")
    kept = near.groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("k")).select(F.col("k.doc_id").alias("id"), F.col("k.th").alias("th"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"), F.xxhash64(row).alias("h"), row.alias("row"))
    one = rows.join(kept, ["id", "th"], "left_semi").groupBy("id", "th").agg(F.min_by("row", "h").alias("row"))
    return one.select("row.*").unionByName(docs.where(F.col(id_col).isNull()))
