"""Mixing sources to target weights by Pfair scheduling (operator 6, DataFrame functions only).

Target weights become integer shares of a period of ``period`` slots.  The j-th block of a source with
share a (j from 0) is released at floor(j * period / a) and due at ceil((j + 1) * period / a).  In every
slot, of the blocks that are released and not yet placed, the one due first is placed (ties: released
first, then source name).  The shares fill the period exactly, so every block keeps its window and no
source is ever a whole block away from its target.

The schedule repeats every period, so it is worked out once, in one row, by a fold over the period's
slots; a document's slot then follows from its number within its source: that is one broadcast join
with the schedule, of exactly ``period`` rows.  Numbers come from counts of (source, hash bucket) and a
rank within the bucket, so a hot source is spread over all buckets.  No row is dropped; when a source
runs out its slots stay free, and the others' order stands.

A null source is the source "".  Null ids are numbered like others, by a hash of the row; repeated rows
get places of their own; an empty table gives an empty result; columns of any name are carried on, but
columns that are named like a result column are replaced by it.  The period doubles until it is twice the
number of sources, so any number of sources fits.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Buckets a source is numbered in: three hex digits of the id's MD5.
BUCKET_DIGITS = 3


def shares(weights: DataFrame, period: int = 1000) -> DataFrame:
    """(source, share): whole weights as shares of at least 1 that sum to ``period`` (largest remainder,
    ties by name).  There must not be more sources than slots, see :func:`fitting_period`."""
    whole = Window.partitionBy()
    w = (weights.withColumn("n", F.count("*").over(whole)).withColumn("total", F.sum("weight").over(whole))
         .withColumn("room", period - F.col("n"))
         .withColumn("base", F.expr("room * weight div total")).withColumn("rest", F.expr("(room * weight) % total")))
    left = F.first("room").over(whole) - F.sum("base").over(whole)
    w = w.withColumn("left", left).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("rest"), "source")))
    return w.select("source", (1 + F.col("base") + F.when(F.col("rank") <= F.col("left"), 1).otherwise(0)).cast("long").alias("share"))


def schedule(share: DataFrame, period: int = 1000) -> DataFrame:
    """(source, share, turn, at): the slot ``at`` of the period in which the source's block ``turn`` is placed."""
    row = share.agg(F.sort_array(F.collect_list(F.struct("source", "share"))).alias("s"))
    steps = row.where("size(s) > 0").selectExpr("s", f"""
        aggregate(sequence(0L, {period}L - 1),
          named_struct('next', transform(s, x -> 0L), 'out', cast(array() as array<struct<at:bigint,i:int,turn:bigint>>)),
          (acc, t) -> transform(array(
              array_min(filter(transform(s, (x, i) -> named_struct(
                  'due', ((acc.next[i] + 1) * {period} + x.share - 1) div x.share,
                  'free', acc.next[i] * {period} div x.share,
                  'i', i)), c -> c.free <= t))),
            p -> named_struct(
              'next', transform(acc.next, (v, i) -> v + if(i = p.i, 1L, 0L)),
              'out', concat(acc.out, array(named_struct('at', t, 'i', p.i, 'turn', acc.next[p.i])))))[0],
          acc -> acc.out) AS o""")
    return steps.selectExpr("s", "inline(o)").selectExpr("s[i].source AS source", "s[i].share AS share", "turn", "at")


def fitting_period(weights: DataFrame, period: int) -> int:
    """``period``, doubled until it is at least twice the number of sources where they are more than its slots."""
    n = weights.count()
    if n <= period:
        return period
    while period < 2 * n:
        period *= 2
    return period


def numbered(docs: DataFrame, source: str, id_col: str) -> DataFrame:
    """(row, src, n): the whole row and its number (from 0) within the source by MD5 of the id, then id; the
    row is packed, so columns of any name are carried."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    own = F.coalesce(F.col(id_col).cast("string"), F.xxhash64(row).cast("string"))  # null ids spread over all buckets
    keyed = docs.select(row.alias("row"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"),
                        F.md5(own.cast("binary")).alias("md5"), F.col(id_col).alias("id")).withColumn("bucket", F.substring("md5", 1, BUCKET_DIGITS))
    counts = keyed.groupBy("src", "bucket").agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("src", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("src", "bucket").orderBy("md5", "id")) - 1
    return keyed.withColumn("rank", rank).join(offsets, ["src", "bucket"]).select("row", "src", (F.col("rank") + F.col("before")).alias("n"))


def root_weights(docs: DataFrame, source: str = "source") -> DataFrame:
    """(source, weight): the square root of the source's documents, rounded up, which lifts small sources."""
    return (docs.groupBy(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"))
            .agg(F.ceil(F.sqrt(F.count("*"))).cast("long").alias("weight")))


def mix(docs: DataFrame, weights: DataFrame | None = None, period: int = 1000, block_docs: int = 16,
        source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with mix_block (number of the block in its source), mix_slot (place of the block in the
    mix), mix_place (place in the block), mix_release and mix_due.  Order by mix_slot, mix_place to read
    the mix.  ``weights`` (source, weight; whole, not negative) must be unique by source; a source
    without one gets the least share."""
    docs = docs.drop("mix_block", "mix_slot", "mix_place", "mix_release", "mix_due")
    own = root_weights(docs, source)
    if weights is not None:
        given = weights.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.col("weight").cast("long").alias("given"))
        own = own.join(given, "source", "left").select("source", F.coalesce("given", F.lit(0)).cast("long").alias("weight"))
    period = fitting_period(own, period)
    plan = schedule(shares(own, period), period)
    each = plan.select(F.col("source").alias("src"), "share").distinct()
    turns = plan.select(F.col("source").alias("src"), "turn", "at")
    out = (numbered(docs, source, id_col).join(F.broadcast(each), "src")  # both have at most ``period`` rows
           .withColumn("mix_block", F.expr(f"n div {block_docs}")).withColumn("mix_place", (F.col("n") % block_docs).cast("int"))
           .withColumn("turn", F.col("mix_block") % F.col("share"))
           .join(F.broadcast(turns), ["src", "turn"])
           .withColumn("mix_slot", F.expr(f"(mix_block div share) * {period} + at"))
           .withColumn("mix_release", F.expr(f"mix_block * {period} div share"))
           .withColumn("mix_due", F.expr(f"((mix_block + 1) * {period} + share - 1) div share")))
    return out.select("row.*", "mix_block", "mix_place", "mix_slot", "mix_release", "mix_due")
