"""Duplicate removal.

Semantics (greedy keep-first): rows are taken in ``order`` order; a row
is dropped iff it matches an earlier *kept* row, where "matches" means it
shares an identifier value (doi / pmid / pmcid, kinds mixed) or the
indel ratio of the lower-cased titles is >= threshold.  This is not
connected components: with A~B, B~C and A!~C, A and C are both kept.

Plan:
* J5 finds similar *distinct* lower titles block against block
  (``title_blocks``); only what cheap tests leave is compared exactly.
* Identifiers and exact titles are hub keys ``(row, key)``: a hot key is
  aggregated (min position per key, map-side combined), never expanded
  into pairs.
  Joins on them are plain, so the skew join can split a hot key.
* D1 decides the rows in blocks by position, each ``GROWTH`` - 1 times as large as all before it.
  A block first loses the rows that match a row kept before it; only what is
  left is compared with itself.  So a cluster of many similar titles is
  joined with its kept leaders and its pairs are never listed.
* Inside a block, a bounded prefix of the undecided rows is decided in order
  in one task (after those are dropped that match a row kept by a round), and
  all others by rounds (drop a row with a kept earlier neighbour; keep one
  without an undecided earlier neighbour), so that neither one long chain nor
  many short ones take many rounds.
  Each round's state is checkpointed to the shared checkpoint folder.
"""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import truthy
from ..session import cut_lineage, materialise
from . import segments

ID_COLS = ("doi", "pmid", "pmcid")
MIN_THRESHOLD = 70
#: Rows of the first block, and undecided rows that one task decides in a round.
BLOCK = 2048
#: Rows decided after a block, as a multiple of those before it: every block costs some tens of jobs, whatever its size.
GROWTH = 4


def _checked(threshold: int) -> None:
    if threshold < MIN_THRESHOLD:
        raise ValueError(f"a threshold under {MIN_THRESHOLD} leaves too few shared segments to find pairs by")


def similar_titles(titles: DataFrame, threshold: int = vocab.TITLE_SIMILARITY_THRESHOLD,
                   col: str = "t") -> DataFrame:
    """Pairs (a, b, ratio) of distinct strings with a < b and ratio >= threshold."""
    _checked(threshold)
    # the distinct titles feed the frequencies and both sides of the join
    t = cut_lineage(titles.select(F.col(col).alias("t")).filter(F.col("t").isNotNull()).distinct())
    return segments.self_pairs(t, threshold)


def similar_to(new: DataFrame, known: DataFrame, threshold: int = vocab.TITLE_SIMILARITY_THRESHOLD) -> DataFrame:
    """J5 between two sets of distinct strings (column t): (a, b, ratio) with a
    from ``new`` and b from ``known``; ``known`` is never joined with itself."""
    _checked(threshold)
    return segments.cross_pairs(cut_lineage(new), cut_lineage(known), threshold)


def row_keys(df: DataFrame, order: str = "pos", title: str = "title") -> DataFrame:
    """(pos, key) hub memberships: identifier values (kinds mixed) and the
    exact lower title."""
    ids = [F.when(truthy(c), F.concat(F.lit("id:"), F.col(c))) for c in ID_COLS if c in df.columns]
    keys = F.array_compact(F.array(*ids, F.concat(F.lit("t:"), F.lower(F.coalesce(F.col(title), F.lit(""))))))
    return df.select(F.col(order).alias("pos"), F.explode(keys).alias("key")).distinct()


def _title_key(c) -> Column:
    return F.concat(F.lit("t:"), F.col(c))


def _in_order(prefix: DataFrame, near: DataFrame) -> DataFrame:
    """(pos, st) of the rows ``prefix`` (pos, key), decided one after another in one task: 1 kept, 2 dropped.

    ``near`` holds (key, nkey) of similar titles among them.  The caller bounds the rows."""
    def decide(table):
        every = pa.chunked_array([*table["key"].chunks, *table["nkey"].chunks], pa.string()).combine_chunks()
        code = every.dictionary_encode().indices.fill_null(-1).to_numpy()
        own, other = code[: table.num_rows], code[table.num_rows:]
        pos, pair = table["pos"].fill_null(0).to_numpy(), table["pos"].is_null().to_numpy()
        rows: dict = {}
        similar: dict = {}
        for p, k in zip(pos[~pair].tolist(), own[~pair].tolist()):
            rows.setdefault(p, []).append(k)
        for a, b in zip(own[pair].tolist(), other[pair].tolist()):
            similar.setdefault(a, []).append(b)
            similar.setdefault(b, []).append(a)
        taken: set = set()
        state = []
        for p in sorted(rows):
            drop = not taken.isdisjoint(rows[p])
            state.append(2 if drop else 1)
            if not drop:
                for k in rows[p]:
                    taken.add(k)
                    taken.update(similar.get(k, ()))
        return pa.table({"pos": pa.array(sorted(rows), pa.int64()), "st": pa.array(state, pa.int32())})

    rows = prefix.select("pos", "key", F.lit(None).cast("string").alias("nkey"))
    pairs = near.select(F.lit(None).cast("long").alias("pos"), "key", "nkey")
    return rows.unionByName(pairs).withColumn("task", F.lit(0)).groupBy("task").applyInArrow(decide, "pos long, st int")


def _first_kept(base: DataFrame, title: str, threshold: int) -> DataFrame:
    """The rows of ``base`` (pos, title and identifiers; materialised) that no earlier kept row of it matches."""
    keys = row_keys(base, "pos", title)
    titles = base.select(F.lower(F.coalesce(F.col(title), F.lit(""))).alias("t"))
    sims = cut_lineage(similar_titles(titles, threshold))  # feeds several branches
    near = sims.select(_title_key("a").alias("key"), _title_key("b").alias("nkey"))
    # rows connected to anything: a key shared by >1 row, or a title with similar titles
    shared = keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    linked = shared.unionByName(near.select("key")).unionByName(near.select(F.col("nkey").alias("key"))).distinct()
    active = keys.join(linked, "key", "left_semi").select("pos").distinct()
    keys = cut_lineage(keys.join(active, "pos", "left_semi"))
    both = near.unionByName(near.select(F.col("nkey").alias("key"), F.col("key").alias("nkey")))
    state = None  # pos, st: 1 kept, 2 dropped; None: all undecided
    left = keys.select("pos").distinct()
    while not left.isEmpty():
        # the first undecided rows, in order
        prefix = left.orderBy("pos").limit(BLOCK)
        part = keys.join(F.broadcast(prefix), "pos", "left_semi")  # BLOCK rows
        dead = None
        if state is not None:
            # rows kept by the round before have not yet dropped those they match
            taken = keys.join(state.where("st = 1"), "pos", "left_semi").select("key").distinct()
            taken = taken.unionByName(both.join(taken, "key", "left_semi").select(F.col("nkey").alias("key")))
            dead = part.join(taken, "key", "left_semi").select("pos").distinct()
            part = part.join(dead, "pos", "left_anti")
        own = part.select("key").distinct()
        pairs = near.join(own, "key", "left_semi").join(own.withColumnRenamed("key", "nkey"), "nkey", "left_semi")
        done = _in_order(part, pairs)
        state = cut_lineage(done if state is None else state.unionByName(done).unionByName(dead.select("pos", F.lit(2).alias("st"))))
        left = cut_lineage(keys.select("pos").distinct().join(state, "pos", "left_anti"))
        if left.isEmpty():
            break
        # all other rows: one round of smallest earlier neighbours, undecided (mu) and kept (mk)
        live = left.withColumn("st", F.lit(0)).unionByName(state.where("st = 1"))
        by_key = keys.join(live, "pos").groupBy("key").agg(F.min(F.when(F.col("st") == 0, F.col("pos"))).alias("mu"),
                                                           F.min(F.when(F.col("st") == 1, F.col("pos"))).alias("mk"))
        via = both.join(by_key.withColumnRenamed("key", "nkey"), "nkey").select("key", "mu", "mk")
        all_keys = by_key.unionByName(via).groupBy("key").agg(F.min("mu").alias("mu"), F.min("mk").alias("mk"))
        row = keys.join(left, "pos", "left_semi").join(all_keys, "key").groupBy("pos").agg(F.min("mu").alias("mu"), F.min("mk").alias("mk"))
        decided = row.select("pos", F.when(F.col("mk") < F.col("pos"), 2).when(F.col("mu") >= F.col("pos"), 1).alias("st")).where("st IS NOT NULL")
        state = cut_lineage(state.unionByName(decided))
        left = cut_lineage(left.join(state, "pos", "left_anti"))
    return base if state is None else base.join(state.where("st = 2"), "pos", "left_anti")


def _unmatched(rows: DataFrame, kept: DataFrame, title: str, threshold: int) -> DataFrame:
    """``rows`` that share no key and no similar title with a row of ``kept``."""
    hub = row_keys(kept, "pos", title).select("key").distinct()
    lower = F.lower(F.coalesce(F.col(title), F.lit("")))
    same = row_keys(rows, "pos", title).join(hub, "key", "left_semi").select("pos").distinct()
    out = cut_lineage(rows.join(same, "pos", "left_anti"))
    near = similar_to(out.select(lower.alias("t")).distinct(), kept.select(lower.alias("t")).distinct(), threshold).select(F.col("a").alias("_t")).distinct()
    return out.join(near, lower == F.col("_t"), "left_anti")


def deduplicate(df: DataFrame, order: str = "pos", title: str = "title",
                threshold: int = vocab.TITLE_SIMILARITY_THRESHOLD,
                registry: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Rows of ``df`` that survive greedy keep-first deduplication.

    ``order`` must be unique whole numbers.  With ``registry`` (S8 output of earlier
    runs) rows matching a registered key or title are dropped first (J7).
    ``block`` is the number of rows of the first block; each later one multiplies the rows decided by ``GROWTH``.
    """
    # the input is evaluated once: only order, title and identifiers take part, the rest is read again at the end
    ids = [c for c in ID_COLS if c in df.columns]
    if set(df.columns) - {order, title, *ids}:
        df = materialise(df)
    base = df.select(F.col(order).cast("long").alias("pos"), title, *ids)
    if registry is not None:
        base = drop_seen(base, registry, threshold=threshold, title=title)
    base = cut_lineage(base)
    n = base.count()
    edges, share = [], block / max(n, 1)
    while share < 1:
        edges.append(share)
        share *= GROWTH
    # a rough cut is enough: the blocks' sizes change the work, not the result
    bounds = sorted(set(base.approxQuantile("pos", edges, 0.1 * block / n))) if edges else []
    kept = None
    for low, high in zip([None, *bounds], [*bounds, None]):
        rows = base
        if low is not None:
            rows = rows.where(F.col("pos") > int(low))
        if high is not None:
            rows = rows.where(F.col("pos") <= int(high))
        if kept is not None:
            rows = _unmatched(rows, kept, title, threshold)
        rows = _first_kept(cut_lineage(rows) if kept is not None else rows, title, threshold)
        kept = rows if kept is None and high is None else cut_lineage(rows if kept is None else kept.unionByName(rows))
    out = kept.withColumnRenamed("pos", order) if order != "pos" else kept
    if set(df.columns) <= set(out.columns) and df.schema[order].dataType == out.schema[order].dataType:
        # nothing beyond the materialised slim columns: no upstream recompute
        return out.select(*df.columns)
    return df.join(out.select(order), order, "left_semi")


def seen_registry(df: DataFrame, article_id_col: str = "article_id", title: str = "title") -> DataFrame:
    """Keys of kept articles (one shared set of id values + lower titles)."""
    cols = [F.struct(F.lit("id").alias("key_kind"), F.col(c).alias("key")) for c in ID_COLS if c in df.columns]
    cols.append(F.struct(F.lit("title").alias("key_kind"), F.lower(F.col(title)).alias("key")))
    out = df.select(F.col(article_id_col).alias("article_id"), F.inline(F.array(*cols)))
    return out.filter(truthy("key")).select("key_kind", "key", "article_id").dropDuplicates(["key_kind", "key"])


def drop_seen(df: DataFrame, registry: DataFrame, threshold: int = vocab.TITLE_SIMILARITY_THRESHOLD,
              title: str = "title") -> DataFrame:
    """Drop rows matching an earlier run's registry (id value, exact or
    similar title)."""
    ids = registry.filter(F.col("key_kind") == "id").select(F.col("key").alias("_k")).distinct()
    out = df
    for c in ID_COLS:
        if c in df.columns:
            out = out.join(ids, F.col(c) == F.col("_k"), "left_anti")
    reg_t = registry.filter(F.col("key_kind") == "title").select(F.col("key").alias("t")).distinct()
    new_t = out.select(F.lower(F.col(title)).alias("t")).filter(F.col("t").isNotNull()).distinct()
    bad = similar_to(new_t, reg_t, threshold).select(F.col("a").alias("t")).unionByName(reg_t).distinct()
    return out.join(bad, F.lower(F.col(title)) == F.col("t"), "left_anti")
