"""Substring dedup by repeated-phrase automata (operator 2).

A window of ``window`` consecutive words is removed from a document if the same words also start in a
document with a smaller id.

1. *Confirm recurring phrases.*  A window's anchor is its phrase of ``phrase`` words with the smallest
   hash, so equal windows have equal anchors.  Distinct (anchor, document) pairs are grouped: an anchor
   in two documents or more recurs, and its owner is the document with the smallest id.
2. *Compile sharded automata.*  Owners send the passages around their recurring anchors to shards by
   owner.  Each shard compiles an Aho-Corasick automaton of its recurring phrases (word by word) and
   a table of its passages' windows.
3. *Stream.*  Every document with a recurring anchor sends its stretches to the owners' shards, where
   the automaton locates the phrases; windows round them are looked up in the passages.  Documents
   without a recurring anchor cannot hold a repeated window.
   Equal hashes are confirmed word by word.
4. *The rest.*  Windows that share a phrase with the owner and yet are not in its passage may repeat
   among other documents; they are grouped by a 128-bit hash of their words, and the smallest id is compared.

A shard that many documents need is split by document id, so exact copies spread over its parts; its
passages are sent to each part.  Texts are
shuffled only for documents that hold a recurring anchor, after one join by id.

Null or empty texts have no words.  Rows with a null id count as larger than every id.  Rows that repeat
an id are judged by their own text; equal rows get equal results.  Texts shorter than a window lose
nothing; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE, id_text, sha, utf8, written

MAX_ID = (1 << 63) - 1
#: Recurring anchors (of all documents) that one part of a shard takes on average.
PART_ANCHORS = 20_000

_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_powers: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i modulo 2^64 for i < n."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for j, base in enumerate((_P, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[j] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` words, by prefix sums of a polynomial and a mix."""
    n = len(hashes)
    if n < length:
        return np.zeros(0, np.uint64)
    up, down = powers(n)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up)])
    x = (total[length:] - total[:-length]) * down[: n - length + 1]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    if len(x) < width:
        return np.zeros(0, x.dtype)
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    more = width - size
    return np.minimum(x[: len(x) - more], x[more:]) if more else x


def anchors_of(hashes: np.ndarray, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrase hashes by position, anchor by window)."""
    grams = run_hashes(hashes, phrase)
    return grams, sliding_min(grams, window - phrase + 1)


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _batch(cols: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in schema], schema=schema)


def summaries(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """Per row of (doc_id, text): key, text hash, words, hash of all words and the distinct anchors."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("th", pa.int64()), ("n_words", pa.int64()), ("sha", pa.string()), ("anchors", pa.list_(pa.int64()))])

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                cols = {f.name: [] for f in schema} | {"doc_id": batch.column(0), "key": batch.column(0).fill_null(MAX_ID)}
                for raw in utf8(batch):
                    words = raw.split()
                    _, anchor = anchors_of(word_hashes(words), window, phrase)
                    cols["th"].append(text_key(raw))
                    cols["n_words"].append(len(words))
                    cols["sha"].append(sha(b" ".join(words)))
                    cols["anchors"].append(np.unique(anchor).view(np.int64))
                yield _batch(cols, schema)

    return docs.mapInArrow(run, "doc_id long, key long, th long, n_words long, sha string, anchors array<long>")


def text_key(raw: bytes) -> int:
    """What Spark's xxhash64 gives for the text."""
    x = xxhash.xxh64_intdigest(raw, 42)
    return x - (1 << 64) if x >> 63 else x


def shard_of(owner: np.ndarray, shards: int) -> np.ndarray:
    x = owner.astype(np.uint64) * np.uint64(_P)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(shards)).astype(np.int64)


SEGMENT = pa.schema([("shard", pa.int64()), ("part", pa.int64()), ("owned", pa.bool_()), ("key", pa.int64()), ("th", pa.int64()),
                     ("start", pa.int64()), ("words", pa.binary()), ("phrases", pa.list_(pa.int32()))])


def segments(marked: DataFrame, window: int, phrase: int, shards: int, parts) -> DataFrame:
    """Stretches of the documents in ``marked``: owned passages (with their phrases' places) to every part
    of the owner's shard, others to one part of each owner's shard."""
    def run(batches):
        split = parts.value
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                cols = {f.name: [] for f in SEGMENT}

                def add(shard, part, owned, key, th, start, words, phrases):
                    for name, v in zip(cols, (shard, part, owned, key, th, start, words, phrases)):
                        cols[name].append(v)

                for key, raw, found in zip(batch.column(0).to_pylist(), utf8(batch), batch.column(2)):
                    words, th = raw.split(), text_key(raw)
                    grams, anchor = anchors_of(word_hashes(words), window, phrase)
                    found = found.values
                    known = found.field("anchor").to_numpy().view(np.uint64)
                    owner = found.field("owner").to_numpy()
                    order = np.argsort(known)
                    known, owner = known[order], owner[order]
                    place = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
                    recurs = known[place] == anchor
                    own = recurs & (owner[place] == key)
                    for s, e in runs(own):
                        mine = np.unique(anchor[s:e])
                        phrases = np.flatnonzero(np.isin(grams[s: e + window - phrase], mine)).astype(np.int32)
                        text = b" ".join(words[s: e + window - 1])
                        shard = int(shard_of(np.array([key]), shards)[0])
                        for part in range(split.get(shard, 1)):
                            add(shard, part, True, key, th, s, text, phrases)
                    to = np.where(recurs & ~own, shard_of(owner[place], shards), -1)
                    cut = np.flatnonzero(np.diff(np.concatenate([[-1], to, [-1]])))
                    for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
                        if to[s] >= 0:
                            shard = int(to[s])
                            add(shard, int(shard_of(np.array([key]), split.get(shard, 1))[0]), False, key, th, s, b" ".join(words[s: e + window - 1]), None)
                yield _batch(cols, SEGMENT)

    return marked.mapInArrow(run, "shard long, part long, owned boolean, key long, th long, start long, words binary, phrases array<int>")


FOUND = pa.schema([("key", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("hash", pa.binary())])


def stream_shard(table: pa.Table, window: int, phrase: int) -> pa.Table:
    """One part of a shard.  Rows out: stretches of removed windows (start, stop in words), and windows
    left to step 4 (hash not null)."""
    owned = np.array(table["owned"].to_pylist(), dtype=bool)
    rows = table.select(["key", "th", "start", "words", "phrases"]).to_pylist()
    code: dict[bytes, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    hashes, owners, at, passage = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    owned_words = []
    for i in np.flatnonzero(owned):
        words = rows[i]["words"].split()
        ids = [code.setdefault(w, len(code) + 1) for w in words]
        for p in rows[i]["phrases"]:
            automaton.add_word(tuple(ids[p: p + phrase]))
        hashes.append(run_hashes(word_hashes(words), window))
        owners.append(np.full(len(hashes[-1]), rows[i]["key"]))
        at.append(np.arange(len(hashes[-1])))
        passage.append(np.full(len(hashes[-1]), len(owned_words)))
        owned_words.append(words)
    known, owner, at, passage = (np.concatenate(x) for x in (hashes, owners, at, passage))
    order = np.lexsort((owner, known))
    known, owner, at, passage = known[order], owner[order], at[order], passage[order]
    first = np.concatenate([[True], known[1:] != known[:-1]]) if len(known) else np.zeros(0, bool)
    known, owner, at, passage = known[first], owner[first], at[first], passage[first]
    automaton.make_automaton()
    cols = {f.name: [] for f in FOUND}

    def add(*values):
        for name, v in zip(cols, values):
            cols[name].append(v)

    for i in np.flatnonzero(~owned):
        r = rows[i]
        words = r["words"].split()
        mine = run_hashes(word_hashes(words), window)
        near = np.zeros(len(words) + 1, dtype=np.int64)  # windows that hold a located phrase
        if len(automaton):
            for end, _ in automaton.iter(tuple(map(code.get, words, repeat(0)))):
                near[max(0, end + 1 - window)] += 1
                near[end - phrase + 2] -= 1
        near = np.cumsum(near)[: len(mine)] > 0
        hit = np.zeros(len(mine), dtype=bool)
        if len(known):
            place = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            hit = near & (known[place] == mine) & (owner[place] < r["key"])
            last = (-1, -1)  # equal hashes are confirmed by words: all of a window's, or the last after an equal window
            for p in np.flatnonzero(hit).tolist():
                there, q = int(passage[place[p]]), int(at[place[p]])
                theirs, step = owned_words[there], window - 1 if last == (p - 1, (there, q - 1)) else 0
                hit[p] = words[p + step: p + window] == theirs[q + step: q + window]
                last = (p, (there, q)) if hit[p] else (-1, -1)
        for s, e in runs(hit):
            add(r["key"], r["th"], r["start"] + s, r["start"] + e + window - 1, None)
        for p in np.flatnonzero(~hit).tolist():
            add(r["key"], r["th"], r["start"] + p, r["start"] + p + window, xxhash.xxh3_128_digest(b" ".join(words[p: p + window])))
    return pa.table([pa.array(cols[f.name], f.type) for f in FOUND], schema=FOUND)


def repeated_spans(docs: DataFrame, window: int = 50, phrase: int = 16) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summaries, marked documents, spans): spans (key, th, start, stop) of words to remove; marked
    (key, text, found, th) are the documents with recurring anchors."""
    spark = docs.sparkSession
    base = written(summaries(docs, window, phrase))
    # a row is told by its id and its text, so rows that repeat an id, or have none, keep lists of their own
    pairs = base.select("key", "th", F.explode("anchors").alias("anchor"))
    recurring = pairs.groupBy("anchor").agg(F.min("key").alias("owner"), F.max("key").alias("last")).where("owner < last").select("anchor", "owner")
    by_doc = written(pairs.join(recurring, "anchor").groupBy("key", "th").agg(F.collect_set(F.struct("anchor", "owner")).alias("found")))
    own = F.col("f.owner")
    total = by_doc.agg(F.sum(F.size("found"))).first()[0] or 0
    shards = max(1, total // PART_ANCHORS)

    def count(batches):  # anchors by shard, with the same hash as the segments
        for batch in batches:
            owner = batch.column(0).to_numpy()
            shard, n = np.unique(shard_of(owner, shards), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(n)], names=["shard", "n"])

    sizes = by_doc.select(F.explode("found").alias("f")).select(own.alias("owner")).mapInArrow(count, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("n"))
    # One number for each shard that is much too large: fewer than total / PART_ANCHORS.
    large = sizes.where(F.col("n") > 2 * PART_ANCHORS).collect()
    parts = spark.sparkContext.broadcast({r["shard"]: -(-r["n"] // PART_ANCHORS) for r in large})
    keyed = docs.select(F.coalesce("doc_id", F.lit(MAX_ID)).alias("key"), F.xxhash64("text").alias("th"), "text")
    marked = written(keyed.join(by_doc, ["key", "th"]).select("key", "text", "found", "th"))
    found = written(segments(marked, window, phrase, shards, parts).groupBy("shard", "part")
                    .applyInArrow(lambda t: stream_shard(t, window, phrase), "key long, th long, start long, stop long, hash binary"))
    rest = found.where("hash is not null")
    least = rest.groupBy("hash").agg(F.min("key").alias("least"), F.max("key").alias("last")).where("least < last").select("hash", "least")
    late = rest.join(least, "hash").where("key > least")
    spans = found.where("hash is null").select("key", "th", "start", "stop").unionByName(late.select("key", "th", "start", "stop"))
    return base, marked, spans


def kept_words(words: list[bytes], spans) -> list[bytes]:
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for s, e in spans:
        gone[s] += 1
        gone[e] -= 1
    keep = np.cumsum(gone)[:-1] == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def substring_dedup(docs: DataFrame, window: int = 50, phrase: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_words, n_removed and the hash of the words that stay, joined by a blank;
    ``kept`` is null for documents that keep all their words, else the text that stays."""
    base, marked, spans = repeated_spans(id_text(docs, id_col, text_col), window, phrase)
    cuts = spans.groupBy("key", "th").agg(F.collect_list(F.struct("start", "stop")).alias("cuts"))
    schema = pa.schema([("key", pa.int64()), ("th", pa.int64()), ("n_removed", pa.int64()), ("new_sha", pa.string()), ("kept", pa.string())])

    def apply(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                cols = {f.name: [] for f in schema} | {"key": batch.column(0), "th": batch.column(1)}
                for raw, cut in zip(utf8(batch), batch.column(3)):
                    words = raw.split()
                    c = cut.values
                    kept = kept_words(words, zip(c.field("start").to_pylist(), c.field("stop").to_pylist()))
                    text = b" ".join(kept)
                    cols["n_removed"].append(len(words) - len(kept))
                    cols["new_sha"].append(sha(text))
                    cols["kept"].append(text.decode())
                yield _batch(cols, schema)

    changed = marked.select("key", "th", "text").join(cuts, ["key", "th"]).select("key", "th", "text", "cuts").mapInArrow(apply, "key long, th long, n_removed long, new_sha string, kept string")
    changed = changed.dropDuplicates(["key", "th"])  # equal rows have equal results
    return base.join(changed, ["key", "th"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("new_sha", "sha").alias("kept_sha256"), "kept")
