"""Phrase collocation mining by multikey three-way quicksort of suffix pointers (operator 11).

Every word position starts a suffix: the words from there to the end of its piece, ``longest`` at most.
Suffixes are routed by their leading words, so that all suffixes with the same beginning meet in one
group; there pointers to them are sorted by a multikey quicksort that parts at a pivot word into less,
equal and greater.  The size of an equal part after d words is the count of that phrase of d words; a
part of fewer than ``least`` suffixes is abandoned, as no phrase in it can be frequent.

Routing is adaptive, so that frequent words do not make large groups.  A first pass counts the hashes of
the beginnings of one word, two words and so on in a table of fixed size.  A suffix is routed by its
shortest beginning whose hash is not hot (1 / HOT of all suffixes); if even the longest is hot, by a
batch's number as well.  A group then may hold a part of a beginning that is shorter than its route:
such counts are kept however small, and the groups' counts of a phrase are added in the end.  Equal
suffixes of a batch are one row with a weight before the shuffle.

Scores: a phrase with count a cut into parts with counts l and r scores floor(2000000 * a / (l + r)),
in decimals; its lowest-scoring cut counts.  A candidate is dropped that is contained in a longer one
with at least ``part`` per cent of its count.

Pieces end at the signs . , ; : ! ? and line ends; words are what blanks and tabs part.  A null text is
empty, a null language ``und``; repeated rows count each; ids are not read, other columns neither.  An
empty table, or texts without frequent phrases, give no rows.  Long texts are cut into batches of
suffixes, never shortened.  Ties at the last rank are decided by count and then by the phrase's bytes.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, SLICE, written

#: Blank for tab, full stop for every sign that ends a piece, small letters for A to Z.
TO_PIECES = bytes(46 if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b == 9 else LOWER[b] for b in range(256))
END = b"."
BREAK = re.compile(rb"[ .]")
#: Counters a level in the table of hashes.
SLOTS = 1 << 15
#: A beginning is hot from 1 / HOT of all suffixes on.
HOT = 256
#: Suffixes that a batch combines before they are sent, and that a group should hold.
BATCH, GROUP = 300_000, 1_000_000
#: Bytes of a long text that are words at one time.
STRETCH = 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


class Codes(dict):
    """Numbers words as they come; the end of a piece is -1."""

    def __init__(self):
        super().__init__({END: -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 1
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int32, count=len(words))

    def words(self) -> list[bytes]:
        """By number; -1, the last, is the end sign."""
        return [*list(self)[1:], END]


class Suffixes:
    """Suffixes of texts of one language: ``longest`` word numbers each, -1 from the piece's end on."""

    def __init__(self, longest: int, before: list[bytes] = ()):
        self.longest, self.codes, self.parts, self.n, self.tail = longest, Codes(), [], 0, []
        self.add(list(before))

    def add(self, words: list[bytes]) -> None:
        self.parts.append(self.codes.numbers(words))
        self.n += len(words)
        self.tail = (self.tail + words[-self.longest:])[-(self.longest - 1):]

    def rows(self) -> np.ndarray:
        """All suffixes but those of the last ``longest - 1`` words, which begin the next batch."""
        flat = np.concatenate(self.parts)
        if len(flat) < self.longest:
            return np.empty((0, self.longest), dtype=np.int32)
        rows = np.lib.stride_tricks.sliding_window_view(flat, self.longest)
        return rows[rows[:, 0] >= 0]

    def combined(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct suffixes and their weights."""
        rows = self.rows()
        key = rows[:, 0].astype(np.int64)
        for d in range(1, self.longest):  # number the distinct beginnings level by level: exact, in 64 bits
            _, key = np.unique(key * (len(self.codes) + 1) + rows[:, d] + 1, return_inverse=True)
        _, at, weight = np.unique(key, return_index=True, return_counts=True)
        return rows[at], weight

    def hashes(self, rows: np.ndarray, salt: int) -> np.ndarray:
        """A column a level: the hash of the beginning of that many words (of the whole suffix if shorter)."""
        by = np.fromiter((xxhash.xxh3_64_intdigest(w, salt) for w in self.codes.words()), dtype=np.uint64, count=len(self.codes))
        out = np.empty(rows.shape, dtype=np.uint64)
        h = np.full(len(rows), salt, dtype=np.uint64)
        for d in range(self.longest):
            new = (h ^ by[rows[:, d]]) * MIX
            h = np.where(rows[:, d] >= 0, new ^ (new >> np.uint64(29)), h)
            out[:, d] = h
        return out


def _stretches(raw: bytes):
    """The words of a text, some at a time; END stands between pieces."""
    text, at = raw.translate(TO_PIECES), 0
    while at < len(text):
        m = BREAK.search(text, at + STRETCH) if at + STRETCH < len(text) else None
        end = m.start() if m else len(text)
        yield text[at:end]
        at = end


def _batches(batches, longest: int):
    """Suffixes of a language in turn, BATCH or a little more at a time: (lang, Suffixes)."""
    open_: dict[str, Suffixes] = {}
    ends = [END] * (longest - 1)
    between = b" " + b" ".join(ends) + b" "
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            part = whole.slice(at, SLICE)
            for lang, raw in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                s = open_.pop(lang, None) or Suffixes(longest)
                for text in _stretches(raw):
                    s.add(text.replace(END, between).split())
                    if s.n >= BATCH:
                        yield lang, s
                        s = Suffixes(longest, s.tail)
                s.add(ends)
                open_[lang] = s
            while sum(s.n for s in open_.values()) >= 2 * BATCH:  # many languages: the largest goes
                lang = max(open_, key=lambda x: open_[x].n)
                yield lang, open_.pop(lang)
    yield from open_.items()


def _salt(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def hot_table(texts: DataFrame, longest: int) -> tuple[np.ndarray, int]:
    """(levels x SLOTS: is the slot hot, suffixes in all), from counts of the whole table."""
    def run(batches):
        total = np.zeros((longest, SLOTS), dtype=np.int64)
        for lang, s in _batches(batches, longest):
            slots = (s.hashes(s.rows(), _salt(lang)) % np.uint64(SLOTS)).astype(np.int64)
            for d in range(longest):
                total[d] += np.bincount(slots[:, d], minlength=SLOTS)
        level, slot = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(level * SLOTS + slot), pa.array(total[level, slot])], names=["slot", "n"])

    counts = texts.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    counts = written(counts)  # levels x SLOTS rows at most
    total = counts.where(F.col("slot") < SLOTS).agg(F.sum("n")).first()[0] or 0
    hot = np.zeros(longest * SLOTS, dtype=bool)
    for r in counts.where(F.col("n") * HOT >= total).collect():  # levels x HOT rows at most
        hot[r["slot"]] = True
    return hot.reshape(longest, SLOTS), total


def routed(texts: DataFrame, hot: np.ndarray, groups: int, longest: int) -> DataFrame:
    """(lang, route, depth, suffixes, weights): suffixes of a batch that go to one group, packed."""
    bc = texts.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        rng = np.random.default_rng(TaskContext.get().partitionId())  # the same when a lost task runs again
        for lang, s in _batches(batches, longest):
            rows, weight = s.combined()
            if not len(rows):
                continue
            by = s.hashes(rows, _salt(lang))
            slots = (by % np.uint64(SLOTS)).astype(np.int64)
            warm = np.stack([bc.value[d][slots[:, d]] for d in range(longest)], axis=1)
            depth = np.where(warm.all(axis=1), longest, np.argmin(warm, axis=1))  # words of the route, less one
            route = by[np.arange(len(rows)), np.minimum(depth, longest - 1)]
            # hot at every level: dealt by batch
            route = np.where(depth == longest, route ^ np.uint64(rng.integers(1 << 62)), route) % np.uint64(groups)
            key = route.astype(np.int64) * (longest + 1) + depth
            order = np.argsort(key, kind="stable")
            key, weight = key[order], weight[order].astype(np.int64)
            edge = np.flatnonzero(np.diff(key, prepend=-1))
            words = np.array(s.codes.words(), dtype=object)[rows[order]]
            spans = list(zip(edge.tolist(), [*edge[1:].tolist(), len(key)]))
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(edge)), pa.array(key[edge] // (longest + 1)), pa.array((key[edge] % (longest + 1)).astype(np.int32)),
                pa.array([b" ".join(words[a:b].ravel().tolist()) for a, b in spans], pa.binary()),
                pa.array([weight[a:b].tobytes() for a, b in spans], pa.binary())],
                names=["lang", "route", "depth", "suffixes", "weights"])

    return texts.mapInArrow(run, "lang string, route long, depth int, suffixes binary, weights binary")


def multikey_quicksort(rows: np.ndarray, weight: np.ndarray, whole: np.ndarray, least: int):
    """(beginnings, counts): each frequent beginning as a tuple of codes.

    ``rows`` are suffixes as codes, -1 at the end.  ``whole[i]`` is the length from which on all suffixes
    that begin like suffix i are here; shorter beginnings are given whatever their count."""
    found: list[tuple[tuple, int]] = []
    columns = [np.ascontiguousarray(rows[:, d]) for d in range(rows.shape[1])]
    deepest = int(whole.max(initial=0))
    todo = [(np.arange(len(rows)), 0, ())]
    while todo:
        at, d, head = todo.pop()
        symbol = columns[d][at]
        n = len(at)
        pivot = symbol[n // 2] if n < 9 else np.sort(symbol[:: n // 9])[4]
        partial = deepest > d + 1  # some suffix's beginnings of this length may be elsewhere too
        for part in (at[symbol < pivot], at[symbol > pivot]):
            if len(part) and (weight[part].sum() >= least or partial and (whole[part] > d + 1).any()):
                todo.append((part, d, head))
        if pivot < 0:
            continue  # suffixes that end here: counted by their beginnings
        part = at[symbol == pivot]
        size = int(weight[part].sum())
        if size >= least or partial and (whole[part] > d + 1).any():
            here = (*head, int(pivot))
            found.append((here, size))
            if d + 1 < len(columns):
                todo.append((part, d + 1, here))
    return found


def phrase_counts(docs: DataFrame, least: int = 30, longest: int = 4, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) of all phrases of 1 to ``longest`` words with f >= least, (lang, n words))."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hot, total = hot_table(texts, longest)
    sent = routed(texts, hot, max(1, -(-total // GROUP)), longest)

    def count(key, group):
        codes = Codes()
        rows = [codes.numbers(c.as_py().split(b" ")).reshape(-1, longest) for c in group["suffixes"]]
        weight = np.frombuffer(b"".join(group["weights"].to_pylist()), dtype=np.int64)
        whole = np.repeat(group["depth"].to_numpy() + 1, [len(r) for r in rows])
        found = multikey_quicksort(np.concatenate(rows), weight, whole, least)
        words, lang = [w.decode() for w in codes.words()], key[0].as_py()
        return pa.table({
            "lang": pa.array([lang] * (len(found) + 1), pa.string()),
            "phrase": pa.array([" ".join([words[c] for c in p]) for p, _ in found] + [None], pa.string()),
            "words": pa.array([len(p) for p, _ in found] + [0], pa.int32()),
            "f": pa.array([c for _, c in found] + [int(weight.sum())], pa.int64())})  # the last row: words in all

    parts = sent.groupBy("lang", "route").applyInArrow(count, "lang string, phrase string, words int, f long")
    counts = written(parts.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("words") == 0)))
    return counts.where("words > 0"), counts.where("words = 0").select("lang", F.col("f").alias("n"))


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, part: int = 80, top: int = 2000, **columns) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases by score."""
    counts, totals = phrase_counts(docs, least, longest, **columns)
    words = F.split("phrase", " ")
    phrases = counts.where("words > 1").withColumnRenamed("f", "a")
    cuts = phrases.withColumn("w", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"))
    side = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    other = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(side, ["lang", "left"]).join(other, ["lang", "right"]).withColumn(
        "score", F.expr("(CAST(a AS DECIMAL(20,0)) * 2000000) div (CAST(l AS DECIMAL(20,0)) + r)"))
    least_cut = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # of the longer phrases that hold a phrase the most frequent one decides
    inside = phrases.where("words > 2").withColumn("w", words).withColumn("m", F.explode(F.sequence(F.lit(2), F.col("words") - 1))) \
        .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1))) \
        .select("lang", F.array_join(F.expr("slice(w, i, m)"), " ").alias("phrase"), F.col("a").alias("longer")) \
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = least_cut.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | F.expr(f"CAST(longer AS DECIMAL(20,0)) * 100 < CAST(a AS DECIMAL(20,0)) * {int(part)}"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    first = kept.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
