"""Quality by ordinal cumulative-link regression (operator 3).

Grades 0 < 1 < 2 (toxic, poor, good) share one weight vector over hashed text features; ordered
thresholds cut the score: P(grade <= k) = sigmoid(threshold_k - score).  From them come the expected
grade and the tail probability P(grade >= 2) that selection uses.

Fitting takes a bounded sample of the labelled rows: at most ``sample`` of them, those with the
smallest hash of the id, so the draw is stable and independent of the order of rows.  Features in fewer
than ``min_docs`` sampled documents are left out on the executors; the rest goes to the driver, four
bytes a feature and document, where no larger copy of it is made.  Scoring is a map over all documents with the weights in a broadcast
of fixed size.

Null text counts as empty; documents without features get the score 0.  Labels with a null id, or
without both labels, are not used; where an id is labelled twice the lowest grade counts.  With no
labelled rows the model gives every document the same grade.  Other columns are not read.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SLICE, map_batches, id_text, utf8, written

BUCKETS = 1 << 18
GRADES = 3
#: Signs that hang on words in junk text, and punctuation of any prose.
SIGNS = b"%$#*&!@~^|{}<>=_+/"
PUNCTUATION = b".,;:!?\"()'"
#: Steps at which shares of odd words, repeats and non-distinct words become features.
SHARES = (.02, .05, .1, .2, .3, .4, .5, .6, .7, .8, .9)


def bucket(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) % BUCKETS


def features(raw: bytes) -> tuple[list[int], list[int]]:
    """Buckets of the text's distinct words, and buckets of its shape (signs, repeats)."""
    words = raw.translate(LOWER).split()
    n = len(words)
    if not n:
        return [], []
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    seen, tails = set(), {}
    for w, c in counts.items():
        if w[-1] in SIGNS:
            tails[w[-1]] = tails.get(w[-1], 0) + c
            w = w.rstrip(SIGNS)
        w = w.strip(PUNCTUATION)
        if w:
            seen.add(bucket(w))
    shape = [bucket(b"\0sign%d" % ch) for ch, c in tails.items() if c >= .05 * n]
    for name, c in ((b"tail", sum(tails.values())), (b"repeat", repeats), (b"again", n - len(counts))):
        shape += [bucket(b"\0%s%d" % (name, int(100 * q))) for q in SHARES if c >= q * n]
    return sorted(seen), shape


def scale(n_words: int) -> float:
    """Weight of one distinct word among n: long texts hold more of everything."""
    return 1 / np.log(n_words + 2.0)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, words: list[int], shape: list[int]) -> float:
        return float(self.weights[words].sum() * scale(len(words)) + self.weights[shape].sum()) if words or shape else 0.0

    def tails(self, score):
        """P(grade >= k) for k from 1 up."""
        return 1 - sigmoid(self.thresholds - np.asarray(score)[..., None])


def slopes(z: np.ndarray, g: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the documents' summed loss -log P(grade = g): by each score, and by the thresholds."""
    rows = np.arange(len(z))
    below = np.hstack([np.zeros((len(z), 1)), sigmoid(thresholds - z[:, None]), np.ones((len(z), 1))])
    upper, lower = below[rows, g + 1], below[rows, g]
    p = np.maximum(upper - lower, 1e-9)
    slope_u, slope_l = upper * (1 - upper), lower * (1 - lower)
    return (slope_u - slope_l) / p, np.array([(slope_l / p)[g == k + 1].sum() - (slope_u / p)[g == k].sum() for k in range(len(thresholds))])


def fit(at: np.ndarray, index: np.ndarray, words: np.ndarray, value: np.ndarray, grades: np.ndarray, steps: int = 4000,
        batch: int = 64, rate: float = 0.6, ridge: float = 1e-4, seed: int = 0) -> Ordinal:
    """Maximum likelihood by ``steps`` adaptive stochastic gradient steps on the cumulative-link model.

    Document d has the buckets ``index[at[d]:at[d + 1]]``; the first ``words[d]`` of them count
    ``value[d]``, the rest 1.  Only a batch's features are spread out at a time."""
    docs, y = range(len(at) - 1), np.asarray(grades, dtype=np.int64)
    weights, seen = np.zeros(BUCKETS), np.full(BUCKETS, 1e-8)
    share = np.cumsum(np.bincount(y, minlength=GRADES) + 1)[:-1] / (len(y) + GRADES)
    thresholds, seen_t = np.log(share / (1 - share)), np.full(GRADES - 1, 1e-8)
    rng = np.random.default_rng(seed)
    for _ in range(-(-steps // max(1, -(-len(docs) // batch))) if len(docs) else 0):
        order = rng.permutation(len(docs))
        for start in range(0, len(order), batch):
            part = order[start: start + batch]
            i = np.concatenate([index[at[d]: at[d + 1]] for d in part])
            v = np.concatenate([np.where(np.arange(at[d + 1] - at[d]) < words[d], value[d], 1.0) for d in part])
            row = np.repeat(np.arange(len(part)), [at[d + 1] - at[d] for d in part])
            z = np.bincount(row, weights[i] * v, minlength=len(part))
            slope, grad_t = slopes(z, y[part], thresholds)
            used, place = np.unique(i, return_inverse=True)
            grad = np.bincount(place, slope[row] * v, minlength=len(used)) / len(part) + ridge * weights[used]
            seen[used] += grad * grad
            weights[used] -= rate * grad / np.sqrt(seen[used])
            grad_t /= len(part)
            seen_t += grad_t * grad_t
            thresholds = np.sort(thresholds - rate * grad_t / np.sqrt(seen_t))
    return Ordinal(weights, thresholds)


def grade_column():
    """0: toxic, 1: poor, 2: good."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text", **options) -> Ordinal:
    """Fit on at most ``sample`` labelled documents; buckets that fewer than ``min_docs`` of them hold are left
    out by the executors, before anything goes to the driver."""
    graded = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(grade_column()).alias("grade")))
    drawn = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = id_text(docs, id_col, text_col).join(F.broadcast(drawn), "doc_id")  # sample rows at most

    def run(batch):
        found = [features(t) for t in utf8(batch)]
        return {"doc_id": batch.column(0), "grade": batch.column(2), "n_words": [len(w) for w, _ in found], "words": [w for w, _ in found], "shape": [s for _, s in found]}

    found = written(map_batches(rows.select("doc_id", "text", "grade"), run, "doc_id long, grade int, n_words int, words array<int>, shape array<int>"))
    counts = found.select(F.explode(F.array_distinct(F.concat("words", "shape"))).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    often = np.zeros(BUCKETS, dtype=bool)
    often[counts.where(F.col("n") >= min_docs).select("bucket").toArrow()["bucket"].to_numpy()] = True  # BUCKETS rows at most
    bc = docs.sparkSession.sparkContext.broadcast(often)

    def keep(batch):
        words, shape = ([[b for b in row if bc.value[b]] for row in batch.column(i).to_pylist()] for i in (3, 4))
        return {"doc_id": batch.column(0), "grade": batch.column(1), "n_words": batch.column(2), "words": [len(w) for w in words], "buckets": [w + s for w, s in zip(words, shape)]}

    got = map_batches(found, keep, "doc_id long, grade int, n_words int, words int, buckets array<int>").toArrow()
    got = got.take(np.argsort(got["doc_id"].to_numpy(), kind="stable"))
    buckets = got["buckets"].combine_chunks()
    value = 1 / np.log(got["n_words"].to_numpy() + 2.0)
    return fit(buckets.offsets.to_numpy(), buckets.flatten().to_numpy(), got["words"].to_numpy(), value, got["grade"].to_numpy(), **options)


def graded(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, expected_grade, p_good): p_good is the tail probability P(grade >= 2)."""
    bc = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights

    def run(batch):
        m = bc.value
        score = np.array([m.score(*features(t)) for t in utf8(batch)])
        tails = m.tails(score)
        return {"doc_id": batch.column(0), "score": score, "expected_grade": tails.sum(axis=1), "p_good": tails[:, -1]}

    return map_batches(id_text(docs, id_col, text_col), run, "doc_id long, score double, expected_grade double, p_good double")


def select_good(docs: DataFrame, model: Ordinal, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) whose P(grade >= 2) is ``least`` or more."""
    bc = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                raw = part.column(place).cast(pa.binary()).to_pylist()
                tails = bc.value.tails(np.array([bc.value.score(*features(t or b"")) for t in raw]))
                yield part.filter(pa.array(tails[:, -1] >= least))

    return docs.mapInArrow(run, docs.schema)
