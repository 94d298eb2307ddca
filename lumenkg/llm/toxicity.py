"""Toxicity by weak supervision (operator 13).

Many voters look at a text, each of them weak: lexicon voters (does the text hold a word, or a word that
begins with letters, of one list?) and pattern voters (shouting, exclamation, masked letters and so on).
A generative label model explains their votes by a hidden label: each voter has a chance to vote under
either label, and depends on one other voter besides, where the two are correlated beyond the label.  Its
accuracies and correlations are estimated by expectation maximisation over the vote patterns of all
documents.  The posterior labels of a bounded sample train a logistic regression on words and beginnings
of words, whose scale and threshold the sample's known labels then set; that linear classifier scores all
documents, also where no voter speaks.

Labels are read only from rows that are not held out (crc32 of the id's text, modulo ``folds``, is not 0),
and only from ``sample`` of them, those with the smallest hash of the id: two thirds fill the lexicons,
the rest fix the label model's meaning (their label is known in the expectation step).  Held-out
documents are only scored.  Labels, language, source and id are no inputs of a score.

Spark counts: features by grouped sums that are combined before the shuffle, vote patterns likewise, and
an expectation step is one map over the pattern table with one grouped sum.  The driver holds lexicons
and classifier of at most ``size`` entries each and the voters' pairwise counts.

A null text is an empty one and gets the score of a text without features; a null id counts as the empty
text (held out).  Where an id is labelled twice the higher label counts; labels that are null are not
used.  Repeated rows are scored each and count each.  Without labels the fixed lists and patterns alone
vote; where all posterior labels agree, every document gets the prior.  An empty table gives an empty
result.  Long texts are read in stretches.  Scores are rounded to six places, as sums depend on their
order in the last ones.
"""
from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, written

WORD = re.compile(r"[^\W\d_]+")
#: Letters of the beginnings that are features beside whole words.
BEGINNINGS = (3, 4, 5, 6)
KINDS = ("w", *map(str, BEGINNINGS))
#: Lists that the entries of a kind are dealt to, by their first three letters.
LISTS = 4
#: Characters of a long text that are words at one time.
STRETCH = 1 << 20

# Common insults, a list a language.
INSULTS = (
    "idiot idiots stupid moron loser dumb trash scum worthless pathetic disgusting clown fool imbecile jerk",
    "idiot trottel dumm dumme dummkopf blödmann depp abschaum wertlos widerlich versager arschloch",
    "idiot idiote imbécile crétin débile abruti minable connard dégoûtant nul ordure",
    "idiota idiotas imbécil estúpido estúpida tonto basura escoria asqueroso inútil patético",
)
# Patterns of heated texts; a voter votes when its pattern is found.
PATTERNS = (
    r"!\s*!",
    r"[?!]{2,}",
    r"\b(?:you are|you're|ur) (?:a|an|such|so)\b|\bdu bist (?:ein|so)\b|\btu es (?:un|une|si)\b|\beres (?:un|una|tan)\b",
    r"[^\W\d_][*#@$]+[^\W\d_]",
    r"\bshut up\b|\bhalt die klappe\b|\bta gueule\b|\bcállate\b",
)
FOUND = tuple(re.compile(p, re.I) for p in PATTERNS)
#: A pattern is looked for only in texts that hold one of these, in small letters.
HINTS = (("!",), ("!!", "!?", "?!", "??"), ("you are ", "you're ", "ur ", "du bist ein", "du bist so", "tu es ", "eres "), ("*", "#", "@", "$"),
         ("shut up", "klappe", "gueule", "cállate"))
DRAWN = re.compile(r"([^\W\d_])\1\1")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]{4,}")


def held_out(id_col: str, folds: int) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == 0


def stretches(text: str):
    at = 0
    while at < len(text):
        end = text.find(" ", at + STRETCH) if at + STRETCH < len(text) else -1
        end = end if end >= 0 else len(text)
        yield text[at:end]
        at = end


def tokens_of(text: str) -> set[str]:
    """What blanks part, in small letters; each holds no, one or more words."""
    out: set[str] = set()
    for part in stretches(text):
        out.update(part.lower().split())
    return out


def features_of(token: str) -> list[str]:
    """Each word of a token, and its beginnings."""
    return [f for w in WORD.findall(token) for f in ("w:" + w, *[f"{k}:{w[:k]}" for k in BEGINNINGS if len(w) >= k])]


class Lookup:
    """Numbers of the features that a token has among ``names``; tokens met before are remembered.

    ``extra(token)`` may add further numbers."""

    def __init__(self, names: list[str], extra=None):
        self.words = {n[2:]: i for i, n in enumerate(names) if n[0] == "w"}
        self.begins = {n[2:]: i for i, n in enumerate(names) if n[0] != "w"}  # their length tells the kind
        self.known: dict[str, tuple[int, ...]] = {}
        self.extra = extra

    def of(self, token: str) -> tuple[int, ...]:
        found = set(self.extra(token)) if self.extra else set()
        for w in (token,) if token.isalpha() else WORD.findall(token):
            if w in self.words:
                found.add(self.words[w])
            for k in BEGINNINGS:
                if len(w) < k:
                    break
                if w[:k] in self.begins:
                    found.add(self.begins[w[:k]])
        return tuple(found)

    def __call__(self, text: str) -> set[int]:
        found: set[int] = set()
        known = self.known
        for w in tokens_of(text):
            got = known.get(w)
            if got is None:
                if len(known) > 200_000:
                    known.clear()
                got = known[w] = self.of(w)
            if got:
                found.update(got)
        return found


@dataclass
class Voters:
    """``entries``: lexicon entries, with the voter of each in ``voter``."""
    entries: list[str]
    voter: list[int] = field(default_factory=list)
    count: int = 0

    @staticmethod
    def of(learnt: list[str]) -> "Voters":
        """A voter for each fixed list, for each kind and list of learnt entries, and for each pattern."""
        entries, voter = [], []
        for v, words in enumerate(INSULTS):
            entries += ["w:" + w for w in words.split()]
            voter += [v] * len(words.split())
        for name in learnt:
            kind, letters = name.split(":", 1)
            entries.append(name)
            voter.append(len(INSULTS) + KINDS.index(kind) * LISTS + sum(map(ord, letters[:3])) % LISTS)
        return Voters(entries, voter, len(INSULTS) + len(KINDS) * LISTS + len(PATTERNS) + 2)

    def caster(self):
        """text -> votes as bits.  The last voters are the patterns, drawn-out letters and capitals."""
        lookups = {}
        for name, v in zip(self.entries, self.voter):
            lookups[name] = lookups.get(name, 0) | 1 << v
        bits = [*lookups.values(), 1 << (self.count - 2)]
        lookup = Lookup(list(lookups), lambda token: (len(lookups),) if DRAWN.search(token) else ())
        first = self.count - len(FOUND) - 2

        def cast(text: str) -> int:
            votes = 0
            for i in lookup(text):
                votes |= bits[i]
            for part in stretches(text):
                lower = part.lower()
                for j, (hints, pattern) in enumerate(zip(HINTS, FOUND)):
                    if not votes >> (first + j) & 1 and any(h in lower for h in hints) and pattern.search(part):
                        votes |= 1 << (first + j)
                if lower != part and len(CAPITALS.findall(part)) * 10 > part.count(" ") + 1:
                    votes |= 1 << (self.count - 1)
            return votes

        return cast


def unpack(votes: np.ndarray, m: int) -> np.ndarray:
    return (votes[:, None] >> np.arange(m, dtype=np.int64) & 1).astype(float)


@dataclass
class LabelModel:
    """P(label) and, for each voter, P(vote | label, vote of its parent); parent -1: no correlated voter."""
    prior: float
    parent: np.ndarray
    chance: np.ndarray  # voter x label x parent's vote

    def log_odds(self, v: np.ndarray) -> np.ndarray:
        """Log odds of label 1 by the votes (rows of 0 and 1)."""
        up = np.where(self.parent >= 0, v[:, np.maximum(self.parent, 0)], 0).astype(int)
        j = np.arange(v.shape[1])
        p0, p1 = self.chance[j, 0, up], self.chance[j, 1, up]
        each = np.where(v > 0, np.log(p1) - np.log(p0), np.log1p(-p1) - np.log1p(-p0))
        return np.log(self.prior) - np.log1p(-self.prior) + each.sum(axis=1)

    def accuracies(self, n: np.ndarray) -> np.ndarray:
        """P(voter agrees with the label) by pairwise counts ``n``."""
        by = n.diagonal(axis1=1, axis2=2)
        right = by[1, :-1] + by[0, -1] - by[0, :-1]
        return right / n[:, -1, -1].sum()


def posterior(model: LabelModel, v: np.ndarray, label: np.ndarray) -> np.ndarray:
    """P(label 1), by the votes; a known label (0 or 1, -1: unknown) is believed."""
    q = 1 / (1 + np.exp(-np.clip(model.log_odds(v), -30, 30)))
    return np.where(label < 0, q, np.where(label == 1, 0.99, 0.01))


def estimate(n: np.ndarray, correlated: float) -> LabelModel:
    """Maximisation: ``n[y, i, j]`` counts votes i and j together under label y; the last index always votes.

    Voters whose mutual information given the label is over ``correlated`` are joined to a tree that keeps
    the most of it; each voter then depends on its parent in the tree."""
    total = n[:, -1, -1]
    m = n.shape[1] - 1
    info = np.zeros((m, m))
    for y in (0, 1):
        both = n[y, :m, :m]
        one = both.diagonal()
        for a in (0, 1):
            for b in (0, 1):
                joint = both if a and b else one[:, None] - both if a else one[None, :] - both if b else total[y] - one[:, None] - one[None, :] + both
                joint = np.maximum(joint, 0) + 0.25
                pa_, pb_ = (one if a else total[y] - one) + 0.5, (one if b else total[y] - one) + 0.5
                info += joint / (total.sum() + 2) * np.log(joint * (total[y] + 1) / (pa_[:, None] * pb_[None, :]))
    parent, linked, best, source = np.full(m, -1), np.zeros(m, dtype=bool), np.full(m, -np.inf), np.full(m, -1)
    for _ in range(m):  # the tree of most information, grown voter by voter
        best_open = np.where(linked, -np.inf, best)
        j = int(best_open.argmax()) if np.isfinite(best_open).any() else int(np.flatnonzero(~linked)[0])
        linked[j] = True
        parent[j] = source[j] if best[j] > correlated else -1
        better = ~linked & (info[j] > best)
        best[better], source[better] = info[j][better], j
    chance = np.empty((m, 2, 2))
    for y in (0, 1):
        one = n[y].diagonal()[:m]
        for j in range(m):
            i = parent[j]
            # a vote more of each kind under either label: chances of 0 and 1 do not occur
            alone = (one[j] + 0.5) / (total[y] + 1)
            if i < 0:
                chance[j, y] = alone
            else:
                chance[j, y, 1] = (n[y, i, j] + 2 * alone) / (one[i] + 2)
                chance[j, y, 0] = (one[j] - n[y, i, j] + 2 * alone) / (total[y] - one[i] + 2)
    return LabelModel(float((total[1] + 1) / (total.sum() + 2)), parent, np.clip(chance, 1e-6, 1 - 1e-6))


def pair_counts(patterns: DataFrame, model: LabelModel, m: int) -> np.ndarray:
    """Expectation: pairwise counts of votes by label, over the pattern table (votes, label, n)."""
    bc = patterns.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        total = np.zeros((2, m + 1, m + 1))
        for b in batches:
            votes, label, count = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            v = unpack(votes, m)
            q = posterior(bc.value, v, label) * count
            v = np.hstack([v, np.ones((len(v), 1))])
            total[1] += (v * q[:, None]).T @ v
            total[0] += (v * (count - q)[:, None]).T @ v
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["at", "n"])

    out = np.zeros(2 * (m + 1) ** 2)
    for r in patterns.mapInArrow(run, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).collect():  # 2 (m + 1)^2 rows
        out[r["at"]] = r["n"]
    return out.reshape(2, m + 1, m + 1)


def fit_label_model(patterns: DataFrame, m: int, known: int, rounds: int, correlated: float) -> LabelModel:
    """``known``: labelled documents that start the estimate; without them voters of insults do."""
    start = np.full((m, 2, 2), 0.02)
    start[:, 1] = 0.05
    start[: m - len(PATTERNS) - 2, 1] = 0.4  # lexicons
    model = LabelModel(0.1, np.full(m, -1), start)
    if known:
        model = estimate(pair_counts(patterns.where("label >= 0"), model, m), float("inf"))
    for i in range(rounds):
        model = estimate(pair_counts(patterns, model, m), correlated if i >= 2 else float("inf"))
    return model


def counted_features(rows: DataFrame) -> DataFrame:
    """(feature, n, weight): documents that hold a feature, and the sum of their ``q``; rows are (text, q)."""
    def run(batches):
        count: dict[str, list[float]] = {}

        def out():
            names = list(count)
            got = [pa.array(names), pa.array([count[x][0] for x in names]), pa.array([count[x][1] for x in names])]
            count.clear()
            return pa.RecordBatch.from_arrays(got, names=["feature", "n", "q"])

        for b in batches:
            for text, q in zip(b.column(0), b.column(1).to_pylist()):
                for f in {f for w in tokens_of(text.as_py()) for f in features_of(w)}:
                    c = count.setdefault(f, [0.0, 0.0])
                    c[0] += 1
                    c[1] += q
                if len(count) > 200_000:
                    yield out()
        yield out()

    return rows.select("text", "q").mapInArrow(run, "feature string, n double, q double").groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("q").alias("q"))


def _margin(toxic: float, clean: float) -> tuple[Column, Column]:
    """How much more often toxic documents hold a feature: log odds and their standard error."""
    t, c = F.col("q") + 0.5, F.col("n") - F.col("q") + 0.5
    return F.log(t / (toxic + 1)) - F.log(c / (clean + 1)), F.sqrt(1 / t + 1 / c)


@dataclass
class Classifier:
    names: list[str]
    weights: np.ndarray
    bias: float


def sampled(rows: DataFrame, sample: int) -> DataFrame:
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000, size: int = 4096, folds: int = 5, rounds: int = 10,
          least: int = 3, surely: float = 10.0, correlated: float = 1e-4, id_col: str = "doc_id", text_col: str = "text") -> tuple[Classifier, Voters, LabelModel]:
    """Lexicons from labels, the label model from all votes, the classifier from posterior labels.

    An entry of a lexicon must be held ``surely`` times as often by toxic documents, by a standard error's
    margin, so that a common word of one language is none."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(~held_out("doc_id", folds))
    graded = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out("doc_id", folds))
              .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("label")))
    drawn = written(sampled(graded, sample))
    third = F.crc32(F.concat(F.lit("anchor:"), F.col("doc_id").cast("string"))) % 3 == 0

    rows = written(own.join(F.broadcast(drawn.where(~third)), "doc_id").select("text", F.col("label").cast("double").alias("q")))  # sample rows at most
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("q"), F.lit(0.0))).first()
    odds, error = _margin(toxic, n - toxic)
    learnt = counted_features(rows).where(F.col("q") >= least).where(odds - error > float(np.log(surely))).orderBy(F.desc(odds - error), "feature").limit(size)
    voters = Voters.of([r["feature"] for r in learnt.collect()])  # size entries at most

    bc = docs.sparkSession.sparkContext.broadcast(voters)

    def votes(batch):
        cast = votes.__dict__.setdefault("cast", None) or bc.value.caster()
        votes.cast = cast
        return {"votes": [cast(t) for t in batch.column(0).to_pylist()], "label": batch.column(1)}

    anchors = drawn.where(third).select("doc_id", "label")
    told = own.join(F.broadcast(anchors), "doc_id", "left").select("text", F.coalesce("label", F.lit(-1)).alias("label"))
    patterns = written(map_batches(told, votes, "votes long, label int").groupBy("votes", "label").agg(F.count("*").alias("n")))
    model = fit_label_model(patterns, voters.count, patterns.where("label = 1").count(), rounds, correlated)

    # posterior labels of a sample of all documents; where a document is labelled, its label is known
    part = sampled(own.select("doc_id").where("doc_id IS NOT NULL").distinct(), sample).join(drawn, "doc_id", "left")
    known_model = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batch):
        cast = judged.__dict__.setdefault("cast", None) or bc.value.caster()
        judged.cast = cast
        texts = batch.column(0).to_pylist()
        v = unpack(np.array([cast(t) for t in texts], dtype=np.int64), bc.value.count)
        return {"text": texts, "q": posterior(known_model.value, v, batch.column(1).to_numpy(zero_copy_only=False)), "label": batch.column(1)}

    judged_rows = own.join(F.broadcast(part), "doc_id").select("text", F.coalesce("label", F.lit(-1)).alias("label"))
    rows = written(map_batches(judged_rows, judged, "text string, q double, label int"))
    return calibrated(classifier(rows, size, least), rows), voters, model


def platt(z: np.ndarray, y: np.ndarray, trust: float = 5.0) -> tuple[float, float]:
    """(slope, shift) of a logistic regression of labels on scores, by Newton steps; both are held to (1, 0)
    with the weight of ``trust`` documents, so few labels change little."""
    at = np.array([1.0, 0.0])
    x = np.stack([z, np.ones(len(z))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (p - y) + trust * (at - [1.0, 0.0])
        curve = (x * (p * (1 - p))[:, None]).T @ x + trust * np.eye(2)
        step = np.linalg.solve(curve, slope)
        at = at - step * min(1.0, 2 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def calibrated(model: Classifier, rows: DataFrame) -> Classifier:
    """The classifier with its scale and threshold set by the sample's documents whose label is known: posterior
    labels understate kinds of toxic texts that few voters know."""
    if not model.names:
        return model
    bc = rows.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        lookup = run.__dict__.setdefault("lookup", None) or Lookup(bc.value.names)
        run.lookup = lookup
        return {"z": [float(bc.value.bias + bc.value.weights[sorted(lookup(t))].sum()) for t in batch.column(0).to_pylist()], "label": batch.column(1)}

    known = map_batches(rows.where("label >= 0").select("text", "label"), run, "z double, label int").toArrow()  # two numbers a sampled document
    z, y = known["z"].to_numpy(), known["label"].to_numpy()
    if len(set(y.tolist())) < 2:
        return model
    order = np.lexsort((y, z))
    slope, shift = platt(z[order], y[order].astype(float))
    return Classifier(model.names, model.weights * slope, model.bias * slope + shift) if slope > 0 else model


def classifier(rows: DataFrame, size: int, least: int, ridge: float = 2e-4) -> Classifier:
    """Logistic regression on the posterior labels ``q`` of ``rows`` (text, q)."""
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("q"), F.lit(0.0))).first()
    odds, error = _margin(toxic, n - toxic)
    names = [r["feature"] for r in counted_features(rows).where(F.col("n") >= least).orderBy(F.desc(F.abs(odds) - error), "feature").limit(size).collect()]
    prior = min(max(toxic / n, 1e-6), 1 - 1e-6) if n else 0.5
    nothing = Classifier([], np.zeros(0), float(np.log(prior / (1 - prior))))
    if not names:
        return nothing
    bc = rows.sparkSession.sparkContext.broadcast(names)

    def held(batch):
        lookup = held.__dict__.setdefault("lookup", None) or Lookup(bc.value)
        held.lookup = lookup
        return {"held": [[bc.value[i] for i in sorted(lookup(t))] for t in batch.column(0).to_pylist()], "q": batch.column(1)}

    data = map_batches(rows, held, "held array<string>, q double")
    # a document is a toxic one by its posterior, and a clean one by the rest
    data = data.select("held", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("q").alias("weight")),
                                                 F.struct(F.lit(0.0).alias("label"), (1 - F.col("q")).alias("weight")))).alias("x"))
    data = written(data.select("held", "x.*").where("weight > 0.02"))
    if data.select("label").distinct().count() < 2:
        return nothing
    vectors = CountVectorizerModel.from_vocabulary(names, inputCol="held", outputCol="features").setBinary(True).transform(data)
    fitted = LogisticRegression(weightCol="weight", regParam=ridge, maxIter=60, standardization=False).fit(vectors.select("features", "label", "weight"))
    return Classifier(names, fitted.coefficients.toArray(), float(fitted.intercept))


def scored(docs: DataFrame, model: Classifier, folds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    bc = docs.sparkSession.sparkContext.broadcast(model)  # ``size`` features

    def run(batch):
        lookup = run.__dict__.setdefault("lookup", None) or Lookup(bc.value.names)
        run.lookup = lookup
        z = np.array([bc.value.bias + bc.value.weights[sorted(lookup(t))].sum() for t in batch.column(2).to_pylist()])
        score = np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 6)
        return {"doc_id": batch.column(0), "held_out": batch.column(1), "score": score, "predicted": (score >= 0.5).astype(np.int32)}

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col, folds).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return map_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    model, _, _ = train(docs, labels, **options)
    return scored(docs, model, options.get("folds", 5))
