"""Phrase mining, centroid clustering and toxicity against brute force, and their edge cases."""
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lumenkg.llm import collocations, queries, shallot, toxicity


# -- phrases ------------------------------------------------------------------

def phrases_by_hand(docs, least, part, top, longest=4):
    f, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    found = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least:
            score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            found[lang, p] = (score, a, f[lang, p[:k]], f[lang, p[k:]])
    out = []
    for (lang, p), (score, a, l, r) in found.items():
        longer = [c[1] for (g, q), c in found.items() if g == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if not any(100 * n >= part * a for n in longer):
            out.append((lang, -score, -a, " ".join(p).encode(), l, r))
    ranked, rank = [], Counter()
    for lang, score, a, p, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], p.decode(), -a, l, r, total[lang], -score))
    return sorted(ranked)


def phrase_rows(spark, docs, least=3, part=80, top=2000):
    rows = [(i, lang, text, "x") for i, (lang, text) in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, phrase string")
    got = collocations.collocations(df, least=least, part=part, top=top)
    return sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def random_docs(seed, n=60):
    rng = random.Random(seed)
    words = ["the", "of", "a", "b", "New", "York", "été", "\x00", "x-y", "日本"] + [f"w{i}" for i in range(30)]
    weights = [40, 30, 10, 10, 10, 10, 5, 2, 5, 5] + [1] * 30
    signs = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "!? "]
    return [(rng.choice(["en", "en", "en", "fr", None]),
             "".join(w + rng.choice(signs) for w in rng.choices(words, weights, k=rng.choice([0, 1, 3, 20, 60])))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_equal_brute_force(spark, seed):
    docs = random_docs(seed)
    assert phrase_rows(spark, docs) == phrases_by_hand(docs, 3, 80, 2000)


def test_hot_words_are_routed_deeper_and_batches_add_up(spark, monkeypatch):
    """Small tables, batches and groups: beginnings are hot at every level, texts are cut, groups hold parts."""
    for name, value in (("SLOTS", 16), ("HOT", 8), ("BATCH", 50), ("GROUP", 100), ("STRETCH", 40)):
        monkeypatch.setattr(collocations, name, value)
    docs = random_docs(3) + [("en", "one two three four five " * 40)] * 3
    hot, total = collocations.hot_table(spark.createDataFrame(docs, "lang string, text string").selectExpr("coalesce(lang, 'und') lang", "text"), 4)
    assert hot[0].any() and hot.any(axis=1).sum() > 1 and total > 500
    # collocations runs its tasks in other processes, which do not see the patched numbers: the map side is tested here
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"lang": [x or "und" for x, _ in docs], "text": [t for _, t in docs]})
    seen = Counter()
    for lang, s in collocations._batches([batch], 4):
        rows, weight = s.combined()
        words = s.codes.words()
        for r, n in zip(rows.tolist(), weight.tolist()):
            seen[lang, tuple(words[c].decode() for c in r if c >= 0)] += n
    want = Counter()
    for lang, text in docs:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            want.update((lang or "und", tuple(w[i:i + 4])) for i in range(len(w)))
    assert seen == want


def test_quicksort_counts_beginnings():
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 4, (500, 3)).astype(np.int32)
    rows[rng.random(500) < .2, 2] = -1
    weight = rng.integers(1, 4, 500)
    want = Counter()
    for r, w in zip(rows.tolist(), weight.tolist()):
        r = [c for c in r if c >= 0]
        for k in range(1, len(r) + 1):
            want[tuple(r[:k])] += w
    found = collocations.multikey_quicksort(rows, weight, np.ones(500, dtype=int), 20)
    assert dict(found) == {k: n for k, n in want.items() if n >= 20} and len(found) == len(dict(found))
    # where only longer beginnings are whole, shorter ones come whatever their count
    partial = dict(collocations.multikey_quicksort(rows, weight, np.full(500, 3), 1000))
    assert partial == {k: n for k, n in want.items() if len(k) < 3}


def test_phrases_of_hot_suffixes(spark):
    """One phrase is most of the table, so that it is hot at every level and dealt by batch."""
    docs = [("en", "of the same thing " * 50)] * 40 + random_docs(4, 20)
    assert phrase_rows(spark, docs, least=5) == phrases_by_hand(docs, 5, 80, 2000)


def test_phrase_ties_ranks_and_long_text(spark):
    docs = [("en", "b c. b c. a d. a d. c b, c b; é a! é a? z é. z é")] * 2 + [("fr", "a b " * 30_000)]
    for top in (2, 2000):
        assert phrase_rows(spark, docs, least=4, top=top) == phrases_by_hand(docs, 4, 80, top)


def test_phrases_of_nothing(spark):
    assert phrase_rows(spark, []) == []
    assert phrase_rows(spark, [(None, None), ("en", ""), ("en", " . , "), ("en", "a b")]) == []


# -- clusters -----------------------------------------------------------------

def clusters_by_hand(rows, k, rounds, dims, scale=64):
    """rows: (id, vector) -> sorted (id, cluster, distance)."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), i, v) for i, v in kept if i is not None)[:k]
    centres = [v for _, _, v in starts]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(col) // len(members[n]) for col in zip(*members[n])] if n in members else c for n, c in enumerate(centres)]
    out = [(i, *nearest(v)[::-1]) for i, v in kept]
    return sorted(out, key=str), centres


def cluster_rows(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster string")
    return df, shallot.clusters(df, **options).collect()


@pytest.mark.parametrize("seed,grid", [(1, 1), (2, 64), (3, 4)])
def test_clusters_equal_brute_force(spark, seed, grid):
    """A coarse grid gives many ties and equal vectors."""
    rng = np.random.default_rng(seed)
    rows = [(int(i), (rng.integers(-3, 4, 6) / grid + (i % 5)).tolist()) for i in range(300)]
    rows += rows[:40] + [(None, rows[0][1])]
    _, got = cluster_rows(spark, rows, k=9, rounds=3, dims=6)
    want, centres = clusters_by_hand(rows, 9, 3, 6)
    assert sorted([(r.vec_id, r.cluster, r.distance) for r in got], key=str) == want
    inertia = Counter()
    for _, c, d in want:
        inertia[c] += d
    for r in got:
        assert (r.cluster_inertia, r.inertia) == (inertia[r.cluster], sum(inertia.values()))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


def test_bounds_save_most_distances():
    """On clustered vectors a late round looks at few centroids, and the state stays exact."""
    rng = np.random.default_rng(7)
    hubs = rng.integers(-2000, 2000, (40, 16))
    x = (hubs[rng.integers(0, 40, 4000)] + rng.integers(-60, 61, (4000, 16))).astype(np.int64)
    points = [p.tolist() for p in x[rng.choice(4000, 40, replace=False)]]
    first, second = np.zeros(4000, np.int32), np.ones(4000, np.int32)
    upper, lower, moved, shares = np.full(4000, np.inf), np.zeros(4000), None, []
    for _ in range(6):
        c = np.array(points)
        shares.append(shallot.assign(x, shallot.Centres(points, moved), first, second, upper, lower) / x.shape[0] / 40)
        d = ((x[:, None, :] - c[None]) ** 2).sum(-1)
        assert (first == d.argmin(axis=1)).all()
        assert (upper >= np.sqrt(d.min(axis=1)) * (1 - 1e-7)).all()
        assert (lower <= np.sqrt(np.partition(d, 1, axis=1)[:, 1]) * (1 + 1e-7)).all()
        new = [[int(v) for v in x[first == n].sum(axis=0) // (first == n).sum()] if (first == n).any() else points[n] for n in range(40)]
        moved = [float(sum((a - b) ** 2 for a, b in zip(p, q))) ** .5 for p, q in zip(points, new)]
        points = new
    assert shares[0] < 0.8 and shares[-1] < 0.1, shares


def test_large_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * (2 ** 22 + rng.random() * 9) for _ in range(2)]) for i in range(30)]
    _, got = cluster_rows(spark, rows, k=4, rounds=2, dims=2, scale=64)
    assert sorted([(r.vec_id, r.cluster, r.distance) for r in got], key=str) == clusters_by_hand(rows, 4, 2, 2)[0]
    with pytest.raises(Exception, match="too large"):
        cluster_rows(spark, [(1, [1e300, 0.0]), (2, [0.0, 0.0])], k=2, dims=2)


def test_cluster_edges(spark):
    assert cluster_rows(spark, [], k=3, dims=2)[1] == []
    odd = [(1, None), (2, []), (3, [1.0]), (4, [None, 1.0]), (5, [float("nan"), 0.0]), (6, [float("inf"), 0.0]), (7, [1.0, 2.0, 3.0])]
    assert cluster_rows(spark, odd, k=3, dims=2)[1] == []
    few = odd + [(8, [0.5, 0.25]), (9, [0.5, 0.25])]  # fewer vectors than centroids, and two equal ones
    got = cluster_rows(spark, few, k=16, dims=2)[1]
    assert sorted([(r.vec_id, r.cluster, r.distance) for r in got], key=str) == clusters_by_hand(few, 16, 3, 2)[0]
    with pytest.raises(ValueError, match="no row with an id"):
        cluster_rows(spark, [(None, [1.0, 2.0])], k=2, dims=2)


# -- toxicity -----------------------------------------------------------------

def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def toxic_corpus(n, seed=1, marks=("blarg", "snork", "zwibb")):
    """Words of two invented languages; toxic texts hold words that begin like one of ``marks``."""
    rng = random.Random(seed)
    common = ["".join(rng.choices("aeioulmnrst", k=rng.randint(2, 7))) for _ in range(300)]
    ends = ["", "a", "o", "ing", "er", "este", "ut"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(common, k=rng.randint(5, 60))
        bad = rng.random() < .25
        for _ in range(rng.randint(1, 4) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(marks) + rng.choice(ends))
        docs.append((i, " ".join(words), "en", "s"))
        if rng.random() < .6:
            labels.append((i, 1, int(bad)))
        docs[-1] += (bad,)
    return docs, labels


DOCS = "doc_id long, text string, lang string, source string, score boolean"
LABELS = "doc_id long, quality int, toxic int"


def test_toxicity_on_held_out_documents(spark):
    docs, labels = toxic_corpus(1500)
    # labels of held-out rows are false on purpose: a model that reads them fails
    labels = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    df = spark.createDataFrame(docs, DOCS)
    got = {r.doc_id: r for r in toxicity.toxicity(df, spark.createDataFrame(labels, LABELS)).collect()}
    assert len(got) == len(docs) and all(got[i].held_out == held(i) for i in got)
    out = [(got[d[0]].predicted, int(d[4]), got[d[0]].score) for d in docs if held(d[0])]
    assert len(out) > 200 and all(0 <= s <= 1 and p == int(s >= 0.5) for p, _, s in out)
    assert np.mean([p == t for p, t, _ in out]) > 0.97
    assert np.mean([p for p, t, _ in out if t]) > 0.9


def test_scores_ignore_id_language_and_source(spark):
    docs, labels = toxic_corpus(300)
    model, _, _ = toxicity.train(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), rounds=3)
    moved = [(10_000 + i, t, "fr", None, not b) for i, t, _, _, b in docs]
    a = {r.doc_id: r.score for r in toxicity.scored(spark.createDataFrame(docs, DOCS), model).collect()}
    b = {r.doc_id - 10_000: r.score for r in toxicity.scored(spark.createDataFrame(moved, DOCS), model).collect()}
    assert a == b


def test_label_model_finds_accuracies_and_correlations(spark):
    """Votes drawn from a known model: the estimate without any label comes near it, and finds the copy."""
    rng = np.random.default_rng(3)
    n, m = 20_000, 6
    y = rng.random(n) < .3
    right = [.9, .85, .8, .75, .7]
    v = np.array([np.where(rng.random(n) < a, y, ~y) for a in right]).T.astype(int)
    v = np.hstack([v, np.where(rng.random(n) < .9, v[:, 4], rng.random(n) < .5)[:, None]])  # the sixth copies the fifth
    counts = Counter(map(tuple, v.tolist()))
    rows = [(sum(x << j for j, x in enumerate(p)), -1, c) for p, c in counts.items()]
    patterns = spark.createDataFrame(rows, "votes long, label int, n long")
    start = np.full((m, 2, 2), .3)
    start[:, 1] = .7
    model = toxicity.LabelModel(.4, np.full(m, -1), start)
    for i in range(30):
        pairs = toxicity.pair_counts(patterns, model, m)
        model = toxicity.estimate(pairs, 1e-2 if i >= 2 else float("inf"))
    assert abs(model.prior - .3) < .04
    assert np.allclose(model.accuracies(pairs)[:5], right, atol=.04)
    assert model.parent[5] == 4 or model.parent[4] == 5
    assert (np.delete(model.parent, [4, 5]) == -1).sum() >= 3
    q = toxicity.posterior(model, v, np.full(n, -1))
    assert ((q > .5) == y).mean() > .9


def test_pair_counts_equal_a_plain_loop(spark):
    rng = np.random.default_rng(4)
    m = 4
    model = toxicity.LabelModel(.3, np.array([-1, 0, 1, 0]), rng.uniform(.1, .9, (m, 2, 2)))
    rows = [(int(p), int(lab), int(c)) for p, lab, c in zip(range(16), rng.integers(-1, 2, 16), rng.integers(1, 9, 16))]
    got = toxicity.pair_counts(spark.createDataFrame(rows, "votes long, label int, n long"), model, m)
    want = np.zeros((2, m + 1, m + 1))
    for votes, label, c in rows:
        v = [votes >> j & 1 for j in range(m)]
        p = [1 - model.prior, model.prior]
        for y in (0, 1):
            for j in range(m):
                up = v[model.parent[j]] if model.parent[j] >= 0 else 0
                p[y] *= model.chance[j, y, up] if v[j] else 1 - model.chance[j, y, up]
        q = p[1] / sum(p) if label < 0 else (.01, .99)[label]
        w = np.array(v + [1])
        want[1] += q * c * np.outer(w, w)
        want[0] += (1 - q) * c * np.outer(w, w)
    assert np.allclose(got, want)


def test_toxicity_edges(spark):
    docs, labels = toxic_corpus(200)
    odd = [(900, None), (901, ""), (902, "!!! ***"), (None, "blarger"), (903, "blargest " * 100_000), (903, "blargest " * 100_000)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], DOCS)
    every = spark.createDataFrame(docs, DOCS).unionByName(df)
    lab = spark.createDataFrame(labels + labels[:5] + [(None, 1, 1), (901, None, None), (77_777, 1, 1)], LABELS)
    got = [r for r in toxicity.toxicity(every, lab, rounds=3).collect() if r.doc_id is None or r.doc_id >= 900]
    by = {r.doc_id: r for r in got}
    assert len(got) == 6 and by[900].score == by[901].score < 0.5 and by[None].held_out
    assert [r.score for r in got if r.doc_id == 903][0] == [r.score for r in got if r.doc_id == 903][1]
    nothing = spark.createDataFrame([], LABELS)
    alone = toxicity.toxicity(spark.createDataFrame([(i, t, "en", "s", b) for i, t, _, _, b in docs[:40]], DOCS), nothing, rounds=2).collect()
    assert len(alone) == 40 and all(0 <= r.score <= 1 for r in alone)
    assert toxicity.toxicity(spark.createDataFrame([], DOCS), lab, rounds=2).collect() == []


def test_calibration_is_the_maximum_of_its_likelihood():
    rng = np.random.default_rng(8)
    z = rng.normal(-2, 2, 2000)
    y = (rng.random(2000) < 1 / (1 + np.exp(-(1.7 * z + 2.2)))).astype(float)
    slope, shift = toxicity.platt(z, y)

    def loss(a, b):
        p = 1 / (1 + np.exp(-(a * z + b)))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum() + 2.5 * ((a - 1) ** 2 + b ** 2)

    assert abs(slope - 1.7) < .3 and abs(shift - 2.2) < .4
    assert all(loss(slope, shift) <= loss(slope + d, shift + e) + 1e-9 for d in (-.01, 0, .01) for e in (-.01, 0, .01))
    far = toxicity.platt(np.array([-5., 5.]), np.array([0., 1.]))  # separable, two documents: close to as it was
    assert abs(far[0] - 1) < .2 and abs(far[1]) < .1


def test_patterns_and_lists_vote():
    voters = toxicity.Voters.of(["w:blarg", "4:snor"])
    cast = voters.caster()
    assert cast("a calm text") == 0
    for text in ("you IDIOT", "so blarg", "SNORking", "what?!", "you are a fish", "b**ch", "sooo", "SHUT up", "ALLES GROSS HIER"):
        assert cast(text), text


def test_registered():
    for name in ("op11_collocations", "op12_clusters", "op13_toxicity"):
        assert name in queries.QUERIES
