"""Operators that look across documents, against brute force."""
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lumenkg.llm import common, decontam, lines, mixing, passages, simhash, topk


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def frame(spark, rows, source=None):
    return spark.createDataFrame([(i, t, source(i) if source else "s", 7, "x") for i, t in rows],
                                 "doc_id long, text string, source string, component_id int, n_removed string")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


# substring dedup ---------------------------------------------------------------------------------

def brute_dedup(rows, window):
    docs = [(passages.MAX_ID if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, ws in docs:
        for p in range(len(ws) - window + 1):
            key = tuple(ws[p: p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, ws in docs:
        gone = set()
        for p in range(len(ws) - window + 1):
            if first[tuple(ws[p: p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, len(ws), len(gone), sha(" ".join(w for p, w in enumerate(ws) if p not in gone))))
    return sorted(out)


def shared_texts(seed, n=60):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(r.choice([3, 40, 4000]))]
    text = lambda k: [r.choice(vocab) for _ in range(k)]
    pool = [text(r.randint(20, 90)) for _ in range(6)]
    rows = []
    for i in range(n):
        ws = text(r.randint(0, 60))
        for _ in range(r.randint(0, 3)):
            p = r.choice(pool)
            a = r.randint(0, 15)
            ws += p[a: len(p) - r.randint(0, 15)] + text(r.randint(0, 10))
        rows.append((i, " ".join(ws)))
    rows += [(r.randrange(n), rows[r.randrange(n)][1]), (None, rows[3][1]), (None, None), (n + 1, ""), (n + 2, rows[4][1].replace(" ", "\n\t ")), (n + 3, "loop " * 400), (n + 4, "loop " * 300)]
    return rows


@pytest.mark.parametrize("seed,part", [(1, 20_000), (2, 20_000), (3, 40), (4, 20_000)])
def test_substring_dedup_is_brute_force(spark, monkeypatch, seed, part):
    monkeypatch.setattr(passages, "PART_ANCHORS", part)
    rows = shared_texts(seed)
    got = passages.substring_dedup(frame(spark, rows), window=30, phrase=10).collect()
    have = sorted((passages.MAX_ID if g.doc_id is None else g.doc_id, g.n_words, g.n_removed, g.kept_sha256) for g in got)
    assert have == brute_dedup(rows, 30)


def test_substring_dedup_empty(spark):
    assert passages.substring_dedup(frame(spark, [])).count() == 0


def test_substring_dedup_spreads_exact_copies(spark, monkeypatch):
    monkeypatch.setattr(passages, "PART_ANCHORS", 40)
    segments, made = passages.segments, []
    monkeypatch.setattr(passages, "segments", lambda *a: made.append(segments(*a)) or made[-1])
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(i, text) for i in range(200)] + [(1000 + i, f"other text {i}") for i in range(20)]
    got = passages.substring_dedup(frame(spark, rows), window=30, phrase=10).collect()
    assert sorted((g.doc_id, g.n_words, g.n_removed, g.kept_sha256) for g in got) == brute_dedup(rows, 30)
    sizes = [r["n"] for r in made[0].where("not owned").groupBy("shard", "part").agg(F.countDistinct("key").alias("n")).collect()]
    assert sum(sizes) == 199 and len(sizes) > 3 and max(sizes) < 100


# decontamination -----------------------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_hits(text, items, k):
    ws = WORD.findall(lower(text or ""))
    hit, found = set(), set()
    for item, t in items:
        iw = WORD.findall(lower(t or ""))
        wins = {tuple(iw[p: p + k]) for p in range(max(1, len(iw) - k + 1))} if iw else set()
        for win in wins:
            for p in range(len(ws) - len(win) + 1):
                if tuple(ws[p: p + len(win)]) == win:
                    hit.update(range(p, p + len(win)))
                    found.add(str(item))
    return len(ws), len(hit), sorted(found)


@pytest.mark.parametrize("seed", range(4))
def test_decontamination_is_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(decontam, "SHARD_WORDS", 60 if seed % 2 else 500_000)
    r = random.Random(seed)
    vocab = ["a", "B", "c1", "É", "the", "x"][: 3 + seed]
    words = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, words(r.randint(4, 25))) for i in range(12)] + [(50, "The X"), (51, ""), (52, None), (53, "q w e r t y u i o p"), (54, "q w e r t y u i o p")]
    if seed == 3:
        items.append((60, "x"))
    rows = [(i, words(r.randint(0, 60)) + (" , " + (r.choice(items)[1] or "") if r.random() < .6 else "")) for i in range(40)]
    rows += [(90, None), (90, ""), (None, "the-x Q.W.E.R.T.Y.U.I.O.P!"), (91, "z " * 3000)]
    got = decontam.contamination(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), 10).collect()
    have = sorted((str(g.doc_id), g.n_words, g.n_hit, g.n_items, g.items_sha256, g.contaminated) for g in got)
    want = []
    for i, t in rows:
        n, h, ids = brute_hits(t, items, 10)
        want.append((str(i), n, h, len(ids), sha(",".join(ids)), h > 0))
    assert have == sorted(want)


def test_decontamination_cleans_texts(spark):
    item = "one two three four five six seven eight nine ten eleven"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = frame(spark, [(1, "Before, " + item.upper() + "! after " + "and so on " * 10), (2, "clean text"), (3, None), (4, item)])
    got = decontam.remove_benchmark(docs, items)
    assert got.columns == docs.columns
    assert {g.doc_id: g.text for g in got.collect()} == {1: "Before, ! after " + "and so on " * 10, 2: "clean text", 3: None}
    assert decontam.remove_benchmark(docs, items.limit(0)).count() == 4


# simhash -------------------------------------------------------------------------------------------

def brute_fingerprint(t, k=4):
    ws = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
    if not ws:
        return 0
    sh = [" ".join(ws[i: i + k]) for i in range(max(1, len(ws) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("bits,block", [(4, 4096), (4, 8), (2, 4096), (6, 16), (0, 4096)])
def test_links_have_the_components_of_all_pairs(spark, monkeypatch, bits, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    r = random.Random(bits * 100 + block)
    fps = {r.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1, 0b1111, 0b11111}
    for f in list(fps):
        for _ in range(6):
            f ^= sum(1 << b for b in r.sample(range(64), r.randint(1, 7)))
            fps.add(f)
    tight = r.getrandbits(64)
    fps |= {tight ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits)
    roots = {x.node: x.root for x in common.components(links).collect()}
    got, want = [roots.get(f, f) for f in signed], brute_components(fps, bits)
    assert len(set(got)) == len(set(want)) == len(set(zip(got, want)))


def test_links_where_buckets_end_with_a_batch(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 2)
    r = random.Random(6)
    fps = {f ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 2))) for f in [r.getrandbits(64) for _ in range(3)] for _ in range(7)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4)
        roots = {x.node: x.root for x in common.components(links).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got, want = [roots.get(f, f) for f in signed], brute_components(fps, 4)
    assert len(set(got)) == len(set(want)) == len(set(zip(got, want)))


def test_near_duplicates_edges(spark):
    rows = [(5, None), (3, ""), (3, ""), (8, "a B c"), (9, "A b C"), (None, "a b c"), (4, "p q r s t u v w"), (2, "X " * 20000)]
    got = {(g.doc_id, g.fingerprint, g.component_id) for g in simhash.near_duplicates(frame(spark, rows)).collect()}
    assert {(i, f"{brute_fingerprint(t):016x}") for i, t in rows} == {(a, b) for a, b, _ in got}
    assert {(a, c) for a, _, c in got} == {(5, 3), (3, 3), (8, 8), (9, 8), (None, 8), (4, 4), (2, 2)}
    kept = simhash.keep_one(frame(spark, rows))
    assert sorted(map(str, (k.doc_id for k in kept.collect()))) == ["2", "3", "4", "8", "None"]
    assert kept.columns == frame(spark, rows).columns
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (7, 7)], "u long, v long")
    got = {x.node: x.root for x in common.components(links).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1001: 1000}


# top-k ---------------------------------------------------------------------------------------------

def brute_topk(rows, k):
    vec = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            vec[i] = [int(np.floor(64 * float(x))) for x in v]
    out = []
    for q in vec:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(vec[q], v)), i) for i, v in vec.items() if i != q and len(v) == len(vec[q]))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("seed,shard", [(1, 8192), (2, 150), (3, 8192)])
def test_topk_is_brute_force(spark, monkeypatch, seed, shard):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "QUERY_ROWS", 20 if seed == 2 else 4096)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 8)) * (1e6 if seed == 3 else 1)
    rows = [(i, (centres[i % 5] + rng.normal(size=8) * .1).tolist()) for i in range(500)]
    rows += [(500 + i, [0.5] * 8) for i in range(300)]
    rows += [(2000, None), (2020, [None] * 8), (2040, [float("nan")] * 8), (2060, [float("inf")] + [0.] * 7), (2080, []), (None, [1.] * 8), (2100, [1., 2.]), (2101, [1., 1.])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int")
    from pyspark.sql import functions as F
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("id") % 20 == 0, k=20).collect())
    assert got == brute_topk(rows, 20)
    assert topk.top_k(df.limit(0), F.col("id") % 20 == 0).count() == 0


@pytest.mark.parametrize("shard", [8192, 200])
def test_topk_prunes_clustered_vectors(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] * 3 + rng.normal(size=16) * .05).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    result, work = topk.search(df, F.col("id") % 20 == 0, k=20)
    got = result.collect()
    whole = np.floor(64 * np.array([v for _, v in rows]))
    for q in range(0, 4000, 400):
        score = whole @ whole[q]
        want = sorted((-int(s), i) for i, s in enumerate(score) if i != q)[:20]
        assert sorted((-r.score, r.vec_id) for r in got if r.query_id == q) == want
    assert work.first().scored < 0.3 * 4000 * 200


def test_topk_of_numbers_beyond_doubles(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.randrange(-2 ** 24, 2 ** 24)) for _ in range(3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("id") % 20 == 0, k=5, scale=64).collect())
    assert got == brute_topk(rows, 5)


# mixing --------------------------------------------------------------------------------------------

def test_mixing_keeps_every_block_in_its_window(spark):
    rows = [(i, "t") for i in range(700)] + [(None, None), (3, "t")]
    docs = frame(spark, rows, source=lambda i: None if i is None else "abcd"[0 if i < 400 else i % 4])
    given = spark.createDataFrame([("a", 5), ("b", 3), ("c", 1), ("zzz", 9)], "source string, weight long")
    for weights in (None, given):
        got = mixing.mix(docs, weights, period=97, block_docs=4).collect()
        assert len(got) == len(rows)
        blocks = {(g.source, g.mix_block): g for g in got}
        assert all(g.mix_release <= g.mix_slot < g.mix_due for g in got)
        assert len({g.mix_slot for g in blocks.values()}) == len(blocks)
        assert len({(g.mix_slot, g.mix_place) for g in got}) == len(got)


def test_schedule_deviates_by_less_than_a_block(spark):
    w = spark.createDataFrame([("a", 50), ("b", 31), ("c", 7), ("d", 1), ("e", 0)], "source string, weight long")
    share = {r.source: r.share for r in mixing.shares(w, 200).collect()}
    assert sum(share.values()) == 200 and min(share.values()) >= 1
    plan = sorted(mixing.schedule(mixing.shares(w, 200), 200).collect(), key=lambda r: r["at"])
    assert [r["at"] for r in plan] == list(range(200))
    done = dict.fromkeys(share, 0)
    for r in plan:
        assert r.turn == done[r.source]
        done[r.source] += 1
        assert all(abs(done[s] - share[s] * (r["at"] + 1) / 200) < 1 for s in share)


def test_mixing_limits(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    got = mixing.mix(frame(spark, [(i, "t") for i in range(30)], source=str), period=20).collect()  # more sources than slots
    assert len({r.mix_slot for r in got}) == 30 and all(r.mix_release <= r.mix_slot < r.mix_due for r in got)


# line dedup ----------------------------------------------------------------------------------------

def brute_lines(rows, ratio, least):
    pages, held = {}, {}
    for i, t, h in rows:
        pages[h] = pages.get(h, 0) + 1
        for x in {x.strip(" \t\r\x0b\x0c") for x in (t or "").split("\n")} - {""}:
            held[h, x] = held.get((h, x), 0) + 1
    out = []
    for i, t, h in rows:
        ls = [] if t is None else t.split("\n")
        kept = [x for x in ls if not (n := held.get((h, x.strip(" \t\r\x0b\x0c")), 0)) >= least or not n > ratio * pages[h]]
        out.append((str(i), len(ls), len(ls) - len(kept), sha("\n".join(kept))))
    return sorted(out)


def test_line_dedup_is_brute_force(spark):
    r = random.Random(4)
    rows = []
    for i in range(200):
        ls = [f"line {r.randrange(4000)}" for _ in range(r.randint(0, 6))]
        ls += [x for x in ("nav", " nav\t", "", "nav", "footer é") if r.random() < .3]
        r.shuffle(ls)
        rows.append((i, "\n".join(ls), r.choice(["h1", "h2", "h2", None])))
    rows += [(None, "nav\nx", "h1"), (None, None, "h1"), (3, rows[3][1], rows[3][2]), (300, "nav " * 9000, "h2")]
    docs = spark.createDataFrame([(i, t, h, 1) for i, t, h in rows], "doc_id long, text string, source string, lines int")
    got = sorted((str(g.doc_id), g.n_lines, g.n_dropped, g.kept_sha256) for g in lines.line_dedup(docs, max_ratio=.1, min_pages=5).collect())
    assert got == brute_lines(rows, .1, 5)
    out = lines.remove_boilerplate(docs, max_ratio=.1, min_pages=5)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert lines.line_dedup(docs.limit(0)).count() == 0


# repeated ids, clashing names, many sources -------------------------------------------------------

def test_keep_one_loses_no_text_of_a_repeated_id(spark):
    texts = ["one two three four five six", "seven eight nine ten eleven twelve", "alpha beta gamma delta epsilon zeta"]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (2, texts[0]), (3, texts[2]), (3, texts[2]), (None, texts[0]), (4, None), (5, ""), (5, None)]
    docs = spark.createDataFrame([(i, t, f"s{n}") for n, (i, t) in enumerate(rows)], "doc_id long, text string, h string")
    got = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()), key=str)
    assert got == sorted([(1, texts[0]), (1, texts[1]), (3, texts[2]), (4, None), (None, texts[0])], key=str)
    again = simhash.keep_one(docs.orderBy(F.desc("h")).repartition(5))
    assert sorted(map(str, again.collect())) == sorted(map(str, simhash.keep_one(docs).collect()))


def test_null_ids_do_not_multiply_anchors(spark):
    r = random.Random(3)
    word = lambda: f"w{r.randrange(10_000)}"
    shared = [word() for _ in range(120)]
    rows = [(None, " ".join([word() for _ in range(30)] + shared + [word() for _ in range(30)])) for _ in range(20)]
    rows += [(7, rows[0][1]), (7, rows[1][1]), (7, rows[1][1]), (8, " ".join(shared))]
    docs = common.id_text(frame(spark, rows))
    base, marked, _ = passages.repeated_spans(docs, 50, 16)
    own = {r.th: r.n for r in base.select("th", F.size("anchors").alias("n")).collect()}
    for row in marked.select(F.xxhash64("text").alias("th"), F.size("found").alias("n")).collect():
        assert row.n <= own[row.th]


def test_operators_carry_columns_of_any_name(spark):
    names = ["__hits", "__items", "__key", "__h", "__page", "__dropped", "__src", "__n", "row", "h", "page", "bucket", "rank", "md5", "src", "share", "n", "th", "id"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names)
    rows = [(i, f"menu\nwords number {i} of a text that is only here {i * 7919}", "s", *names) for i in range(12)]
    docs = spark.createDataFrame(rows, schema)
    items = spark.createDataFrame([(1, "words number 3 of a text that is only here 23757")], "item_id long, text string")
    for out, n in ((decontam.remove_benchmark(docs, items, max_coverage=0.99), 12), (lines.remove_boilerplate(docs), 12), (simhash.keep_one(docs), None), (mixing.mix(docs), 12)):
        assert out.columns[: len(docs.columns)] == docs.columns
        got = out.collect()
        assert n is None or len(got) == n
        assert all(r[name] == name for r in got for name in names)
    mixed = common.written(mixing.mix(mixing.mix(docs)))  # result columns are replaced, so it can be written
    assert mixed.columns == mixing.mix(docs).columns and mixed.count() == 12


def test_more_sources_than_slots(spark):
    docs = spark.range(1, 260).selectExpr("id AS doc_id", "concat('s', id % 130) AS source")
    got = mixing.mix(docs, period=100, block_docs=1).collect()
    assert len(got) == 259 and len({r.mix_slot for r in got}) == 259
    assert all(r.mix_release <= r.mix_slot < r.mix_due for r in got)


def test_null_ids_are_spread_over_buckets(spark):
    docs = spark.range(4000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'s' AS source", "concat('t', id) AS text")
    n = sorted(r.n for r in mixing.numbered(docs, "source", "doc_id").select("n").collect())
    assert n == list(range(4000))


def test_benchmark_shards_are_built_by_tasks_and_stay_small(spark):
    r = random.Random(1)
    vocab = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([0, 4, 30, 200])))) for i in range(300)] + [(None, "a b c"), (5, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    packed = decontam.automata(bench, 10, shard_words=4000)
    made = [decontam.unpacked(str(row.shard), bytes(row.automaton)) for row in packed.collect()]
    words = sum(len((t or "").split()) for _, t in items)
    assert len(made) >= words // 4000
    assert sum(a.size() for a in made) < 80 * words
    docs = [(i, " ".join((t or "").split()[:25] + ["gap"] + (u or "").split()[-12:])) for i, ((_, t), (_, u)) in enumerate(zip(items, items[1:]))]
    df = frame(spark, docs)
    one = {x.doc_id: tuple(x) for x in decontam.contamination(df, bench).collect()}
    whole = decontam.marked(common.id_text(df), packed, "text")
    for row in whole.collect():
        n = sum(e - s for s, e in decontam.spans(row["__hits"]))
        assert (row.doc_id, n, len(row["__items"])) == (one[row.doc_id][0], one[row.doc_id][2], one[row.doc_id][3])
