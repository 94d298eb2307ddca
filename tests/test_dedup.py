import random

from lumenkg.functions.similarity import lcs_length, ratio
from lumenkg.operators.dedup import deduplicate, similar_titles


def test_ratio_cases():
    cases = [("effects of microgravity on bone density", "effects of microgravity on bone density in mice", 91),
             ("effects of microgravity on bone density", "effect of microgravity on bone densities", 94),
             ("microgravity alters gene expression", "microgravity alters genome expression", 97),
             ("bone loss in mice", "bone loss in rats", 76), ("abcd", "abce", 75), ("kitten", "sitting", 62),
             ("", "", 100), ("a", "", 0)]
    for a, b, r in cases:
        assert ratio(a, b) == r


def test_lcs_matches_dp():
    def dp(a, b):
        prev = [0] * (len(b) + 1)
        for ca in a:
            cur = [0]
            for j, cb in enumerate(b):
                cur.append(prev[j] + 1 if ca == cb else max(cur[j], prev[j + 1]))
            prev = cur
        return prev[-1]
    rnd = random.Random(7)
    for _ in range(500):
        a = "".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 40)))
        b = "".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 40)))
        assert lcs_length(a, b) == dp(a, b)


def test_blocked_pairs_equal_brute_force(spark):
    rnd = random.Random(11)
    words = ["bone", "loss", "mice", "rat", "space", "gene", "density", "in", "of", "the", "micro", "gravity"]
    titles = sorted({" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 6))) for _ in range(250)}
                    | {"ab", "ac", "a", "b"})
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = {(r.a, r.b) for r in similar_titles(df).collect()}
    want = {(a, b) for i, a in enumerate(titles) for b in titles[i + 1:] if ratio(a, b) >= 85}
    assert got == want


def test_keep_first_not_components(spark):
    rows = [(1, "aaaaaaaaaabbbbbbbbbb", None, None), (2, "aaaaaaaaaabbbbbbbbcc", None, None),
            (3, "aaaaaaaaaabbbbbbcccc", None, None)]
    df = spark.createDataFrame(rows, "pos long, title string, doi string, pmid string")
    assert sorted(r.pos for r in deduplicate(df).collect()) == [1, 3]


def test_identifier_kinds_share_one_set(spark):
    rows = [(1, "first title here", None, "X"), (2, "a completely different one", "X", None),
            (3, "yet another unrelated name", None, None)]
    df = spark.createDataFrame(rows, "pos long, title string, doi string, pmid string")
    assert sorted(r.pos for r in deduplicate(df).collect()) == [1, 3]


def test_dedup_equals_sequential_model(spark):
    rnd = random.Random(5)
    words = ["bone", "loss", "mice", "rat", "space", "gene"]
    rows = []
    for i in range(120):
        t = " ".join(rnd.choice(words) for _ in range(rnd.randint(2, 5)))
        doi = rnd.choice([None, None, "d1", "d2", "d3"])
        rows.append((i, t, doi, rnd.choice([None, None, "d1", "p1"])))
    df = spark.createDataFrame(rows, "pos long, title string, doi string, pmid string")
    seen_ids, seen_t, keep = set(), [], []
    for pos, t, doi, pmid in rows:
        lt = t.lower()
        if (doi and doi in seen_ids) or (pmid and pmid in seen_ids) or any(ratio(lt, x) >= 85 for x in seen_t):
            continue
        keep.append(pos)
        seen_t.append(lt)
        seen_ids.update(x for x in (doi, pmid) if x)
    assert sorted(r.pos for r in deduplicate(df).collect()) == keep


def test_dedup_with_a_key_that_most_rows_share(spark):
    import lumenkg.operators.dedup as dd
    rows = [(i, f"title number {i} unique words here", "HOT" if i % 3 == 0 else None, None) for i in range(40)]
    rows += [(100 + i, "same shared title", None, None) for i in range(10)]
    df = spark.createDataFrame(rows, "pos long, title string, doi string, pmid string")
    seen_ids, seen_t, keep = set(), [], []
    for pos, t, doi, pmid in sorted(rows):
        lt = t.lower()
        if (doi and doi in seen_ids) or any(ratio(lt, x) >= 85 for x in seen_t):
            continue
        keep.append(pos)
        seen_t.append(lt)
        if doi:
            seen_ids.add(doi)
    assert sorted(r.pos for r in dd.deduplicate(df).collect()) == keep


def test_pairs_equal_brute_force_at_other_thresholds(spark):
    import pytest
    rnd = random.Random(3)
    titles = sorted({"".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 10))) for _ in range(60)}
                    | {"".join(rnd.choice("abc def") for _ in range(rnd.randint(11, 40))) for _ in range(60)}
                    | {"abc", "abcd", "abcde", "abcdef", "a", ""})
    near = [t + "x" for t in titles if len(t) > 12] + [t[1:] for t in titles if len(t) > 12]
    titles = sorted(set(titles) | set(near))
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    for threshold in (70, 75, 80, 90, 95):
        got = {(r.a, r.b) for r in similar_titles(df, threshold).collect()}
        want = {(a, b) for i, a in enumerate(titles) for b in titles[i + 1:] if ratio(a, b) >= threshold}
        assert got == want, threshold
    with pytest.raises(ValueError):
        similar_titles(df, 60)


def test_similar_to_a_registry(spark):
    from lumenkg.operators.dedup import similar_to
    rnd = random.Random(8)
    words = ["bone", "loss", "mice", "rat", "space", "gene", "density"]
    new = sorted({" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 5))) for _ in range(80)})
    known = sorted({" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 5))) for _ in range(80)} | {"ab", "abc"})
    frame = lambda ts: spark.createDataFrame([(t,) for t in ts], "t string")
    got = {(r.a, r.b) for r in similar_to(frame(new), frame(known)).collect()}
    assert got == {(a, b) for a in new for b in known if a != b and ratio(a, b) >= 85}


def test_a_chain_needs_no_round_limit(spark):
    # each title is similar to its neighbours only
    base = "abcdefghijklmnopqrstuvwxyz0123456789"
    rows = [(i, ("%02d" % i) * 6 + base[i % 8:], f"k{i // 2}", f"k{(i + 1) // 2}") for i in range(14)]
    df = spark.createDataFrame(rows, "pos long, title string, doi string, pmid string")
    kept = []
    for i, t, a, b in rows:
        if not any({a, b} & {x, y} or ratio(t, u) >= 85 for _, u, x, y in kept):
            kept.append((i, t, a, b))
    assert sorted(r.pos for r in deduplicate(df).collect()) == [k[0] for k in kept]


def sequential(rows, threshold=85):
    """rows of (pos, title, doi): positions kept by the plain loop."""
    ids, titles, keep = set(), [], []
    for pos, title, doi in sorted(rows):
        t = title.lower()
        if (doi and doi in ids) or any(ratio(t, x) >= threshold for x in titles):
            continue
        keep.append(pos)
        titles.append(t)
        if doi:
            ids.add(doi)
    return keep


def chain(n):
    """Titles of which each is similar to the next ones only: a window sliding over random letters."""
    rnd = random.Random(2)
    letters = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4 * n + 60))
    return [(i, letters[4 * i: 4 * i + 60], None) for i in range(n)]


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    import lumenkg.operators.dedup as dd
    rows = chain(500)
    cuts = []
    monkeypatch.setattr(dd, "cut_lineage", lambda df, real=dd.cut_lineage: cuts.append(1) or real(df))
    df = spark.createDataFrame(rows, "pos long, title string, doi string")
    assert sorted(r.pos for r in dd.deduplicate(df).collect()) == sequential(rows)
    assert len(cuts) < 20


def test_blocks_and_rounds_equal_the_sequential_loop(spark, monkeypatch):
    """Small blocks: a chain, a cluster of similar titles in a row, a hot identifier, in many blocks and rounds."""
    import lumenkg.operators.dedup as dd
    monkeypatch.setattr(dd, "BLOCK", 8)
    rnd = random.Random(4)
    rows = chain(30)
    rows += [(100 + i, f"the same long title of a cluster, number {i:02d}", None) for i in range(25)]
    rows += [(200 + i, "".join(rnd.choice("klmnopqrst") for _ in range(30)), "HOT" if i % 3 == 0 else None) for i in range(30)]
    rnd.shuffle(rows)
    rows = [(i, t, d) for i, (_, t, d) in enumerate(rows)]
    df = spark.createDataFrame(rows, "pos long, title string, doi string")
    assert sorted(r.pos for r in dd.deduplicate(df, block=8).collect()) == sequential(rows)


def test_a_cluster_of_many_titles_is_joined_with_its_leaders_only(spark, monkeypatch):
    import lumenkg.operators.segments as sg
    import lumenkg.operators.dedup as dd
    listed = []
    real = sg.exact
    monkeypatch.setattr(sg, "exact", lambda pairs, threshold: real(listed.append(pairs.count()) or pairs, threshold))
    rows = [(i, f"a title of one large cluster, copy number {i:04d}", None) for i in range(400)]
    df = spark.createDataFrame(rows, "pos long, title string, doi string")
    assert sorted(r.pos for r in dd.deduplicate(df, block=25).collect()) == sequential(rows)
    assert sum(listed) < 400 * 399 / 2 / 50, listed


def test_segments_are_disjoint_and_long_titles_are_cut_in_stretches():
    import numpy as np
    from lumenkg.operators import segments as sg
    rnd = random.Random(6)
    frequency = np.random.default_rng(1).integers(0, 1000, 1 << sg.SLOT_BITS).astype(float)
    for n in (1, 2, 5, 60, 64, 90, 97, 500):
        text = "".join(rnd.choice("abcdeé日 ") for _ in range(n))
        for k in {1, max(1, n // 3), n}:
            got = sg.cut(text, k, frequency)
            assert len(got) == k and all(1 <= q <= sg.LONGEST for _, q in got)
            assert all(p + q <= r for (p, q), (r, _) in zip(got, got[1:])) and got[0][0] >= 0 and sum(got[-1]) <= n
    text = "".join(rnd.choice("abcd") for _ in range(9))
    cost = [frequency[s] + 1 for s in sg.slots(text)]

    def least(i, k):
        if k == 0:
            return 0
        return min((least(j + q, k - 1) + cost[q - 1][j] for j in range(i, 9) for q in range(1, min(4, 9 - j) + 1) if 9 - j - q >= k - 1), default=float("inf"))

    for k in (1, 3, 6, 9):
        assert sum(cost[q - 1][p] for p, q in sg.cut(text, k, frequency)) == least(0, k)


def test_long_titles_of_other_scripts(spark):
    rnd = random.Random(9)
    base = ["".join(rnd.choice("абвгд日本語 \U0001F600") for _ in range(rnd.randint(80, 400))) for _ in range(12)]
    titles = sorted({t for b in base for t in (b, b[7:], b + "абв", b.replace("а", ""), b[:50] + "ж" * 9 + b[50:])})
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = {(r.a, r.b) for r in similar_titles(df).collect()}
    assert got == {(a, b) for a in titles for b in titles if a < b and ratio(a, b) >= 85}


def test_titles_meet_block_against_block(spark, monkeypatch):
    """Many small blocks lose no pair, and what they leave for the exact test is little more than the pairs."""
    from lumenkg.operators import title_blocks as tb
    from lumenkg.operators.dedup import similar_to
    monkeypatch.setattr(tb, "SMALLEST", 16)
    rnd = random.Random(12)
    titles = {"".join(rnd.choice("abcdefgh é") for _ in range(rnd.randint(0, 90))) for _ in range(120)}
    titles |= {t[2:] for t in titles} | {t + "ab" for t in titles} | {t.replace("a", "") for t in titles} | {"x" * 520, "x" * 519 + "y"}
    titles = sorted(titles)
    df = spark.createDataFrame([(t,) for t in titles], "t string").repartition(3)
    assert tb._blocks(len(titles)) > 10 and tb._packed(df, 7).count() == 7
    want = {(a, b) for i, a in enumerate(titles) for b in titles[i + 1:] if ratio(a, b) >= 85}
    assert {(r.a, r.b) for r in similar_titles(df).collect()} == want
    found = [(r.a, r.b) for r in tb.self_candidates(df, 85).collect()]
    assert len(found) == len({(min(p), max(p)) for p in found}) <= 1.5 * len(want)
    new, known = titles[::2], titles[1::3]
    got = {(r.a, r.b) for r in similar_to(df.where(df.t.isin(new)), df.where(df.t.isin(known))).collect()}
    assert got == {(a, b) for a in new for b in known if a != b and ratio(a, b) >= 85}


def test_the_search_of_titles_copies_no_substrings(spark):
    """The rows between the titles and their pairs: blocks, not substrings of every title."""
    from lumenkg.operators import segments as sg
    rnd = random.Random(13)
    titles = [("".join(rnd.choice("abcdefghij ") for _ in range(60)),) for _ in range(200)]
    plan = sg.self_pairs(spark.createDataFrame(titles, "t string"), 85)._jdf.queryExecution().optimizedPlan().toString()
    assert "substring" not in plan and "collect_list" in plan


def test_blocks_are_compared_where_they_lie(spark, monkeypatch):
    """What is shuffled does not grow with the number of blocks: each string is dealt to its block, not copied to every pair."""
    from lumenkg.operators import title_blocks as tb
    titles = spark.createDataFrame([(f"title {i} " + "abcdefghij"[i % 10] * 30,) for i in range(200)], "t string")
    for smallest in (100, 10):
        monkeypatch.setattr(tb, "SMALLEST", smallest)
        plan = tb.self_candidates(titles, 85)._jdf.queryExecution().optimizedPlan().toString()
        assert "inline" not in plan and "explode" not in plan
        executed = tb.self_candidates(titles, 85)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in executed and "Broadcast" not in executed


def test_dropped_pairs_cannot_be_similar():
    """The subsequence test drops pairs before their ends; it keeps those within reach and no others."""
    import numpy as np
    from lumenkg.operators import title_blocks as tb
    rnd = random.Random(21)
    for longest, least in ((30, 1), (64, 40), (200, 0)):
        texts = ["".join(rnd.choice("abc d") for _ in range(rnd.randint(least, longest))) for _ in range(40)]
        texts += [t[rnd.randint(0, 9):] + "abcd"[: rnd.randint(0, 4)] for t in texts]
        x, y = tb._Tile(np.arange(80), texts, 0.155), tb._Tile(np.arange(80), texts[::-1], 0.155)
        i, j = (a.ravel() for a in np.meshgrid(np.arange(80), np.arange(80)))
        for delta in (0.0, 0.155, 0.305):
            most = np.floor(delta * (x.n[i] + y.n[j]) + 1e-9).astype(np.int64)
            want = [k for k in range(len(i)) if x.n[i[k]] + y.n[j[k]] - 2 * lcs_length(texts[i[k]], texts[79 - j[k]]) <= most[k]]
            assert tb._alike(x, y, i, j, most).tolist() == want


def test_rows_kept_by_a_round_drop_what_they_match(spark, monkeypatch):
    """Pairs and threes of equal or similar titles beyond the rows that are decided in order."""
    import lumenkg.operators.dedup as dd
    monkeypatch.setattr(dd, "BLOCK", 6)
    rnd = random.Random(31)
    names = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(40)) for _ in range(20)]
    rows = [(i, t + tail, None) for i, (t, tail) in enumerate((t, tail) for t in names for tail in ("", "", "x"))]
    df = spark.createDataFrame(rows, "pos long, title string, doi string")
    assert sorted(r.pos for r in dd.deduplicate(df, block=100).collect()) == sequential(rows)


def test_few_blocks_for_many_rows(spark, monkeypatch):
    """Every block costs tens of jobs: rows decided grow fourfold with each."""
    import lumenkg.operators.dedup as dd
    blocks = []
    monkeypatch.setattr(dd, "_first_kept", lambda rows, *a, real=dd._first_kept: blocks.append(1) or real(rows, *a))
    rows = [(i, f"{i * 7919 % 1009:04d}" * 9, None) for i in range(400)]
    df = spark.createDataFrame(rows, "pos long, title string, doi string")
    assert sorted(r.pos for r in dd.deduplicate(df, block=10).collect()) == sequential(rows)
    assert len(blocks) <= 5
