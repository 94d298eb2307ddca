"""Row-wise operators against brute force: PII, secrets, tokens, quality."""
import hashlib
import random
import re

import numpy as np
import pytest

from lumenkg.llm import common, pii, quality, secretscan, tokens

ROWS = [(1, ""), (2, None), (None, "a@b.co"), (3, "x " * 5000), (3, "x " * 5000), (4, "\n\n\t "), (5, "é " * 3 + "😀 tok\nen")]


def frame(spark, rows=ROWS):
    """Clashing names beside the two columns that count."""
    return spark.createDataFrame([(i, t, "n", 1) for i, t in rows], "doc_id long, text string, spans string, n_tokens int")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_pii(t):
    out = [(0, *m.span()) for m in EMAIL.finditer(t)]
    out += [(1, *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(t):
        d = [int(c) for c in m[0] if c.isdigit()]
        alt = [x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(d[::-1])]
        if 16 <= len(d) <= 19 and sum(alt) % 10 == 0:
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in PHONE.finditer(t) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def noise(seed, parts):
    r = random.Random(seed)
    return "".join(r.choice(parts) for _ in range(r.randint(0, 40)))


@pytest.mark.parametrize("seed", range(300))
def test_pii_base_is_the_plain_patterns(seed):
    t = noise(seed, ["a", "b.c", "@", ".", "-", " ", "1", "22", "255", "256", "+1", "(", ")", "4532015112830366", "4", "%", "é", "\n", "000"])
    assert pii.detect(t) == brute_pii(t)


@pytest.mark.parametrize("text,kind,span", [
    ("Mail john.doe [at] example (dot) com now", "email", "john.doe [at] example (dot) com"),
    ("jane at mail dot example dot org!", "email", "jane at mail dot example dot org"),
    ("plus one four one five five five five two six seven one", "phone", "plus one four one five five five five two six seven one"),
    ("ｊｏｅ＠ｍａｉｌ．ｃｏｍ", "email", "ｊｏｅ＠ｍａｉｌ．ｃｏｍ"),
    ("no ４５３２０１５１１２８３０３６６ end", "card", "４５３２０１５１１２８３０３６６"),
    ("é 😀 ip １０.0.0.1 x", "ip", "１０.0.0.1"),
])
def test_pii_disguises_map_back_to_source(text, kind, span):
    base, more = pii.find_pii(text)
    assert base == brute_pii(text)
    assert [(pii.KINDS[k], text[s:e]) for k, s, e in more] == [(kind, span)]


@pytest.mark.parametrize("text,kind,span", [
    ("to john@example[dot]com now", "email", "john@example[dot]com"),
    ("to john@example[.]com", "email", "john@example[.]com"),
    ("ip 192[.]168[.]1[.]1 x", "ip", "192[.]168[.]1[.]1"),
    ("ip 192 dot 168 dot 1 dot 1 x", "ip", "192 dot 168 dot 1 dot 1"),
    ("ip one nine two dot one six eight dot one dot one x", "ip", "one nine two dot one six eight dot one dot one"),
    ("ip one nine two. one six eight. one. one x", "ip", "one nine two. one six eight. one. one"),
    ("card 4532 0151 1283 zero three six six x", "card", "4532 0151 1283 zero three six six"),
    ("card four five 32 0151 1283 036 six x", "card", "four five 32 0151 1283 036 six"),
    ("call +1 four one five 555 0123 x", "phone", "+1 four one five 555 0123"),
    ("４５３２０１５１１２８３０３６６ one of", "card", "４５３２０１５１１２８３０３６６"),
])
def test_pii_partly_disguised(text, kind, span):
    assert (kind, span) in [(pii.KINDS[k], text[s:e]) for k, s, e in pii.find_pii(text)[1]]


@pytest.mark.parametrize("text", ["one in 10 or 2 of three", "300 dot 1 dot 1 dot 1", "4532 0151 1283 zero three six seven", "me@home one dot", "in 2023 one. Two. Three"])
def test_pii_detectors_decide_on_disguises(text):
    assert pii.find_pii(text)[1] == []


@pytest.mark.parametrize("text", ["meet me at noon dot", "look at example.com", "one two three", "at dot at dot", "[at] (dot)", "naïve café"])
def test_pii_prose_gains_nothing(text):
    assert pii.find_pii(text)[1] == []


@pytest.mark.parametrize("text", ["jоhn@gmail.com", "john@gmail.cоm"])
def test_pii_wider_finds_stay_beside_base_spans(text):
    base, more = pii.find_pii(text)
    assert base == brute_pii(text) and len(base) == 1
    assert more == [(0, 0, 14)]
    assert pii.redact(text, pii.spelled(sorted(base + more))) == "<email>"


def test_pii_wider_address_with_a_disguised_dot():
    text = "to john@mail.example dot com"
    base, more = pii.find_pii(text)
    assert base == brute_pii(text) and len(base) == 1
    assert [text[s:e] for _, s, e in more] == ["john@mail.example dot com"]


def test_pii_query_edges(spark):
    got = pii.pii_spans(frame(spark)).collect()
    assert len(got) == len(ROWS)
    by = {(r.doc_id, r.spans) for r in got}
    assert (None, "email:0:6") in by and (2, "") in by
    assert {r.base_sha256 for r in got if r.doc_id == 1} == {sha("")}
    assert pii.pii_spans(frame(spark, [])).count() == 0
    assert pii.redact("hi a@b.co", "email:3:9") == "hi <email>"


ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_secrets(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32])


@pytest.mark.parametrize("seed", range(300))
def test_secret_base_is_the_plain_patterns(seed):
    t = noise(seed, ["PassWord", "api_key", "apikey", "token", "secret", "passwd", "\"", "'", " ", "=", ":", "abc", "deadbeef00", "AKIA", "Z9", "ſecret", "é", "\n", "0123456789abcdef"])
    assert secretscan.base_spans(t) == brute_secrets(t)


def test_secret_battery_tells_random_from_regular():
    r = random.Random(5)
    alphabet = secretscan.ENCODINGS["base64"]
    rejected = sum(secretscan.battery("".join(r.choice(alphabet) for _ in range(40)), "base64") < 1e-3 for _ in range(500))
    assert rejected <= 10
    for regular in ("abcdefghijklmnopqrstuvwxyz0123456789", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", "a1a1a1a1a1a1a1a1a1a1a1a1a1a1a1a1"):
        assert secretscan.battery(regular, "base62") < 1e-3


def test_secret_added_spans_are_controlled(spark):
    r = random.Random(7)
    key = lambda: "".join(r.choice(secretscan.ENCODINGS["base62"]) for _ in range(44))
    rows = [(i, f"the value {key()} stands here") for i in range(40)]
    rows += [(100 + i, f"see some_long_identifier_name_{i} and VeryLongCamelCaseIdentifierName{i} there") for i in range(40)]
    got = {x.doc_id: x for x in secretscan.secret_spans(frame(spark, rows + ROWS)).collect()}
    assert sum(got[i].n_added for i in range(40)) >= 36
    assert sum(got[100 + i].n_added for i in range(40)) == 0
    assert got[0].spans == "random:10:54"
    assert got[None].spans == "" and got[2].base_sha256 == sha("")
    assert secretscan.secret_spans(frame(spark, [])).count() == 0


@pytest.mark.parametrize("text", ["AUTH_KEY={}", "client_key={}", "x.org/a?id=3&sig={}&v=2", "a_name_of_more_than_twenty={}", "A={}=="])
def test_secret_after_an_equals_sign(spark, text):
    r = random.Random(9)
    rows = [(i, text.format("".join(r.choice(secretscan.ENCODINGS["base62"]) for _ in range(40)))) for i in range(40)]
    got = {x.doc_id: x for x in secretscan.secret_spans(frame(spark, rows)).collect()}
    assert sum(got[i].n_added for i in range(40)) >= 38
    at, pad = text.index("{"), 2 * text.endswith("==")
    assert {x.spans for x in got.values() if x.n_added} == {f"random:{at}:{at + 40 + pad}"}


@pytest.mark.parametrize("encoding", ["hex", "HEX", "base32", "base62"])
@pytest.mark.parametrize("size", [20, 24, 32, 48, 64, 128])
def test_secret_recall_by_encoding_and_length(spark, encoding, size):
    if encoding == "hex" and size >= 32:
        pytest.skip("a base kind")
    r = random.Random(size)
    prose = "the river was wide and the people who lived there had built their houses on the northern bank".split()
    rows = []
    for i in range(60):
        key = "".join(r.choice(secretscan.ENCODINGS[encoding]) for _ in range(size))
        rows.append((i, f"the value {key} stands here"))
    for i in range(120):
        words = [r.choice(prose) for _ in range(400)]
        name = "".join(w.title() for w in words)[: size - 2] + "27"
        other = "_".join(words)[: size - 3] + "_19"
        rows.append((1000 + i, f"{' '.join(words)} {name} {name.upper()} {other}"))
    got = {x.doc_id: x.n_added for x in secretscan.secret_spans(frame(spark, rows)).collect()}
    assert sum(got[i] for i in range(60)) >= 54
    assert sum(got[1000 + i] for i in range(120)) == 0


def test_secret_rank_and_cut_is_brute_force(spark):
    """Benjamini-Hochberg over all tokens, class by class, by a plain loop over the sorted p-values."""
    r = random.Random(11)
    prose = "the river was wide and the people who lived there had built their houses on the northern bank".split()
    rows = []
    for i in range(80):
        words = [r.choice(prose) for _ in range(60)]
        tokens_ = ["".join(r.choice(secretscan.ENCODINGS[r.choice(["hex", "base32", "base62", "base64"])]) for _ in range(r.choice([20, 22, 26, 30, 40, 70]))) for _ in range(r.randint(0, 2))]
        names = ["".join(w.title() for w in r.sample(prose, 5)) + str(r.randrange(99)) for _ in range(r.randint(0, 2))]
        rows.append((i, " ".join(words + tokens_ + names + [f"password={r.choice(tokens_ or ['abcdefgh'])}"])))
    logs = secretscan.letter_logs(sum((secretscan.letter_pairs(t.encode()) for _, t in rows), np.zeros(729, dtype=np.int64)))
    found = [(i, *c) for i, t in rows for c in secretscan.candidates(t, secretscan.base_spans(t), logs)]
    added = set()
    for length in {f[3] for f in found}:
        group = sorted((f for f in found if f[3] == length), key=lambda f: -f[4])  # by p-value
        last = 0
        for rank, f in enumerate(group, 1):
            if 10 ** (-f[4] / 4) * len(group) <= 0.01 * sum(g[4] >= f[4] for g in group):
                last = rank
        added |= {(f[0], f[1], f[2]) for f in group if last and f[4] >= group[last - 1][4] and f[5]}
    got = {(x.doc_id, *map(int, span.split(":")[1:])) for x in secretscan.secret_spans(frame(spark, rows)).collect() for span in x.spans.split(",") if span.startswith("random")}
    assert got == added and len(added) > 20


def test_many_spans_in_one_text_take_linear_time():
    import time
    n = 4000
    text = " ".join(f"password=abcdefgh{i} mail{i} at site{i} dot com user{i}@host{i}.org {i % 9}9.1.1.1" for i in range(n))
    start = time.time()
    base = secretscan.base_spans(text)
    secretscan.candidates(text, base, secretscan.letter_logs(np.zeros(729)))
    found, more = pii.find_pii(text)
    assert len(base) >= n and len(found) >= 2 * n and time.time() - start < 30


def test_spans_touch():
    r = random.Random(2)
    for _ in range(200):
        spans = [(a, a + r.randint(1, 6)) for a in (r.randrange(40) for _ in range(r.randint(0, 6)))]
        cover = common.Spans(spans)
        for s in range(42):
            for e in range(s + 1, s + 5):
                assert cover.touch(s, e) == any(a < e and s < b for a, b in spans)


def test_two_rank_tables_of_one_size_are_told_apart():
    one, two = {b"a": 0, b"b": 1, b"ab": 2}, {b"a": 0, b"b": 1, b"ba": 2}
    assert tokens.encoder(one, r"\w+")[0].encode("ab") == [2] and tokens.encoder(two, r"\w+")[0].encode("ab") == [0, 1]


@pytest.mark.parametrize("rule", tokens.RULES)
def test_tokens_match_brute_force(spark, rule):
    rows = ROWS + [(9, "one two\n\nthree   \n four" * 3)]
    encoding, size = tokens.encoder(tokens.read_ranks(tokens.RANKS), tokens.PATTERN)
    for r in tokens.section_tokens(frame(spark, rows), rule=rule).collect():
        texts = [t or "" for i, t in rows if i == r.doc_id]
        raw = texts[0].encode()
        where = []  # section of each byte
        for n, line in enumerate(re.findall(rb"[^\n]*\n|[^\n]+", raw)):
            where += [n] * len(line)
        want, at = [0] * (where[-1] + 1 if where else 0), 0
        for t in encoding.encode_ordinary(texts[0]):
            held = where[at: at + int(size[t])]
            at += int(size[t])
            want[{"start": held[0], "end": held[-1], "majority": max(sorted(set(held)), key=held.count)}[rule]] += 1
        assert at == len(raw) and r.tokens == want
    assert tokens.token_digest(tokens.section_tokens(frame(spark, []))).count() == 0


def test_token_digest(spark):
    got = tokens.token_digest(tokens.section_tokens(frame(spark, [(1, "a b\nc"), (2, None)]))).collect()
    assert [(r.doc_id, r.n_sections, r.n_tokens) for r in got] == [(1, 2, 4), (2, 0, 0)]


def ordinal_loss(z, g, t):
    cut = [0.0, *(1 / (1 + np.exp(-(x - z))) for x in t), 1.0]
    return -np.log(cut[g + 1] - cut[g])


def test_quality_slopes_are_derivatives():
    rng = np.random.default_rng(2)
    z, g, t, h = rng.normal(0, 2, 30), rng.integers(0, 3, 30), np.array([-.7, .9]), 1e-6
    by_score, by_threshold = quality.slopes(z, g, t)
    for i in range(30):
        assert abs((ordinal_loss(z[i] + h, g[i], t) - ordinal_loss(z[i] - h, g[i], t)) / (2 * h) - by_score[i]) < 1e-4
    for k in range(2):
        step = np.eye(2)[k] * h
        want = sum(ordinal_loss(z[i], g[i], t + step) - ordinal_loss(z[i], g[i], t - step) for i in range(30)) / (2 * h)
        assert abs(want - by_threshold[k]) < 1e-3


def test_quality_fit_equals_a_plain_loop():
    """The same steps with a dictionary of weights, a document at a time."""
    rng = np.random.default_rng(5)
    docs = [(sorted(rng.choice(40, rng.integers(0, 9), replace=False).tolist()), rng.integers(40, 50, rng.integers(0, 3)).tolist()) for _ in range(30)]
    grades = rng.integers(0, 3, 30)
    flat = [w + s for w, s in docs]
    at = np.cumsum([0, *map(len, flat)])
    value = np.array([1 / np.log(len(w) + 2.0) for w, _ in docs])
    model = quality.fit(at, np.array([b for d in flat for b in d], dtype=np.int32), np.array([len(w) for w, _ in docs]), value, grades, steps=40, batch=8)
    weights, seen, order = {}, {}, np.random.default_rng(0)
    share = np.cumsum(np.bincount(grades, minlength=3) + 1)[:-1] / 33
    t, seen_t = np.log(share / (1 - share)), np.full(2, 1e-8)
    for _ in range(10):
        turn = order.permutation(30)
        for start in range(0, 30, 8):
            part, grad, grad_t = turn[start: start + 8], {}, np.zeros(2)
            for d in part:
                x = [(b, value[d]) for b in docs[d][0]] + [(b, 1.0) for b in docs[d][1]]
                z = sum(weights.get(b, 0.0) * v for b, v in x)
                slope, by_t = quality.slopes(np.array([z]), grades[d: d + 1], t)
                grad_t += by_t / len(part)
                for b, v in x:
                    grad[b] = grad.get(b, 0.0) + slope[0] * v / len(part)
            for b, gr in grad.items():
                gr += 1e-4 * weights.get(b, 0.0)
                seen[b] = seen.get(b, 1e-8) + gr * gr
                weights[b] = weights.get(b, 0.0) - 0.6 * gr / np.sqrt(seen[b])
            seen_t += grad_t ** 2
            t = np.sort(t - 0.6 * grad_t / np.sqrt(seen_t))
    assert np.allclose([model.weights[b] for b in range(50)], [weights.get(b, 0.0) for b in range(50)], atol=1e-8)
    assert np.allclose(model.thresholds, t, atol=1e-8)
    words, shape = docs[3]
    assert abs(model.score(words, shape) - sum(weights.get(b, 0.0) for b in words) * value[3] - sum(weights.get(b, 0.0) for b in shape)) < 1e-8


def test_quality_held_out(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(300)]

    def doc(grade):
        text = [r.choice(words) for _ in range(r.randint(5, 80))]
        if grade == 0:
            for _ in range(3):
                text.insert(r.randrange(len(text)), r.choice(["vile", "nasty"]))
        return " ".join(w + "%%%" if grade == 1 else w for w in text)

    data = [(i, doc(i % 3)) for i in range(900)]
    labels = [(i, int(i % 3 != 1), int(i % 3 == 0)) for i, _ in data if i < 600] + [(None, 1, 1), (7, None, 0), (1, 0, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = frame(spark, data + [(10_000, None), (None, "")])
    model = quality.train(docs, labels, sample=500)
    assert model.thresholds[0] <= model.thresholds[1]
    again = quality.train(docs, labels, sample=500)
    assert np.array_equal(model.weights, again.weights)
    got = quality.graded(docs, model).collect()
    held = [g for g in got if g.doc_id is not None and 600 <= g.doc_id < 900]
    right = sum((g.p_good >= .5) == (g.doc_id % 3 == 2) for g in held) / len(held)
    assert right > .9
    order = [np.mean([g.expected_grade for g in held if g.doc_id % 3 == k]) for k in range(3)]
    assert order[0] < order[1] < order[2]
    assert len(got) == 902
    kept = quality.select_good(docs, model)
    assert kept.columns == docs.columns
    assert {x.doc_id for x in kept.collect()} == {g.doc_id for g in got if g.p_good >= .5}
    empty = quality.train(docs, labels.limit(0))
    assert quality.graded(frame(spark, []), empty).count() == 0
