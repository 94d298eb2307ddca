"""The pipeline against plain Python versions of its stages, on a small fixture."""
import os
import random
import tempfile

import numpy as np

import corpus_pipeline
from lumenkg.llm import mixing, quality
from test_corpus_operators import WORD, brute_components, brute_fingerprint, lower

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def fixture(spark):
    r = random.Random(11)
    words = [f"word{i}" for i in range(400)]
    item = " ".join(r.choice(words) for _ in range(14))
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = []
    for i in range(240):
        kind = i % 8
        text = prose(r.randint(20, 80))
        if kind == 1:
            text = " ".join(w + "%%%" for w in text.split())
        elif kind == 2:
            text += " vile nasty vile"
        elif kind == 3:
            text += "\n" + item.upper() + "\n" + prose(40)
        elif kind == 4 and rows:
            text = rows[i - 4][1]
        if i % 3 == 0:
            text = "shared header line\n" + text
        rows.append((i, text, "en", f"src{i % 3}", len(text)))
    rows += [(500, None, None, None, None), (501, "", "en", "src1", 0), (502, item, "en", "src1", len(item)), (503, "\n\n", "en", "src1", 2)]
    sf = tempfile.mkdtemp(prefix="lumenkg-pipeline-")
    write = lambda data, schema, name: spark.createDataFrame(data, schema).write.parquet(os.path.join(sf, f"{name}.parquet"))
    write(rows, COLUMNS, "documents")
    write([(i, int(i % 8 != 1), int(i % 8 == 2)) for i in range(200)], "doc_id long, quality int, toxic int", "labels")
    write([(1, item), (2, None), (3, "")], "item_id long, text string", "benchmark")
    return sf, rows, item


def test_pipeline_is_its_stages_in_plain_python(spark):
    sf, rows, item = fixture(spark)
    got = corpus_pipeline.run(spark, sf).collect()

    model = quality.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), sample=20_000)
    good = lambda t: model.tails(np.array([model.score(*quality.features((t or "").encode()))]))[0, -1] >= .5
    docs = [r for r in rows if good(r[1])]
    assert sum(r[0] % 8 in (1, 2) for r in docs if r[0] < 500) <= 6 and len(docs) >= 150

    pages, held = {}, {}
    for _, t, _, h, _ in docs:
        pages[h] = pages.get(h, 0) + 1
        for x in {x.strip(" \t\r\x0b\x0c") for x in (t or "").split("\n")} - {""}:
            held[h, x] = held.get((h, x), 0) + 1
    drop = {k for k, n in held.items() if n >= 5 and n > .02 * pages[k[0]]}
    cut = lambda t, h: None if t is None else "\n".join(x for x in t.split("\n") if (h, x.strip(" \t\r\x0b\x0c")) not in drop)
    docs = [(i, cut(t, h), h) for i, t, _, h, _ in docs]
    assert any("shared header line" in (x or "") for _, x, *_ in rows) and not any("shared header line" in (x or "") for _, x, _ in docs)

    root = brute_components([brute_fingerprint(t) for _, t, _ in docs], 4)
    least = {}
    for (i, *_), g in zip(docs, root):
        least[g] = min(least.get(g, i), i)
    docs = [d for d, g in zip(docs, root) if least[g] == d[0]]

    want, windows = {}, [item.split()[p: p + 10] for p in range(len(item.split()) - 9)]
    for i, t, h in docs:
        spans = [m.span() for m in WORD.finditer(t or "")]
        ws = [lower((t or "")[a:b]) for a, b in spans]
        hit = sorted({q for p in range(len(ws) - 9) if ws[p: p + 10] in windows for q in range(p, p + 10)})
        if len(hit) > .5 * len(ws):
            continue
        if hit:
            out, at = "", 0
            for q in hit:
                if q - 1 not in hit:
                    out += t[at: spans[q][0]]
                at = spans[q][1]
            t = out + t[at:]
        want[i] = (t, h)
    assert {g.doc_id: (g.text, g.source) for g in got} == want
    assert all(g.n_chars == (None if g.text is None else len(g.text)) for g in got)
    slots = {(g.source, g.mix_block): g.mix_slot for g in got}
    assert len(set(slots.values())) == len(slots) and all(g.mix_release <= g.mix_slot < g.mix_due for g in got)
    assert len(mixing.mix(spark.createDataFrame([], COLUMNS)).collect()) == 0


def test_stages_return_the_columns_of_documents(spark):
    sf, _, _ = fixture(spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), sf)
        assert out.columns == docs.columns and out.count() == 0
        assert stage(spark, docs, sf).dtypes == docs.dtypes
