import os
import tempfile

from pyspark.sql import functions as F

from lumenkg.operators.cascade import article_cascade
from lumenkg.sources.sinks import write_outputs
from lumenkg.streaming.incremental import run_incremental

SCHEMA = "pos long, title string, url string, pmcid string, page_text string"


def test_incremental_registry_and_sinks(spark):
    root = tempfile.mkdtemp(prefix="lumenkg-test-")
    src = os.path.join(root, "in")
    rows1 = [(1, "Effects of microgravity on bone density", "http://a/1", "PMC1", None),
             (2, "Effects of microgravity on bone density!", "http://a/2", None, None)]
    spark.createDataFrame(rows1, SCHEMA).write.parquet(os.path.join(src, "b1"))
    out, reg, ck = (os.path.join(root, x) for x in ("out", "reg", "ck"))
    q = run_incremental(spark, os.path.join(src, "*"), SCHEMA, lambda b: article_cascade(b), out, reg, ck)
    q.awaitTermination(120)
    assert sorted(r.pos for r in spark.read.parquet(out).collect()) == [1]
    rows2 = [(3, "A new unrelated study of plants", "http://a/3", "PMC1", None),
             (4, "Totally different fungus paper", "http://a/4", None, None)]
    spark.createDataFrame(rows2, SCHEMA).write.parquet(os.path.join(src, "b2"))
    q = run_incremental(spark, os.path.join(src, "*"), SCHEMA, lambda b: article_cascade(b), out, reg, ck)
    q.awaitTermination(120)
    assert sorted(r.pos for r in spark.read.parquet(out).collect()) == [1, 4]   # pos 3 shares PMC1
    arts = spark.read.parquet(out)
    write_outputs(arts, os.path.join(root, "sink"), formats=("json", "json-ld", "rdf", "csv"))
    nt = spark.read.text(os.path.join(root, "sink", "rdf")).collect()
    assert any("<https://schema.org/name>" in r.value for r in nt)
    rec = spark.read.json(os.path.join(root, "sink", "json")).first()
    assert set(rec.asDict()) == {"article_data", "json_ld", "rdf_triples", "graph_entities"}


def test_replayed_batch_leaves_no_duplicate(spark):
    import shutil
    root = tempfile.mkdtemp(prefix="lumenkg-test-")
    src = os.path.join(root, "in")
    out, reg, ck = (os.path.join(root, x) for x in ("out", "reg", "ck"))
    for n, row in enumerate([(1, "Effects of microgravity on bone", "http://a/1", "PMC1", None), (2, "Plants grown far from any soil", "http://a/2", None, None)]):
        spark.createDataFrame([row], SCHEMA).write.parquet(os.path.join(src, f"b{n}"))
        run_incremental(spark, os.path.join(src, "*"), SCHEMA, lambda b: article_cascade(b), out, reg, ck).awaitTermination(120)
    # the second batch's commit is lost: it runs again
    os.remove(os.path.join(ck, "commits", "1"))
    for f in os.listdir(os.path.join(ck, "commits")):
        if f.startswith(".1."):
            os.remove(os.path.join(ck, "commits", f))
    run_incremental(spark, os.path.join(src, "*"), SCHEMA, lambda b: article_cascade(b), out, reg, ck).awaitTermination(120)
    assert sorted(r.pos for r in spark.read.parquet(out).collect()) == [1, 2]
    assert spark.read.parquet(os.path.join(reg, "keys")).groupBy("key").count().filter("count > 1").count() == 0


def test_sink_options(spark):
    from lumenkg.sources.sinks import ntriples
    root = tempfile.mkdtemp(prefix="lumenkg-test-")
    arts = article_cascade(spark.createDataFrame([(1, "A long enough title", "http://a/<x y>", "PMC1", "text " * 300)], SCHEMA))
    write_outputs(arts, root, formats=("json", "json-ld", "rdf"), include_full_text=False, timestamp_suffix="20250101")
    assert sorted(os.listdir(root)) == ["json-ld_20250101", "json_20250101", "rdf_20250101"]
    lines = [r.value for r in spark.read.text(os.path.join(root, "rdf_20250101")).collect()]
    assert any(x.endswith('"false"^^<http://www.w3.org/2001/XMLSchema#boolean> .') for x in lines)
    assert any("<http://a/%3Cx%20y%3E>" in x for x in lines)
    t = spark.createDataFrame([("s", "http://purl.org/dc/terms/created", "2020-01-01T00:00:00", "literal")], "s string, p string, o string, o_kind string")
    assert ntriples(t).first().value.endswith('"2020-01-01T00:00:00"^^<http://www.w3.org/2001/XMLSchema#dateTime> .')


def sequential_batches(batches, threshold=85):
    """Positions that a plain loop over the batches keeps."""
    from lumenkg.functions.similarity import ratio
    ids, titles, out = set(), [], []
    for rows in batches:
        new_ids, new_titles, kept = set(), [], []
        for pos, title, doi in sorted(rows):
            t = (title or "").lower()
            if doi in ids or any(ratio(t, x) >= threshold for x in titles):
                continue  # known from an earlier batch
            if doi and doi in new_ids or any(ratio(t, x) >= threshold for x in new_titles):
                continue
            kept.append(pos)
            new_titles.append(t)
            new_ids.add(doi)
        ids |= {d for d in new_ids if d}
        titles += new_titles
        out.append(kept)
    return out


def test_the_index_equals_a_loop_over_batches(spark):
    import random
    from lumenkg.operators.dedup import deduplicate
    from lumenkg.operators.registry import SeenIndex
    rnd = random.Random(3)
    words = ["bone", "loss", "mice", "rat", "space", "gene", "density", "plant", "cell"]
    batches = [[(100 * b + i, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 1, 3, 5, 6]))), rnd.choice([None] * 6 + ["d1", "d2", "d3"]))
                for i in range(40)] for b in range(3)]
    batches[1] += [(190, "ab", None), (191, "Bone", None), (192, "", None)]
    batches[2] += [(290, "abc", None), (291, "ac", None), (292, "bon", None)]
    index = SeenIndex(spark, tempfile.mkdtemp(prefix="lumenkg-test-"), buckets=32)
    got = []
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "pos long, title string, doi string")
        kept = deduplicate(index.drop(df, n)).select("pos", "title", "doi", *(F.lit(None).cast("string").alias(c) for c in ("pmid", "pmcid"))).collect()
        got.append(sorted(r.pos for r in kept))
        for _ in range(2):  # a repeated batch replaces its part
            index.add(spark.createDataFrame(kept, "pos long, title string, doi string, pmid string, pmcid string"), n)
    assert got == sequential_batches(batches)


def test_a_batch_reads_only_the_buckets_it_hits(spark):
    from lumenkg.operators.registry import SeenIndex
    index = SeenIndex(spark, tempfile.mkdtemp(prefix="lumenkg-test-"), buckets=64)
    known = [(i, f"title {i} of a registry {i * 7919 % 1000}", None, None, None) for i in range(300)]
    index.add(spark.createDataFrame(known, "pos long, title string, doi string, pmid string, pmcid string"), 0)
    own = index._wanted(spark.createDataFrame([("id:x",), ("t:y",)], "key string").select(index._bucket("key")))
    files = index.read("keys", 1, own).inputFiles()
    every = index.read("keys", 1).inputFiles()
    plan = index.read("keys", 1, own)._jdf.queryExecution().executedPlan().toString()
    assert len(own) <= 2 and "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:200]
    assert len({f.split("bucket=")[1].split("/")[0] for f in every}) > 40 and len(files) <= len(every)
    assert {r.bucket for r in index.read("keys", 1, own).select("bucket").distinct().collect()} <= set(own)


def test_the_triple_store_equals_the_merged_graph(spark):
    import random
    from lumenkg.functions import vocab
    from lumenkg.operators.graph import merge_triples
    from lumenkg.operators.triple_store import TripleStore
    rnd = random.Random(2)
    schema = "s string, p string, o string, o_kind string"

    def some(n):
        return [(f"s{rnd.randrange(15)}", rnd.choice(["link", "name", vocab.RDF_TYPE]), rnd.choice([None, *(f"s{i}" for i in range(12))]), rnd.choice(["uri", "literal"])) for _ in range(n)]

    batches = [some(60), some(60), some(10)]
    root = tempfile.mkdtemp(prefix="lumenkg-test-")
    store = TripleStore(spark, root, buckets=8)
    assert store.triples().count() == 0 and store.degrees().count() == 0
    for n, rows in enumerate(batches):
        for _ in range(2):  # a repeated batch replaces itself
            store.add(spark.createDataFrame(rows, schema), n)
    merged = merge_triples(spark.createDataFrame(sum(batches, []), schema))
    assert sorted(map(str, store.triples().collect())) == sorted(map(str, merged.collect()))
    want = {}
    for s, p, o, kind in {tuple(r) for r in merged.collect()}:
        if kind == "uri" and p != vocab.RDF_TYPE:
            want.setdefault(o, [0, 0])[0] += 1
            want.setdefault(s, [0, 0])[1] += 1
    assert {r.uri: [r.in_degree, r.out_degree] for r in store.degrees().collect()} == want

    def files():
        return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))

    before = [f for f in files() if "batch_id=0" in f or "batch_id=1" in f or "batch_id=2" in f]
    store.add(spark.createDataFrame(sum(batches, []), schema), 3)  # all known: nothing is added, nothing rewritten
    assert set(before) <= set(files()) and store.triples().count() == merged.count()
    assert spark.read.parquet(os.path.join(root, "triples", "batch_id=0")).count() < merged.count()


def test_several_formats_run_the_plan_once(spark):
    runs = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        runs.add(1)
        return x

    arts = article_cascade(spark.createDataFrame([(i, f"A long enough title {i}", f"http://a/{i}", f"PMC{i}", "text, \"quoted\"\n" * 30) for i in range(7)], SCHEMA))
    root = tempfile.mkdtemp(prefix="lumenkg-test-")
    write_outputs(arts.withColumn("title", counted.asNondeterministic()("title")), root, formats=("json", "json-ld", "rdf", "csv"))
    assert runs.value == 7
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(os.path.join(root, "csv"))
    assert sorted(r.title for r in back.collect()) == [f"A long enough title {i}" for i in range(7)]
    import pytest
    with pytest.raises(ValueError):
        write_outputs(arts, root, formats=("json", "xml"))


def test_the_index_files_a_title_once(spark):
    from lumenkg.operators.registry import SeenIndex
    root = tempfile.mkdtemp(prefix="lumenkg-test-")
    known = [(i, f"title {i} of a registry {i * 7919 % 1000}", None, None, None) for i in range(100)]
    index = SeenIndex(spark, root, buckets=8)
    index.add(spark.createDataFrame(known, "pos long, title string, doi string, pmid string, pmcid string"), 0)
    rows = sum(spark.read.parquet(f"{root}/{name}").count() for name in os.listdir(root))
    assert rows == 200  # its key and its text
