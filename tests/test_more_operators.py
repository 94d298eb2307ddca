import json
import os
import tempfile

from pyspark.sql import functions as F

from lumenkg.operators.articles import with_article_defaults
from lumenkg.operators.enrich import enrich_articles, route_mentions
from lumenkg.operators.graph import with_json_ld
from lumenkg.sources.publications import limit_publications, read_publications
from lumenkg.sources.sinks import article_json


def test_read_publications(spark):
    d = tempfile.mkdtemp(prefix="lumenkg-csv-")
    with open(os.path.join(d, "pubs.csv"), "w", encoding="utf-8") as f:
        f.write('Title,Link\n'
                '"Mice in Bion-M 1 space mission: training and selection",https://www.ncbi.nlm.nih.gov/pmc/articles/PMC4136787/\n'
                '  Effects of microgravity on bone density  , https://www.ncbi.nlm.nih.gov/pmc/articles/PMC5847291/ \n'
                'NA,https://x/1\n'
                'Only title,\n'
                '"   ",https://x/2\n')
    rows = read_publications(spark, os.path.join(d, "pubs.csv")).orderBy("pos").collect()
    assert [(r.title, r.url, r.pmcid) for r in rows] == [
        ("Mice in Bion-M 1 space mission: training and selection",
         "https://www.ncbi.nlm.nih.gov/pmc/articles/PMC4136787/", "PMC4136787"),
        ("Effects of microgravity on bone density", "https://www.ncbi.nlm.nih.gov/pmc/articles/PMC5847291/",
         "PMC5847291"),
    ]
    assert limit_publications(read_publications(spark, os.path.join(d, "pubs.csv")), 1).count() == 1


def _art(spark, **kw):
    base = {"article_id": "a1", "title": "T", "url": "http://x", "abstract": "Bone loss in mice, TP53 and 5 mg.",
            "llm_extracted": False}
    base.update(kw)
    cols = ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'string'}" for k, v in base.items())
    return with_article_defaults(spark.createDataFrame([tuple(base.values())], cols))


def test_route_mentions_and_enrich(spark):
    arts = _art(spark)
    ment = spark.createDataFrame([("a1", "GENE", "AB"), ("a1", "GENE", " TP53 "), ("a1", "DRUG", "Aspirin"),
                                  ("a1", "DISEASE", "Osteopenia"), ("a1", "SPECIES", "Mus")],
                                 "article_id string, label string, text string")
    r = enrich_articles(arts, "main", mentions=ment).first()
    assert r.genes == ["TP53", "tp53"]
    assert r.measurements == ["5 mg", "aspirin"]
    assert "osteopenia" in r.conditions and "bone" in r.conditions
    assert r.organisms == ["mice", "mus"]


def test_enrich_gates_and_strict(spark):
    r = enrich_articles(_art(spark, llm_extracted=True), "main").first()
    assert r.genes == [] and r.organisms == []
    s = enrich_articles(_art(spark, abstract="bone density in mice measured"), "strict",
                        extractors={"n_words": F.size(F.split("abstract", " "))}).first()
    assert s.measurements == ["bone density"] and s.organisms == ["mice"] and s.conditions == []
    assert s.n_words == 5
    blank = enrich_articles(_art(spark, abstract="   "), "main").first()
    assert blank.genes == []


def test_json_ld_profiles(spark):
    df = _art(spark, pmcid="PMC1")
    main = json.loads(with_json_ld(df, "main").first().json_ld)
    assert main["@id"] == "http://space-biology.org/article/PMC1"
    assert main["schema:identifier"] == [{"@type": "schema:PropertyValue", "schema:propertyID": "PMCID",
                                          "schema:value": "PMC1"}]
    assert "schema:text" not in main and main["llm_extracted"] is False
    strict = json.loads(with_json_ld(df, "strict").first().json_ld)
    assert strict["schema:text"] is None and strict["dcterms:created"] is None
    assert "llm_extracted" not in strict


def test_article_json(spark):
    js = json.loads(_art(spark).select(article_json(_art(spark)).alias("j")).first().j)
    assert js["title"] == "T" and js["keywords"] == [] and js["doi"] is None


def test_publications_keep_file_order(spark):
    d = tempfile.mkdtemp(prefix="lumenkg-csv-")
    for name, n in (("a.csv", 2), ("b.csv", 300), ("c.csv", 5)):
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write("Title,Link\n" + "".join(f"{name} title {i},http://x/{name}/{i}\n" for i in range(n)))
    for multi_line in (True, False):
        rows = read_publications(spark, d, multi_line).orderBy("pos").collect()
        assert [r.title for r in rows] == [f"{name} title {i}" for name, n in (("a.csv", 2), ("b.csv", 300), ("c.csv", 5)) for i in range(n)]
        assert [r.pos for r in rows] == list(range(307))


def test_graph_nodes_keep_all_names(spark):
    from lumenkg.functions import vocab
    from lumenkg.operators.graph import graph_tables
    name = vocab.SCHEMA_NS + "name"
    t = spark.createDataFrame([("s", vocab.RDF_TYPE, "T", "uri"), ("s", name, "b", "literal"), ("s", name, "a", "literal"), ("s", "p", "o", "uri")],
                              "s string, p string, o string, o_kind string")
    nodes, edges = graph_tables(t)
    assert [tuple(r) for r in nodes.collect()] == [("s", "T", ["a", "b"])] and edges.count() == 1


def test_strict_thresholds_are_parameters(spark):
    from lumenkg.functions.quality import is_valid, quality_score
    df = _art(spark, title="A title of some length", abstract="x" * 60)
    low = {"min_title_length": 5, "min_abstract_length": 50, "min_full_text_length": 10}
    r = df.select(quality_score("strict").alias("a"), quality_score("strict", thresholds=low).alias("b"),
                  is_valid("strict").alias("c"), is_valid("strict", required=("title", "url", "journal")).alias("d")).first()
    assert (round(r.b - r.a, 9), r.c, r.d) == (0.2, True, False)


def test_terms_equal_contains_and_shards_add_up(spark):
    import random
    import re
    from lumenkg.operators.enrich import match_terms
    rnd = random.Random(5)
    letters = "abcABC é日1_-"
    texts = [(i, "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 5, 60, 300])))) for i in range(60)] + [(100, None), (101, "x" * 300_000 + "needle")]
    terms = sorted({(rnd.choice("pq"), "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 4)))) for _ in range(150)} | {("p", "needle"), ("q", "needle")})
    df, g = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(terms + terms[:5] + [("p", ""), ("p", None)], "category string, term string")
    for fold in (True, False):
        for whole in (True, False):
            lower = str.lower if fold else str
            want = set()
            for i, t in texts:
                for c, term in terms:
                    if t is not None and lower(term) in lower(t):
                        if not whole or re.search(r"(?<!\w)" + re.escape(lower(term)) + r"(?!\w)", lower(t)):
                            want.add((i, c, term))
            for size in (1_000_000, 200):
                rows = [tuple(r) for r in match_terms(df, "text", g, "doc_id", case_insensitive=fold, word_boundary=whole, shard_chars=size).collect()]
                assert len(rows) == len(set(rows)) and set(rows) == want, (fold, whole, size)


def test_a_hundred_thousand_terms_without_a_shuffle_of_texts(spark):
    from lumenkg.operators.enrich import match_terms
    g = spark.range(100_000).selectExpr("'c' AS category", "concat('term', id, 'x') AS term")
    df = spark.createDataFrame([(i, f"some text with TERM{i * 37}x and term{i}y in it") for i in range(500)], "doc_id long, text string")
    hits = match_terms(df, "text", g, "doc_id")
    assert sorted(tuple(r) for r in hits.collect()) == sorted((i, "c", f"term{i * 37}x") for i in range(500))
    assert "Exchange" not in hits._jdf.queryExecution().executedPlan().toString()


def test_metrics_taken_while_writing_equal_the_aggregates(spark):
    from pyspark.sql import functions as F
    from lumenkg.operators.metrics import Watched, article_metrics, run_metrics
    from lumenkg.session import materialise
    rows = [(i, f"title {i}" if i % 4 else "", f"u{i}", .1 * i, i % 3 == 0, .2 * (i % 5), ["mice"] * (i % 3), ["g"] * (i % 2)) for i in range(20)]
    arts = spark.createDataFrame(rows, "pos long, title string, url string, quality_score double, llm_extracted boolean, llm_confidence_score double, organisms array<string>, genes array<string>")
    runs = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        runs.add(1)
        return x

    arts = arts.repartition(3).withColumn("pos", counted.asNondeterministic()("pos"))
    pubs = spark.range(25)
    run = Watched()
    materialise(run.count(pubs, "publications"))
    valid = materialise(run.watch(arts, "articles", *article_metrics()))
    kept = run.count(valid.where("pos % 2 = 0"), "kept")
    materialise(kept)
    got = run.report(spark)
    assert runs.value == 20
    want = run_metrics(valid, publications=pubs, kept=valid.where("pos % 2 = 0"))
    assert got.select(*sorted(got.columns)).collect() == want.select(*sorted(want.columns)).collect()


def test_wide_rows_are_evaluated_once(spark):
    import hashlib
    from pyspark.sql import functions as F
    from lumenkg.operators.dedup import deduplicate
    runs = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        runs.add(1)
        return x

    df = spark.createDataFrame([(i, hashlib.md5(str(i).encode()).hexdigest(), "body") for i in range(10)] + [(10, hashlib.md5(b"0").hexdigest(), "body")], "pos long, title string, text string")
    out = deduplicate(df.withColumn("text", counted.asNondeterministic()("text")))
    assert out.count() == 10 and out.columns == ["pos", "title", "text"] and runs.value == 11


def test_graph_counts_equal_the_tables(spark):
    from pyspark.sql import functions as F
    from lumenkg.functions import vocab
    from lumenkg.operators.graph import graph_counts, graph_tables, in_degree
    ty = vocab.RDF_TYPE
    rows = [("a", ty, "T", "uri"), ("a", ty, "T", "uri"), ("b", ty, "T", "uri"), ("a", "link", "k", "uri"), ("b", "link", "k", "uri"), ("b", "other", "k", "uri"),
            ("k", ty, "K", "uri"), ("a", "name", "x", "literal")]
    t = spark.createDataFrame(rows, "s string, p string, o string, o_kind string")
    nodes, edges = graph_tables(t)
    want = {("node", r.type, r.n) for r in nodes.groupBy("type").agg(F.count("*").alias("n")).collect()}
    want |= {("edge", r.predicate, r.n) for r in edges.groupBy("predicate").agg(F.count("*").alias("n")).collect()}
    want |= {("max_in_degree", "any", in_degree(edges).agg(F.max("in_degree")).first()[0])}
    assert {tuple(r) for r in graph_counts(t).collect()} == want


def test_triples_of_pages_hold_few_pages_in_a_worker(spark, tmp_path):
    """From pages to triples no step gathers pages into Arrow batches."""
    from lumenkg.operators.graph import merge_triples, to_triples
    from lumenkg.plans import catalog
    html = "<title>Mice in space</title><body><p>microgravity and mice, " + "a text of some length, " * 9 + "</p></body>"
    spark.createDataFrame([(1, "http://x.org/1", html), (2, "http://x.org/2", None)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = merge_triples(to_triples(catalog._pages_enriched(spark, str(tmp_path))))
    assert "ArrowEvalPython" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.o for r in out.where("o_kind = 'literal'").collect()} >= {"Mice in space", "mice", "microgravity"}
