import json

from pyspark.sql import functions as F

from lumenkg.operators.cascade import article_cascade
from lumenkg.operators.graph import to_triples
from lumenkg.operators.articles import with_article_defaults
from lumenkg.sources.bioc import pmc_articles
from lumenkg.sources.html import doi_from_page, journal_from_page, parse_page, parse_pages, pmcid_from_page, pmid_from_page
from lumenkg.sources.replies import first_valid_reply


def _reply(content):
    return json.dumps({"choices": [{"message": {"content": content}}]})


def _map(spark, contents, title="Input title long enough"):
    pubs = spark.createDataFrame([(i, f"u{i}", title, None) for i in range(len(contents))],
                                 "pos long, url string, title string, pmcid string")
    rep = spark.createDataFrame([(f"u{i}", "deepseek", 200, _reply(c)) for i, c in enumerate(contents)],
                                "url string, provider string, status int, body string")
    out = {r.pos: r.llm for r in first_valid_reply(pubs, rep).collect()}
    return [out.get(i) for i in range(len(contents))]


def test_reply_mapping_rules(spark):
    got = _map(spark, [
        '{"title": null}',                                   # present null title -> dropped
        '{"abstract": "x"}',                                 # missing title -> input title
        '{"title": "T", "confidence_score": null}',          # null confidence -> dropped
        '{"title": "T", "confidence_score": "high"}',        # not castable -> dropped
        '{"title": "T", "confidence_score": "0.9"}',
        '{"title": "T"}',                                    # missing confidence -> 0.0
        '{"title": "T", "authors": ["A", {"name": "B"}, null], "organisms": "x"}',
        'Sure! {"title": "T2"} done',
        'no braces here',
    ])
    assert got[0] is None
    assert got[1].title == "Input title long enough"
    assert got[2] is None and got[3] is None
    assert got[4].llm_confidence_score == 0.9
    assert got[5].llm_confidence_score == 0.0
    assert [(a.name, a.affiliation) for a in got[6].authors] == [("A", None), ("B", None)]
    assert got[6].organisms == []
    assert got[7].title == "T2" and got[7].extraction_source == "llm_deepseek"
    assert got[8] is None


def test_first_provider_wins_even_if_low_score(spark):
    pubs = spark.createDataFrame([(1, "u", "Some title of a paper", None)], "pos long, url string, title string, pmcid string")
    rep = spark.createDataFrame([
        ("u", "groq", 200, _reply('{"title": "G", "abstract": "' + "a" * 80 + '"}')),
        ("u", "deepseek", 200, _reply('{"title": "D"}')),
        ("u", "together", 500, _reply('{"title": "X"}')),
    ], "url string, provider string, status int, body string")
    r = first_valid_reply(pubs, rep).first().llm
    assert r.title == "D" and r.extraction_source == "llm_deepseek"


def test_bioc_passages(spark):
    doc = {"documents": [{"passages": [{"infons": {"type": "front"}, "text": "Title line"},
                                       {"infons": {"type": "Abstract"}, "text": "mice in space " * 5},
                                       {"text": "body"}]}]}
    pubs = spark.createDataFrame([(1, "u", "A title about mice", "PMC1")], "pos long, url string, title string, pmcid string")
    bioc = spark.createDataFrame([("PMC1", json.dumps(doc))], "pmcid string, json string")
    a = pmc_articles(pubs, bioc).first().pmc
    assert a.abstract == ("mice in space " * 5).strip()
    assert a.full_text == "Title line\nbody"
    assert a.organisms == ["mice"] and a.keywords == ["space"]
    assert a.extraction_source == "pmc_api_fallback"


def test_cascade_branches(spark):
    pubs = spark.createDataFrame([
        (1, "p1", "Long enough title one", None, "x" * 1200),   # html text -> html_fallback
        (2, "p2", "Long enough title two", None, None),         # nothing -> minimal
        (3, "p3", "Long enough title three", "PMC9", None),     # pmc document
    ], "pos long, url string, title string, pmcid string, page_text string")
    bioc = spark.createDataFrame([("PMC9", json.dumps({"documents": [{"passages": [
        {"infons": {"type": "abstract"}, "text": "b" * 80}]}]}))], "pmcid string, json string")
    c = article_cascade(pubs, pmc_articles=pmc_articles(pubs, bioc))
    got = {r.url: r.extraction_source for r in c.collect()}
    assert got == {"p1": "html_fallback", "p2": "minimal_metadata", "p3": "pmc_api_fallback"}
    assert article_cascade(pubs.filter("url = 'p2'"), test_mode=False).count() == 0


def test_minimal_article_triples(spark):
    df = spark.createDataFrame([("A title", "http://x/y", "An abstract", ["kw"])],
                               "title string, url string, abstract string, keywords array<string>")
    t = to_triples(with_article_defaults(df))
    assert t.count() == 8


def test_html_parse_rules():
    html = ("<html><head><title>T &amp; U</title><meta name='citation_doi' content='10.1000/xyz'>"
            "<link rel='canonical' href='https://www.ncbi.nlm.nih.gov/pmc/articles/PMC77/'></head>"
            "<body><nav>menu</nav><div class='journal-title'> J Space </div>"
            "<div class='abstract'>Short abs</div><article>" + "word " * 150 + "</article>"
            "<a href='https://pubmed.ncbi.nlm.nih.gov/pubmed/123'>p</a><footer>f</footer></body></html>")
    p = parse_page(html)
    assert p["title"] == "T & U"
    assert p["text"].startswith("Abstract: Short abs\n\nword word")
    assert p["journal_sel"] == "J Space"
    assert p["meta"]["citation_doi"] == "10.1000/xyz"
    short = parse_page("<html><body><nav>x</nav><p>hello</p><footer>y</footer></body></html>")
    assert short["text"] == "hello"


def test_html_accessors(spark):
    html = ("<html><head><title>T</title><link rel='canonical' href='https://www.ncbi.nlm.nih.gov/pmc/articles/PMC77/'>"
            "</head><body><p>see doi 10.12345/abc.d now</p><a href='/x'>x</a>"
            "<a href='https://www.ncbi.nlm.nih.gov/PubMed/55'>q</a><a href='https://x/pubmed/42'>p</a></body></html>")
    df = parse_pages(spark.createDataFrame([(1, html)], "id long, html string"))
    r = df.select(doi_from_page(), journal_from_page(), pmcid_from_page(), pmid_from_page()).first()
    assert tuple(r) == ("10.12345/abc.d", None, "PMC77", "42")


def test_shared_url_gives_one_row_each(spark):
    pubs = spark.createDataFrame([(1, "u", "First long title here", "PMC1"), (2, "u", "Second long title here", "PMC1")],
                                 "pos long, url string, title string, pmcid string")
    rep = spark.createDataFrame([("u", "groq", 200, _reply('{"abstract": "' + "a" * 80 + '", "confidence_score": 1}'))],
                                "url string, provider string, status int, body string")
    doc = json.dumps({"documents": [{"passages": [{"text": "body " * 30}]}]})
    bioc = spark.createDataFrame([("PMC1", doc)], "pmcid string, json string")
    pages = spark.createDataFrame([("u", "text " * 50), ("u", "other " * 50)], "url string, page_text string")
    llm = first_valid_reply(pubs, rep)
    assert {r.pos: r.llm.title for r in llm.collect()} == {1: "First long title here", 2: "Second long title here"}
    c = article_cascade(pubs, page_text=pages, llm_articles=llm, pmc_articles=pmc_articles(pubs, bioc))
    assert sorted((r.pos, r.title) for r in c.collect()) == [(1, "First long title here"), (2, "Second long title here")]


def test_broken_documents_fall_through(spark):
    good = json.dumps({"documents": [{"passages": [{"text": "kept " * 30}]}]})
    bodies = ["not json", "", '{"documents": 5}', '["x"]', good, "{}", good]
    pubs = spark.createDataFrame([(i, f"u{i}", "A title that is long", f"PMC{i}", "page text " * 20) for i in range(7)],
                                 "pos long, url string, title string, pmcid string, page_text string")
    bioc = spark.createDataFrame([(f"PMC{i}", b, 404 if i == 6 else 200) for i, b in enumerate(bodies)],
                                 "pmcid string, json string, status int")
    c = article_cascade(pubs, pmc_articles=pmc_articles(pubs, bioc))
    got = {r.pos: r.extraction_source for r in c.collect()}
    assert got == {i: "pmc_api_fallback" if i in (4, 5) else "html_fallback" for i in range(7)}


def test_one_usable_response_of_a_pmcid_is_taken(spark):
    body = lambda t: json.dumps({"documents": [{"passages": [{"text": t}]}]})
    pubs = spark.createDataFrame([(1, "u", "A title that is long", "PMC1")], "pos long, url string, title string, pmcid string")
    bioc = spark.createDataFrame([("PMC1", body("b")), ("PMC1", body("a")), ("PMC1", "broken"), ("PMC2", body("c"))], "pmcid string, json string")
    assert pmc_articles(pubs, bioc).first().pmc.full_text == "a"


def test_boolean_items_are_spelled_as_the_source_does(spark):
    got = _map(spark, ['{"title": "T", "genes": [true, "x", 2], "authors": [true]}'])[0]
    assert got.genes == ["True", "x", "2"] and got.authors[0].name == "True"


def test_cuts_are_opt_in(spark):
    from lumenkg.functions import vocab
    from lumenkg.functions.entities import extract_entities
    from lumenkg.operators.cascade import html_fallback_abstract, prompt_text
    from lumenkg.operators.enrich import nlp_text
    text = "GENE%s " * 40 % tuple(range(40)) + "x" * 6000
    page = f"<html><body><article>{text}</article></body></html>"
    assert parse_page(page)["text"] == text and len(parse_page(page, vocab.PAGE_TEXT_CHARS)["text"]) == 3000
    df = spark.createDataFrame([(text, text, "u", "t")], "page_text string, full_text string, url string, title string").withColumn("abstract", F.lit("a"))
    r = df.select(
        F.size(extract_entities("page_text")["genes"]).alias("all"), F.size(extract_entities("page_text", limits=vocab.ENTITY_LIMITS)["genes"]).alias("ten"),
        F.length(html_fallback_abstract("page_text")).alias("whole"), F.length(html_fallback_abstract("page_text", vocab.HTML_ABSTRACT_PREFIX)).alias("prefix"),
        (F.length(prompt_text()) - F.length(prompt_text(content_chars=vocab.PROMPT_CONTENT_CHARS))).alias("prompt"),
        F.length(nlp_text()).alias("nlp"), F.length(nlp_text(vocab.NLP_TEXT_CHARS["main"])).alias("nlp_cut")).first()
    assert tuple(r) == (40, 10, len(text), 503, len(text) - 4000, len(text) + 2, 3002)


def test_term_matching(spark):
    from lumenkg.operators.enrich import match_terms
    docs = spark.createDataFrame([(1, "the ISS crew of mice"), (2, "a"), (3, None), (4, "missing"), (5, "mi.ce (x")], "id long, text string")
    terms = spark.createDataFrame([("c", "ISS"), ("c", "mice"), ("c", "a"), ("d", "mi.ce"), ("d", ""), ("d", "w(")], "category string, term string")
    got = lambda **k: sorted((r.id, r.term) for r in match_terms(docs, "text", terms, "id", **k).collect())
    assert got() == [(1, "ISS"), (1, "mice"), (2, "a"), (4, "ISS"), (5, "mi.ce")]
    assert got(word_boundary=True) == [(1, "ISS"), (1, "mice"), (2, "a"), (5, "mi.ce")]
    assert got(case_insensitive=False) == [(1, "ISS"), (1, "mice"), (2, "a"), (5, "mi.ce")]


def test_a_response_that_is_stored_twice_counts_once(spark):
    body = '{"documents": [{"passages": [{"infons": {"type": "ABSTRACT"}, "text": "X"}, {"infons": {"type": "p"}, "text": "body"}]}]}'
    late = body.replace('"X"', '"newer"')
    pubs = spark.createDataFrame([(1, "u1", "A title of mice in space", "PMC1"), (2, "u2", "Another title of mice", "PMC2")], "pos long, url string, title string, pmcid string")
    rows = [("PMC1", body, 200)] * 2 + [("PMC1", "not json", 200), ("PMC1", late, 404), ("PMC2", "not json", 200), ("PMC2", '{"documents": 5}', 200)]
    got = {r.pos: r.pmc for r in pmc_articles(pubs, spark.createDataFrame(rows, "pmcid string, json string, status int")).collect()}
    assert set(got) == {1} and (got[1].abstract, got[1].full_text) == ("X", "body")
    timed = [("PMC1", body, 200, "2024-01-01 00:00:00"), ("PMC1", late, 200, "2025-01-01 00:00:00"), ("PMC1", "not json", 200, "2026-01-01 00:00:00"), ("PMC1", body, 200, None)]
    df = spark.createDataFrame(timed, "pmcid string, json string, status int, fetched_at string")
    assert pmc_articles(pubs, df).first().pmc.abstract == "newer"


def test_staged_cascade_parses_only_what_is_unserved(spark, monkeypatch):
    """The stages' rows equal those of the joined cascade; bodies and pages of served publications are never parsed."""
    import lumenkg.operators.cascade as cascade
    import lumenkg.sources.html as html
    from pyspark.sql import Observation, functions as F

    def reply(score):
        return '{"choices": [{"text": "{\\"abstract\\": \\"' + "word " * 40 + '\\", \\"confidence_score\\": %s}"}]}' % score

    bioc_body = '{"documents": [{"passages": [{"infons": {"type": "abstract"}, "text": "%s"}]}]}' % ("gene " * 60)
    page = "<html><head><title>t</title></head><body><p>" + "plants grow in space " * 20 + "</p></body></html>"
    pubs = spark.createDataFrame([(i, f"Publication number {i} of mice", f"u{i}", f"PMC{i}" if i != 7 else None) for i in range(10)],
                                 "pos long, title string, url string, pmcid string")
    rep = spark.createDataFrame([(f"u{i}", "groq", 200 if i else 500, reply(0.9)) for i in range(3)], "url string, provider string, status int, body string")
    bioc = spark.createDataFrame([(f"PMC{i}", bioc_body if i != 4 else "broken", 200) for i in range(6)], "pmcid string, json string, status int")
    pages = spark.createDataFrame([(f"u{i}", page, 200 if i != 8 else 404) for i in range(9)], "url string, html string, status int")
    seen = Observation("parsed")
    real = html.parse_pages
    monkeypatch.setattr(html, "parse_pages", lambda p, **k: real(p.observe(seen, F.count("*").alias("n"), F.sort_array(F.collect_list("url")).alias("urls")), **k))
    got = {r.pos: r for r in cascade.staged_cascade(pubs, rep, bioc, pages, as_of="2025-01-01 00:00:00").collect()}
    source = {i: r.extraction_source for i, r in got.items()}
    assert source == {0: "pmc_api_fallback", 1: "llm_groq", 2: "llm_groq", 3: "pmc_api_fallback", 4: "html_fallback", 5: "pmc_api_fallback",
                      6: "html_fallback", 7: "html_fallback", 8: "minimal_metadata", 9: "minimal_metadata"}
    assert seen.get["urls"] == ["u4", "u6", "u7", "u8"]
    monkeypatch.undo()
    text = html.parse_pages(pages, status_col="status").select("url", F.col("page")["text"].alias("page_text"))
    joined = article_cascade(pubs, page_text=text, llm_articles=first_valid_reply(pubs, rep), pmc_articles=pmc_articles(pubs, bioc), as_of="2025-01-01 00:00:00")
    keep = [c for c in joined.columns if c != "extraction_timestamp"]
    assert sorted(map(str, joined.select(*keep).collect())) == sorted(str(r) for r in spark.createDataFrame(list(got.values()), joined.schema).select(*keep).collect())


def test_replies_are_grouped_without_a_second_shuffle(spark):
    pubs = spark.createDataFrame([(1, "t", "u", "PMC1")], "pos long, title string, url string, pmcid string")
    rep = spark.createDataFrame([("u", "groq", 200, "{}")], "url string, provider string, status int, body string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = first_valid_reply(pubs, rep)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2, plan


def test_a_csv_with_quoted_line_breaks_is_read_in_byte_ranges(spark, tmp_path):
    import csv
    import random
    from lumenkg.sources.publications import read_publications
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        title = "".join(rnd.choice(["word", " ", ",", '"', "\n", "\r\n", "é", "x", "a longer part"]) for _ in range(rnd.randint(0, 12))) + (f"t{i}" if i % 9 else "")
        rows.append((title, rnd.choice([f"http://x/{i}", " ", "", "NA", f"https://a/articles/PMC{i}/"]), str(i)))
    rows[200] = ("long " * 300 + "\n" * 200 + "end", "http://x/long", "200")  # a record over many ranges
    for name, part in (("a.csv", rows[:250]), ("b.csv", rows[250:])):
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f, lineterminator="\n" if name == "a.csv" else "\r\n")
            w.writerow(["Title", "Link", "No"])
            w.writerows(part)

    def read(size, multi):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = read_publications(spark, str(tmp_path), multi)
            return sorted(tuple(r) for r in df.select("pos", "title", "url", "pmcid").collect()), df
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")

    from lumenkg.sources.publications import from_rows
    import io
    want = []
    for n, name in enumerate(("a.csv", "b.csv")):
        text = open(tmp_path / name, newline="", encoding="utf-8").read()
        body = list(csv.reader(io.StringIO(text, newline="")))[1:]
        want += [(250 * n + i, t, l) for i, (t, l, _) in enumerate(body)]
    plain = spark.createDataFrame(want, "pos long, Title string, Link string")
    # line ends inside quotes are read as \n
    plain = plain.withColumn("Title", F.regexp_replace("Title", "\r\n", "\n"))
    expected = sorted(tuple(r) for r in from_rows(plain, "Title", "Link").select("pos", "title", "url", "pmcid").collect())
    for size in (150, 1000, 1 << 20):
        got, df = read(size, True)
        assert [(p, t.replace("\r\n", "\n"), u, c) for p, t, u, c in got] == expected, size
    import os
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        from lumenkg.sources.publications import _split_lines
        assert _split_lines(spark, str(tmp_path)).rdd.getNumPartitions() >= os.path.getsize(tmp_path / "a.csv") // 1000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_pages_are_parsed_in_slices(spark):
    import gc
    import pyarrow as pa
    from lumenkg.sources import html as H
    pages = [None if i % 7 == 3 else f"<title>t{i}</title><meta name=m content=c{i}><nav><b>x</b></nav><body><p>{'é' * (i % 50)}</p>" for i in range(300)]
    parts = list(H._slices(pa.array(pages)))
    assert [x for p in parts for x in p.to_pylist()] == pages and max(map(len, parts)) <= H.SLICE_PAGES
    large = pa.array(["a" * (H.SLICE_BYTES * 3 // 5)] * 4)
    assert [len(p) for p in H._slices(large)] == [1] * 4
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string").coalesce(1)
    got = {r.i: r.page.asDict() for r in H.parse_pages(df).collect()}
    assert got == {i: H.parse_page(p) or dict.fromkeys(H.PAGE_STRUCT.names) for i, p in enumerate(pages)}
    gc.collect()
    gc.disable()
    try:
        H.parse_page(pages[1])
        assert gc.collect() == 0  # no tree waits for the collector
    finally:
        gc.enable()


def test_candidates_are_computed_once_a_row(spark):
    """The filters on scores hold plain columns: terms are looked for in one place, in texts lower-cased once."""
    from lumenkg.operators.cascade import article_cascade
    from lumenkg.operators.validate import validate_quality
    rows = [(1, "Bone loss in mice", "http://x.org/1", None, "Abstract " + "x" * 60), (2, "Mice", None, None, None)]
    df = validate_quality(article_cascade(spark.createDataFrame(rows, "pos long, title string, url string, pmcid string, page_text string")), "main")
    assert [(r.pos, r.organisms) for r in df.collect()] == [(1, [])]
    plan = df.select("pos", "title")._jdf.queryExecution().optimizedPlan().toString()
    assert not [ln for ln in plan.split("\n") if "Filter" in ln and "ontains(" in ln]
    assert plan.count("lower(page_text") <= 1


def test_workers_hold_few_pages_at_a_time(spark):
    """Pages are not gathered into Arrow batches, whose rows are counted by the session and whose pages may be large."""
    from lumenkg.plans.pages import page_publications
    df = spark.createDataFrame([(1, "http://x.org/1", "<title> a </title><meta name=m><body>b</body>"), (2, "http://x.org/2", None)], "page_id long, url string, html string")
    plan = page_publications(df)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    assert [(r.pos, r.title, r.page_text) for r in page_publications(df).collect()] == [(1, "a", "b")]
    assert [r.page and r.page.meta for r in parse_pages(df).orderBy("page_id").collect()] == [{"m": None}, None]
