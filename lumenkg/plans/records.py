"""Registered queries over identifiers, mentions, registries and whole records.

Their inputs are derived from ``documents`` and ``pages`` by Spark and, in the
oracle, by plain SQL.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import sorted_join
from . import sqlgen as S
from .catalog import _ART, _docs_articles, _docs_articles_sql, _pages_enriched, _pages_valid, register
from .pages import page_publications, read_table

# -- S1, P2-P5: publication rows and page identifiers -------------------------

@register("publication_rows", f"""SELECT doc_id, {S.py_strip('t')} AS title, {S.py_strip('u')} AS url, {S.pmcid_from_url('u')} AS pmcid FROM (
  SELECT doc_id, CASE source WHEN 'src1' THEN 'NA' WHEN 'src2' THEN ' ' WHEN 'src3' THEN NULL ELSE ' ' || split_part(text, chr(10), 1) || chr(9) END AS t,
         CASE lang WHEN 'de' THEN 'null' WHEN 'fr' THEN ' http://x.org/' || doc_id || ' ' ELSE 'https://www.ncbi.nlm.nih.gov/pmc/articles/PMC' || doc_id END AS u FROM documents)
WHERE t IS NOT NULL AND t NOT IN ('NA') AND u <> 'null' AND length({S.py_strip('t')}) > 0""")
def q_publication_rows(spark, sf):
    """The publication rules (missing markers, stripping, PMCID) over title / link rows."""
    from ..sources.publications import from_rows
    d = read_table(spark, sf, "documents")
    title = F.when(F.col("source") == "src1", "NA").when(F.col("source") == "src2", " ").when(F.col("source") == "src3", F.lit(None)) \
        .otherwise(F.concat(F.lit(" "), F.substring_index("text", "\n", 1), F.lit("\t")))
    link = F.when(F.col("lang") == "de", "null").when(F.col("lang") == "fr", F.concat(F.lit(" http://x.org/"), "doc_id", F.lit(" "))) \
        .otherwise(F.concat(F.lit("https://www.ncbi.nlm.nih.gov/pmc/articles/PMC"), "doc_id"))
    return from_rows(d.select("doc_id", title.alias("Title"), link.alias("Link")), "Title", "Link")


@register("page_identifiers", """SELECT doc_id,
  CASE lang WHEN 'en' THEN '10.1/en.' || doc_id WHEN 'fr' THEN '10.5555/fr.' || doc_id END AS doi,
  CASE lang WHEN 'en' THEN source WHEN 'de' THEN 'Journal ' || source END AS journal,
  CASE lang WHEN 'es' THEN 'PMC' || doc_id END AS pmcid,
  CASE lang WHEN 'en' THEN 'PMC7' || doc_id WHEN 'es' THEN 'PMC' || doc_id END AS pmcid_compat,
  CASE lang WHEN 'en' THEN '7' || doc_id WHEN 'fr' THEN '9' || doc_id END AS pmid FROM documents""")
def q_page_identifiers(spark, sf):
    """DOI, journal, PMCID and PMID of pages, from meta tags, links, selectors or text."""
    from ..sources import html as H
    i = F.col("doc_id").cast("string")
    lang = F.col("lang")
    head = (F.when(lang == "en", F.concat(F.lit('<meta name="citation_doi" content="10.1/en.'), i, F.lit('"><meta name="citation_pmid" content="7'), i,
                                          F.lit('"><meta name="citation_journal_title" content="'), "source", F.lit('">')))
            .when(lang == "es", F.concat(F.lit('<link rel="nofollow canonical" href="https://www.ncbi.nlm.nih.gov/pmc/articles/PMC'), i, F.lit('/">'))).otherwise(F.lit("")))
    body = (F.when(lang == "fr", F.concat(F.lit('<p>see doi 10.5555/fr.'), i, F.lit(' end</p><a href="https://x.org/PubMed/pubmed/9'), i, F.lit('">p</a>')))
            .when(lang == "de", F.concat(F.lit('<div class="site-header"><b class="journal"> Journal '), "source", F.lit(" </b></div>"))).otherwise(F.lit("")))
    d = read_table(spark, sf, "documents").select("doc_id", F.concat(F.lit("<html><head>"), head, F.lit("</head><body>"), body, F.lit("</body></html>")).alias("html"))
    p = H.parse_pages(d)
    return p.select("doc_id", H.doi_from_page().alias("doi"), H.journal_from_page().alias("journal"), H.pmcid_from_page().alias("pmcid"),
                    H.pmcid_from_page(compat=True).alias("pmcid_compat"), H.pmid_from_page().alias("pmid"))


# -- D1 + J4, J7 + S8, J5 over page titles -------------------------------------

_IDENTIFIED_SQL = S.pages_cte() + """, idd AS (SELECT pos, title, url,
  CASE WHEN contains(url, '/en/') THEN '10.1/' || (pos // 3) END AS doi, CASE WHEN contains(url, '/fr/') THEN CAST(pos // 2 AS VARCHAR) END AS pmid,
  CASE WHEN contains(url, '/de/') OR contains(url, '/fr/') THEN CAST(pos // 5 AS VARCHAR) END AS pmcid FROM pg)"""


def _identified(spark, sf):
    """Page publications with identifiers that some of them share."""
    url = F.col("url")
    return page_publications(read_table(spark, sf, "pages")).select(
        "pos", "title", "url", F.when(url.contains("/en/"), F.concat(F.lit("10.1/"), F.expr("pos DIV 3"))).alias("doi"),
        F.when(url.contains("/fr/"), F.expr("CAST(pos DIV 2 AS STRING)")).alias("pmid"),
        F.when(url.contains("/de/") | url.contains("/fr/"), F.expr("CAST(pos DIV 5 AS STRING)")).alias("pmcid"))


@register("dedup_identified", f"WITH {_IDENTIFIED_SQL}, tt AS (SELECT lower(title) AS t FROM idd), {S.similar_pairs_sql('tt')}, "
          "rws AS (SELECT pos, lower(title) AS lt, list_filter([doi, pmid, pmcid], lambda x: x IS NOT NULL) AS ids FROM idd), "
          + S.greedy_dedup_sql("rws") + " SELECT i.pos, i.title FROM idd i JOIN kept k ON k.pos = i.pos")
def q_dedup_identified(spark, sf):
    """D1 + J4 + J5: keep-first deduplication with shared doi / pmid / pmcid values and near titles."""
    from ..operators.dedup import deduplicate
    return deduplicate(_identified(spark, sf)).select("pos", "title")


@register("unseen_pages", f"""WITH {_IDENTIFIED_SQL}, tt AS (SELECT lower(title) AS t FROM idd), {S.similar_pairs_sql('tt')},
reg AS (SELECT * FROM idd WHERE contains(url, '/de/') OR contains(url, '/es/')), regid AS (SELECT doi AS k FROM reg UNION SELECT pmid FROM reg UNION SELECT pmcid FROM reg),
regt AS (SELECT DISTINCT lower(title) AS t FROM reg),
bad AS (SELECT t FROM regt UNION SELECT a FROM sim JOIN regt ON regt.t = sim.b UNION SELECT b FROM sim JOIN regt ON regt.t = sim.a)
SELECT pos, title FROM idd WHERE NOT (contains(url, '/de/') OR contains(url, '/es/'))
  AND NOT EXISTS (SELECT 1 FROM regid WHERE k IS NOT NULL AND (k = doi OR k = pmid OR k = pmcid)) AND lower(title) NOT IN (SELECT t FROM bad)""")
def q_unseen_pages(spark, sf):
    """S8 + J7: the registry of the German and Spanish pages drops what it matches of the others."""
    from ..functions.text import article_id
    from ..operators.dedup import drop_seen, seen_registry
    from ..session import materialise
    d = materialise(_identified(spark, sf))  # both sides and their titles read it; the pages are parsed once
    old = F.col("url").contains("/de/") | F.col("url").contains("/es/")
    return drop_seen(d.filter(~old), seen_registry(d.filter(old).withColumn("article_id", article_id()))).select("pos", "title")


@register("near_titles", f"""WITH {S.pages_cte()}, src AS (SELECT lower(title) AS t FROM pg),
tt AS (SELECT t FROM src UNION SELECT t || ' ii' FROM src UNION SELECT replace(t, 'e', '') FROM src),
{S.similar_pairs_sql('tt')} SELECT a, b, ratio FROM sim""")
def q_near_titles(spark, sf):
    """J5 + D2 over page titles and two altered forms of each."""
    from ..operators.dedup import similar_titles
    t = page_publications(read_table(spark, sf, "pages")).select(F.lower("title").alias("t"))
    return similar_titles(t.select(F.explode(F.array("t", F.concat("t", F.lit(" ii")), F.replace("t", F.lit("e"), F.lit("")))).alias("t")))


# -- J6, X1, X2, F6 ----------------------------------------------------------

_LABELS = {"en": "SPECIES", "fr": "GENE", "de": "DRUG", "es": "CONDITION"}
_FIELDS = ("organisms", "genes", "measurements", "conditions")


@register("routed_mentions", "WITH m AS (SELECT doc_id, lang, lower(" + S.py_strip("w") + ") AS w FROM (SELECT doc_id, lang, unnest(string_split(text, '.')) AS w FROM documents)) "
          "SELECT d.doc_id, " + ", ".join(
              f"array_to_string(list_sort(coalesce((SELECT list(DISTINCT m.w) FROM m WHERE m.doc_id = d.doc_id AND m.lang = '{lang}'"
              + (" AND length(m.w) > 2" if field == "genes" else "") + f"), []::VARCHAR[])), '|') AS {field}"
              for lang, field in zip(_LABELS, _FIELDS)) + " FROM documents d")
def q_routed_mentions(spark, sf):
    """Mentions (one per sentence, labelled by language) routed to entity fields."""
    from ..operators.enrich import route_mentions
    d = read_table(spark, sf, "documents")
    label = F.create_map(*[F.lit(x) for kv in _LABELS.items() for x in kv])[F.col("lang")]
    mentions = d.select(F.col("doc_id").alias("article_id"), label.alias("label"), F.explode(F.split("text", r"\.")).alias("text"))
    out = route_mentions(d.select(F.col("doc_id").alias("article_id")), mentions)
    return out.select(F.col("article_id").alias("doc_id"), *[sorted_join(f"_ner_{f}").alias(f) for f in _FIELDS])


@register("custom_rules", _docs_articles_sql() + f"""
SELECT pos, title, CASE WHEN NOT llm_extracted AND length({S.py_strip("coalesce(abstract, '') || coalesce(full_text, '')")}) > 0
  THEN CAST(len(string_split(coalesce(abstract, ''), ' ')) AS INTEGER) END AS abstract_words
FROM arts_d WHERE {S.truthy('title')} AND length({S.py_strip('title')}) >= 5 AND {S.truthy('url')} AND contains(title, 'e')
  AND {S.quality_main(_ART)} >= 0.4""")
def q_custom_rules(spark, sf):
    """X1 + X2: a user's extractor column and a user's validator, with its own threshold."""
    from ..operators.enrich import enrich_articles
    from ..operators.validate import validate_quality
    a = validate_quality(_docs_articles(spark, sf), "main", threshold=0.4, validators={"has_e": F.col("title").contains("e")})
    e = enrich_articles(a, "main", extractors={"abstract_words": F.size(F.split(F.coalesce("abstract", F.lit("")), " "))})
    return e.select("pos", "title", "abstract_words")


@register("low_quality", _docs_articles_sql() + " SELECT pos, quality_score FROM arts_d WHERE quality_score >= 0.5")
def q_low_quality(spark, sf):
    """rows that reach a score."""
    from ..operators.validate import drop_low_quality
    return drop_low_quality(_docs_articles(spark, sf), 0.5, inclusive=True).select("pos", "quality_score")


# -- JSON-LD, triples and entities of every article ----------------------------

@register("json_ld_values", _docs_articles_sql() + f"""
SELECT pos, abstract, full_text, nullif(journal, '') AS journal, CASE WHEN len(authors) > 0 THEN array_to_string(authors, '|') END AS authors,
  CASE WHEN len(keywords) > 0 THEN {S.sorted_join('keywords')} END AS keywords, pmcid, llm_extracted, llm_confidence_score, url
FROM (SELECT * REPLACE (nullif(abstract, '') AS abstract, nullif(full_text, '') AS full_text) FROM arts_d)""")
def q_json_ld_values(spark, sf):
    """K1: every value of the JSON-LD documents."""
    from ..operators.graph import to_json_ld
    a = _docs_articles(spark, sf).withColumn("js", to_json_ld("main"))
    at = lambda p: F.get_json_object("js", p)
    names = F.transform(F.from_json(at("$['schema:author']"), "array<map<string,string>>"), lambda x: x["schema:name"])
    return a.select(
        "pos", at("$['schema:abstract']").alias("abstract"), at("$['schema:text']").alias("full_text"),
        at("$['schema:isPartOf']['schema:name']").alias("journal"), F.when(names.isNotNull(), F.array_join(names, "|")).alias("authors"),
        F.when(at("$['schema:keywords']").isNotNull(), sorted_join(F.from_json(at("$['schema:keywords']"), "array<string>"))).alias("keywords"),
        at("$['schema:identifier'][0]['schema:value']").alias("pmcid"), at("$.llm_extracted").cast("boolean").alias("llm_extracted"),
        at("$.llm_confidence_score").cast("double").alias("llm_confidence_score"), at("$['schema:url']").alias("url"))


@register("json_ld_strict", _docs_articles_sql() + """
SELECT pos, true AS has_fixed, abstract, full_text, url FROM arts_d""")
def q_json_ld_strict(spark, sf):
    """K2: the strict profile names url, created, abstract and text always, null or not."""
    from ..operators.graph import to_json_ld
    a = _docs_articles(spark, sf).select("pos", to_json_ld("strict").alias("js"))
    at = lambda k: F.get_json_object("js", f"$['{k}']")
    keys = F.json_object_keys("js")
    fixed = ("schema:url", "dcterms:created", "schema:abstract", "schema:text")
    has = F.lit(True)
    for k in fixed:
        has = has & F.array_contains(keys, k)
    return a.select("pos", has.alias("has_fixed"), at("schema:abstract").alias("abstract"), at("schema:text").alias("full_text"), at("schema:url").alias("url"))


def _docs_triples_sql() -> str:
    sn, bio, sp, rdf, base, dc = (vocab.SCHEMA_NS, vocab.BIO_NS, vocab.SPACE_NS, vocab.RDF_TYPE, vocab.BASE_URI, vocab.DCTERMS_NS)
    node = lambda kind, x: f"{S.q(base + kind + '/')} || md5({x})"
    rows = []

    def add(s, p, o, kind, src="e", where="true"):
        rows.append(f"SELECT pos, {s} AS s, {S.q(p)} AS p, {o} AS o, '{kind}' AS o_kind FROM {src} WHERE {where}")

    add("aid", rdf, S.q(sn + "ScholarlyArticle"), "uri")
    add("aid", sn + "name", "title", "literal")
    for p, c, kind in ((sn + "url", "url", "uri"), (sn + "abstract", "abstract", "literal"), (sn + "text", "full_text", "literal"),
                       (sn + "doi", "doi", "literal"), (bio + "pmid", "pmid", "literal"), (bio + "pmcid", "pmcid", "literal")):
        add("aid", p, c, kind, where=S.truthy(c))
    add("aid", dc + "created", "'2020-01-02T03:04:05'", "literal", where="lang = 'en'")
    add("aid", sp + "llmExtracted", "CAST(llm_extracted AS VARCHAR)", "literal")
    add("aid", sp + "llmConfidenceScore", "CAST(llm_confidence_score AS VARCHAR)", "literal", where="llm_confidence_score > 0")
    j = S.truthy("journal")
    add(node("journal", "journal"), rdf, S.q(sn + "Periodical"), "uri", where=j)
    add(node("journal", "journal"), sn + "name", "journal", "literal", where=j)
    add("aid", sn + "isPartOf", node("journal", "journal"), "uri", where=j)
    # two authors: a plain name, and the language with the source as affiliation
    au = "(SELECT pos, aid, unnest(authors) AS n FROM e)"
    add(node("author", "n"), rdf, S.q(sn + "Person"), "uri", au)
    add(node("author", "n"), sn + "name", "n", "literal", au)
    add("aid", sn + "author", node("author", "n"), "uri", au)
    two = "len(authors) = 2"
    add(node("org", "authors[1]"), rdf, S.q(sn + "Organization"), "uri", where=two)
    add(node("org", "authors[1]"), sn + "name", "authors[1]", "literal", where=two)
    add(node("author", "authors[2]"), sn + "affiliation", node("org", "authors[1]"), "uri", where=two)
    for kind, lst, cls, link in (("keyword", "keywords", sn + "DefinedTerm", sn + "keywords"), ("organism", "organisms", bio + "Organism", sp + "studiesOrganism")):
        each = f"(SELECT pos, aid, unnest({lst}) AS k FROM e)"
        add(node(kind, "k"), rdf, S.q(cls), "uri", each)
        add(node(kind, "k"), sn + "name", "k", "literal", each)
        add("aid", link, node(kind, "k"), "uri", each)
    return (_docs_articles_sql() + ", e AS (SELECT *, " + S.article_id("doi", "pmcid", "pmid", "title") + " AS aid FROM ("
            "SELECT a.*, d.lang, CASE WHEN d.lang = 'en' THEN '10.1/' || d.doc_id END AS doi, CASE WHEN d.lang = 'fr' THEN CAST(d.doc_id AS VARCHAR) END AS pmid "
            "FROM arts_d a JOIN documents d ON d.doc_id = a.pos)), td AS (" + " UNION ALL ".join(rows) + ") SELECT DISTINCT pos, s, p, o, o_kind FROM td")


@register("document_triples", _docs_triples_sql())
def q_document_triples(spark, sf):
    """K3: every predicate, with journals, authors, affiliations, identifiers, dates and confidence."""
    from ..operators.graph import to_triples
    lang = read_table(spark, sf, "documents").select(F.col("doc_id").alias("pos"), "lang")
    a = _docs_articles(spark, sf).join(lang, "pos").withColumns({
        "doi": F.when(F.col("lang") == "en", F.concat(F.lit("10.1/"), "pos")),
        "pmid": F.when(F.col("lang") == "fr", F.col("pos").cast("string")),
        "publication_date": F.when(F.col("lang") == "en", F.lit("2020-01-02 03:04:05").cast("timestamp"))})
    return to_triples(a, keep=("pos",))


@register("graph_entity_lists", _docs_articles_sql() + f"""
SELECT pos, {S.article_id('NULL', 'pmcid', 'NULL', 'title')} AS id, title, quality_score, array_to_string(authors, '|') AS authors,
  CASE WHEN len(authors) = 2 THEN authors[1] END AS affiliation, {S.sorted_join('keywords')} AS keywords, {S.sorted_join('organisms')} AS organisms, '' AS mesh_terms FROM arts_d""")
def q_graph_entity_lists(spark, sf):
    """K4: the Article struct, Authors and entity lists of every article."""
    from ..operators.graph import graph_entities
    g = F.col("g")
    a = _docs_articles(spark, sf).select("pos", graph_entities().alias("g"))
    return a.select("pos", g["Article"]["id"].alias("id"), g["Article"]["title"].alias("title"), g["Article"]["quality_score"].alias("quality_score"),
                    F.array_join(F.transform(g["Authors"], lambda x: x["name"]), "|").alias("authors"), F.get(g["Authors"], F.lit(1))["affiliation"].alias("affiliation"),
                    sorted_join(g["Keywords"]).alias("keywords"), sorted_join(g["Organisms"]).alias("organisms"), sorted_join(g["MeshTerms"]).alias("mesh_terms"))


# -- the whole run: cascade, validation, enrichment, dedup, K6 -------------------

_RUN_SQL = f"""WITH {S.pages_cte()}, {S.cascade_cte()}, {S.validated_cte()}, tt AS (SELECT lower(title) AS t FROM valid), {S.similar_pairs_sql('tt')},
rws AS (SELECT pos, lower(title) AS lt, list_filter([pmcid], lambda x: x IS NOT NULL AND x <> '') AS ids FROM valid), {S.greedy_dedup_sql("rws")}"""


@register("standardized_records", _RUN_SQL + f"""
SELECT v.title, v.extraction_source, v.abstract, v.quality_score, {S.article_id('NULL', 'v.pmcid', 'NULL', 'v.title')} AS id, v.url,
  {S.sorted_join('v.keywords')} AS keywords
FROM valid v JOIN kept k ON k.pos = v.pos""")
def q_standardized_records(spark, sf):
    """The whole run as one plan: cascade, validation, enrichment, deduplication (D1), four-part records (K6, K1, K4)."""
    from ..operators.dedup import deduplicate
    from ..operators.graph import standardize
    kept = deduplicate(_pages_enriched(spark, sf))
    r = standardize(kept, ["title", "extraction_source", "abstract", "quality_score"])
    g = F.col("graph_entities")
    return r.select(
        F.col("article_data.title").alias("title"), F.col("article_data.extraction_source").alias("extraction_source"),
        F.get_json_object("json_ld", "$['schema:abstract']").alias("abstract"), g["Article"]["quality_score"].alias("quality_score"),
        g["Article"]["id"].alias("id"), F.get_json_object("json_ld", "$['schema:url']").alias("url"), sorted_join(g["Keywords"]).alias("keywords"))


@register("run_report", _RUN_SQL + """
SELECT (SELECT count(*) FROM pages) AS publications, count(*) AS total, (SELECT count(*) FROM pages) - count(*) AS failed,
  round(count(*) / (SELECT count(*) FROM pages), 9) AS coverage, (SELECT count(*) FROM kept) AS kept,
  round((count(*) - (SELECT count(*) FROM kept)) / count(*), 9) AS duplicate_rate, CAST(sum(len(organisms)) AS BIGINT) AS entities FROM valid""")
def q_run_report(spark, sf):
    """A5 + A6: extracted, failed, coverage, kept, duplicate share and entities of a whole run."""
    from ..operators.cascade import article_cascade
    from ..operators.dedup import deduplicate
    from ..operators.metrics import Watched, article_metrics
    from ..operators.validate import validate_quality
    from ..session import materialise
    run = Watched()
    pages = run.count(read_table(spark, sf, "pages"), "publications")
    valid = run.watch(validate_quality(article_cascade(page_publications(pages)), "main"), "articles", *article_metrics())
    kept = run.count(deduplicate(materialise(valid).select("pos", "title", "pmcid")), "kept")
    materialise(kept)  # the run writes what it keeps; its metrics come with it
    return run.report(spark).select("publications", "total", "failed", "coverage", "kept", "duplicate_rate", "entities")


@register("duplicate_report", _RUN_SQL + """
SELECT 'duplicate' AS validator, (SELECT count(*) FROM kept) AS passed, count(*) - (SELECT count(*) FROM kept) AS failed FROM valid""")
def q_duplicate_report(spark, sf):
    """The duplicate validator."""
    from ..operators.dedup import deduplicate
    from ..operators.validate import default_validators, validation_report, with_duplicate_flag
    from ..session import materialise
    valid = materialise(_pages_valid(spark, sf).select("pos", "title", "pmcid"))
    flagged = with_duplicate_flag(valid.select("pos"), deduplicate(valid))
    return validation_report(flagged, {"duplicate": default_validators(duplicates=True)["duplicate"]})
