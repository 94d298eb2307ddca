"""Registered queries over the driver tables and their DuckDB oracles.

Every query reads whole tables (pages, documents, orders, labels) and
returns plain columns (arrays are rendered as sorted / ordered strings so
results hash the same way on both sides).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.dates import parse_date, publication_date_from_text
from ..functions.entities import basic_keywords, basic_organisms, basic_conditions, extract_entities
from ..functions.quality import quality_score
from ..functions.text import sorted_join
from ..operators.cascade import article_cascade
from ..operators.enrich import enrich_articles, match_terms
from ..operators.graph import to_triples
from ..operators.validate import validate_quality
from . import sqlgen as S
from .pages import page_publications, read_table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _join(c) -> F.Column:
    return F.array_join(F.coalesce(c, F.array().cast("array<string>")), "|")


# -- pages: publications, text, cascade, validation, enrichment, triples -----

def _pages_pubs(spark, sf):
    return page_publications(read_table(spark, sf, "pages"))


def _pages_cascade(spark, sf):
    return article_cascade(_pages_pubs(spark, sf))


def _pages_valid(spark, sf):
    return validate_quality(_pages_cascade(spark, sf), "main")


def _pages_enriched(spark, sf):
    return enrich_articles(_pages_valid(spark, sf), "main")


@register("page_text", f"WITH {S.pages_cte()} SELECT pos, title, url, pmcid, page_text FROM pg")
def q_page_text(spark: SparkSession, sf: str) -> DataFrame:
    """S1 + S2 + P1 + P6: page publications with their main text."""
    return _pages_pubs(spark, sf).select("pos", "title", "url", "pmcid", "page_text")


@register("html_articles", f"""WITH {S.pages_cte()}, {S.cascade_cte()}
SELECT pos, extraction_source, abstract, {S.sorted_join('organisms')} AS organisms,
       {S.sorted_join('keywords')} AS keywords, {S.sorted_join('conditions')} AS conditions, quality_score
FROM arts""")
def q_html_articles(spark, sf):
    """J2 (HTML / minimal branches) + P7 + P8 + E1-E3 + Q1 + F4."""
    a = _pages_cascade(spark, sf)
    return a.select("pos", "extraction_source", "abstract", sorted_join("organisms").alias("organisms"),
                    sorted_join("keywords").alias("keywords"), sorted_join("conditions").alias("conditions"),
                    "quality_score")


@register("validated_articles", f"""WITH {S.pages_cte()}, {S.cascade_cte()}, {S.validated_cte()}
SELECT pos, title, quality_score FROM valid""")
def q_validated_articles(spark, sf):
    """F1 + F5: validation of the cascade output (main rule, >= 0.2)."""
    return _pages_valid(spark, sf).select("pos", "title", "quality_score")


def _enriched_sql() -> str:
    t = S.nlp_text_sql("main", "abstract", "NULL")
    e = S.entities_main_cols("nt")
    u = lambda old, new: S.sorted_join(f"list_concat({old}, {new})")
    return f"""WITH {S.pages_cte()}, {S.cascade_cte()}, {S.validated_cte()},
txt AS (SELECT *, {t} AS nt FROM valid),
ent AS (SELECT *, {e['organisms']} AS n_org, {e['conditions']} AS n_cond, {e['experiments']} AS n_exp,
               {e['genes']} AS n_genes, {e['proteins']} AS n_prot, {e['measurements']} AS n_meas,
               length({S.py_strip('nt')}) = 0 AS is_blank FROM txt)
SELECT pos,
  CASE WHEN is_blank THEN {S.sorted_join_keep('organisms')} ELSE {u('organisms', 'n_org')} END AS organisms,
  CASE WHEN is_blank THEN {S.sorted_join_keep('conditions')} ELSE {u('conditions', 'n_cond')} END AS conditions,
  CASE WHEN is_blank THEN '' ELSE {u('[]::VARCHAR[]', 'n_exp')} END AS experiments,
  CASE WHEN is_blank THEN '' ELSE {u('[]::VARCHAR[]', 'n_genes')} END AS genes,
  CASE WHEN is_blank THEN '' ELSE {u('[]::VARCHAR[]', 'n_prot')} END AS proteins,
  CASE WHEN is_blank THEN '' ELSE {u('[]::VARCHAR[]', 'n_meas')} END AS measurements
FROM ent"""


@register("enriched_articles", _enriched_sql())
def q_enriched_articles(spark, sf):
    """E11 (main) + P12 + E4-E8: entity sets of validated page articles."""
    a = _pages_enriched(spark, sf)
    return a.select("pos", *[sorted_join(c).alias(c) for c in
                             ("organisms", "conditions", "experiments", "genes", "proteins", "measurements")])


def _triples_sql(body: str) -> str:
    a = S.article_id("NULL", "pmcid", "NULL", "title")
    sn, bio, sp, rdf = vocab.SCHEMA_NS, vocab.BIO_NS, vocab.SPACE_NS, vocab.RDF_TYPE
    base = vocab.BASE_URI
    e = S.entities_main_cols("nt")
    u = lambda old, new: f"list_sort(list_distinct(list_concat({old}, {new})))"
    return f"""WITH {S.pages_cte()}, {S.cascade_cte()}, {S.validated_cte()},
txt AS (SELECT *, {S.nlp_text_sql('main', 'abstract', 'NULL')} AS nt FROM valid),
ent AS (SELECT pos, title, url, pmcid, abstract, keywords,
               CASE WHEN length({S.py_strip('nt')}) = 0 THEN organisms ELSE {u('organisms', e['organisms'])} END AS organisms
        FROM txt),
ids AS (SELECT *, {a} AS aid FROM ent),
t AS (
  SELECT pos, aid AS s, {S.q(rdf)} AS p, {S.q(sn + 'ScholarlyArticle')} AS o, 'uri' AS o_kind FROM ids
  UNION ALL SELECT pos, aid, {S.q(sn + 'name')}, title, 'literal' FROM ids
  UNION ALL SELECT pos, aid, {S.q(sn + 'url')}, url, 'uri' FROM ids WHERE {S.truthy('url')}
  UNION ALL SELECT pos, aid, {S.q(sn + 'abstract')}, abstract, 'literal' FROM ids WHERE {S.truthy('abstract')}
  UNION ALL SELECT pos, aid, {S.q(sp + 'llmExtracted')}, 'false', 'literal' FROM ids
  UNION ALL SELECT pos, aid, {S.q(bio + 'pmcid')}, pmcid, 'literal' FROM ids WHERE {S.truthy('pmcid')}
  UNION ALL SELECT pos, {S.q(base + 'keyword/')} || md5(k), {S.q(rdf)}, {S.q(sn + 'DefinedTerm')}, 'uri' FROM (SELECT pos, unnest(keywords) AS k FROM ids)
  UNION ALL SELECT pos, {S.q(base + 'keyword/')} || md5(k), {S.q(sn + 'name')}, k, 'literal' FROM (SELECT pos, unnest(keywords) AS k FROM ids)
  UNION ALL SELECT pos, aid, {S.q(sn + 'keywords')}, {S.q(base + 'keyword/')} || md5(k), 'uri' FROM (SELECT pos, aid, unnest(keywords) AS k FROM ids)
  UNION ALL SELECT pos, {S.q(base + 'organism/')} || md5(k), {S.q(rdf)}, {S.q(bio + 'Organism')}, 'uri' FROM (SELECT pos, unnest(organisms) AS k FROM ids)
  UNION ALL SELECT pos, {S.q(base + 'organism/')} || md5(k), {S.q(sn + 'name')}, k, 'literal' FROM (SELECT pos, unnest(organisms) AS k FROM ids)
  UNION ALL SELECT pos, aid, {S.q(sp + 'studiesOrganism')}, {S.q(base + 'organism/')} || md5(k), 'uri' FROM (SELECT pos, aid, unnest(organisms) AS k FROM ids)
),
td AS (SELECT DISTINCT pos, s, p, o, o_kind FROM t)
{body}"""


@register("triple_counts", _triples_sql("SELECT p, count(*) AS n FROM td GROUP BY p"))
def q_triple_counts(spark, sf):
    """Flagship: pages -> articles -> K3 triples, counted per predicate."""
    return to_triples(_pages_enriched(spark, sf)).groupBy("p").agg(F.count("*").alias("n"))


@register("graph_triples", _triples_sql("SELECT DISTINCT s, p, o, o_kind FROM td"))
def q_graph_triples(spark, sf):
    """K3 + A8: the whole graph as a set of triples."""
    from ..operators.graph import merge_triples
    return merge_triples(to_triples(_pages_enriched(spark, sf)))


# -- documents: entities ----------------------------------------------------

def _doc_entities_sql(profile: str) -> str:
    cols = S.entities_main_cols("text") if profile == "main" else S.entities_strict_cols("text")
    sel = ", ".join(f"array_to_string({v}, '|') AS {k}" for k, v in cols.items())
    return f"SELECT doc_id, {sel} FROM documents"


@register("doc_entities_main", _doc_entities_sql("main"))
def q_doc_entities_main(spark, sf):
    """E4 + E6-E8 + E10 (main) over whole document texts (lists in match order)."""
    d = read_table(spark, sf, "documents")
    e = d.select("doc_id", extract_entities(F.col("text"), "main").alias("e"))
    return e.select("doc_id", *[_join(F.col("e")[c]).alias(c) for c in
                                ("organisms", "conditions", "experiments", "genes", "proteins", "measurements")])


@register("doc_entities_strict", _doc_entities_sql("strict"))
def q_doc_entities_strict(spark, sf):
    """E5 + E10 (strict) over whole document texts."""
    d = read_table(spark, sf, "documents")
    e = d.select("doc_id", extract_entities(F.col("text"), "strict").alias("e"))
    return e.select("doc_id", *[_join(F.col("e")[c]).alias(c) for c in
                                ("organisms", "experiments", "genes", "proteins", "measurements",
                                 "space_conditions", "biological_systems")])


@register("doc_basic_entities", f"""SELECT doc_id,
  array_to_string({S.term_hits('lower(text)', vocab.BASIC_ORGANISMS)}, '|') AS organisms,
  array_to_string({S.term_hits('lower(text)', vocab.BASIC_KEYWORDS, False)}, '|') AS keywords,
  array_to_string({S.term_hits('lower(text)', vocab.BASIC_CONDITIONS, False)}, '|') AS conditions
FROM documents""")
def q_doc_basic_entities(spark, sf):
    """E1-E3 (basic dictionaries, substring rule, unlowered keywords)."""
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", _join(basic_organisms("text")).alias("organisms"),
                    _join(basic_keywords("text")).alias("keywords"),
                    _join(basic_conditions("text")).alias("conditions"))


# Probe terms that do occur in the synthetic prose, so the theta join has work.
PROBE_TERMS = ["the", "thorat", "ering", "tion"]


def _gazetteer_rows():
    rows = [(cat, t) for cat, terms in vocab.MAIN_GAZETTEER.items() for t in terms]
    return rows + [("probe", t) for t in PROBE_TERMS]


@register("doc_term_hits", "SELECT doc_id, category, term FROM documents, (VALUES "
          + ", ".join(f"({S.q(c)}, {S.q(t)})" for c, t in _gazetteer_rows())
          + ") g(category, term) WHERE contains(lower(text), term)")
def q_doc_term_hits(spark, sf):
    """Documents x gazetteer table on ``contains``, by an automaton over the terms."""
    d = read_table(spark, sf, "documents")
    g = spark.createDataFrame(_gazetteer_rows(), "category string, term string")
    return match_terms(d, "text", g, key="doc_id")


# -- dates ------------------------------------------------------------------

DATE_VARIANTS = [  # name, Spark date_format pattern, DuckDB strftime pattern
    ("iso", "yyyy-MM-dd", "%Y-%m-%d"),
    ("slash", "yyyy/M/d", "%Y/%-m/%-d"),
    ("long", "MMMM d, yyyy", "%B %-d, %Y"),
    ("short", "MMM d, yyyy", "%b %-d, %Y"),
    ("dlong", "d MMMM yyyy", "%-d %B %Y"),
    ("dshort", "dd MMM yyyy", "%d %b %Y"),
    ("year", "yyyy", "%Y"),
    ("nocomma", "MMMM d yyyy", "%B %-d %Y"),
    ("spaced", "MMMM  d,  yyyy", "%B  %-d,  %Y"),
]


def _date_strings_sql() -> str:
    parts = [f"SELECT o_orderkey, {S.q(n)} AS variant, strftime(o_orderdate, {S.q(d)}) AS s FROM orders"
             for n, _, d in DATE_VARIANTS]
    parts.append(f"SELECT o_orderkey, 'lower' AS variant, lower(strftime(o_orderdate, '%B %-d, %Y')) AS s FROM orders")
    return " UNION ALL ".join(parts)


def _parse_date_sql(x: str) -> str:
    norm = f"regexp_replace({S.py_strip(x)}, {S.q(S.WS + '+')}, ' ', 'g')"
    tries = ", ".join(f"try_strptime({norm}, {S.q(f)})" for f in vocab.DATE_FORMATS_PY)
    return f"(CASE WHEN {S.truthy(x)} THEN strftime(coalesce({tries}), '%Y-%m-%d') END)"


def _date_strings(spark, sf):
    o = read_table(spark, sf, "orders")
    cols = [F.struct(F.lit(n).alias("variant"), F.date_format("o_orderdate", p).alias("s")) for n, p, _ in DATE_VARIANTS]
    cols.append(F.struct(F.lit("lower").alias("variant"), F.lower(F.date_format("o_orderdate", "MMMM d, yyyy")).alias("s")))
    return o.select("o_orderkey", F.inline(F.array(*cols)))


@register("parse_dates", f"SELECT o_orderkey, variant, s, {_parse_date_sql('s')} AS parsed FROM ({_date_strings_sql()})")
def q_parse_dates(spark, sf):
    """Strptime-style parsing of date strings rendered from order dates."""
    d = _date_strings(spark, sf)
    return d.select("o_orderkey", "variant", "s", F.date_format(parse_date("s"), "yyyy-MM-dd").alias("parsed"))


def _pub_texts_sql() -> str:
    return (f"SELECT o_orderkey, 'published' AS variant, 'Published: ' || strftime(o_orderdate, '%B %-d, %Y') || "
            f"' revised ' || strftime(o_orderdate, '%Y-%m-%d') AS txt FROM orders UNION ALL "
            f"SELECT o_orderkey, 'iso', 'Received ' || strftime(o_orderdate, '%Y-%m-%d') || '; ' || o_orderpriority FROM orders UNION ALL "
            f"SELECT o_orderkey, 'nocomma', 'Printed ' || strftime(o_orderdate, '%B %-d %Y') FROM orders UNION ALL "
            f"SELECT o_orderkey, 'none', o_orderpriority || ' ' || o_orderstatus FROM orders")


def _pub_date_text_sql(x: str) -> str:
    out = "CASE"
    for p in vocab.PUBLISHED_DATE_PATTERNS:
        rp = p.replace(r"\s", S.WS).replace(r"\d", S.DIGIT)
        out += f" WHEN regexp_matches({x}, {S.q(rp)}) THEN {_parse_date_sql(f'regexp_extract({x}, {S.q(rp)}, 1)')}"
    return out + " END"


@register("pub_dates_text", f"SELECT o_orderkey, variant, {_pub_date_text_sql('txt')} AS parsed FROM ({_pub_texts_sql()})")
def q_pub_dates_text(spark, sf):
    """Publication date from free text; the first matching pattern decides."""
    o = read_table(spark, sf, "orders")
    texts = o.select("o_orderkey", F.inline(F.array(
        F.struct(F.lit("published").alias("variant"),
                 F.concat(F.lit("Published: "), F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit(" revised "),
                          F.date_format("o_orderdate", "yyyy-MM-dd")).alias("txt")),
        F.struct(F.lit("iso").alias("variant"),
                 F.concat(F.lit("Received "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("; "),
                          F.col("o_orderpriority")).alias("txt")),
        F.struct(F.lit("nocomma").alias("variant"),
                 F.concat(F.lit("Printed "), F.date_format("o_orderdate", "MMMM d yyyy")).alias("txt")),
        F.struct(F.lit("none").alias("variant"),
                 F.concat(F.col("o_orderpriority"), F.lit(" "), F.col("o_orderstatus")).alias("txt")),
    )))
    return texts.select("o_orderkey", "variant",
                        F.date_format(publication_date_from_text("txt"), "yyyy-MM-dd").alias("parsed"))


# -- dedup ------------------------------------------------------------------

def _dedup_base_sql() -> str:
    return (f"WITH {S.pages_cte()}, {S.cascade_cte()}, {S.validated_cte()}, "
            f"tt AS (SELECT lower(title) AS t FROM valid), {S.similar_pairs_sql('tt')}")


@register("title_pairs", _dedup_base_sql() + " SELECT a, b, ratio FROM sim")
def q_title_pairs(spark, sf):
    """J5 + D2: similar distinct lower-cased titles (ratio >= 85), blocked join."""
    from ..operators.dedup import similar_titles
    v = _pages_valid(spark, sf)
    return similar_titles(v.select(F.lower("title").alias("t"))).select("a", "b", "ratio")


@register("dedup_pages", _dedup_base_sql() + ", rws AS (SELECT pos, lower(title) AS lt, "
          "list_filter([pmcid], lambda x: x IS NOT NULL AND x <> '') AS ids FROM valid), "
          + S.greedy_dedup_sql("rws") + " SELECT v.pos, v.title FROM valid v JOIN kept k ON k.pos = v.pos")
def q_dedup_pages(spark, sf):
    """D1 + J4: greedy keep-first deduplication of validated page articles."""
    from ..operators.dedup import deduplicate
    return deduplicate(_pages_valid(spark, sf).select("pos", "title", "pmcid")).select("pos", "title")


# -- documents scenario: model replies, API documents, full cascade ----------

def _docs_base_sql() -> str:
    o_kw = S.term_hits("lower(o_text)", vocab.BASIC_KEYWORDS, False)
    o_org = S.term_hits("lower(o_text)", vocab.BASIC_ORGANISMS)
    first = S.py_strip("split_part(text, chr(10), 1)")
    q2 = lambda a: S.quality_llm(a)
    ds = {"title": "o_title", "abstract": "d_abstract", "journal": "o_source", "keywords": "d_kw",
          "organisms": "d_org", "llm_confidence_score": "d_conf"}
    gq = {"title": "title", "abstract": "g_abstract", "authors": "[o_source, o_lang]", "llm_confidence_score": "0.75"}
    o_lines = "string_split(o_text, chr(10))"
    pm = {"title": "title", "pmcid": "pmcid", "abstract": "p_abstract", "full_text": "p_full",
          "organisms": "p_org", "keywords": "p_kw"}
    mn = {"title": "title", "pmcid": "pmcid", "abstract": "m_abstract", "organisms": "m_org", "keywords": "m_kw"}
    probe = "lower(title || ' ' || coalesce(p_abstract, ''))"
    return f"""WITH
dp AS (
  SELECT doc_id AS pos, {first} AS title, '{'https://www.ncbi.nlm.nih.gov/pmc/articles/PMC'}' || uid || '/' AS url,
         'PMC' || uid AS pmcid, text, lang, source, uid
  FROM (SELECT *, CASE WHEN lang = 'es' THEN doc_id // 8 * 8 ELSE doc_id END AS uid FROM documents) WHERE length({first}) > 0
),
own AS (SELECT uid AS o_uid, title AS o_title, text AS o_text, source AS o_source, lang AS o_lang FROM dp WHERE uid = pos),
rp AS (
  SELECT pos, title, url, pmcid, o_title, o_source, o_lang, l.quality, l.toxic,
         coalesce({o_lines}[2], '') AS d_abstract, {o_kw} AS d_kw, {o_org} AS d_org,
         CASE WHEN l.quality = 1 THEN 0.9 ELSE 0.4 END::DOUBLE AS d_conf,
         o_text AS g_abstract
  FROM dp JOIN own ON o_uid = uid JOIN labels l ON l.doc_id = uid
),
llm AS (
  SELECT pos, url, CASE WHEN toxic = 1 THEN 'llm_groq' ELSE 'llm_deepseek' END AS extraction_source,
         CASE WHEN toxic = 1 THEN title ELSE o_title END AS l_title,
         CASE WHEN toxic = 1 THEN 0.75::DOUBLE ELSE d_conf END AS llm_confidence_score,
         CASE WHEN toxic = 1 THEN {q2(gq)} ELSE {q2(ds)} END AS quality_score,
         CASE WHEN toxic = 1 THEN g_abstract ELSE d_abstract END AS abstract,
         CASE WHEN toxic = 1 THEN '' ELSE o_source END AS journal,
         CASE WHEN toxic = 1 THEN o_source || '|' || o_lang ELSE '' END AS author_names,
         CASE WHEN toxic = 1 THEN '' ELSE {S.sorted_join('d_kw')} END AS keywords,
         CASE WHEN toxic = 1 THEN '' ELSE {S.sorted_join('d_org')} END AS organisms
  FROM rp
),
pc AS (
  SELECT *, list_sort({S.term_hits(probe, vocab.BASIC_ORGANISMS)}) AS p_org,
         list_sort({S.term_hits(probe, vocab.BASIC_KEYWORDS, False)}) AS p_kw
  FROM (SELECT pos, title, url, pmcid, CASE WHEN length({S.py_strip(o_lines + '[2]')}) > 0 THEN {S.py_strip(o_lines + '[2]')} END AS p_abstract,
               array_to_string(list_filter({o_lines}, lambda x, i: i <> 2), chr(10)) AS p_full
        FROM dp JOIN own ON o_uid = uid WHERE o_lang IN ('en', 'es') AND o_source NOT IN ('src1', 'src2', 'src3', 'src4'))
),
pmc AS (SELECT pos, p_abstract, p_full, p_org, p_kw, {S.quality_main(pm)} AS quality_score FROM pc),
pmc_ok AS (SELECT * FROM pmc WHERE quality_score > 0.2),
mn AS (
  SELECT pos, m_abstract, {S.quality_main(mn)} AS quality_score
  FROM (SELECT *, 'Research article: ' || title AS m_abstract,
               {S.term_hits('lower(title)', vocab.BASIC_ORGANISMS)} AS m_org,
               {S.term_hits('lower(title)', vocab.BASIC_KEYWORDS, False)} AS m_kw FROM dp)
)"""


@register("reply_articles", _docs_base_sql() + """
SELECT pos, extraction_source, l_title AS title, llm_confidence_score, quality_score, abstract, journal, author_names, keywords, organisms
FROM llm""")
def q_reply_articles(spark, sf):
    """S4a-c + J1 + Q2: first valid provider reply per publication, mapped to an article."""
    from ..sources.replies import first_valid_reply
    from .documents import documents_scenario
    pubs, _, replies = documents_scenario(spark, sf)
    w = first_valid_reply(pubs.select("pos", "url", "title", "pmcid"), replies)
    a = F.col("llm")
    return w.select("pos", a["extraction_source"].alias("extraction_source"), a["title"].alias("title"),
                    a["llm_confidence_score"].alias("llm_confidence_score"),
                    a["quality_score"].alias("quality_score"), a["abstract"].alias("abstract"),
                    a["journal"].alias("journal"),
                    F.array_join(F.transform(a["authors"], lambda x: x["name"]), "|").alias("author_names"),
                    sorted_join(a["keywords"]).alias("keywords"), sorted_join(a["organisms"]).alias("organisms"))


@register("bioc_articles", _docs_base_sql() + """
SELECT d.pos, d.url, p.p_abstract AS abstract, p.p_full AS full_text, array_to_string(p.p_org, '|') AS organisms,
       array_to_string(p.p_kw, '|') AS keywords, p.quality_score
FROM pmc_ok p JOIN dp d ON d.pos = p.pos""")
def q_bioc_articles(spark, sf):
    """S3: BioC full-text documents parsed into articles (kept when score > 0.2)."""
    from ..sources.bioc import pmc_articles
    from .documents import documents_scenario
    pubs, bioc, _ = documents_scenario(spark, sf)
    p = pmc_articles(pubs.select("pos", "url", "title", "pmcid"), bioc)
    a = F.col("pmc")
    return p.select("pos", "url", a["abstract"].alias("abstract"), a["full_text"].alias("full_text"),
                    F.array_join(a["organisms"], "|").alias("organisms"), F.array_join(a["keywords"], "|").alias("keywords"),
                    a["quality_score"].alias("quality_score"))


@register("docs_cascade", _docs_base_sql() + """
SELECT d.pos,
  CASE WHEN l.quality_score > 0.3 THEN l.extraction_source WHEN p.pos IS NOT NULL THEN 'pmc_api_fallback'
       ELSE 'minimal_metadata' END AS extraction_source,
  CASE WHEN l.quality_score > 0.3 THEN l.quality_score WHEN p.pos IS NOT NULL THEN p.quality_score
       ELSE m.quality_score END AS quality_score,
  CASE WHEN l.quality_score > 0.3 THEN l.abstract WHEN p.pos IS NOT NULL THEN p.p_abstract
       ELSE m.m_abstract END AS abstract
FROM dp d LEFT JOIN llm l ON l.pos = d.pos LEFT JOIN pmc_ok p ON p.pos = d.pos LEFT JOIN mn m ON m.pos = d.pos""")
def q_docs_cascade(spark, sf):
    """J2 (all branches) + F4: model reply > PMC document > minimal record."""
    from ..operators.cascade import staged_cascade
    from .documents import documents_scenario
    pubs, bioc, replies = documents_scenario(spark, sf)
    c = staged_cascade(pubs.select("pos", "url", "title", "pmcid"), replies, bioc)
    return c.select("pos", "extraction_source", "quality_score", "abstract")


def _docs_articles_sql() -> str:
    """CTE ``arts_d``: every field of the documents-scenario cascade output."""
    return _docs_base_sql() + """,
rpl AS (SELECT r.pos, r.toxic, r.o_source, r.o_lang, r.d_kw, r.d_org, l.* EXCLUDE (pos)
        FROM rp r JOIN llm l ON l.pos = r.pos),
arts_d AS (
  SELECT d.pos, d.url, CASE WHEN l.quality_score > 0.3 THEN l.l_title ELSE d.title END AS title, d.pmcid,
    CASE WHEN l.quality_score > 0.3 THEN 'llm' WHEN p.pos IS NOT NULL THEN 'pmc' ELSE 'min' END AS br,
    CASE WHEN l.quality_score > 0.3 THEN l.extraction_source WHEN p.pos IS NOT NULL THEN 'pmc_api_fallback'
         ELSE 'minimal_metadata' END AS extraction_source,
    CASE WHEN l.quality_score > 0.3 THEN l.abstract WHEN p.pos IS NOT NULL THEN p.p_abstract ELSE m.m_abstract END AS abstract,
    CASE WHEN l.quality_score > 0.3 THEN NULL WHEN p.pos IS NOT NULL THEN p.p_full END AS full_text,
    CASE WHEN l.quality_score > 0.3 THEN l.journal END AS journal,
    CASE WHEN l.quality_score > 0.3 AND l.toxic = 1 THEN [l.o_source, l.o_lang] ELSE []::VARCHAR[] END AS authors,
    CASE WHEN l.quality_score > 0.3 THEN CASE WHEN l.toxic = 1 THEN []::VARCHAR[] ELSE l.d_kw END
         WHEN p.pos IS NOT NULL THEN p.p_kw ELSE m.m_kw END AS keywords,
    CASE WHEN l.quality_score > 0.3 THEN CASE WHEN l.toxic = 1 THEN []::VARCHAR[] ELSE l.d_org END
         WHEN p.pos IS NOT NULL THEN p.p_org ELSE m.m_org END AS organisms,
    (l.quality_score > 0.3) IS TRUE AS llm_extracted,
    CASE WHEN l.quality_score > 0.3 THEN l.llm_confidence_score ELSE 0.0::DOUBLE END AS llm_confidence_score,
    CASE WHEN l.quality_score > 0.3 THEN l.quality_score WHEN p.pos IS NOT NULL THEN p.quality_score
         ELSE m.quality_score END AS quality_score
  FROM dp d LEFT JOIN rpl l ON l.pos = d.pos LEFT JOIN pmc_ok p ON p.pos = d.pos
  LEFT JOIN (SELECT mn.*, x.m_org, x.m_kw FROM mn JOIN (SELECT pos,
        """ + S.term_hits("lower(title)", vocab.BASIC_ORGANISMS) + """ AS m_org,
        """ + S.term_hits("lower(title)", vocab.BASIC_KEYWORDS, False) + """ AS m_kw FROM dp) x USING (pos)) m
    ON m.pos = d.pos
)"""


def _docs_articles(spark, sf):
    from ..operators.cascade import staged_cascade
    from .documents import documents_scenario
    pubs, bioc, replies = documents_scenario(spark, sf)
    return staged_cascade(pubs.select("pos", "url", "title", "pmcid"), replies, bioc)


_ART = {k: k for k in ("title", "pmcid", "abstract", "full_text", "journal", "authors", "keywords", "organisms",
                       "llm_extracted", "llm_confidence_score")}


@register("quality_profiles", _docs_articles_sql() + f"""
SELECT pos, {S.quality_main(_ART)} AS q_main, {S.quality_llm(_ART)} AS q_llm, {S.quality_strict(_ART)} AS q_strict,
  ({S.truthy('title')} AND length({S.py_strip('title')}) >= 5 AND {S.truthy('url')}) AS valid_main,
  ({S.truthy('title')} AND length({S.py_strip('title')}) >= 10 AND {S.truthy('url')}
   AND regexp_matches(url, '^[\\x00-\\x20]*[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]')
   AND ({S.truthy('abstract')} OR {S.truthy('full_text')})) AS valid_strict
FROM arts_d""")
def q_quality_profiles(spark, sf):
    """Q1 + Q2 + Q3 + F1 + F2 + F3: every score rule and validity rule per article."""
    from ..functions.quality import is_valid
    a = _docs_articles(spark, sf)
    return a.select("pos", quality_score("main").alias("q_main"), quality_score("llm").alias("q_llm"),
                    quality_score("strict").alias("q_strict"), is_valid("main").alias("valid_main"),
                    is_valid("strict").alias("valid_strict"))


_LD_BASE = ["@context", "@id", "@type", "schema:name", "schema:url", "extraction_source", "llm_extracted",
            "llm_confidence_score"]


@register("json_ld", _docs_articles_sql() + f"""
SELECT pos,
  array_to_string(list_sort(list_concat({S.str_list(_LD_BASE)},
    CASE WHEN {S.truthy('abstract')} THEN ['schema:abstract'] ELSE [] END,
    CASE WHEN {S.truthy('full_text')} THEN ['schema:text'] ELSE [] END,
    CASE WHEN {S.truthy('journal')} THEN ['schema:isPartOf'] ELSE [] END,
    CASE WHEN len(authors) > 0 THEN ['schema:author'] ELSE [] END,
    CASE WHEN {S.truthy('pmcid')} THEN ['schema:identifier'] ELSE [] END,
    CASE WHEN len(keywords) > 0 THEN ['schema:keywords'] ELSE [] END)), '|') AS keys,
  {S.article_id('NULL', 'pmcid', 'NULL', 'title')} AS id, title AS name, url,
  len(authors) AS n_authors, CASE WHEN {S.truthy('pmcid')} THEN 'PMCID' END AS id_kinds
FROM arts_d""")
def q_json_ld(spark, sf):
    """K1: JSON-LD documents; checked through their keys and key values."""
    from ..operators.graph import to_json_ld
    a = _docs_articles(spark, sf).withColumn("js", to_json_ld("main"))
    return a.select(
        "pos", F.array_join(F.sort_array(F.json_object_keys("js")), "|").alias("keys"),
        F.get_json_object("js", "$['@id']").alias("id"), F.get_json_object("js", "$['schema:name']").alias("name"),
        F.get_json_object("js", "$['schema:url']").alias("url"),
        F.coalesce(F.json_array_length(F.get_json_object("js", "$['schema:author']")), F.lit(0)).cast("long").alias("n_authors"),
        F.get_json_object("js", "$['schema:identifier'][0]['schema:propertyID']").alias("id_kinds"))


@register("source_counts", _docs_articles_sql() + " SELECT extraction_source, count(*) AS n FROM arts_d GROUP BY 1")
def q_source_counts(spark, sf):
    """A1: articles per extraction source."""
    from ..operators.metrics import count_by_source
    return count_by_source(_docs_articles(spark, sf))


@register("run_metrics", _docs_articles_sql() + f"""
SELECT count(*) AS total, count_if(llm_extracted)::BIGINT AS llm_extracted,
  round(avg(CASE WHEN llm_extracted THEN llm_confidence_score END), 9) AS avg_llm_confidence,
  round(avg(quality_score), 9) AS avg_quality,
  count_if(quality_score >= 0.2 AND {S.truthy('title')} AND length({S.py_strip('title')}) >= 5 AND {S.truthy('url')})::BIGINT AS passed,
  CAST(sum(len(organisms)) AS BIGINT) AS entities,
  round(avg(CASE WHEN quality_score >= 0.2 AND {S.truthy('title')} AND length({S.py_strip('title')}) >= 5
                 AND {S.truthy('url')} THEN 1.0 ELSE 0.0 END), 9) AS pass_rate,
  round(avg(CASE WHEN {S.truthy('title')} AND {S.truthy('url')} THEN 1.0 ELSE 0.0 END), 9) AS completeness,
  round(avg(len(organisms) + 0.0), 9) AS organisms_per_article
FROM arts_d""")
def q_run_metrics(spark, sf):
    """A2 + A3 + A5 + A6: one-row run summary."""
    from ..operators.metrics import run_metrics
    return run_metrics(_docs_articles(spark, sf))


@register("validation_report", _docs_articles_sql() + """
SELECT validator, count_if(ok)::BIGINT AS passed, count_if(NOT ok)::BIGINT AS failed FROM (
  SELECT 'url' AS validator, regexp_matches(url, '^[\\x00-\\x20]*[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]') AS ok FROM arts_d
  UNION ALL SELECT 'date', d.lang <> 'de' FROM arts_d a JOIN documents d ON d.doc_id = a.pos
  UNION ALL SELECT 'title', length(title) >= 10 FROM arts_d) GROUP BY validator""")
def q_validation_report(spark, sf):
    """A7 + X2: pass / fail counts per validator; German documents carry a date out of range."""
    from ..operators.validate import default_validators, validation_report
    lang = read_table(spark, sf, "documents").select(F.col("doc_id").alias("pos"), "lang")
    date = F.when(F.col("lang") == "de", F.lit("1900-01-01")).when(F.col("lang") == "en", F.lit("2020-01-01")).cast("timestamp")
    dated = _docs_articles(spark, sf).join(lang, "pos").withColumn("publication_date", date)
    return validation_report(dated, default_validators())


_ENTITY_TYPES = ["Keywords", "MeshTerms", "Organisms", "Genes", "Proteins", "Conditions", "Experiments", "Measurements"]


def _entity_counts_sql() -> str:
    e = S.entities_main_cols("nt")
    u = lambda old, new: f"len(list_distinct(list_concat({old}, {new})))"
    return f"""WITH {S.pages_cte()}, {S.cascade_cte()}, {S.validated_cte()},
txt AS (SELECT *, {S.nlp_text_sql('main', 'abstract', 'NULL')} AS nt FROM valid),
c AS (SELECT len(keywords) AS kw, {u('organisms', e['organisms'])} AS org, {u('[]::VARCHAR[]', e['genes'])} AS gen,
             {u('[]::VARCHAR[]', e['proteins'])} AS prot, {u('conditions', e['conditions'])} AS cond,
             {u('[]::VARCHAR[]', e['experiments'])} AS exp, {u('[]::VARCHAR[]', e['measurements'])} AS meas FROM txt)
SELECT entity_type, CAST(n AS BIGINT) AS n FROM (
SELECT 'Keywords' AS entity_type, sum(kw)::BIGINT AS n FROM c UNION ALL SELECT 'MeshTerms', 0::BIGINT
UNION ALL SELECT 'Organisms', sum(org) FROM c UNION ALL SELECT 'Genes', sum(gen) FROM c
UNION ALL SELECT 'Proteins', sum(prot) FROM c UNION ALL SELECT 'Conditions', sum(cond) FROM c
UNION ALL SELECT 'Experiments', sum(exp) FROM c UNION ALL SELECT 'Measurements', sum(meas) FROM c
UNION ALL SELECT 'Authors', 0::BIGINT
UNION ALL SELECT 'total', sum(kw + org + gen + prot + cond + exp + meas) FROM c)"""


@register("entity_counts", _entity_counts_sql())
def q_entity_counts(spark, sf):
    """K4 + A4: list-valued graph entities counted per type, with a total."""
    from ..operators.metrics import entity_counts
    return entity_counts(_pages_enriched(spark, sf))


@register("graph_summary", _triples_sql("""
, types AS (SELECT DISTINCT s, o FROM td WHERE p = '""" + vocab.RDF_TYPE + """')
SELECT 'node' AS kind, o AS name, count(*) AS n FROM types GROUP BY o
UNION ALL
SELECT 'edge', p, count(*) FROM (SELECT DISTINCT s, p, o FROM td WHERE o_kind = 'uri' AND p <> '""" + vocab.RDF_TYPE + """') GROUP BY p
UNION ALL
SELECT 'max_in_degree', 'any', max(c) FROM (SELECT o, count(*) AS c FROM (SELECT DISTINCT s, p, o FROM td
  WHERE o_kind = 'uri' AND p <> '""" + vocab.RDF_TYPE + """') GROUP BY o)""").replace("td AS (SELECT DISTINCT pos, s, p, o, o_kind FROM t)\n,", "td AS (SELECT DISTINCT pos, s, p, o, o_kind FROM t),"))
def q_graph_summary(spark, sf):
    """K5: node table (count per type), edge table (count per predicate), max in-degree."""
    from ..operators.graph import graph_counts
    return graph_counts(to_triples(_pages_enriched(spark, sf)))


def _prompt_sql() -> str:
    head, tail = vocab.EXTRACTION_PROMPT.split("{text}")
    body = ("array_to_string(list_filter([CASE WHEN length(title) > 0 THEN 'Title: ' || title END, "
            "CASE WHEN length(url) > 0 THEN 'Source URL: ' || url END, "
            "CASE WHEN length(coalesce(CASE WHEN length(page_text) > 0 THEN page_text ELSE title END, '')) > 0 "
            "THEN 'Content: ' || CASE WHEN length(page_text) > 0 THEN page_text ELSE title END END], "
            "lambda x: x IS NOT NULL), chr(10) || chr(10))")
    return (f"WITH {S.pages_cte()} SELECT pos, length({body})::INTEGER AS request_chars, "
            f"md5({S.q(head)} || {body} || {S.q(tail)}) AS prompt_md5 FROM pg")


@register("prompt_requests", _prompt_sql())
def q_prompt_requests(spark, sf):
    """P10: the model request built for every page publication (its length and digest)."""
    from ..operators.cascade import prompt_request, prompt_text
    p = _pages_pubs(spark, sf)
    return p.select("pos", F.length(prompt_text()).alias("request_chars"), F.md5(prompt_request()).alias("prompt_md5"))


@register("article_ids", f"""WITH {S.pages_cte()}
SELECT 'pages' AS src, pos, {S.article_id('NULL', 'pmcid', 'NULL', 'title')} AS article_id FROM pg
UNION ALL
SELECT 'documents', doc_id, {S.article_id('NULL', S.pmcid_from_url("'https://www.ncbi.nlm.nih.gov/pmc/articles/PMC' || (CASE WHEN lang = 'es' THEN doc_id // 8 * 8 ELSE doc_id END) || '/'"), 'NULL', S.py_strip('split_part(text, chr(10), 1)'))}
FROM documents WHERE length({S.py_strip('split_part(text, chr(10), 1)')}) > 0""")
def q_article_ids(spark, sf):
    """P1 + P9: PMCID from the url and the article URI (doi > pmcid > pmid > md5(title))."""
    from ..functions.text import article_id
    from .documents import document_publications
    pg = _pages_pubs(spark, sf).select(F.lit("pages").alias("src"), "pos", article_id(doi=F.lit(None), pmid=F.lit(None)).alias("article_id"))
    dc = document_publications(read_table(spark, sf, "documents")).select(
        F.lit("documents").alias("src"), "pos", article_id(doi=F.lit(None), pmid=F.lit(None)).alias("article_id"))
    return pg.unionByName(dc)


@register("space_relevance", f"""WITH {S.pages_cte()}
SELECT pos, title, (contains(lower(title), 'microgravity') OR contains(lower(title), 'space')
  OR contains(lower(title), 'astronaut') OR contains(lower(title), 'ISS')) AS relevant FROM pg""")
def q_space_relevance(spark, sf):
    """relevance of a title to the domain (lower title contains a term as spelled)."""
    from ..functions.text import is_space_relevant
    return _pages_pubs(spark, sf).select("pos", "title", is_space_relevant("title").alias("relevant"))


@register("sample_record", f"""WITH {S.pages_cte()}, {S.cascade_cte()}, {S.validated_cte()}
SELECT left(title, 80) AS title, extraction_source, quality_score FROM valid ORDER BY pos LIMIT 1""")
def q_sample_record(spark, sf):
    """L3: first record of the run (title cut at 80 characters); the limit is the feature."""
    from ..operators.metrics import sample_record
    return sample_record(_pages_valid(spark, sf)).select("title", "extraction_source", "quality_score")


_TIME_SQL = S.DIGIT + "+" + S.WS + "*(?:days?|weeks?|months?|years?|hrs?|hours?|mins?|minutes?)"


@register("doc_time_periods", f"SELECT doc_id, array_to_string(regexp_extract_all(text, {S.q(_TIME_SQL)}, 0), '|') "
          "AS time_periods FROM documents")
def q_doc_time_periods(spark, sf):
    """Number + time unit mentions over whole document texts (all matches, in order)."""
    from ..functions.entities import time_periods
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", _join(time_periods("text")).alias("time_periods"))


from . import outputs, records  # noqa: E402,F401  register the queries over identifiers, whole records and outputs
