"""Registered queries over what a run writes: sinks, records, defaults, thresholds, batches, graph store.

Each writes with the library's sink to the shared folder and reads back what is there.
"""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import sorted_join
from ..operators.graph import to_triples
from ..session import checkpoint_dir
from . import sqlgen as S
from .catalog import _pages_enriched, _pages_pubs, _triples_sql, register
from .pages import read_table
from .records import _IDENTIFIED_SQL, _identified


def _folder(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/outputs-{uuid.uuid4().hex}"


# -- S5, S7: every output format ------------------------------------------------

@register("written_outputs", _triples_sql("""
SELECT 'json' AS format, extraction_source AS key, count(*) AS n, CAST(round(sum(quality_score), 6) AS DOUBLE) AS total FROM valid GROUP BY 2
UNION ALL SELECT 'json-ld', title, count(*), NULL FROM valid GROUP BY 2
UNION ALL SELECT 'csv', url, count(*), CAST(round(sum(quality_score), 6) AS DOUBLE) FROM valid GROUP BY 2
UNION ALL SELECT 'rdf', p, count(*), NULL FROM (SELECT DISTINCT s, p, o, o_kind FROM td) GROUP BY 2"""))
def q_written_outputs(spark, sf):
    """S5 + S7: articles written as JSON records, JSON-LD lines, N-Triples and CSV in one run, and read back."""
    from ..sources.sinks import write_outputs
    path = _folder(spark)
    write_outputs(_pages_enriched(spark, sf), path, formats=("json", "json-ld", "rdf", "csv"))
    score = F.round(F.sum(F.col("s").cast("double")), 6).alias("total")
    none = F.lit(None).cast("double").alias("total")
    count = F.count("*").alias("n")
    record = "article_data struct<extraction_source: string, quality_score: double>"
    json = spark.read.schema(record).json(f"{path}/json").select(F.col("article_data.extraction_source").alias("key"), F.col("article_data.quality_score").alias("s"))
    ld = spark.read.text(f"{path}/json-ld").select(F.get_json_object("value", "$['schema:name']").alias("key"))
    rdf = spark.read.text(f"{path}/rdf").select(F.regexp_extract("value", "^<[^>]*> <([^>]*)> ", 1).alias("key"))
    csv = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{path}/csv").select(F.col("url").alias("key"), F.col("quality_score").alias("s"))
    parts = [("json", json.groupBy("key").agg(count, score)), ("json-ld", ld.groupBy("key").agg(count, none)),
             ("csv", csv.groupBy("key").agg(count, score)), ("rdf", rdf.groupBy("key").agg(count, none))]
    out = None
    for name, df in parts:
        df = df.select(F.lit(name).alias("format"), "key", "n", "total")
        out = df if out is None else out.unionByName(df)
    return out


# -- S6: one article as JSON text --------------------------------------------------

@register("article_lines", f"""WITH {S.pages_cte()}, {S.cascade_cte()}, {S.validated_cte()}
SELECT pos, title, url, abstract, quality_score, {S.sorted_join('keywords')} AS keywords, true AS nulls_kept, CAST(NULL AS VARCHAR) AS doi FROM valid""")
def q_article_lines(spark, sf):
    """Each article as a JSON string, parsed again; fields without a value are there as nulls."""
    from ..operators.validate import validate_quality
    from ..operators.cascade import article_cascade
    from ..sources.sinks import article_json
    valid = validate_quality(article_cascade(_pages_pubs(spark, sf)), "main")
    lines = valid.select("pos", article_json(valid).alias("line"))
    back = F.from_json("line", "title string, url string, abstract string, quality_score double, keywords array<string>, doi string").alias("a")
    return lines.select("pos", back, (F.instr("line", '"doi":null') > 0).alias("nulls_kept")).select(
        "pos", "a.title", "a.url", "a.abstract", "a.quality_score", sorted_join(F.col("a.keywords")).alias("keywords"), "nulls_kept", "a.doi")


# -- P11: defaults ----------------------------------------------------------------

@register("article_defaults", """SELECT doc_id, title, CASE WHEN lang = 'en' THEN source ELSE 'web_scraping' END AS extraction_source,
  CASE WHEN lang = 'fr' THEN n_chars / 10.0 ELSE 0.0 END AS quality_score, lang = 'de' AS llm_extracted, 0.0::DOUBLE AS llm_confidence_score,
  CAST(CASE WHEN lang = 'es' THEN 2 ELSE 0 END AS INTEGER) AS n_keywords, CAST(0 AS INTEGER) AS n_genes, CAST(0 AS INTEGER) AS n_authors, true AS stamped, true AS others_null
FROM (SELECT *, split_part(text, chr(10), 1) AS title FROM documents)""")
def q_article_defaults(spark, sf):
    """Records with missing columns, null lists and null scalars get the article defaults."""
    from ..operators.articles import with_article_defaults
    lang = F.col("lang")
    d = read_table(spark, sf, "documents").select(
        "doc_id", F.substring_index("text", "\n", 1).alias("title"), F.when(lang == "en", F.col("source")).alias("extraction_source"),
        F.when(lang == "fr", F.col("n_chars") / 10.0).alias("quality_score"), F.when(lang == "de", F.lit(True)).alias("llm_extracted"),
        F.when(lang == "es", F.array("lang", "source")).alias("keywords"))
    a = with_article_defaults(d, as_of="2025-01-02 03:04:05")
    return a.select("doc_id", "title", "extraction_source", "quality_score", "llm_extracted", "llm_confidence_score", F.size("keywords").alias("n_keywords"),
                    F.size("genes").alias("n_genes"), F.size("authors").alias("n_authors"),
                    (F.col("extraction_timestamp") == F.lit("2025-01-02 03:04:05").cast("timestamp")).alias("stamped"),
                    (F.col("abstract").isNull() & F.col("doi").isNull() & F.col("publication_date").isNull()).alias("others_null"))


# -- F8: thresholds ---------------------------------------------------------------

_STRICT = {"min_title_length": 30, "min_abstract_length": 100, "min_fulltext_length": 1000}


@register("strict_thresholds", f"""WITH {S.pages_cte()}, {S.cascade_cte()}
SELECT pos, coalesce(length({S.py_strip('title')}) >= 30 AND regexp_matches(url, '^https?://[^/]+') AND length(coalesce(abstract, '')) > 0
  AND length(title) > 0 AND length(url) > 0 AND length(coalesce(pmcid, '')) > 0, false) AS with_pmcid,
  coalesce(length({S.py_strip('title')}) >= 30 AND regexp_matches(url, '^https?://[^/]+') AND length(coalesce(abstract, '')) > 0
  AND length(title) > 0 AND length(url) > 0, false) AS valid FROM arts""")
def q_strict_thresholds(spark, sf):
    """F8: the strict rule with thresholds and required fields of its own."""
    from ..functions.quality import is_valid
    from ..operators.cascade import article_cascade
    arts = article_cascade(_pages_pubs(spark, sf))
    return arts.select("pos", is_valid("strict", thresholds=_STRICT, required=("title", "url", "pmcid")).alias("with_pmcid"), is_valid("strict", thresholds=_STRICT).alias("valid"))


# -- U3, S8, J7: batches against the persisted index -------------------------------

@register("seen_batches", f"""WITH {_IDENTIFIED_SQL}, lg AS (SELECT *, CASE WHEN contains(url, '/de/') OR contains(url, '/es/') THEN 0 ELSE 1 END AS b FROM idd),
tt AS (SELECT lower(title) AS t FROM idd), {S.similar_pairs_sql('tt')},
rws AS (SELECT b * 10000000000 + pos AS pos, lower(title) AS lt, list_filter([doi, pmid, pmcid], lambda x: x IS NOT NULL) AS ids FROM lg), {S.greedy_dedup_sql("rws")}
SELECT CAST(pos // 10000000000 AS INTEGER) AS batch, CAST(pos % 10000000000 AS BIGINT) AS pos FROM kept""")
def q_seen_batches(spark, sf):
    """U3 + S8 + J7: German and Spanish pages, then the others, as batches of a growing run; the index drops what it has seen."""
    from ..operators.dedup import deduplicate
    from ..operators.registry import SeenIndex
    from ..session import materialise
    index = SeenIndex(spark, _folder(spark), buckets=32)
    pages = materialise(_identified(spark, sf))
    first = F.col("url").contains("/de/") | F.col("url").contains("/es/")
    out = None
    for n, batch in enumerate((pages.where(first), pages.where(~first))):
        kept = materialise(deduplicate(index.drop(batch, n)))
        index.add(kept, n)
        part = kept.select(F.lit(n).alias("batch"), "pos")
        out = part if out is None else out.unionByName(part)
    return out


# -- A8, K5: the graph in batches ----------------------------------------------------

@register("graph_store", _triples_sql("""
, g AS (SELECT DISTINCT s, p, o, o_kind FROM td), e AS (SELECT s, o FROM g WHERE o_kind = 'uri' AND p <> '""" + vocab.RDF_TYPE + """'),
u AS (SELECT o AS uri, 1 AS i, 0 AS x FROM e UNION ALL SELECT s, 0, 1 FROM e)
SELECT uri, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(x) AS BIGINT) AS out_degree, (SELECT count(*) FROM g) AS triples FROM u GROUP BY 1""").replace(
    "td AS (SELECT DISTINCT pos, s, p, o, o_kind FROM t)\n\n, g AS", "td AS (SELECT DISTINCT pos, s, p, o, o_kind FROM t)\n, g AS"))
def q_graph_store(spark, sf):
    """A8 + K5: the graph built in two batches, of which the second holds the first again: nothing is added twice."""
    from ..operators.triple_store import TripleStore
    from ..session import materialise
    triples = materialise(to_triples(_pages_enriched(spark, sf)))
    store = TripleStore(spark, _folder(spark), buckets=32)
    store.add(triples.where(F.col("o_kind") == "uri"), 0)
    store.add(triples, 1)
    return store.degrees().withColumn("triples", F.lit(store.triples().count()))


# -- L1: the sampling feature ----------------------------------------------------------

@register("first_publications", f"WITH {S.pages_cte()} SELECT pos, title, url FROM pg ORDER BY pos LIMIT 5")
def q_first_publications(spark, sf):
    """L1: the first five publications in input order."""
    from ..sources.publications import limit_publications
    return limit_publications(_pages_pubs(spark, sf), 5).select("pos", "title", "url")
