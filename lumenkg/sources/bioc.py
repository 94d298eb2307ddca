"""Full-text API documents (BioC JSON) -> articles (S3).

All passages of all documents are flattened in order; passages whose
``infons.type`` contains "abstract" (any case) form the abstract (joined
by a blank, stripped), the others the full text (joined by newlines, kept
whenever there is at least one such passage).  Pure Column expressions:
``try_parse_json`` + ``flatten(transform(...))`` + ``filter`` + ``array_join``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.entities import term_hits_sql
from ..functions.quality import quality_score_sql
from ..functions.text import _STRIP_RE, sql_str
from ..operators.articles import ARTICLE_FIELDS, ARTICLE_SCHEMA

DOCUMENTS_TYPE = "array<struct<passages: array<struct<infons: map<string,string>, text: string>>>>"


def bioc_stages_sql(jsons: str) -> list[tuple[str, str]]:
    """Staged columns (name, SQL) over ``jsons`` (array of response bodies):
    each body is parsed once, passages are flattened once, then split into
    abstract and body texts.  A body that is not a JSON object, or whose
    ``documents`` is not a list of documents, gives nothing; ``_docs`` is empty
    when no body is usable."""
    typ = "lower(coalesce(element_at(p.infons, 'type'), ''))"
    txt = "coalesce(p.text, '')"
    parsed = f"transform({jsons}, j -> try_parse_json(j))"
    objects = f"filter({parsed}, v -> v IS NOT NULL AND schema_of_variant(v) LIKE 'OBJECT<%')"
    listed = (f"transform({objects}, v -> CASE WHEN variant_get(v, '$.documents') IS NULL THEN CAST(array() AS {DOCUMENTS_TYPE}) "
              f"ELSE try_variant_get(v, '$.documents', '{DOCUMENTS_TYPE}') END)")
    return [
        ("_docs", f"filter({listed}, d -> d IS NOT NULL)"),
        ("_pass", "flatten(transform(flatten(_docs), d -> coalesce(d.passages, array())))"),
        ("_abs", f"transform(filter(_pass, p -> contains({typ}, 'abstract')), p -> {txt})"),
        ("_body", f"transform(filter(_pass, p -> NOT contains({typ}, 'abstract')), p -> {txt})"),
        ("_abs_txt", f"regexp_replace(array_join(_abs, ' '), {sql_str(_STRIP_RE)}, '')"),
    ]


def bioc_fields_sql(title: str) -> dict[str, str]:
    """SQL for abstract, full_text, organisms and keywords over the stages."""
    abstract = "(CASE WHEN length(_abs_txt) > 0 THEN _abs_txt END)"
    probe = f"lower(concat({title}, ' ', coalesce({abstract}, '')))"
    return {
        "abstract": abstract,
        "full_text": "(CASE WHEN size(_body) > 0 THEN array_join(_body, '\\n') END)",
        "organisms": f"sort_array({term_hits_sql(probe, vocab.BASIC_ORGANISMS, True)})",
        "keywords": f"sort_array({term_hits_sql(probe, vocab.BASIC_KEYWORDS, False)})",
    }


def pmc_articles(publications: DataFrame, bioc: DataFrame, json_col: str = "json", row_id: str = "pos") -> DataFrame:
    """S3 for every publication with a pmcid and a fetched API document:
    returns ``row_id, pmcid, url, pmc`` (article struct), one row per
    publication, only when the score > 0.2.

    ``bioc`` (pmcid, json, and status if there is one: only 200 counts) is
    first restricted to the wanted pmcids.  One response counts for a pmcid: of
    the usable ones the last fetched, where a column ``fetched_at`` tells, and of
    equal ones the smallest body; a response that is stored twice counts once.
    """
    pubs = publications.filter(F.col("pmcid").isNotNull() & (F.length("pmcid") > 0)) \
        .select(row_id, "url", "pmcid", F.col("title").alias("_t"))
    if "status" in bioc.columns:
        bioc = bioc.filter(F.col("status") == 200)
    at = F.col("fetched_at").cast("timestamp") if "fetched_at" in bioc.columns else F.lit(None).cast("timestamp")
    docs = bioc.join(pubs.select("pmcid").distinct(), "pmcid", "left_semi").select("pmcid", at.alias("_at"), F.array(json_col).alias("_jsons"))
    for name, e in bioc_stages_sql("_jsons")[:1]:
        docs = docs.withColumn(name, F.expr(e))
    # a body at most is carried a pmcid, chosen before the shuffle; min takes a null time last, as it is negated
    late = F.coalesce(-F.unix_micros("_at"), F.lit((1 << 63) - 1))
    docs = docs.withColumn("_rank", F.when(F.size("_docs") > 0, F.struct(late.alias("late"), F.col("_jsons"))))
    docs = docs.groupBy("pmcid").agg(F.min("_rank").alias("_rank")).where("_rank IS NOT NULL").select("pmcid", F.col("_rank._jsons").alias("_jsons"))
    for name, e in bioc_stages_sql("_jsons"):
        docs = docs.withColumn(name, F.expr(e))
    j = pubs.join(docs.select("pmcid", "_abs_txt", "_body"), "pmcid")
    cols = bioc_fields_sql("coalesce(_t, '')")
    j = j.select(row_id, "url", "pmcid", "_t", *[F.expr(e).alias(n) for n, e in cols.items()])
    j = j.withColumn("_score", F.expr(quality_score_sql("main", get=lambda n: {
        "title": "_t", "pmcid": "pmcid", "abstract": "abstract", "full_text": "full_text",
        "organisms": "organisms", "keywords": "keywords", "llm_extracted": "false",
        "llm_confidence_score": "0.0D"}.get(n, "NULL"))))
    j = j.filter(F.col("_score") > vocab.FALLBACK_MIN_SCORE)
    vals = {"title": "_t", "url": "url", "pmcid": "pmcid", "abstract": "abstract", "full_text": "full_text",
            "organisms": "organisms", "keywords": "keywords", "quality_score": "_score",
            "extraction_source": "'pmc_api_fallback'", "llm_extracted": "false", "llm_confidence_score": "0.0D",
            "extraction_timestamp": "current_timestamp()"}
    fields = []
    for f in ARTICLE_FIELDS:
        dt = ARTICLE_SCHEMA[f].dataType.simpleString()
        e = vals.get(f, "array()" if dt.startswith("array") else "NULL")
        fields.append(F.expr(f"CAST({e} AS {dt})").alias(f))
    return j.select(row_id, "pmcid", "url", F.struct(*fields).alias("pmc"))
