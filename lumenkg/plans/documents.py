"""A second end-to-end scenario derived from ``documents`` and ``labels``.

Each document is a publication whose PMC full-text document (BioC JSON)
and model replies are tables Spark derives from the document itself:

* publication: title = first line, url = a PMC article address; Spanish
  documents share the address of their group of eight
* BioC (one response per address, of the document that the address names):
  English and Spanish documents; passage 1 "front", passage 2 "ABSTRACT",
  the rest "paragraph"; some sources answer with broken bodies or status 404
* replies (address documents with a label): ``deepseek`` answers 500 for
  toxic documents, otherwise a message whose content wraps a JSON object in
  free text; ``groq`` always answers with a ``text`` choice without title
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.entities import term_hits_sql
from ..functions.text import _STRIP_RE, pmcid_from_url, sql_str
from .pages import read_table

PMC_BASE = "https://www.ncbi.nlm.nih.gov/pmc/articles/PMC"


def _first_line() -> str:
    return f"regexp_replace(substring_index(text, '\\n', 1), {sql_str(_STRIP_RE)}, '')"


def document_publications(documents: DataFrame) -> DataFrame:
    d = documents.select("doc_id", "text", "lang", "source")
    d = d.withColumn("uid", F.expr("CASE WHEN lang = 'es' THEN (doc_id DIV 8) * 8 ELSE doc_id END"))
    d = d.withColumn("url", F.concat(F.lit(PMC_BASE), F.col("uid").cast("string"), F.lit("/")))
    return d.select(F.col("doc_id").alias("pos"), F.expr(_first_line()).alias("title"), "url",
                    pmcid_from_url("url").alias("pmcid"), "text", "lang", "source", "uid") \
        .filter("length(title) > 0")


def document_bioc(pubs: DataFrame) -> DataFrame:
    js = ("to_json(named_struct('documents', array(named_struct('passages', "
          "transform(split(text, '\\n'), (l, i) -> named_struct('infons', map('type', "
          "CASE i WHEN 0 THEN 'front' WHEN 1 THEN 'ABSTRACT' ELSE 'paragraph' END), 'text', l))))))")
    broken = F.when(F.col("source") == "src1", F.lit("not json")).when(F.col("source") == "src2", F.lit('{"documents": 5}')) \
        .when(F.col("source") == "src3", F.lit(""))
    return pubs.filter(F.col("lang").isin("en", "es") & (F.col("uid") == F.col("pos"))).select(
        "pmcid", F.coalesce(broken, F.expr(js)).alias("json"),
        F.when(F.col("source") == "src4", F.lit(404)).otherwise(F.lit(200)).alias("status"))


def document_replies(pubs: DataFrame, labels: DataFrame) -> DataFrame:
    j = pubs.filter(F.col("uid") == F.col("pos")).join(labels, F.col("pos") == F.col("doc_id")).select("url", "title", "text", "source", "lang",
                                                                   "quality", "toxic")
    second = "try_element_at(split(text, '\\n'), 2)"
    kw = term_hits_sql("lower(text)", vocab.BASIC_KEYWORDS, False)
    org = term_hits_sql("lower(text)", vocab.BASIC_ORGANISMS, True)
    obj1 = (f"to_json(named_struct('title', title, 'abstract', coalesce({second}, ''), 'journal', source, "
            f"'keywords', {kw}, 'organisms', {org}, 'confidence_score', "
            f"CASE WHEN quality = 1 THEN '0.9' ELSE '0.4' END, 'publication_date', 'null'))")
    body1 = (f"to_json(named_struct('choices', array(named_struct('message', named_struct('content', "
             f"concat('Here is the JSON: ', {obj1}, ' Done.'))))))")
    def jstr(x):  # JSON string literal of a SQL string expression
        return f"regexp_extract(to_json(array({x})), '^\\\\[(.*)\\\\]$', 1)"
    # authors mix a plain string and an object, so this object is spelled out
    obj2 = (f"concat('{{\"abstract\": ', {jstr('text')}, ', \"confidence_score\": 0.75, "
            f"\"authors\": [', {jstr('source')}, ', {{\"name\": ', {jstr('lang')}, ', \"affiliation\": ', "
            f"{jstr('source')}, '}}]}}')")
    body2 = f"to_json(named_struct('choices', array(named_struct('text', {obj2}))))"
    r1 = j.select("url", F.lit("deepseek").alias("provider"),
                  F.when(F.col("toxic") == 1, F.lit(500)).otherwise(F.lit(200)).alias("status"),
                  F.expr(body1).alias("body"))
    r2 = j.select("url", F.lit("groq").alias("provider"), F.lit(200).alias("status"), F.expr(body2).alias("body"))
    return r1.unionByName(r2)


def documents_scenario(spark: SparkSession, sf: str):
    docs = read_table(spark, sf, "documents")
    pubs = document_publications(docs)
    labels = read_table(spark, sf, "labels")
    return pubs, document_bioc(pubs), document_replies(pubs, labels)
