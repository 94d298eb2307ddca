"""Model replies -> articles (S4a-c, J1), schema-on-read with VARIANT.

A reply body is a chat-completion JSON; its message content holds a JSON
object surrounded by free text.  Keys that are *present but null* behave
differently from *missing* keys (a null title drops the row, a missing one
falls back to the input title; a null confidence drops the row, a missing
one is 0.0), so the content is parsed into a VARIANT and inspected with
``variant_get`` / ``is_variant_null`` / ``schema_of_variant``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.quality import quality_score_sql
from ..functions.text import _STRIP_RE, ident, sql_str
from ..operators.articles import ARTICLE_FIELDS, ARTICLE_SCHEMA

REPLY_LIST_FIELDS = ["keywords", "organisms", "genes", "proteins", "conditions", "experiments", "measurements"]


def _is_string(v: str) -> str:
    return f"(schema_of_variant({v}) = 'STRING')"


def _truthy_variant(v: str) -> str:
    """Python truthiness of a JSON value held in a VARIANT."""
    sch = f"schema_of_variant({v})"
    return (f"(NOT ({v} IS NULL OR is_variant_null({v}) OR {sch} IN ('OBJECT<>', 'ARRAY<VOID>') "
            f"OR ({sch} = 'STRING' AND try_variant_get({v}, '$', 'string') = '') "
            f"OR ({sch} = 'BOOLEAN' AND NOT try_variant_get({v}, '$', 'boolean')) "
            f"OR ({sch} NOT IN ('STRING', 'BOOLEAN') AND {sch} NOT LIKE 'OBJECT%' AND {sch} NOT LIKE 'ARRAY%' "
            f"AND try_variant_get({v}, '$', 'double') = 0)))")


def reply_content_sql(c0: str) -> str:
    """S4a over ``c0`` = the first choice (VARIANT): ``message.content`` if
    ``message`` is present, else ``text``; only string contents count."""
    msg = f"variant_get({c0}, '$.message')"
    content = f"variant_get({c0}, '$.message.content')"
    text = f"variant_get({c0}, '$.text')"
    return (f"(CASE WHEN {msg} IS NOT NULL THEN CASE WHEN {_is_string(content)} "
            f"THEN try_variant_get({content}, '$', 'string') END "
            f"WHEN {text} IS NOT NULL AND {_is_string(text)} THEN try_variant_get({text}, '$', 'string') END)")


def reply_json_sql(s: str) -> str:
    """S4b over ``s`` = the stripped content: the span from the first '{' to
    the last '}', parsed; null when absent or invalid."""
    i = f"instr({s}, '{{')"
    r = f"instr(reverse({s}), '}}')"
    j = f"(length({s}) - {r} + 1)"
    return f"(CASE WHEN {i} > 0 AND {r} > 0 AND {j} > {i} THEN try_parse_json(substring({s}, {i}, {j} - {i} + 1)) END)"


def _item_str(v: str) -> str:
    """``str(item)`` of a list item: booleans are spelled True / False."""
    return (f"(CASE WHEN schema_of_variant({v}) = 'BOOLEAN' THEN CASE WHEN try_variant_get({v}, '$', 'boolean') "
            f"THEN 'True' ELSE 'False' END ELSE try_variant_get({v}, '$', 'string') END)")


def _str_of(v: str) -> str:
    """``str(value)`` for a JSON scalar (objects / arrays as JSON text)."""
    return f"try_variant_get({v}, '$', 'string')"


def reply_article_columns(v: str, title: str, url: str, pmcid: str, provider: str) -> dict[str, str]:
    """SQL for every article field of the reply object ``v`` plus
    ``_ok`` (the row survives).  Inputs are SQL expressions."""
    g = lambda k: f"_f_{k}"  # noqa: E731  (pre-extracted: variant_get(v, '$.<k>'))
    tv = g("title")
    title_sql = f"(CASE WHEN {tv} IS NULL THEN {title} WHEN {_is_string(tv)} THEN {_str_of(tv)} END)"
    title_ok = f"(({tv} IS NULL AND {title} IS NOT NULL AND length({title}) > 0) OR ({_is_string(tv)} AND length({_str_of(tv)}) > 0))"
    av = g("abstract")
    abstract = f"(CASE WHEN {av} IS NULL THEN '' WHEN is_variant_null({av}) THEN NULL ELSE {_str_of(av)} END)"
    abstract_ok = f"({av} IS NULL OR is_variant_null({av}) OR {_is_string(av)})"
    jv = g("journal")
    journal = f"(CASE WHEN {jv} IS NULL THEN '' WHEN is_variant_null({jv}) THEN NULL ELSE {_str_of(jv)} END)"
    dv = g("doi")
    doi = f"(CASE WHEN {dv} IS NULL OR is_variant_null({dv}) THEN NULL ELSE {_str_of(dv)} END)"
    cv = g("confidence_score")
    csch = f"schema_of_variant({cv})"
    conf = (f"(CASE WHEN {cv} IS NULL THEN CAST(0.0 AS DOUBLE) "
            f"WHEN {csch} = 'STRING' THEN try_cast(trim({_str_of(cv)}) AS DOUBLE) "
            f"WHEN {csch} = 'BOOLEAN' THEN CASE WHEN try_variant_get({cv}, '$', 'boolean') THEN 1.0D ELSE 0.0D END "
            f"WHEN is_variant_null({cv}) OR {csch} LIKE 'OBJECT%' OR {csch} LIKE 'ARRAY%' THEN NULL "
            f"ELSE try_variant_get({cv}, '$', 'double') END)")
    pv = g("publication_date")
    ps = _str_of(pv)
    pub = (f"(CASE WHEN {pv} IS NOT NULL AND {_is_string(pv)} AND {ps} <> '' AND {ps} <> 'null' "
           f"AND {ps} RLIKE '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$' THEN try_to_timestamp({ps}, 'yyyy-M-d') END)")
    au = "_f_authors_arr"
    authors = (f"coalesce(transform(filter({au}, x -> {_truthy_variant('x')}), x -> CASE "
               f"WHEN schema_of_variant(x) LIKE 'OBJECT%' THEN named_struct('name', CASE WHEN variant_get(x, '$.name') IS NULL "
               f"THEN '' ELSE try_variant_get(x, '$.name', 'string') END, 'affiliation', try_variant_get(x, '$.affiliation', 'string'), "
               f"'orcid', CAST(NULL AS STRING)) "
               f"ELSE named_struct('name', {_item_str('x')}, 'affiliation', CAST(NULL AS STRING), "
               f"'orcid', CAST(NULL AS STRING)) END), array())")
    cols = {
        "title": title_sql, "url": url, "pmcid": pmcid, "abstract": abstract, "journal": journal, "doi": doi,
        "llm_confidence_score": conf, "publication_date": pub, "authors": authors,
        "extraction_source": f"concat('llm_', {provider})", "llm_extracted": "true",
    }
    for f in REPLY_LIST_FIELDS:
        arr = f"_f_{f}_arr"
        cols[f] = f"coalesce(transform(filter({arr}, x -> {_truthy_variant('x')}), x -> {_item_str('x')}), array())"
    cols["_ok"] = f"({title_ok} AND {abstract_ok} AND ({cv} IS NULL OR {conf} IS NOT NULL))"
    return cols


def first_valid_reply(publications: DataFrame, replies: DataFrame, key: str = "url", row_id: str = "pos") -> DataFrame:
    """Per publication, the reply of the first provider (fixed priority)
    with status 200 that maps to an article; returns ``row_id, llm`` (struct).

    Replies are joined to publications on ``key`` and mapped with the title
    and pmcid of their own publication; the winner is ``min_by(article,
    priority)`` per publication row, in the join's own partitions (no second shuffle).  Publications may
    share a key: ``row_id`` tells them apart, so each gets one row.  The score
    test comes after this choice.
    """
    prov = "array(" + ", ".join(sql_str(p) for p in vocab.LLM_PROVIDERS) + ")"
    r = replies
    if "priority" not in r.columns:
        r = r.withColumn("priority", F.expr(f"array_position({prov}, provider)"))
    pubs = publications.select(row_id, key, F.col("title").alias("_in_title"), F.col("pmcid").alias("_in_pmcid"),
                               *([] if key == "url" else ["url"]))
    j = r.filter(F.col("status") == 200).join(pubs, key)
    # staged columns: every JSON value is parsed / extracted exactly once
    j = j.withColumn("_c0", F.expr("variant_get(try_parse_json(body), '$.choices[0]')"))
    j = j.withColumn("_content", F.expr(reply_content_sql("_c0")))
    j = j.withColumn("_s", F.expr(f"regexp_replace(_content, {sql_str(_STRIP_RE)}, '')"))
    j = j.withColumn("_v", F.expr(reply_json_sql("_s")))
    # validity is folded into the ordering key (NULL = not eligible) instead of
    # a row filter, so no predicate is pushed below the parsing projections
    j = j.withColumn("_obj", F.expr("_v IS NOT NULL AND schema_of_variant(_v) LIKE 'OBJECT<%' "
                                    "AND schema_of_variant(_v) <> 'OBJECT<>'"))
    keys = ["title", "abstract", "journal", "doi", "confidence_score", "publication_date"]
    j = j.withColumns({f"_f_{k}": F.expr(f"variant_get(_v, '$.{k}')") for k in keys})
    j = j.withColumns({f"_f_{k}_arr": F.expr(f"try_variant_get(_v, '$.{k}', 'array<variant>')")
                       for k in ["authors"] + REPLY_LIST_FIELDS})
    cols = reply_article_columns("_v", "_in_title", "url", "_in_pmcid", "provider")
    j = j.select(row_id, F.col(key).alias("_join"), "priority", "_obj", *[F.expr(e).alias("_a_" + n) for n, e in cols.items()])
    j = j.withColumn("priority", F.expr("CASE WHEN _obj AND _a__ok THEN priority END"))
    defaults = {"affiliations": "array()", "mesh_terms": "array()", "full_text": "NULL", "pmid": "NULL",
                "quality_score": "0.0D", "extraction_timestamp": "current_timestamp()"}
    fields = []
    for f in ARTICLE_FIELDS:
        e = ident("_a_" + f) if f in cols else defaults.get(f, "NULL")
        fields.append(F.expr(f"CAST({e} AS {ARTICLE_SCHEMA[f].dataType.simpleString()})").alias(f))
    art = j.select(F.col(row_id).alias("_key"), "_join", "priority", *fields)
    art = art.withColumn("quality_score", F.expr(quality_score_sql("llm")))
    # the join key is a group key too, so the rows stay where the join's shuffle put them
    won = art.groupBy("_join", F.col("_key").alias(row_id)).agg(
        F.min_by(F.struct(*[F.col(f) for f in ARTICLE_FIELDS]), F.col("priority")).alias("llm"),
        F.min("priority").alias("_best"))
    return won.filter(F.col("_best").isNotNull()).drop("_best", "_join")
