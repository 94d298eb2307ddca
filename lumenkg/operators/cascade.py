"""Best record per publication: the fallback cascade.

Every fallback reads an existing table (model replies, BioC API documents,
parsed pages), so the cascade is a set of equi left joins keyed on url /
pmcid followed by a ``coalesce`` of candidate structs in priority order.
Side tables hold one row per publication (row id) before the join (no fan-out).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.entities import basic_conditions, basic_keywords, basic_organisms
from ..functions.quality import quality_score
from ..functions.text import col, ident, once, truthy
from ..session import materialise
from .articles import ARTICLE_FIELDS, ARTICLE_SCHEMA, LIST_FIELDS


def html_fallback_abstract(text, prefix: int | None = None) -> Column:
    """P7 abstract rule for page text: a short text as a whole, else its line
    that names an abstract, else the whole text; with ``prefix`` (opt-in
    ``vocab.HTML_ABSTRACT_PREFIX``) that many characters and "..."."""
    text = col(text)
    lines = F.split(text, "\n")
    hit = F.get(F.filter(lines, lambda ln: F.lower(ln).contains("abstract")
                         & (F.length(ln) > vocab.HTML_ABSTRACT_LINE_MIN)), 0)
    return (F.when(F.length(text) < vocab.HTML_SHORT_TEXT, text)
            .otherwise(F.coalesce(hit, text if prefix is None else F.concat(F.substring(text, 1, prefix), F.lit("...")))))


_DEFAULT_SQL = {"quality_score": "CAST(0.0 AS DOUBLE)", "llm_confidence_score": "CAST(0.0 AS DOUBLE)",
                "llm_extracted": "false"}


def _default_sql(name: str) -> str:
    if name in _DEFAULT_SQL:
        return _DEFAULT_SQL[name]
    if name in LIST_FIELDS:
        return "CAST(array() AS ARRAY<STRING>)" if name != "authors" else "array()"
    return "NULL"


def add_candidate(df: DataFrame, prefix: str, fields: dict[str, Column], profile: str = "main") -> DataFrame:
    """Materialise one candidate article as flat ``<prefix><field>`` columns
    plus its quality score.  Flat columns keep expression trees small (the
    score reads plain column references, not re-inlined structs), and each is
    computed once a row: a filter on the score would else hold all of them."""
    cols = {prefix + k: once(v) for k, v in fields.items()}

    def get(name):
        return ident(prefix + name) if name in fields else _default_sql(name)

    return df.withColumns(cols).withColumn(prefix + "quality_score", quality_score(profile, get=get))


def html_candidate_fields(text_name: str, lowered: str | None = None) -> dict[str, Column]:
    """P7 fields from page text (organisms, keywords, conditions as sets); ``lowered`` names its lower-cased form."""
    text = F.col(text_name)
    return {
        "abstract": html_fallback_abstract(text),
        "organisms": F.sort_array(basic_organisms(text_name, lowered)),
        "keywords": F.sort_array(basic_keywords(text_name, lowered)),
        "conditions": F.sort_array(basic_conditions(text_name, lowered)),
    }


def minimal_candidate_fields(title_name: str, lowered: str | None = None) -> dict[str, Column]:
    """P8 fields from the title; ``lowered`` names its lower-cased form."""
    title = F.col(title_name)
    return {
        "abstract": F.concat(F.lit("Research article: "), F.coalesce(title, F.lit(""))),
        "organisms": F.sort_array(basic_organisms(title_name, lowered)),
        "keywords": F.sort_array(basic_keywords(title_name, lowered)),
    }


def prompt_text(title="title", url="url", text="page_text", content_chars: int | None = None) -> Column:
    """P10: the request text sent to a model for one publication.

    Non-empty parts joined by a blank line; the content is the page text, or
    the title when the text is empty; ``content_chars`` (opt-in
    ``vocab.PROMPT_CONTENT_CHARS``) cuts it.
    """
    title, url, text = col(title), col(url), col(text)
    content = F.when(truthy(text), text).otherwise(title)
    parts = F.array_compact(F.array(
        F.when(truthy(title), F.concat(F.lit("Title: "), title)),
        F.when(truthy(url), F.concat(F.lit("Source URL: "), url)),
        F.when(truthy(content), F.concat(F.lit("Content: "),
                                        content if content_chars is None else F.substring(content, 1, content_chars))),
    ))
    return F.array_join(parts, "\n\n")


def prompt_request(title="title", url="url", text="page_text", content_chars: int | None = None) -> Column:
    """The full prompt (template with the request text substituted)."""
    head, tail = vocab.EXTRACTION_PROMPT.split("{text}")
    return F.concat(F.lit(head), prompt_text(title, url, text, content_chars), F.lit(tail))


def article_cascade(publications: DataFrame, page_text: DataFrame | None = None,
                    llm_articles: DataFrame | None = None, pmc_articles: DataFrame | None = None,
                    test_mode: bool = True, as_of=None, key: str = "url", row_id: str = "pos") -> DataFrame:
    """One article per publication, first available of
    LLM (score > 0.3) -> PMC API -> HTML text -> minimal (test mode only).

    publications : title, url, pmcid, a unique ``row_id`` (+ carried columns)
    page_text    : url, page_text (of several texts of a url the smallest)
    llm_articles : row_id, article struct ``llm`` (J1 output)
    pmc_articles : row_id, article struct ``pmc`` (S3 output)

    One row per publication, also where publications share a url.
    """
    df = publications
    if page_text is not None:
        df = df.join(page_text.groupBy(key).agg(F.min("page_text").alias("page_text")), on=key, how="left")
    elif "page_text" not in df.columns:
        df = df.withColumn("page_text", F.lit(None).cast("string"))
    base = {"title": F.col("title"), "url": F.col("url"), "pmcid": F.col("pmcid")}
    order = []  # (tag, ok-condition, prefix or struct column, source literal)
    if llm_articles is not None:
        df = df.join(llm_articles.select(row_id, "llm"), on=row_id, how="left")
        order.append(("llm", F.col("llm")["quality_score"] > vocab.LLM_MIN_SCORE))
    if pmc_articles is not None:
        df = df.join(pmc_articles.select(row_id, "pmc"), on=row_id, how="left")
        order.append(("pmc", truthy("pmcid") & F.col("pmc").isNotNull()))
    # the texts are lower-cased once, not for every term
    df = df.withColumns({"_low_text": once(F.lower("page_text")), "_low_title": once(F.lower("title"))})
    df = add_candidate(df, "_h_", {**base, **html_candidate_fields("page_text", "_low_text")})
    order.append(("html", truthy("page_text") & (F.col("_h_quality_score") > vocab.FALLBACK_MIN_SCORE)))
    if test_mode:
        df = add_candidate(df, "_m_", {**base, **minimal_candidate_fields("title", "_low_title")})
        order.append(("minimal", F.lit(True)))
    alive = truthy("page_text") | truthy("title")
    pick = None
    for tag, ok in order:
        pick = F.when(alive & ok, F.lit(tag)) if pick is None else pick.when(alive & ok, F.lit(tag))
    df = df.withColumn("_pick", pick).filter(F.col("_pick").isNotNull())
    src_sql = {"html": "'html_fallback'", "minimal": "'minimal_metadata'", "pmc": "'pmc_api_fallback'"}
    ts_sql = "current_timestamp()" if as_of is None else f"CAST('{as_of}' AS TIMESTAMP)"

    present = set(df.columns)

    def field(name):
        branches = []
        for tag, _ in order:
            if tag in ("llm", "pmc"):
                v = src_sql["pmc"] if (name == "extraction_source" and tag == "pmc") else f"{tag}.{ident(name)}"
            else:
                pre = "_h_" if tag == "html" else "_m_"
                if name == "extraction_source":
                    v = src_sql[tag]
                elif name == "extraction_timestamp":
                    v = ts_sql
                else:
                    v = ident(pre + name) if pre + name in present else _default_sql(name)
            branches.append(f"WHEN _pick = '{tag}' THEN {v}")
        dtype = ARTICLE_SCHEMA[name].dataType.simpleString()
        return F.expr(f"CAST(CASE {' '.join(branches)} END AS {dtype})").alias(name)

    carried = [c for c in publications.columns if c not in ARTICLE_FIELDS and c != "page_text"]
    return df.select(*carried, *[field(f) for f in ARTICLE_FIELDS])


def staged_cascade(publications: DataFrame, replies: DataFrame | None = None, bioc: DataFrame | None = None,
                   pages: DataFrame | None = None, test_mode: bool = True, as_of=None, row_id: str = "pos") -> DataFrame:
    """J2 as stages: each one sees only the publications that no earlier stage served.

    ``replies`` (url, provider, status, body), ``bioc`` (pmcid, json, status) and ``pages`` (url, html, status)
    are the raw tables: model replies come first, then API documents of the unserved publications, then the
    pages of what is left, so bodies and pages of served publications are never parsed.  A stage's articles
    are written once; the stages' rows are the result.
    """
    from ..sources.bioc import pmc_articles
    from ..sources.html import parse_pages
    from ..sources.replies import first_valid_reply

    rest, out = publications, None

    def served(stage: DataFrame) -> None:
        nonlocal rest, out
        stage = materialise(stage)
        rest = rest.join(stage.select(row_id), row_id, "left_anti")
        out = stage if out is None else out.unionByName(stage)

    if replies is not None:
        served(article_cascade(rest, llm_articles=first_valid_reply(rest, replies, row_id=row_id), test_mode=False, as_of=as_of, row_id=row_id))
    if bioc is not None:
        served(article_cascade(rest, pmc_articles=pmc_articles(rest, bioc, row_id=row_id), test_mode=False, as_of=as_of, row_id=row_id))
    if pages is not None:
        wanted = pages.join(rest.select("url").distinct(), "url", "left_semi")
        text = parse_pages(wanted, status_col="status" if "status" in pages.columns else None)
        text = text.select("url", F.col("page")["text"].alias("page_text"))
        served(article_cascade(rest, page_text=text, test_mode=False, as_of=as_of, row_id=row_id))
    if test_mode:
        last = article_cascade(rest, as_of=as_of, row_id=row_id)
        out = last if out is None else out.unionByName(last)
    return out
