"""Quality scores (Q1-Q3) and validity predicates.

Scores are sums of double literals added left to right in a fixed
order; ``0.2 + 0.1 > 0.3`` is true in IEEE doubles, so the order is part
of the semantics and must not be rearranged.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab
from .text import ident, is_valid_url, non_empty_sql, py_strip, truthy, truthy_sql


def _w(cond: str, weight: float) -> str:
    return f"(CASE WHEN coalesce({cond}, false) THEN CAST({weight!r} AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)"


def _longer(x: str, n: int) -> str:
    return f"({truthy_sql(x)} AND length({x}) > {n})"


def quality_score_sql(profile: str = "main", get=ident, thresholds: dict[str, int] = vocab.QUALITY_THRESHOLDS) -> str:
    """Quality score as one SQL expression; ``get(field)`` gives the SQL of
    each article field (a column name by default); ``thresholds`` are the
    least lengths of the strict profile."""
    if profile == "main":
        parts = [
            _w(_longer(get("title"), 10), 0.3),
            f"(CASE WHEN {_longer(get('abstract'), 50)} THEN CAST(0.3 AS DOUBLE) "
            f"WHEN {_longer(get('full_text'), 100)} THEN CAST(0.2 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)",
            _w(f"({truthy_sql(get('pmid'))} OR {truthy_sql(get('pmcid'))})", 0.1),
            _w(truthy_sql(get("doi")), 0.1),
            _w(truthy_sql(get("journal")), 0.1),
            _w(non_empty_sql(get("authors")), 0.1),
            _w(f"({non_empty_sql(get('keywords'))} OR {non_empty_sql(get('organisms'))})", 0.1),
            _w(f"({get('llm_extracted')} AND {get('llm_confidence_score')} > 0.7)", 0.1),
        ]
    elif profile == "llm":
        n = " + ".join(f"coalesce(size({get(k)}), 0)" for k in ("keywords", "organisms", "genes", "conditions"))
        parts = [
            _w(_longer(get("title"), 10), 0.2),
            _w(_longer(get("abstract"), 50), 0.3),
            _w(truthy_sql(get("journal")), 0.1),
            _w(truthy_sql(get("doi")), 0.1),
            _w(non_empty_sql(get("authors")), 0.1),
            f"(CASE WHEN ({n}) > 5 THEN CAST(0.15 AS DOUBLE) WHEN ({n}) > 0 THEN CAST(0.1 AS DOUBLE) "
            f"ELSE CAST(0.0 AS DOUBLE) END)",
            _w(f"({get('llm_confidence_score')} > 0.8)", 0.05),
        ]
    elif profile == "strict":
        parts = [
            _w(_longer(get("title"), thresholds["min_title_length"]), 1.0),
            _w(_longer(get("abstract"), thresholds["min_abstract_length"]), 2.0),
            _w(_longer(get("full_text"), thresholds["min_full_text_length"]), 2.0),
            _w(f"({truthy_sql(get('pmid'))} OR {truthy_sql(get('pmcid'))})", 1.0),
            _w(truthy_sql(get("doi")), 1.0),
            _w(truthy_sql(get("journal")), 1.0),
            _w(f"({get('publication_date')} IS NOT NULL)", 0.5),
            _w(non_empty_sql(get("authors")), 1.0),
            _w(f"({non_empty_sql(get('keywords'))} OR {non_empty_sql(get('mesh_terms'))})", 0.5),
        ]
    else:
        raise ValueError(f"unknown profile {profile!r}")
    total = "CAST(0.0 AS DOUBLE)"
    for p in parts:
        total = f"({total} + {p})"
    if profile == "strict":
        total = f"({total} / CAST(10.0 AS DOUBLE))"
    return f"least({total}, CAST(1.0 AS DOUBLE))"


def quality_score(profile: str = "main", get=ident, thresholds: dict[str, int] = vocab.QUALITY_THRESHOLDS) -> Column:
    """Quality score of an ``articles`` row for the given rule set.

    main   - cascade / validation rule
    llm    - score of a model-extracted article
    strict - points out of ten
    Terms are added left to right in the fixed order.
    """
    return F.expr(quality_score_sql(profile, get, thresholds))


def is_valid(profile: str = "main", as_of=None, thresholds: dict[str, int] = vocab.QUALITY_THRESHOLDS,
             required=("title", "url")) -> Column:
    """Minimum validity of an article (F1 main, F2 strict).  ``thresholds`` and
    the ``required`` fields (F8) apply to the strict profile."""
    title_len = F.length(py_strip("title"))
    if profile == "main":
        ok = truthy("title") & (title_len >= 5) & (
            truthy("url") | (F.coalesce(F.col("extraction_source"), F.lit("")) == "test_data"))
    elif profile == "strict":
        as_of = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
        year = F.year("publication_date")
        ok = F.lit(True)
        for c in required:
            ok = ok & truthy(c)
        ok = (
            ok & (title_len >= thresholds["min_title_length"]) & is_valid_url("url")
            & (truthy("abstract") | truthy("full_text"))
            & (F.col("publication_date").isNull() | year.between(F.lit(1950), F.year(as_of)))
        )
    else:
        raise ValueError(f"unknown profile {profile!r}")
    return F.coalesce(ok, F.lit(False))
