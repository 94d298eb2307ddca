"""Scalar string helpers (Column -> Column), all JVM-side.

Python truthiness is the null rule of the source data model: ``None``,
``""`` and ``[]`` all count as absent.  These helpers encode that rule
once so every operator uses the same definition.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab

# Characters Python's str.strip()/isspace() treat as whitespace: Unicode
# White_Space plus the four ASCII separators U+001C..U+001F.
PY_WS_CLASS = r"[\s\x{1c}-\x{1f}]"
_STRIP_RE = r"(?U)^" + PY_WS_CLASS + r"+|" + PY_WS_CLASS + r"+$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_str(s: str) -> str:
    """Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def truthy_sql(x: str) -> str:
    return f"({x} IS NOT NULL AND length({x}) > 0)"


def non_empty_sql(x: str) -> str:
    return f"(coalesce(size({x}), 0) > 0)"


def once(c) -> Column:
    """``c``, computed where it stands: marked as not deterministic (its test always holds), so the optimizer neither
    repeats it in every column that uses it nor moves a filter on such a column below it."""
    return F.when(F.monotonically_increasing_id() >= 0, col(c))


def py_strip(c) -> Column:
    """``str.strip()`` with Python's (Unicode) whitespace set."""
    return F.regexp_replace(col(c), _STRIP_RE, "")


def truthy(c) -> Column:
    """Non-null, non-empty string."""
    c = col(c)
    return c.isNotNull() & (F.length(c) > 0)


def non_empty(c) -> Column:
    """Non-null array with at least one element."""
    return F.coalesce(F.size(col(c)), F.lit(0)) > 0


def blank(c) -> Column:
    """Null, or only whitespace."""
    return F.coalesce(F.length(py_strip(c)) == 0, F.lit(True))


def or_empty_array(c) -> Column:
    return F.coalesce(col(c), F.array().cast("array<string>"))


def pmcid_from_url(url) -> Column:
    """``PMC<digits>`` when the url contains ``pmc/articles/PMC``.

    The first ``PMC\\d+`` anywhere in the url wins (case-sensitive).
    """
    url = col(url)
    hit = F.regexp_extract(url, r"(?U)PMC(\d+)", 1)
    return F.when(
        url.contains("pmc/articles/PMC") & (F.length(hit) > 0),
        F.concat(F.lit("PMC"), hit),
    )


def article_id(doi="doi", pmcid="pmcid", pmid="pmid", title="title") -> Column:
    """Stable article URI: doi, else pmcid, else pmid, else md5(title)."""
    doi, pmcid, pmid, title = col(doi), col(pmcid), col(pmid), col(title)
    return (
        F.when(truthy(doi), F.concat(F.lit(vocab.ARTICLE_URI + "doi:"), F.replace(doi, F.lit("/"), F.lit("_"))))
        .when(truthy(pmcid), F.concat(F.lit(vocab.ARTICLE_URI), pmcid))
        .when(truthy(pmid), F.concat(F.lit(vocab.ARTICLE_URI + "pmid:"), pmid))
        .otherwise(F.concat(F.lit(vocab.ARTICLE_URI), F.md5(F.coalesce(title, F.lit("")))))
    )


def is_valid_url(url) -> Column:
    """``urlparse`` has both a scheme and a netloc."""
    u = F.regexp_replace(col(url), r"[\t\r\n]", "")
    return F.coalesce(u.rlike(r"^[\x00-\x20]*[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]"), F.lit(False))


def is_space_relevant(title) -> Column:
    """Lower-cased title contains one of the relevance terms (as spelled)."""
    t = F.lower(col(title))
    out = F.lit(False)
    for term in vocab.SPACE_RELEVANCE_TERMS:
        out = out | t.contains(term)
    return F.coalesce(out, F.lit(False))


def sorted_join(arr, sep: str = "|") -> Column:
    """Deterministic string form of a string array (sorted, joined)."""
    return F.array_join(F.sort_array(or_empty_array(arr)), sep)
