"""Dictionary and pattern entity extraction as Column expressions.

Dictionary hits are *substring* tests on lower-cased text (so "rat"
matches inside "generation"); each dictionary is a constant, so the
test compiles to a fixed list of ``contains`` calls inside generated
code - no join, no Python.  Pattern matches use Java regexes with
``(?U)`` so ``\\b``, ``\\d`` and ``\\s`` follow Unicode like Python's ``re``.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab
from .text import col, ident, sql_str


def term_hits_sql(text_lower_sql: str, terms, lower_terms: bool = True) -> str:
    """SQL: terms (as spelled) whose (lower-cased) form occurs in the text."""
    cases = ", ".join(
        f"CASE WHEN contains({text_lower_sql}, {sql_str(t.lower() if lower_terms else t)}) THEN {sql_str(t)} END"
        for t in terms)
    return f"array_compact(array({cases}))"


def term_hits(text_lower, terms, lower_terms: bool = True) -> Column:
    """Terms (as spelled) whose (lower-cased) form occurs in ``text_lower``.

    ``text_lower`` is a column name (lower-cased text expected) or Column.
    ``lower_terms=False`` compares each term unlowered, which is the rule
    of the basic keyword list.
    """
    if isinstance(text_lower, str):
        return F.expr(term_hits_sql(ident(text_lower), terms, lower_terms))
    t = text_lower
    hits = [F.when(t.contains(term.lower() if lower_terms else term), F.lit(term)) for term in terms]
    return F.array_compact(F.array(*hits))


def _basic(text, lowered, terms, lower_terms) -> Column:
    if lowered is not None:
        return term_hits(lowered, terms, lower_terms)
    if isinstance(text, str):
        return F.expr(term_hits_sql(f"lower({ident(text)})", terms, lower_terms))
    return term_hits(F.lower(text), terms, lower_terms)


def basic_organisms(text, lowered=None) -> Column:
    return _basic(text, lowered, vocab.BASIC_ORGANISMS, True)


def basic_keywords(text, lowered=None) -> Column:
    return _basic(text, lowered, vocab.BASIC_KEYWORDS, False)


def basic_conditions(text, lowered=None) -> Column:
    return _basic(text, lowered, vocab.BASIC_CONDITIONS, False)


def _java(pattern: str) -> Column:
    return F.lit("(?U)" + pattern)


def regex_matches(text, pattern: str, limit: int | None = None) -> Column:
    """All non-overlapping matches (group 0) in order; with ``limit`` the first ones."""
    m = F.regexp_extract_all(col(text), _java(pattern), F.lit(0))
    m = F.coalesce(m, F.array().cast("array<string>"))
    return F.slice(m, 1, limit) if limit else m


def gene_symbols(text, limit: int | None = None) -> Column:
    return regex_matches(text, vocab.GENE_PATTERN, limit)


def protein_names(text, limit: int | None = None) -> Column:
    return regex_matches(text, vocab.PROTEIN_PATTERN, limit)


def measurements(text, limit: int | None = None) -> Column:
    return regex_matches(text, vocab.MEASUREMENT_PATTERN, limit)


def time_periods(text) -> Column:
    return regex_matches(text, vocab.TIME_PERIOD_PATTERN)


def gazetteer(profile: str = "main") -> dict[str, list[str]]:
    if profile == "main":
        return vocab.MAIN_GAZETTEER
    if profile == "strict":
        return vocab.STRICT_GAZETTEER
    raise ValueError(f"unknown profile {profile!r}")


def extract_entities(text, profile: str = "main", gazetteer_terms: dict[str, list[str]] | None = None,
                     limits: dict[str, int] | None = None) -> Column:
    """Every entity family found in ``text`` as one struct.

    main   : organisms, conditions (= space conditions + biological
             systems), experiments, genes, proteins, measurements
    strict : organisms, experiments, genes, proteins, measurements
             (= dictionary measurements then pattern measurements), plus
             space_conditions / biological_systems as extra fields that
             are not article fields.
    Lists keep discovery order and may hold repeats; callers dedup.
    ``limits`` (e.g. ``vocab.ENTITY_LIMITS``) keeps only the first pattern
    matches of a family; by default all are kept.
    """
    g = gazetteer_terms or gazetteer(profile)
    lower_sql = f"lower({ident(text)})" if isinstance(text, str) else None
    text = col(text)
    lower = F.lower(text)

    def hits(cat):
        if lower_sql is not None:
            return F.expr(term_hits_sql(lower_sql, g.get(cat, []), lower_terms=False))
        return term_hits(lower, g.get(cat, []), lower_terms=False)

    cut = limits or {}
    genes, proteins, meas = (gene_symbols(text, cut.get("genes")), protein_names(text, cut.get("proteins")),
                             measurements(text, cut.get("measurements")))
    if profile == "main":
        return F.struct(
            hits("organisms").alias("organisms"),
            F.concat(hits("space_conditions"), hits("biological_systems")).alias("conditions"),
            hits("experiments").alias("experiments"),
            genes.alias("genes"),
            proteins.alias("proteins"),
            meas.alias("measurements"),
        )
    return F.struct(
        hits("organisms").alias("organisms"),
        hits("experiments").alias("experiments"),
        genes.alias("genes"),
        proteins.alias("proteins"),
        F.concat(hits("measurements"), meas).alias("measurements"),
        hits("space_conditions").alias("space_conditions"),
        hits("biological_systems").alias("biological_systems"),
    )
