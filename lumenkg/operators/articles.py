"""The ``articles`` table: canonical schema and defaults."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUTHOR = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("affiliation", T.StringType()),
    T.StructField("orcid", T.StringType()),
])
STR_ARRAY = T.ArrayType(T.StringType())

ARTICLE_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("pmcid", T.StringType()),
    T.StructField("pmid", T.StringType()),
    T.StructField("doi", T.StringType()),
    T.StructField("authors", T.ArrayType(AUTHOR)),
    T.StructField("affiliations", STR_ARRAY),
    T.StructField("journal", T.StringType()),
    T.StructField("publication_date", T.TimestampType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("full_text", T.StringType()),
    T.StructField("keywords", STR_ARRAY),
    T.StructField("mesh_terms", STR_ARRAY),
    T.StructField("organisms", STR_ARRAY),
    T.StructField("genes", STR_ARRAY),
    T.StructField("proteins", STR_ARRAY),
    T.StructField("conditions", STR_ARRAY),
    T.StructField("experiments", STR_ARRAY),
    T.StructField("measurements", STR_ARRAY),
    T.StructField("quality_score", T.DoubleType()),
    T.StructField("extraction_timestamp", T.TimestampType()),
    T.StructField("extraction_source", T.StringType()),
    T.StructField("llm_extracted", T.BooleanType()),
    T.StructField("llm_confidence_score", T.DoubleType()),
])
ARTICLE_FIELDS = [f.name for f in ARTICLE_SCHEMA.fields]
LIST_FIELDS = [f.name for f in ARTICLE_SCHEMA.fields if isinstance(f.dataType, T.ArrayType)]
ENTITY_FIELDS = ["organisms", "genes", "proteins", "conditions", "experiments", "measurements"]


def _default(field: T.StructField, as_of) -> Column:
    if isinstance(field.dataType, T.ArrayType):
        return F.array().cast(field.dataType)
    if field.name == "quality_score" or field.name == "llm_confidence_score":
        return F.lit(0.0)
    if field.name == "llm_extracted":
        return F.lit(False)
    if field.name == "extraction_source":
        return F.lit("web_scraping")
    if field.name == "extraction_timestamp":
        return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return F.lit(None).cast(field.dataType)


def with_article_defaults(df: DataFrame, as_of=None, keep_extra: bool = True) -> DataFrame:
    """Add missing article columns, replace null lists by ``[]`` and fill the
    scalar defaults; other columns (ids, positions) are kept after them."""
    cols = []
    for f in ARTICLE_SCHEMA.fields:
        if f.name in df.columns:
            c = F.col(f.name).cast(f.dataType)
            if isinstance(f.dataType, T.ArrayType) or f.name in (
                    "quality_score", "llm_confidence_score", "llm_extracted",
                    "extraction_timestamp", "extraction_source"):
                c = F.coalesce(c, _default(f, as_of))
        else:
            c = _default(f, as_of)
        cols.append(c.alias(f.name))
    extra = [F.col(c) for c in df.columns if c not in ARTICLE_FIELDS] if keep_extra else []
    return df.select(*cols, *extra)
