"""Run reports (A1-A7, L1, L3): single-pass aggregates over the article table."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import py_strip, truthy

ENTITY_LISTS = [("Authors", "authors"), ("Keywords", "keywords"), ("MeshTerms", "mesh_terms"),
                ("Organisms", "organisms"), ("Genes", "genes"), ("Proteins", "proteins"),
                ("Conditions", "conditions"), ("Experiments", "experiments"), ("Measurements", "measurements")]


def count_by_source(df: DataFrame) -> DataFrame:
    """A1: articles per extraction source."""
    return df.groupBy("extraction_source").agg(F.count("*").alias("n"))


def article_metrics(threshold: float = 0.2, required=("title", "url"), n_entities=("organisms", "genes")) -> list:
    """A2 + A3 + A5 as aggregate Columns over articles: total, llm_extracted, avg_llm_confidence, avg_quality,
    passed (valid by the main rule with score >= threshold) and pass_rate, completeness (share of rows whose
    ``required`` fields are set), entities (items of the ``n_entities`` lists), organisms_per_article."""
    valid = truthy("title") & (F.length(py_strip("title")) >= 5) & truthy("url") \
        & (F.col("quality_score") >= threshold)
    as_d = lambda c: F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))
    complete = F.lit(True)
    for c in required:
        complete = complete & truthy(c)
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if("llm_extracted").alias("llm_extracted"),
        F.round(F.avg(F.when(F.col("llm_extracted"), F.col("llm_confidence_score"))), 9).alias("avg_llm_confidence"),
        F.round(F.avg("quality_score"), 9).alias("avg_quality"),
        F.count_if(valid).alias("passed"),
        F.round(F.avg(as_d(valid)), 9).alias("pass_rate"),
        F.round(F.avg(as_d(complete)), 9).alias("completeness"),
        F.coalesce(F.sum(sum((F.coalesce(F.size(c), F.lit(0)) for c in n_entities), F.lit(0)).cast("long")), F.lit(0)).alias("entities"),
        F.round(F.avg(F.coalesce(F.size("organisms"), F.lit(0)).cast("double")), 9).alias("organisms_per_article"),
    ]


def _with_shares(out: DataFrame) -> DataFrame:
    share = lambda a, b: F.when(b > 0, F.round(a / b, 9))
    if "publications" in out.columns:
        out = out.withColumn("failed", F.col("publications") - F.col("total")) \
            .withColumn("coverage", share(F.col("total"), F.col("publications")))
    if "kept" in out.columns:
        out = out.withColumn("duplicate_rate", share(F.col("total") - F.col("kept"), F.col("total")))
    return out


def run_metrics(df: DataFrame, threshold: float = 0.2, publications: DataFrame | None = None,
                kept: DataFrame | None = None, required=("title", "url"), n_entities=("organisms", "genes")) -> DataFrame:
    """A2 + A3 + A5 + A6: one row, the columns of :func:`article_metrics` over ``df``.

    With ``publications`` (the input list): publications, failed (without a
    row) and coverage.  With ``kept`` (after deduplication): kept and duplicate_rate.
    """
    out = df.agg(*article_metrics(threshold, required, n_entities))
    if publications is not None:
        out = out.unionByName(publications.agg(F.count("*").alias("publications")), allowMissingColumns=True)
    if kept is not None:
        out = out.unionByName(kept.agg(F.count("*").alias("kept")), allowMissingColumns=True)
    # each column is set in one of these rows
    return _with_shares(out.agg(*[F.max(c).alias(c) for c in out.columns]))


class Watched:
    """Metrics taken while a run writes its tables, so that a report needs no second run of the plan.

    ``watch(df, name, *metrics)`` returns ``df`` with the metrics attached; they are filled by the first
    action that reads all of it.  ``report(...)`` gives them as one row, with the shares of A5 and A6."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}
        self._types: dict[str, list] = {}

    def watch(self, df: DataFrame, name: str, *metrics) -> DataFrame:
        self._seen[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        self._types[name] = df.agg(*metrics).schema.fields
        return df.observe(self._seen[name], *metrics)

    def count(self, df: DataFrame, name: str) -> DataFrame:
        return self.watch(df, name, F.count(F.lit(1)).alias(name))

    def report(self, spark: SparkSession) -> DataFrame:
        fields = [f for fs in self._types.values() for f in fs]
        values = {k: v for o in self._seen.values() for k, v in o.get.items()}
        return _with_shares(spark.createDataFrame([tuple(values[f.name] for f in fields)], StructType(fields)))


def entity_counts(df: DataFrame) -> DataFrame:
    """A4: number of items per list-valued graph entity type plus a total
    (one pass: per-row sizes unpivoted, then ``rollup``)."""
    present = [(n, c) for n, c in ENTITY_LISTS if c in df.columns]
    sizes = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("entity_type"), F.coalesce(F.size(c), F.lit(0)).cast("long").alias("k"))
        for n, c in present])).alias("e")).select("e.*")
    out = sizes.rollup("entity_type").agg(F.sum("k").alias("n"))
    return out.select(F.coalesce("entity_type", F.lit("total")).alias("entity_type"), "n")


def sample_record(df: DataFrame, order: str = "pos") -> DataFrame:
    """L3: the first output record, title cut at 80 characters."""
    return df.orderBy(order).limit(1).select(
        F.substring("title", 1, 80).alias("title"), "extraction_source", "llm_extracted",
        "llm_confidence_score", "quality_score", "organisms", "keywords", "conditions")
