"""End-to-end plan over a fetched-pages table.

Each page row is one publication (title from ``<title>``, its url) whose
fetched HTML is already present, so the publication list and the page
text come from the same row: no join, no shuffle before validation.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import pmcid_from_url, py_strip, truthy
from ..session import input_partitions, table_path
from ..sources.html import parse_pages


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    n = input_partitions(spark)
    return df.repartition(n) if n else df


def page_publications(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) -> pos, title, url, pmcid, page_text.

    The S1 rules apply to the (title, url) pair: both stripped and
    non-empty.  ``pos`` (= page_id) is the processing order.
    """
    parsed = parse_pages(pages.select("page_id", "url", "html"))
    return (parsed.select(
        F.col("page_id").alias("pos"),
        py_strip(F.col("page")["title"]).alias("title"),
        py_strip("url").alias("url"),
        pmcid_from_url("url").alias("pmcid"),
        F.col("page")["text"].alias("page_text"),
    ).filter(truthy("title") & truthy("url")))
