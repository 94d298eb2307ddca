"""Persisted duplicate registry in buckets.

What earlier batches kept is filed once:

* ``keys``: identifier values and lower titles, in folders by hash bucket;
* ``titles``: lower titles, in folders by length.

A batch computes the buckets that its own keys fall into and the lengths that
its titles can match (bounded lists) and reads only those folders; the titles
there are compared with its own block against block (``title_blocks``).  Each batch adds a folder of
its own, which a repeated batch overwrites, so a replay changes nothing; a
batch sees only batches before it.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import article_id
from ..session import cut_lineage, materialise
from . import segments
from .dedup import row_keys, seen_registry

SCHEMAS = {
    "keys": "key string, article_id string, bucket int, batch_id long",
    "titles": "t string, bucket int, batch_id long",
}


class SeenIndex:
    """``threshold`` and ``buckets`` belong to the index: keep them for its lifetime."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256, threshold: int = vocab.TITLE_SIMILARITY_THRESHOLD):
        self.spark, self.path, self.buckets, self.threshold = spark, path.rstrip("/"), buckets, threshold

    def _bucket(self, c) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(self.buckets)).cast("int")

    def read(self, name: str, before: int, wanted: list[int] | None = None) -> DataFrame | None:
        """Rows of earlier batches in the ``wanted`` buckets; a folder that does not exist yet counts as none."""
        try:
            df = self.spark.read.schema(SCHEMAS[name]).option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        df = df.where(F.col("batch_id") < before)
        return df if wanted is None else df.where(F.col("bucket").isin(wanted))

    def _wanted(self, buckets: DataFrame) -> list[int]:
        """The buckets that occur: at most ``self.buckets`` numbers, or the lengths of titles."""
        return sorted(r[0] for r in buckets.distinct().collect())

    def add(self, kept: DataFrame, batch_id: int, title: str = "title") -> None:
        """File what a batch kept (an article table)."""
        kept = kept if "article_id" in kept.columns else kept.withColumn("article_id", article_id())
        reg = cut_lineage(seen_registry(kept, title=title).withColumn("key", F.concat(
            F.when(F.col("key_kind") == "id", "id:").otherwise("t:"), "key")).select("key", "article_id"))
        titles = reg.where("startswith(key, 't:')").select(F.expr("substring(key, 3)").alias("t")).distinct()
        tables = {"keys": reg.withColumn("bucket", self._bucket("key")), "titles": titles.withColumn("bucket", F.length("t"))}
        for name, df in tables.items():
            # many titles may have one length
            spread = ["bucket"] if name == "keys" else ["bucket", F.pmod(F.xxhash64("t"), F.lit(16))]
            df.repartition(*spread).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}/batch_id={batch_id}")

    def drop(self, df: DataFrame, before: int, order: str = "pos", title: str = "title") -> DataFrame:
        """The rows of ``df`` that match nothing filed before batch ``before``."""
        df = materialise(df)
        own = row_keys(df, order, title).withColumn("bucket", self._bucket("key"))
        keys = self.read("keys", before, self._wanted(own.select("bucket")))
        if keys is None:
            return df
        same = own.join(keys.select("key", "bucket").distinct(), ["bucket", "key"], "left_semi").select(F.col("pos").alias(order)).distinct()
        rest = df.join(same, order, "left_anti")
        lower = F.lower(F.coalesce(F.col(title), F.lit("")))
        titles = cut_lineage(rest.select(lower.alias("t")).distinct())
        lengths = titles.select(F.length("t").alias("n")).distinct().select(F.explode(segments.lengths_in_reach(self.threshold)))
        known = self.read("titles", before, self._wanted(lengths))
        if known is None:
            raise ValueError(f"the index at {self.path} has keys but no titles: file its batches anew")
        known = cut_lineage(known.select("t").distinct())
        near = segments.cross_pairs(titles, known, self.threshold).select(F.col("a").alias("_t")).distinct()
        return rest.join(near, lower == F.col("_t"), "left_anti")
