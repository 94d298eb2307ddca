"""Incremental triple store (A8, K5): a graph that grows by batches.

Triples lie in folders by batch and hash bucket of the subject.  A batch reads
only the buckets that its own subjects fall into, keeps what is not there yet,
and writes that, with the in- and out-degrees it adds, to folders of its own,
which a repeated batch overwrites.  Degrees are sums, so those of the whole
graph are the sums over the batches; nothing that was written is written again.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab
from .graph import merge_triples

TRIPLES = "s string, p string, o string, o_kind string, bucket int, batch_id long"
DEGREES = "uri string, in_degree long, out_degree long, batch_id long"
_FIELDS = ("s", "p", "o", "o_kind")


class TripleStore:
    """``buckets`` belongs to the store: keep it for its lifetime."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _read(self, name: str, schema: str, before: int | None) -> DataFrame | None:
        try:
            df = self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return df if before is None else df.where(F.col("batch_id") < before)

    def add(self, triples: DataFrame, batch_id: int) -> None:
        """Add the triples (s, p, o, o_kind) that no earlier batch holds."""
        new = merge_triples(triples).withColumn("bucket", F.pmod(F.xxhash64("s"), F.lit(self.buckets)).cast("int"))
        old = self._read("triples", TRIPLES, batch_id)
        if old is not None:
            hit = sorted(r[0] for r in new.select("bucket").distinct().collect())  # ``buckets`` numbers at most
            same = [new["bucket"] == old["bucket"]] + [new[c].eqNullSafe(old[c]) for c in _FIELDS]
            new = new.join(old.where(F.col("bucket").isin(hit)), same, "left_anti")
        out = f"{self.path}/triples/batch_id={batch_id}"
        new.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(out)
        added = self.spark.read.schema("s string, p string, o string, o_kind string, bucket int").parquet(out)
        edges = added.where((F.col("o_kind") == "uri") & (F.col("p") != vocab.RDF_TYPE))
        # an edge counts for both its ends, combined before the shuffle
        ends = edges.select(F.explode(F.array(
            F.struct(F.col("o").alias("uri"), F.lit(1).alias("i"), F.lit(0).alias("o")),
            F.struct(F.col("s").alias("uri"), F.lit(0).alias("i"), F.lit(1).alias("o")))).alias("x")).select("x.*")
        ends.groupBy("uri").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree")) \
            .write.mode("overwrite").parquet(f"{self.path}/degrees/batch_id={batch_id}")

    def triples(self) -> DataFrame:
        """The graph: a triple is in one batch only."""
        df = self._read("triples", TRIPLES, None)
        return self.spark.createDataFrame([], TRIPLES).select(*_FIELDS) if df is None else df.select(*_FIELDS)

    def degrees(self) -> DataFrame:
        """(uri, in_degree, out_degree) of every node with an edge."""
        df = self._read("degrees", DEGREES, None)
        df = self.spark.createDataFrame([], DEGREES) if df is None else df
        return df.groupBy("uri").agg(F.sum("in_degree").alias("in_degree"), F.sum("out_degree").alias("out_degree"))
