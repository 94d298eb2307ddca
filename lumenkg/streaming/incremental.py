"""Incremental runs over arriving publication batches (S8 + J7 + D1, U3).

The source keeps state only through its duplicate registry, so repeated
batch runs are made incremental with Structured Streaming: a file source
watches a folder of publication tables, and every micro-batch goes through
``process`` (cascade -> validation -> enrichment), loses what the persisted
index of earlier batches knows (``SeenIndex``: only the buckets that the batch
hits are read), is deduplicated within itself (keep-first by position), and is
written, like its part of the index, to a folder of its batch id, which a
repeated batch overwrites.  Progress and index live in shared storage, so a
restarted query resumes where it stopped; ``availableNow`` processes what is
there and stops (a batch job with exactly-once bookkeeping).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import article_id
from ..operators.dedup import deduplicate
from ..operators.registry import SeenIndex


def run_incremental(spark: SparkSession, source_dir: str, schema: str, process: Callable[[DataFrame], DataFrame],
                    output_path: str, registry_path: str, checkpoint_path: str, order: str = "pos"):
    """Start (and with availableNow, finish) the incremental pipeline."""
    stream = spark.readStream.schema(schema).parquet(source_dir)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        index = SeenIndex(s, registry_path)
        kept = deduplicate(index.drop(process(batch), batch_id, order), order=order).withColumn("article_id", article_id())
        # A folder per batch, overwritten: a batch that is run again after a failure replaces itself.
        out = f"{output_path}/batch_id={batch_id}"
        kept.write.mode("overwrite").parquet(out)
        index.add(s.read.schema(kept.schema).parquet(out), batch_id)

    return (stream.writeStream.foreachBatch(each_batch)
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True).start())
