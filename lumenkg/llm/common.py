"""Helpers shared by the training-data operators: reading, Arrow batches, lineage cuts, components."""
from __future__ import annotations

import hashlib
import tempfile
import uuid
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a batch that are Python objects at one time.
SLICE = 256
#: Tasks that the links of one node are dealt to.
SPREAD = 8
#: ASCII capitals to small letters, on UTF-8 bytes.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string): a null text is read as an empty one."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """Map Arrow batches with ``fn(batch) -> dict of columns``; batches are cut to SLICE rows, so memory
    does not follow the batch size Spark chose."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                got = fn(batch.slice(at, SLICE))
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The text column as UTF-8 bytes, without decoding."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


class Spans:
    """Which stretches of a text are taken, for many questions about one text: spans are merged once."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for s, e in sorted(spans):
            if self.ends and s <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def touch(self, s: int, e: int) -> bool:
        """Whether a span shares a character with [s, e)."""
        at = bisect_left(self.starts, e) - 1
        return at >= 0 and self.ends[at] > s


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a private one only where it is unset (tests on one machine)."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = tempfile.mkdtemp(prefix="lumenkg-checkpoint-")
        sc.setCheckpointDir(named)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back.

    A lost executor costs only the tasks that read the files again, never the work before them."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spanning_links(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star links (member, smallest member) with the same components as the links (u, v)."""
    nodes, inv = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = inv[: len(u)], inv[len(u):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component of ``links`` (u long, v long).

    Alternating large-star and small-star rounds; each round is a grouped minimum (combined before
    the shuffle) and a join on the node, whose links are spread over SPREAD tasks (and more by the skew
    join), as a root in the end holds all its members.
    Rounds go on until nothing changes; each one's links are written to the shared folder."""
    def summary(e):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    def star(e, larger):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        side = both.where(F.col("v") > F.col("u")) if larger else both.where(F.col("v") < F.col("u"))
        # the links of one node go to SPREAD tasks, each with the node's minimum
        side = side.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SPREAD)).cast("int"))
        each = low.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        out = side.join(each, ["u", "s"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not larger:
            out = out.unionByName(low.where(F.col("m") < F.col("u")).select("u", F.col("m").alias("v")))
        return out.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    edges = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    was = summary(edges)
    while was[0]:
        edges = written(star(star(edges, True), False))
        now = summary(edges)
        if now == was:
            break
        was = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
