"""Spark session defaults and the shared checkpoint folder."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # pages can be large: keep Arrow batches to the UDFs small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
    # local mode runs everything in the driver JVM
    "spark.driver.memory": "16g",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "lumenkg",
                  extra: dict | None = None) -> SparkSession:
    """A session with the defaults above.  Without ``master`` and
    ``shuffle_partitions`` both are left to the cluster."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when nothing is configured (local tests) a private folder is
    created and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="lumenkg-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: what follows reads only the columns
    it needs, and never runs the plan before it again."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


#: Session setting: partitions that tables are dealt to after the scan.  Unset
#: (the default) they stay as scanned; set it where tables are a few files.
INPUT_PARTITIONS = "spark.lumenkg.inputPartitions"


def input_partitions(spark: SparkSession) -> int | None:
    n = spark.conf.get(INPUT_PARTITIONS, None)
    return int(n) if n else None
