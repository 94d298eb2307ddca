"""Publication lists (S1) and the publications a fetched page table implies."""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import pmcid_from_url, py_strip, truthy

# FIXED VALUES: strings pandas.read_csv reads as missing by default
PANDAS_NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

CSV_SCHEMA = T.StructType([T.StructField("Title", T.StringType()), T.StructField("Link", T.StringType())])

#: What a piece of a split is: a whole record, the end of a record begun before, a begun one, or neither end.
WHOLE, END, BEGUN, MIDDLE = "whole", "end", "begun", "middle"


def _split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, id, line): the lines of the files, split by byte ranges; ``at`` is the range's start and ``id``
    grows within a range."""
    raw = spark.read.option("lineSep", "\n").text(path).select("value", "_metadata")
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                      F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, place, record): the records of CSV files whose quoted fields may hold line breaks, read in
    parallel byte ranges.

    A line break ends a record where the quotes before it in the file are even.  So the quotes of each range
    are counted first (a number a range); their running parity tells how each range begins, and each is cut
    into records on its own.  Only a record that crosses ranges is put together afterwards, from a few pieces.
    ``place`` counts the records that begin in a range, blank ones left out.
    """
    lines = _split_lines(spark, path)
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    ranges = lines.groupBy("file", "at").agg((F.sum(quotes) % 2).alias("odd"))
    before = F.sum("odd").over(Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    # a row a range of a file: fewer than bytes / range size
    starts = ranges.select("file", "at", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"))

    def cut(batches):
        current, inside, place, held, kind = None, False, 0, [], WHOLE

        def out(pieces):
            names = ["file", "at", "place", "kind", "record"]
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pieces], t) for i, t in enumerate(types)], names=names)

        def close(pieces):  # what is open where a range ends
            if held:
                pieces.append((*current, place, BEGUN if kind == WHOLE else MIDDLE, "\n".join(held)))
                held.clear()

        for b in batches:
            pieces = []
            for file, at, line, odd in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if (file, at) != current:
                    close(pieces)
                    current, inside, place, kind = (file, at), odd, 0, END if odd else WHOLE
                held.append(line)
                if line.count('"') % 2:
                    inside = not inside
                if not inside:
                    pieces.append((file, at, place, kind, "\n".join(held)))
                    place += kind == WHOLE
                    held.clear()
                    kind = WHOLE
            yield out(pieces)
        pieces = []
        if current:
            close(pieces)
        yield out(pieces)

    ordered = lines.join(F.broadcast(starts), ["file", "at"]).select("file", "at", "line", "inside")
    pieces = ordered.mapInArrow(cut, "file string, at long, place long, kind string, record string")
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "at", "place", "record")
    # at most two pieces a range: a record begins with a ``begun`` one
    torn = pieces.where(F.col("kind") != WHOLE)
    number = F.sum((F.col("kind") == BEGUN).cast("int")).over(Window.partitionBy("file").orderBy("at", F.col("kind") == BEGUN))
    joined = torn.withColumn("number", number).groupBy("file", "number").agg(
        F.min("at").alias("at"), F.max_by("place", F.col("kind") == BEGUN).alias("place"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "record"))), lambda x: x["record"]), "\n").alias("record"))
    return whole.unionByName(joined.select("file", "at", "place", "record"))


def read_publications(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Publication CSV (header ``Title,Link``) -> title, url, pmcid, pos.

    Rows with a missing / empty title or link are dropped, both are
    stripped, and rows blank after the strip are dropped.  ``pos`` keeps
    the input order (path of the file, then place in it; dense over all rows
    read).  Files are read in byte ranges, also with ``multi_line`` (quoted
    line breaks).
    """
    if multi_line:
        columns = spark.read.option("header", True).option("escape", '"').csv(path).columns
        rows = csv_records(spark, path).where(F.trim(F.regexp_replace("record", "\r", "")) != "")
        fields = F.from_csv(F.regexp_replace("record", "\r$", ""), ", ".join(f"`{c}` string" for c in columns), {"escape": '"', "multiLine": "true"})
        rows = rows.select("file", "at", "place", fields.alias("r"), "record")
        first = F.row_number().over(Window.partitionBy("file").orderBy("place"))
        head = rows.where("at = 0").select("file", "place").withColumn("k", first).where("k = 1").select("file", F.lit(0).cast("long").alias("at"), "place")
        rows = rows.join(F.broadcast(head), ["file", "at", "place"], "left_anti")  # a row a file
        raw = rows.select("file", "at", "place", "r.*")
    else:
        raw = (spark.read.option("header", True).option("escape", '"').csv(path).select("*", "_metadata"))
        raw = raw.withColumn("file", F.col("_metadata.file_path")).withColumn("at", F.col("_metadata.file_block_start")) \
            .withColumn("place", F.monotonically_increasing_id()).drop("_metadata")
    for c in ("Title", "Link"):
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    raw = raw.select("Title", "Link", "file", "at", "place")
    # Rows of a range are put in order by their place; ranges by path and offset, a row a range.
    ranges = raw.groupBy("file", "at").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(Window.orderBy("file", "at").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select("file", "at", "first", F.coalesce(before, F.lit(0)).alias("before"))
    raw = raw.join(F.broadcast(ranges), ["file", "at"])
    if multi_line:
        rank = F.row_number().over(Window.partitionBy("file", "at").orderBy("place")) - 1
    else:
        rank = F.col("place") - F.col("first")
    raw = raw.select("Title", "Link", (F.col("before") + rank).cast("long").alias("pos"))
    return from_rows(raw, "Title", "Link")


def from_rows(df: DataFrame, title_col: str, link_col: str) -> DataFrame:
    t, l = F.col(title_col), F.col(link_col)
    missing = lambda c: c.isNull() | c.isin(*PANDAS_NA_VALUES)
    out = df.filter(~missing(t) & ~missing(l))
    keep = [c for c in df.columns if c not in (title_col, link_col)]
    out = out.select(*keep, py_strip(t).alias("title"), py_strip(l).alias("url"), pmcid_from_url(l).alias("pmcid"))
    return out.filter(truthy("title") & truthy("url"))


def limit_publications(df: DataFrame, n: int = 5, order_col: str = "pos") -> DataFrame:
    """L1: first ``n`` publications in input order (the sampling feature)."""
    return df.orderBy(order_col).limit(n)
