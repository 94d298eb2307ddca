"""Line dedup by site-relative frequency (operator 10).

Per host, the pages that hold a line are divided by the host's pages.  A line held by more than
``max_ratio`` of them, and by ``min_pages`` pages at least, is boilerplate there and is dropped from
every page of the host.  Lines are compared without blanks at their ends; blank lines stay.

DataFrame functions throughout.  Each page names a line once, so counts are combined before the
shuffle and a line on every page is no hot key.  A host has at most (lines per page) / max_ratio
boilerplate lines; they are joined to the pages' line hashes, and only pages that hold one are
gathered by page.

A null text or host: a null text has no lines and stays null, null hosts are one host.  Rows with the
same page id count as pages of their own and lose the same lines.  An empty table gives an empty result;
columns of any name are carried.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BREAK = "\n"
BLANKS = " \t\r\x0b\x0c"


def _lines(text):
    return F.split(text, BREAK, -1)


def _mark(line):
    return F.xxhash64(F.trim(line, F.lit(BLANKS)))


def _marks(text):
    """Distinct hashes of a text's lines that are not blank."""
    return F.array_distinct(F.transform(F.filter(_lines(text), lambda x: F.trim(x, F.lit(BLANKS)) != ""), _mark))


def boilerplate(pages: DataFrame, host, text_col: str = "text", max_ratio: float = 0.02, min_pages: int = 5) -> DataFrame:
    """(host, line hash) of the lines that are boilerplate on their host."""
    shown = pages.select(host.alias("h"), _marks(F.col(text_col)).alias("lines"))
    total = shown.groupBy("h").agg(F.count("*").alias("pages"))
    held = shown.select("h", F.explode("lines").alias("line")).groupBy("h", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    return (held.join(total, held["h"].eqNullSafe(total["h"])).where(F.col("n") > max_ratio * F.col("pages"))
            .select(held["h"].alias("bh"), F.col("line").alias("bline")))


def drop_boilerplate(pages: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text",
                     max_ratio: float = 0.02, min_pages: int = 5) -> DataFrame:
    """(row, dropped): each page's whole row, packed so that columns of any name are carried, and the hashes
    of the lines that its text loses (null: none); :func:`kept_text` applies them."""
    host = F.coalesce(F.col(host_col).cast("string"), F.lit("\x00null"))
    lines = boilerplate(pages, host, text_col, max_ratio, min_pages)
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns])
    page = F.struct(F.col(id_col))
    held = pages.select(page.alias("page"), host.alias("h"), F.explode(_marks(F.col(text_col))).alias("line"))
    found = (held.join(lines, (F.col("h") == F.col("bh")) & (F.col("line") == F.col("bline")))
             .groupBy(F.col("page").alias("fpage"), F.col("h").alias("fh")).agg(F.collect_set("line").alias("dropped")))
    keyed = pages.select(row.alias("row"), page.alias("page"), host.alias("h"))
    return keyed.join(found, (F.col("page") == F.col("fpage")) & (F.col("h") == F.col("fh")), "left").select("row", "dropped")


def kept_lines(text, dropped):
    """The lines that stay; a null ``dropped`` drops nothing."""
    return F.filter(_lines(text), lambda x: (F.trim(x, F.lit(BLANKS)) == "") | ~F.coalesce(F.array_contains(dropped, _mark(x)), F.lit(False)))


def kept_text(text, dropped):
    return F.when(dropped.isNull(), text).otherwise(F.array_join(kept_lines(text, dropped), BREAK))


def line_dedup(pages: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text",
               max_ratio: float = 0.02, min_pages: int = 5) -> DataFrame:
    """One row per page: doc_id, lines, dropped lines and the hash of the text that stays."""
    marked = drop_boilerplate(pages.select(id_col, host_col, text_col), id_col, host_col, text_col, max_ratio, min_pages)
    text, dropped = F.col("row")[text_col], F.col("dropped")
    n_lines = F.coalesce(F.size(_lines(text)), F.lit(0))
    n_lines = F.when(text.isNull(), 0).otherwise(n_lines)
    n_kept = F.when(dropped.isNull() | text.isNull(), n_lines).otherwise(F.size(kept_lines(text, dropped)))
    return marked.select(F.col("row")[id_col].cast("long").alias("doc_id"), n_lines.cast("long").alias("n_lines"), (n_lines - n_kept).cast("long").alias("n_dropped"),
                         F.sha2(F.encode(F.coalesce(kept_text(text, dropped), F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def remove_boilerplate(pages: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text",
                       max_ratio: float = 0.02, min_pages: int = 5) -> DataFrame:
    """``pages`` with the same columns, its texts without boilerplate lines."""
    marked = drop_boilerplate(pages, id_col, host_col, text_col, max_ratio, min_pages)
    return marked.select(*[(kept_text(F.col("row")[c], F.col("dropped")) if c == text_col else F.col("row")[c]).alias(c) for c in pages.columns])
