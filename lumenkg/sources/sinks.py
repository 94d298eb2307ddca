"""Sinks (S5, S6, S7): standardized records as JSON lines, JSON-LD lines,
N-Triples lines and CSV, written by Spark in parallel (one file per task)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..operators.articles import ARTICLE_FIELDS
from ..operators.graph import standardize, to_json_ld, to_triples
from ..session import materialise

LARGE_COLUMNS = ("full_text",)


def article_json(df: DataFrame) -> Column:
    """One article as a JSON string (nulls kept, ISO timestamps)."""
    fields = [F.col(c) for c in ARTICLE_FIELDS if c in df.columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The four-part standardized records as JSON lines (non-ASCII kept)."""
    fields = [c for c in ARTICLE_FIELDS if c in df.columns]
    standardize(df, fields).write.mode(mode).json(path)


XSD = "http://www.w3.org/2001/XMLSchema#"
#: Literals of these predicates carry a type, the others are strings.
LITERAL_TYPES = {vocab.DCTERMS_NS + "created": "dateTime", vocab.SPACE_NS + "llmExtracted": "boolean",
                 vocab.SPACE_NS + "llmConfidenceScore": "double"}


def _nt_uri(u: Column) -> Column:
    """A URI in brackets; characters that N-Triples does not allow there are percent-encoded."""
    bad = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(f"%{ord(c):02X}").alias("e")) for c in ' <>"{}|^`\\\n\r\t'])
    return F.concat(F.lit("<"), F.aggregate(bad, u, lambda acc, x: F.replace(acc, x["c"], x["e"])), F.lit(">"))


def _nt_term(p: Column, o: Column, kind: Column) -> Column:
    typed = F.coalesce(*[F.when(p == k, F.lit(f"^^<{XSD}{t}>")) for k, t in LITERAL_TYPES.items()], F.lit(""))
    esc = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(o, r"\\", r"\\\\"), '"', r'\\"'),
                                            "\n", r"\\n"), "\r", r"\\r")
    return F.when(kind == "uri", _nt_uri(o)).otherwise(F.concat(F.lit('"'), esc, F.lit('"'), typed))


def ntriples(triples: DataFrame) -> DataFrame:
    """Distinct triples as N-Triples lines (column ``value``)."""
    t = triples.select("s", "p", "o", "o_kind").dropDuplicates()
    return t.select(F.concat_ws(" ", _nt_uri(F.col("s")), _nt_uri(F.col("p")),
                                _nt_term(F.col("p"), F.col("o"), F.col("o_kind")), F.lit(".")).alias("value"))


def write_outputs(df: DataFrame, path: str, formats=("json",), include_full_text: bool = True,
                  include_embeddings: bool = False, mode: str = "overwrite", timestamp_suffix: str | None = None) -> None:
    """Json / json-ld / rdf (N-Triples) / csv under ``path/<format>``, or
    ``path/<format>_<timestamp_suffix>``.  Without full texts the column is null.
    With several formats the articles are written once to the shared folder first, so that the plan before
    runs once; each format is a job of its own, whose failed tasks leave nothing."""
    unknown = set(formats) - {"json", "json-ld", "rdf", "csv"}
    if unknown:
        raise ValueError(f"unknown output format {sorted(unknown)[0]!r}")
    data = materialise(df) if len(formats) > 1 else df
    if not include_full_text:
        data = data.withColumns({c: F.lit(None).cast(data.schema[c].dataType) for c in LARGE_COLUMNS if c in data.columns})
    if not include_embeddings and "embeddings" in data.columns:
        data = data.drop("embeddings")
    for fmt in formats:
        out = f"{path.rstrip('/')}/{fmt}" + (f"_{timestamp_suffix}" if timestamp_suffix else "")
        if fmt == "json":
            write_records(data, out, mode)
        elif fmt == "json-ld":
            data.select(to_json_ld("main").alias("value")).write.mode(mode).text(out)
        elif fmt == "rdf":
            ntriples(to_triples(data)).write.mode(mode).text(out)
        elif fmt == "csv":
            flat = data.select(*[F.to_json(F.col(c)).alias(c) if dict(data.dtypes)[c].startswith(("array", "struct"))
                                 else F.col(c) for c in data.columns])
            # quotes are doubled, as most readers of CSV expect
            flat.write.mode(mode).option("header", True).option("escape", '"').csv(out)
