"""Entity enrichment of articles."""
from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.entities import extract_entities
from ..functions.terms import compiled
from ..functions.text import blank, or_empty_array, py_strip, truthy
from ..session import cut_lineage


def nlp_text(max_chars: int | None = None) -> Column:
    """``abstract + " "`` (if any) followed by the full text, whole or
    (opt-in, ``vocab.NLP_TEXT_CHARS[profile]``) its first ``max_chars``."""
    full = F.col("full_text") if max_chars is None else F.substring("full_text", 1, max_chars)
    a = F.when(truthy("abstract"), F.concat(F.col("abstract"), F.lit(" "))).otherwise(F.lit(""))
    t = F.when(truthy("full_text"), full).otherwise(F.lit(""))
    return F.concat(a, t)


def _union_sorted(existing: Column, new: Column) -> Column:
    return F.sort_array(F.array_distinct(F.concat(or_empty_array(existing), or_empty_array(new))))


def enrich_articles(df: DataFrame, profile: str = "main", extractors: dict[str, Column] | None = None,
                    mentions: DataFrame | None = None, max_chars: int | None = None,
                    limits: dict[str, int] | None = None) -> DataFrame:
    """Add dictionary / pattern entities to articles.

    main   : only rows not extracted by a model; organisms, genes, proteins,
             conditions, experiments, measurements become the sorted set of
             old + new values.
    strict : every row; organisms, experiments, measurements, genes,
             proteins (the two condition families are not article fields).
    A row whose text is blank is left unchanged.  ``mentions`` (J6) adds
    NER mentions before the sets are formed; ``extractors`` (X1) are extra
    ``name -> Column`` outputs added as columns.  ``max_chars`` and ``limits``
    are the opt-in cuts of :func:`nlp_text` and :func:`extract_entities`.
    """
    text = nlp_text(max_chars)
    df = df.withColumn("_nlp_text", text)
    if mentions is not None:
        df = route_mentions(df, mentions)
    ent = extract_entities("_nlp_text", profile, limits=limits)
    apply = ~blank("_nlp_text")
    if profile == "main":
        apply = apply & ~F.coalesce(F.col("llm_extracted"), F.lit(False))
        fields = ["organisms", "genes", "proteins", "conditions", "experiments", "measurements"]
    else:
        fields = ["organisms", "experiments", "measurements", "genes", "proteins"]
    df = df.withColumn("_ent", F.when(apply, ent))
    updates = {}
    for f in fields:
        new = F.col("_ent")[f]
        if mentions is not None:
            new = F.concat(new, or_empty_array(F.col(f"_ner_{f}")))
        updates[f] = F.when(apply, _union_sorted(F.col(f), new)).otherwise(F.col(f))
    if mentions is not None and profile == "strict":
        # stated intent: condition mentions are kept even in the strict profile
        updates["conditions"] = F.when(apply, _union_sorted(F.col("conditions"), F.col("_ner_conditions"))) \
            .otherwise(F.col("conditions"))
    df = df.withColumns(updates)
    if extractors:
        df = df.withColumns({name: F.when(apply, c) for name, c in extractors.items()})
    drop = ["_nlp_text", "_ent"] + [c for c in df.columns if c.startswith("_ner_")]
    return df.drop(*drop)


#: Characters of gazetteer terms in one shard.
SHARD_CHARS = 1_000_000


def route_mentions(articles: DataFrame, mentions: DataFrame, key: str = "article_id") -> DataFrame:
    """NER mentions (article_id, label, text) routed to entity fields.

    Pre-aggregated per article (map-side combine) before one left join, so
    a hot article never expands the articles side.
    """
    text = F.lower(py_strip(F.col("text")))
    label = F.col("label")
    aggs = []
    for labels, field in vocab.NER_ROUTES:
        cond = label.isin(*labels)
        if field == "genes":
            cond = cond & (F.length(text) > 2)
        aggs.append(F.collect_set(F.when(cond, text)).alias(f"_ner_{field}"))
    per_article = mentions.groupBy(F.col(key)).agg(*aggs)
    out = articles.join(per_article, on=key, how="left")
    for _, field in vocab.NER_ROUTES:
        out = out.withColumn(f"_ner_{field}", or_empty_array(f"_ner_{field}"))
    for f in ("organisms", "genes", "measurements", "conditions", "experiments", "proteins"):
        if f"_ner_{f}" not in out.columns:
            out = out.withColumn(f"_ner_{f}", F.array().cast("array<string>"))
    return out


def match_terms(df: DataFrame, text_col: str, gazetteer: DataFrame, key: str,
                case_insensitive: bool = True, word_boundary: bool = False, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(key, category, term) for every gazetteer term contained in the text.

    ``gazetteer`` is a user table (category, term) of any size.  Its terms are dealt by hash to shards of about
    ``shard_chars`` characters, so that a shard's size is bounded; each is broadcast and compiled to an
    Aho-Corasick automaton once a worker.  The texts stream through it where they are read: no text is
    shuffled, and a table of more shards costs more passes, not more memory.
    ``word_boundary`` asks for whole words; by default a term may be part of one.
    """
    text = F.lower(F.col(text_col)) if case_insensitive else F.col(text_col)
    docs = df.select(F.col(key), text.alias("_t")).filter(F.col("_t").isNotNull())
    needle = F.lower("term") if case_insensitive else F.col("term")
    g = gazetteer.select("category", "term").filter(truthy("term")).dropDuplicates().withColumn("_needle", needle)
    g = cut_lineage(g)
    size = g.agg(F.coalesce(F.sum(F.length("_needle") + F.length("term") + F.length("category")), F.lit(0))).first()[0]
    shards = max(1, -(-size // shard_chars))
    schema = docs.select(key, F.lit("").alias("category"), F.lit("").alias("term")).schema
    out = None
    for n in range(shards):
        part = g.where(F.pmod(F.xxhash64("_needle"), F.lit(shards)) == n)
        hits = docs.mapInArrow(_finder(df.sparkSession, part, word_boundary), schema)
        out = hits if out is None else out.unionByName(hits)
    return out


def _finder(spark, terms: DataFrame, word_boundary: bool):
    """Map side of :func:`match_terms` for the terms of one shard."""
    by: dict[str, list] = {}
    for r in terms.collect():  # one shard
        by.setdefault(r["_needle"], []).append((r["category"], r["term"]))
    shared, name = spark.sparkContext.broadcast(by), uuid.uuid4().hex

    def run(batches):
        found = compiled(name, shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                row, category, term = [], [], []
                for i, text in enumerate(part.column(1)):
                    for c, t in found(text.as_py(), word_boundary):
                        row.append(i)
                        category.append(c)
                        term.append(t)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row, pa.int64())), pa.array(category, pa.string()), pa.array(term, pa.string())],
                                                 names=[part.schema.names[0], "category", "term"])

    return run
