"""Corpus pipeline: documents -> stages -> a mixed corpus.  Counted as part of lumenkg.llm.

In every stage a null text counts as empty and a null source as one source of its own; rows with a null id
are judged by their text and never joined with others by id; an empty table gives an empty table; further
columns are carried.  Rows that repeat an id are judged by their own texts; equal texts of one id become one
row in the SimHash stage."""
from __future__ import annotations

from pyspark.sql import functions as F

from lumenkg.llm import decontam, lines, mixing, quality, simhash
from lumenkg.llm.common import read_table, written


def _counted(docs):
    """``docs`` whose texts were changed, with n_chars as the length of the text that stays."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_classifier(spark, docs, sf_dir):
    """Documents go whose probability of the best grade is under one half; a text without words is judged by
    the thresholds alone.  Without labels all documents have the same grade."""
    model = quality.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), sample=20_000)
    return quality.select_good(docs, model, least=0.5)


def line_dedup(spark, docs, sf_dir):
    """Lines go that more than a fiftieth of their source's documents, and five at least, hold.  Blank lines
    and null texts stay; repeated rows count each."""
    return _counted(lines.remove_boilerplate(docs, max_ratio=0.02, min_pages=5))


def simhash_near_dedup(spark, docs, sf_dir):
    """Of each group of near duplicates the document with the smallest id stays; rows with a null id stay."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def decontaminate(spark, docs, sf_dir):
    """Benchmark passages leave the texts; documents that are mostly such passages go.  Null and empty texts
    stay; an empty benchmark changes nothing."""
    return _counted(decontam.remove_benchmark(docs, read_table(spark, sf_dir, "benchmark"), min_words=10, max_coverage=0.5))


def mix_sources(spark, docs, sf_dir):
    """Blocks of documents get slots by source; order by mix_slot and mix_place to read the corpus.  Every row
    gets a place, repeated ones too."""
    return mixing.mix(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

#: The quality classifier is fitted, so no SQL states the result; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages one after another over the whole documents table, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
