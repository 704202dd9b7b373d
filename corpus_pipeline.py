"""Corpus preparation: a fixed sequence of stages over the document table.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from aerotrace.llm.decontam import clean_documents
from aerotrace.llm.minhash import one_per_group
from aerotrace.llm.mixing import mixed_documents
from aerotrace.llm.quality import passing
from aerotrace.llm.tokens import token_table
from aerotrace.session import stage_table

#: Token ids, positions in files and partial copies have no SQL form; the
#: stages are tested one by one against brute-force versions.
ORACLE_SQL = None


def quality_rules(spark, docs, sf_dir):
    """Drop documents that the quality rules reject: null, empty and blank
    texts and those of under 50 words among them.  Each row is judged by its
    text alone; ties, repeated rows, null ids and further columns of any name
    do not matter; an empty table stays empty."""
    return passing(docs)


def near_dedup(spark, docs, sf_dir):
    """Keep one document of every near-duplicate group over 5-word shingles:
    the one with the smallest id, documents without an id last.  Rows that
    repeat an id and its text, or a text without an id, count once; documents
    without words all stay; columns of any name pass through; an empty table
    stays empty."""
    return one_per_group(docs, k=5)


def decontaminate(spark, docs, sf_dir):
    """Drop documents with a window that matches a benchmark item, items
    without an id included.  Null and empty texts match nothing and stay, as do
    all rows where either table is empty; repeated rows are judged each;
    columns of any name pass through."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark, docs, sf_dir):
    """Repeat, keep or leave out documents so that each source meets its budget.
    Null, empty and blank texts use none of it and stay once; a null source is
    a source of its own; rows that repeat an id and size share their number of
    copies; columns of any name pass through; an empty table stays empty."""
    return mixed_documents(docs)


def tokenize(spark, docs, sf_dir):
    """Write the token files and return what they hold per document.  Null and
    empty texts have the end id only; rows without an id come last; repeated
    rows have a row each; other columns are ignored; an empty table gives none."""
    return token_table(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix_sources", mix_sources), ("tokenize", tokenize)]


def run(spark, sf_dir):
    """All stages in order, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
