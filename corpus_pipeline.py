"""A corpus pipeline over ``documents``: toxic ones out, copies out, near copies out, repeated passages out, packed.

Each stage takes all that the one before has kept, with all its columns; only the last one returns something else,
the packed pieces. Rows survive nulls in any column: a null text counts as empty, a row without doc_id is no one's copy
but in exact dedup, where texts alone decide.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.llm import exact, neardup, packing, suffix, toxicity
from dayloom.llm.common import table
from dayloom.session import written

#: No SQL can train the classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic: a score of 0.3 or more rejects."""
    return toxicity.kept_rows(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, 0.8 in common) the document with the lowest doc_id."""
    return neardup.kept_rows(docs, size=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the strings of 100 bytes or more that stand earlier; n_chars, if there is one, follows the text."""
    made = suffix.cleaned(docs)
    return made.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else made


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and offset.

    Workers and heaps live on through all stages, so that this one goes in small steps and leaves nothing behind.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), batch=1_000, keep=False)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("MinHash near-dedup", drop_near_copies),
          ("suffix-array dedup", cut_repeats), ("best-fit packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
