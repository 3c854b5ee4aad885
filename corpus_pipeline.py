"""From raw documents to packed training sequences, in stages that each work on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's docs. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shoplake.llm import chunks, decontaminate, langid, packing, simhash
from shoplake.llm.common import cut, table
from shoplake.session import clear_scratch, scratch_made


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language; those without letters and mixtures without a leading language go."""
    return langid.with_language(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link at two bits or fewer."""
    return simhash.keep_first(docs, shingle=3, distance=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every passage that occurred before cut out."""
    return chunks.without_repeats(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, verbatim or re-parameterised."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 2048 ids along the Hilbert curve."""
    return packing.pieces(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), "words", 1))


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark),
    ("packing", pack),
]

#: SQL has neither the random field nor the tokenizer, so the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Once a stage's rows are stored, what it and the stage before it stored on the way is removed."""
    docs, stored = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        before = scratch_made(spark)
        docs = cut(stage(spark, docs, sf_dir), name)
        made = [f for f in scratch_made(spark) if f not in before]
        clear_scratch(spark, [*stored, *made[:-1]])
        stored = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
