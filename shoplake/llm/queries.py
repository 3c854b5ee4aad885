"""The operators as registered queries over the sample tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm import (
    alignment,
    chunks,
    decontaminate,
    html_text,
    langid,
    mixing,
    packing,
    prefix_trie,
    quality,
    simhash,
    token_blocks,
    toxicity,
    url_rules,
)
from shoplake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measurements, failed rules and the current policy's verdict."""
    return quality.judged(quality.ledger(table(spark, sf_dir, "documents")))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, verbatim or with other numbers, names and units."""
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), "item_id", "n_windows", "n_item_windows", "reparameterised")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity by its nearest labelled examples, with those as evidence."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).drop("tie")


def op4_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2048 ids, in the order of a Hilbert curve over hashed document vectors."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pieces(packing.pack(table(spark, sf_dir, "documents"), vocabulary, "words", 1))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text by tag-path ratios."""
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of every document that occurred before, with the document that keeps it."""
    return chunks.repeated_passages(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the component it is linked to at two bits or fewer."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries that were active on the day it was fetched."""
    pages = table(spark, sf_dir, "pages")
    return url_rules.evaluate(url_rules.sample_captures(pages), url_rules.sample_entries(pages))


def op9_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' ids written in patched frame-of-reference blocks and read back."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return token_blocks.token_digests(token_blocks.write_tokens(table(spark, sf_dir, "documents"), vocabulary, "bytes", 0))


def op10_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by a conditional random field over its words."""
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs)).drop("tie")


def op11_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words in a mix of all sources by capped weights."""
    return mixing.mixed(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, epochs=2.0)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all conversations, rebuilt as variants of one another."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two vocabularies in groups over the same bytes, with corpus-wide counts of linked ids."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.alignment(table(spark, sf_dir, "documents"), *paths)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_ledger,
        op2_decontamination,
        op3_toxicity,
        op4_hilbert_packing,
        op5_main_text,
        op6_substring_dedup,
        op7_simhash,
        op8_url_rules,
        op9_token_blocks,
        op10_language_crf,
        op11_water_filling,
        op12_prefix_trie,
        op13_token_alignment,
    )
}

#: The others cannot be written in SQL; their tests hold them against brute force, round trips or held-out labels.
ORACLE: dict[str, str] = {"op1_quality_ledger": quality.OP1_SQL, "op8_url_rules": url_rules.OP8_SQL, "op12_prefix_trie": prefix_trie.OP12_SQL}
