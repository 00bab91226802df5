"""The queries of the pipeline operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, chat, extraction, licenses, mixing, oracles, perplexity, quality, repair, secrets
from millrace.llm import shingles, spelling, substrings, vectors
from millrace.llm.common import documents, in_a_task
from millrace.sources.lines import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


@query(oracles.QUALITY)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.line_rules(documents(spark, sf_dir)).drop("cleaned")


@query()
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL cannot look at every window of every text; tests compare with all windows of small tables."""
    return substrings.repeated_substrings(documents(spark, sf_dir))


@query()
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags have no SQL; tests compare with a plain reading of the patterns and exhaustive paths."""
    texts = documents(spark, sf_dir)
    return secrets.scan(texts, in_a_task(spark, secrets.train, secrets.sample_texts(texts)))


@query()
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("copies")


@query()
def op5_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tests compare the probabilities with a plain model and the verdicts with held-out labels."""
    return perplexity.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query(oracles.VECTORS)
def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.links(table(spark, sf_dir, "embeddings"))


@query()
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


@query(oracles.JACCARD)
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingles.jaccard_components(documents(spark, sf_dir))


@query()
def op9_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trained reader has no SQL; tests measure it on pages whose main text is known."""
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, in_a_task(spark, extraction.train, extraction.sample_pages(pages)))


@query()
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-level oracle in SQL does not exist; tests compare with the tokenizers library."""
    return bpe.digests(documents(spark, sf_dir), VOCABULARY)


@query(oracles.REPAIR)
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(table(spark, sf_dir, "conversations"))


@query(oracles.CHAT)
def op12_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_control_texts(spark, table(spark, sf_dir, "conversations"))
    return chat.digests(chat.windows(rows))


@query(oracles.SPELLING)
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))
