"""From raw documents to token ids: five stages, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the
columns of ``documents``, extra ones included. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, mixing, perplexity, secrets, shingles
from millrace.llm.common import documents, in_a_task
from millrace.llm.queries import VOCABULARY
from millrace.session import scratch_path
from millrace.sources.lines import table


# What a row is known by: its id and its text, as ids may repeat with other texts.
_ROW = ["doc_id", "__one", "__two"]


def _known(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"__one": F.xxhash64("text"), "__two": F.xxhash64(F.lit(1), "text")})


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the perplexity classifier keeps. Rows that share an id (NULL too) share the better verdict."""
    verdicts = perplexity.classify(docs, table(spark, sf_dir, "labels"))
    kept = verdicts.filter("kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group of near duplicates: one with the smallest id.

    Rows that share that id but have other texts all stay, as the group does not tell which
    of them it means; rows with the same id and text stay once. Rows without an id cannot be
    told apart and all stay.
    """
    groups = shingles.jaccard_components(docs).filter("doc_id = component_id")
    kept = groups.select(F.col("doc_id").alias("__id")).distinct()
    row = F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row")
    # Found by id without the texts first, so that whole rows are shuffled once, for the join and the grouping.
    wanted = _known(docs).select(*_ROW).join(kept, F.col("doc_id") == F.col("__id"), "left_semi").distinct()
    chosen = _known(docs).join(wanted, _ROW, "left_semi").groupBy(*_ROW).agg(row).select("row.*")
    return chosen.unionByName(docs.filter("doc_id IS NULL"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets masked; ``n_chars`` follows the new text."""
    masked = secrets.masked(docs, in_a_task(spark, secrets.train, secrets.sample_texts(docs)))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.emit(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens) per document taken, in the public byte-level vocabulary."""
    return bpe.encode(docs, VOCABULARY).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("encoding", encoded),
]

# Tags, trees and merges have no SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
