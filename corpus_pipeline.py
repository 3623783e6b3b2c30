"""From raw documents to sampled token sequences: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendloom.llm import exact_dedup, jaccard, language, mixing, pieces
from trendloom.session import stage


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without any letter go, and those of which the network finds no language likelier than by chance."""
    return language.keep_known(docs, language.fit(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays; NULL and empty texts are equal. An empty table stays empty."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by word shingles the one with the smallest id stays."""
    return jaccard.drop_near_copies(docs, width=5, least=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole and drawn copies of each document by its source's target; documents may go or stand several times."""
    return mixing.mix(docs)


def sample_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy of a document, with its sampled token sequences."""
    return pieces.encode(docs, keep=["doc_id", "source"]).select("row.doc_id", "row.source", "samples")


STAGES = [
    ("language ID", keep_known_languages),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", sample_pieces),
]

#: Language scores and sampled segmentations are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source and samples of the mixed documents; an empty or unlabelled table goes through as any other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
