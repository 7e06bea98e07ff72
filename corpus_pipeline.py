"""Corpus pipeline: documents -> quality filter -> exact dedup -> near dedup -> packed token sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the shared folder and
reads it again as the next stage's documents, so a lost executor costs a re-read. All but the last stage return the
columns of ``documents``; the last returns pieces with their sequence and offset.

Nulls and empty texts: an empty text is scored like any other, equals other empty texts, and packs to its end id. Of
repeated rows and ties one document stays in the second and third stage (the longest original, then the smallest id, then
the first read); the others treat each row by itself. An
empty table passes through all stages. Extra columns pass through the first three.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import exact_dedup, near_dedup, packing, quality
from cardwatch.llm.common import fresh, keep_rows, stage
from cardwatch.llm.queries import METADATA, TOKENIZER, quality_model, table

#: Documents below this score are rejected.
LEAST_SCORE = 0.3


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the factorisation machine scores at least ``LEAST_SCORE``."""
    name = fresh(docs, "quality_score")[0]
    scored = quality.score(docs, quality_model(spark, docs, sf_dir), METADATA, name)
    return scored.where(F.col(name) >= LEAST_SCORE).drop(name)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the longest original of each group of equal texts (white space aside)."""
    return keep_rows(docs, exact_dedup.exact_dedup(docs).where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near copies."""
    return keep_rows(docs, near_dedup.near_dedup(docs).where("kept"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' tokens into sequences."""
    return packing.pack(stage(packing.pieces(docs, public_tokenizers.path(TOKENIZER)), "pieces")).drop("lane")


STAGES = [
    ("quality_filter", quality_filter),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("best_fit_packing", pack_sequences),
]

#: A trained model, Poisson signatures and local search aren't SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
