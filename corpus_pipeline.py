"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark passages, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next stage reads it back
from Parquet as its ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from thawline.llm import op1_sentencepiece, op4_suffix, op7_quality, op9_decontam, op10_minhash
from thawline.llm.common import saved, table
from thawline.llm.registry import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF accepts."""
    return op7_quality.keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more)."""
    return op10_minhash.keep_one(docs, words=5, percent=80, one_row_an_id=False)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that occur elsewhere too."""
    return op4_suffix.without_repeats(docs, threshold=50)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return op9_decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the documents that are left, and the text decoded from them."""
    vocabulary = op1_sentencepiece.Pieces.load(tokenizer_path("piece_bpe_32k.model"))
    # small chunks: ids and decoded texts are in memory beside a chunk's words; small shares: the executor still holds what earlier stages took
    return op1_sentencepiece.encode(docs, vocabulary, chunk_chars=3_000_000, shares=4)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", passages),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", pieces),
]

# Trained scores, sketches and tokenizer ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
