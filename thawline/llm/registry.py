"""Queries of the training-data operators, each over whole tables, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from thawline.llm import (
    op1_sentencepiece,
    op2_ann,
    op3_license,
    op4_suffix,
    op5_lm,
    op6_token_ids,
    op7_quality,
    op8_toxicity,
    op9_decontam,
    op10_minhash,
    op11_token_counts,
    op12_collocations,
    op13_whitening,
)
from thawline.llm.common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = op1_sentencepiece.Pieces.load(tokenizer_path("piece_bpe_32k.model"))
    return op1_sentencepiece.encode(table(spark, sf_dir, "documents"), vocabulary, digest=True)


def op2_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_ann.neighbours(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_license.license_scan(table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_suffix.removed_bytes(table(spark, sf_dir, "documents"), threshold=400)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "labels").where("quality = 1")
    return op5_lm.rounded(op5_lm.cross_entropy_difference(table(spark, sf_dir, "documents"), target))


def op5_lm_scoring_frequent_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "labels").where("quality = 1")
    return op5_lm.rounded(op5_lm.cross_entropy_difference(table(spark, sf_dir, "documents"), target, vocabulary=1500))


def op6_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = op6_token_ids.write_shards(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2)
    return op6_token_ids.read_digests(manifest)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op8_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op11_token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), limit=2048)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_collocations.collocations(table(spark, sf_dir, "documents"), least=10, max_words=3, inside=50, top=2000)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


QUERIES = {
    f.__name__.removesuffix("_query"): f
    for f in (
        op1_sentencepiece_codec,
        op2_ann_search,
        op3_license_scan,
        op4_suffix_array_dedup,
        op5_lm_scoring,
        op5_lm_scoring_frequent_words,
        op6_token_id_output,
        op7_quality_classifier,
        op8_toxicity_scores,
        op9_benchmark_decontamination,
        op10_minhash_near_dedup,
        op11_token_counts_query,
        op12_phrase_collocations,
        op13_embedding_whitening,
    )
}

SQL: dict[str, str] = {
    "op3_license_scan": op3_license.license_sql(),
    "op4_suffix_array_dedup": op4_suffix.removed_bytes_sql(400),
    "op5_lm_scoring": op5_lm.cross_entropy_sql(),
    "op5_lm_scoring_frequent_words": op5_lm.cross_entropy_sql(vocabulary=1500),
    "op10_minhash_near_dedup": op10_minhash.near_duplicates_sql(2, 80),
    "op12_phrase_collocations": op12_collocations.collocations_sql(10, 50, 2000),
}
