"""The registered queries of this package, and the SQL of those that SQL can express."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomstead.llm import (
    bloom_language_model,
    exact_packing,
    license_bands,
    nn_descent,
    orchard_clusters,
    overlap_tokens,
    paragraph_bands,
    quota_mix,
    robust_outliers,
    simhash_trees,
    token_alignment,
    warc_store,
    weak_toxicity,
)
from loomstead.llm.common import table


def op1_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return robust_outliers.quality(table(spark, folder, "documents"))


def op2_overlap_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return overlap_tokens.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_weak_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return weak_toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_quota_mix(spark: SparkSession, folder: str) -> DataFrame:
    return quota_mix.takings(table(spark, folder, "documents"))


def op5_paragraph_bands(spark: SparkSession, folder: str) -> DataFrame:
    return paragraph_bands.repeated_passages(table(spark, folder, "documents"))


def op6_simhash_trees(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_trees.near_duplicates(table(spark, folder, "documents"))


def op7_exact_packing(spark: SparkSession, folder: str) -> DataFrame:
    return exact_packing.packed(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_warc_store(spark: SparkSession, folder: str) -> DataFrame:
    return warc_store.archived(table(spark, folder, "pages"))


def op9_license_bands(spark: SparkSession, folder: str) -> DataFrame:
    return license_bands.licenses(table(spark, folder, "documents"))


def op10_nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    return nn_descent.nearest(table(spark, folder, "embeddings"), "vec_id % 20 = 0")


def op11_orchard_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return orchard_clusters.clustered(table(spark, folder, "embeddings"))


def op12_bloom_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return bloom_language_model.scored(table(spark, folder, "documents"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.alignments(table(spark, folder, "documents"), *paths)


QUERIES = {
    f.__name__: f
    for f in (
        op1_robust_outliers, op2_overlap_tokens, op3_weak_toxicity, op4_quota_mix, op5_paragraph_bands,
        op6_simhash_trees, op7_exact_packing, op8_warc_store, op9_license_bands, op10_nn_descent,
        op11_orchard_clusters, op12_bloom_language_model, op13_token_alignment,
    )
}

ORACLES = {"op8_warc_store": warc_store.ORACLE_SQL, "op11_orchard_clusters": orchard_clusters.ORACLE_SQL}
