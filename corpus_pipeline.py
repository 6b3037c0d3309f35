"""From raw documents to packed sequences: five stages, each written and read again."""

import functools

import public_tokenizers
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession

import loomstead
from loomstead.llm import exact_packing, paragraph_bands, quota_mix, robust_outliers, simhash_trees
from loomstead.llm.common import WRITTEN, discard, new_folder, prepared, table

# Python workers get the package's functions with the job.
register_pickle_by_value(loomstead)


_left: list[str] = []


def stage(step):
    """A stage's function. What the one before it wrote on the way is deleted: its result has
    been written by then, as every result is before the next stage begins."""

    @functools.wraps(step)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(prepared(spark), _left)
        before = len(WRITTEN)
        out = step(spark, docs, sf_dir)
        _left[:] = WRITTEN[before:]
        return out

    return run_stage


@stage
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near their language and source."""
    return robust_outliers.filtered(docs)


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    return simhash_trees.deduplicated(docs)


@stage
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    return paragraph_bands.cleaned(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return quota_mix.mixed_documents(docs)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    return exact_packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Fingerprints, exact covariances and tokenizers are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        path = new_folder(spark)
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
