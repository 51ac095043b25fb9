"""The pipeline's stages: each takes (spark, docs, sf_dir) and applies one
operator's decisions to all documents it gets.

Every stage but the last returns the columns of its input. Rows with a null
doc_id take part like others; null and empty texts pass the filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity classifier does not reject."""
    from ..sources.tables import table
    from . import toxicity
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each near-duplicate group
    (five-word shingles; the two words of ``MinHashSpec`` are the op4 query's)."""
    from . import minhash
    return minhash.keep_one(docs, minhash.MinHashSpec(shingle=5))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal numbers and dates replaced by keyed pseudonyms."""
    from . import pii
    return pii.pseudonymise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: per document and pass, the words the mix takes."""
    from . import mixing
    return mixing.mixed_texts(docs)


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document. The executors still hold what the stages
    before have grown to, so a task keeps fewer lattices here than it does alone (more
    CPU, the same samples)."""
    from . import segmentation
    return segmentation.sample(docs, segmentation.SegmentSpec(
        cached_bytes=64 << 20, slice_bytes=512 << 10, build_chars=1 << 16))
