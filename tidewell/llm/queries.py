"""The operators bound to the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing
    return mixing.mix(table(spark, sf_dir, "documents"))


@register
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import minhash
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import licenses
    return licenses.scan(table(spark, sf_dir, "documents"))


@register
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op9_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


@register
def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), count="n_replaced")


@register
def op8_sentencepiece_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import segmentation
    return segmentation.sample(table(spark, sf_dir, "documents"), ids=False)


@register
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import ann
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@register
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import embed_dedup
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import suffix_dedup
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@register
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import url_filter
    return url_filter.judge(table(spark, sf_dir, "pages"))


@register
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import collocations
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import importance
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _oracles() -> None:
    from . import collocations, embed_dedup, importance, licenses, minhash, url_filter, warc
    ORACLES.update(op3_embedding_near_dedup=embed_dedup.ORACLE, op4_minhash_near_dedup=minhash.ORACLE,
                   op9_warc_archives=warc.ORACLE, op10_license_scan=licenses.oracle_sql(),
                   op11_url_filter=url_filter.oracle_sql(), op12_phrase_collocations=collocations.ORACLE,
                   op13_importance_resampling=importance.ORACLE)


_oracles()
