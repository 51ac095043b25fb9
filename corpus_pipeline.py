"""The corpus pipeline: five stages over ``documents``, each one's rows written as
Parquet and read back as the next one's input.

toxicity -> MinHash near-dedup -> PII -> mixing -> SentencePiece. All but the
last return the columns of ``documents``. No stage can be put in SQL as a whole
(a trained classifier, signatures, keyed permutations, draws), so there is no
oracle text; the tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import stages
from tidewell.session import scratch
from tidewell.sources.tables import table

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("minhash_dedup", stages.one_of_each_group),
    ("pii", stages.pseudonymise),
    ("mix", stages.mix_sources),
    ("sentencepiece", stages.segment),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
