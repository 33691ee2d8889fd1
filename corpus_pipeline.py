"""Corpus pipeline over the training-data operators: documents in, mix out.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of ``documents``; the last returns
the mix: how many words of each document it takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import op2_sainte_lague_mix as mixing
from tallyspark.llm import op4_multi_order_join as near
from tallyspark.llm import op7_gam_quality as quality
from tallyspark.llm import op8_simhash_decontam as decontam
from tallyspark.llm import op9_dfa_secrets as secrets
from tallyspark.llm.tables import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents scored below 0.3 go."""
    return quality.keep_good(docs, quality.train_on_texts(docs, table(spark, sf_dir, "labels")))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of documents connected by five-word Jaccard similarity of
    0.8 or more, the one of the smallest id stays."""
    return near.keep_smallest(docs, k=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a benchmark item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: secrets are masked; all documents stay."""
    return secrets.mask_secrets(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: words taken of each document for the target mix."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("benchmark decontamination", benchmark_stage),
    ("secret scan", secrets_stage),
    ("source mix", mix_stage),
]

# A boosted model, fingerprints and automata: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
