"""From raw documents to packed sequences: five stages, each over all that the one before kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. run()
writes each stage's rows as Parquet in the shared folder and reads them again for the next, so a
lost executor costs a stage at most. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyrill.llm import decontaminate, gram_join, packing, secret_scan, toxicity
from tallyrill.llm.store import ship, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that class-conditional language models take for toxic go."""
    ship(spark)
    return toxicity.keep_ordinary(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    ship(spark)
    return gram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of the benchmark go."""
    ship(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced; every document stays."""
    return secret_scan.masked(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of at most 1024."""
    ship(spark)
    # Executors hold what earlier stages left in them, so their workers remember less: about 60 MB each when full.
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), pieces=100_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


#: Scores and near copies are beyond SQL here; the tests check the stages one by one.
ORACLE_SQL = None
