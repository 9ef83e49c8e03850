"""Corpus clean-up pipeline over ``documents``.

Each stage takes what its predecessor kept, as a stored table; all but the last
return the columns of ``documents``. Null texts pass every filter as empty texts
and end as one-token documents; rows that repeat an id are filtered alike; very
long texts go through each stage whole, as its module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import decontaminate, near_dedup, packing, secret_scan, toxicity
from stratum.llm.queries import read, tokenizer
from stratum.llm.ship import ship
from stratum.session import free, scratch_path, scratch_scope

# One or two words inside a text are no sign of contamination.
LEAST_ITEM_WORDS = 3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the calibrated classifier scores 0.5 or more go."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group (five-word shingles, similarity 0.8) the smallest doc_id stays."""
    ship(spark)
    return near_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain 80 % of a benchmark item's five-word shingles go; an
    item of fewer words is looked for as it stands, one of fewer than
    ``LEAST_ITEM_WORDS`` only among whole texts."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"), short_inside=True, least_words=LEAST_ITEM_WORDS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place; every document stays."""
    return secret_scan.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in windows of 2048: one row per piece."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer(), with_ids=True)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("secret_scan", mask_secrets), ("packing", pack)]

# Learned scores, MinHash groups and tokenizer ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):  # what a stage makes on its way goes with its end
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            free(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
