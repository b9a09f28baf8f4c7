"""From raw documents to a sharded training corpus, stage by stage.

Every stage takes (spark, docs, sf_dir), works on all rows it is given and returns rows with the
columns of `documents`; only the last returns the placement of the rows. `run` writes what a stage
returns as Parquet in the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casefile.llm import decontaminate, hilbert, mixing, quality_model, simhash
from casefile.llm.common import forget, table, written
from casefile.llm.queries import language_labels

SHARDS = 24
# Wanted share of the tokens of each language.
WEIGHTS = {"en": 0.5, "fr": 0.2, "de": 0.18, "es": 0.12}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier gives 0.7 or more; null and empty texts are judged by their (zero) statistics."""
    model = quality_model.learn_quality(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality_model.quality_score(model, docs["text"]) >= quality_model.REJECT_BELOW)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints over 3-word shingles that differ in at most two bits: the one with the smallest id."""
    return simhash.one_of_each_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as often as the rates fitted to `WEIGHTS` ask; none is lost."""
    return mixing.apply_rates(docs, mixing.fit_mix(docs, language_labels(spark, sf_dir), WEIGHTS, floor=1.0))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, curve) of every row."""
    return hilbert.shard_rows(docs, SHARDS, hilbert.corpus_levels(docs))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminated), ("mix", mix), ("shard", shards)]

# Models and groups of near copies have no counterpart in SQL. Tests hold near_dedup against the groups of op6 and
# decontaminate against planted items; the other stages by columns, ids and counts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to `documents`; what a stage read is removed once its own rows are written."""
    docs, done = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs, path = written(stage(spark, docs, sf_dir))
        if done:
            forget(spark, done)
        done = path
    return docs
