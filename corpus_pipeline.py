"""The corpus pipeline: quality rules, near-duplicate removal, removal of
repeated passages, mixing to target weights, packing.

``run`` applies the stages to ``documents``; each stage's rows are written as
Parquet below ``spark.checkpoint.dir`` and read again as the next one's input.
All but the last return the columns of ``documents``.  What a stage writes on
its way is removed once its rows are there; the last stage's files and the
stages' rows stay for the returned frame, until ``session.remove_scratch``.

Null and empty texts have too few words, so the first stage drops them; an empty
table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import read_table
from tessera.llm.mixing import mix_documents
from tessera.llm.near_dedup import keep_first
from tessera.llm.packing import packed
from tessera.llm.quality import keep_good
from tessera.llm.queries import MIX
from tessera.llm.substring_dedup import remove_repeats
from tessera.session import scratch_folder, scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 35 words that are repeated."""
    return remove_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents to the target weights of domains, languages and sources."""
    return mix_documents(docs, **MIX)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 4096 tokens."""
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality_rules), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("mixing", mix_sources), ("packing", pack)]

#: The stages are not expressible in SQL; tests/llm/test_pipeline.py holds them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_folder(spark, f"within-{name}"):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
