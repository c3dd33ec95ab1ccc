"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sealstone.llm import line_dedup, packing, simhash, source_mix, toxicity
from sealstone.llm.common import saved, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("line_dedup", line_dedup.stage),
    ("simhash_near_dedup", simhash.stage),
    ("mix_sources", source_mix.stage),
    ("best_fit_packing", packing.stage),
]

#: The trained model and the tokenizer can't be written in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents through all stages; the rows are the pieces of the last one, with their sequences. Each stage states what it does with nulls,
    empty and very long texts, ties, repeated rows, empty tables and other columns."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
