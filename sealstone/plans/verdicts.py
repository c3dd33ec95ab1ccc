"""Verdict queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sealstone.operators import verdict
from sealstone.plans import inputs
from sealstone.plans.oracle import FX
from sealstone.rules import rule_book


def verdict_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict.verdict_v1(inputs.orders(spark, sf_dir), inputs.photos(spark, sf_dir))


def verdict_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict.verdict_v2(inputs.orders(spark, sf_dir), inputs.photos(spark, sf_dir), rule_book(spark))


QUERIES = {"verdict_v1": verdict_v1, "verdict_v2": verdict_v2}
SQL = {"verdict_v1": FX + "SELECT * FROM verdict1", "verdict_v2": FX + "SELECT * FROM verdict"}
