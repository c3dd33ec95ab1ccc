"""What the operators share: reading tables and the words of a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sealstone.checkpoints import saved  # noqa: F401  (the operators take it from here)

#: The only characters that separate words.
SPACE = r"[\x20\x09-\x0D]+"
#: SPACE as Python's re module writes it.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A side of a join is broadcast if its rows, counted before, take at most so many bytes; else Spark decides.
BROADCAST = 8 << 20


def bounded(df: DataFrame, n_bytes: int) -> DataFrame:
    """df, to be broadcast if it is known to be small enough."""
    return F.broadcast(df) if n_bytes <= BROADCAST else df


def words(text: Column) -> Column:
    """The words of a text, in order; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE, -1), lambda w: w != "")


def n_words(text: Column) -> Column:
    """The number of words, without an array of non-empty ones: a split has an empty string only at its ends."""
    s = F.split(F.coalesce(text, F.lit("")), SPACE, -1)
    first = (F.element_at(s, 1) == "").cast("long")
    last = ((F.size(s) > 1) & (F.element_at(s, -1) == "")).cast("long")
    return F.size(s).cast("long") - first - last


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
