"""Scans and sinks of orders and results: CSV, JSON lines and Parquet directories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sealstone.schema import ORDERS


def read_orders(spark: SparkSession, path: str, fmt: str = "csv", schema: str | None = ORDERS) -> DataFrame:
    """Orders with ids and product lines as text; NaN in number columns becomes null. A schema saves the pass that infers one."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c).cast("string").alias(c) if c in ("order_id", "lob") else F.col(c) for c, t in df.dtypes])


def read_results(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Earlier results from CSV, with or without a byte-order mark, all text unless a schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def _flat(df: DataFrame) -> DataFrame:
    """Text columns without nulls, as the CSV contract has it."""
    return df.select(*[F.coalesce(F.col(f"`{f.name}`"), F.lit("")).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`") for f in df.schema])


def append_csv(df: DataFrame, path: str) -> None:
    _flat(df).write.mode("append").option("header", True).option("emptyValue", "").csv(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def append_both(df: DataFrame, csv_path: str, json_path: str) -> None:
    """Both sinks from one computation."""
    df = df.persist()
    try:
        append_csv(df, csv_path)
        append_jsonl(df, json_path)
    finally:
        df.unpersist()


def create_empty(df: DataFrame, path: str) -> None:
    """A result with the full header and no rows."""
    df.limit(0).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export(spark: SparkSession, path: str, to: str, fmt: str = "parquet", files: int | None = None, schema: str | None = None) -> DataFrame:
    """All appended results as one export; files=1 puts results that one task can write into one file."""
    df = read_results(spark, path, schema)
    out = (df.coalesce(files) if files else df).write.mode("overwrite")
    (out.option("header", True).csv(to) if fmt == "csv" else out.format(fmt).save(to))
    return spark.read.option("header", True).csv(to) if fmt == "csv" else spark.read.format(fmt).load(to)


def read_photos(spark: SparkSession, path: str) -> DataFrame:
    """path, length and content of photos in an object store."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "content")


def stored(photos: DataFrame, files: DataFrame, name: Column) -> DataFrame:
    """photos (order_id, image_idx, url) with content and status: ok, or missing where there is no url or no file (path, length, content) of that name.

    name: a file's url, of its path. A photo that several orders share goes to each; of files with one name the first path counts. What fetched() gives
    for photos on the web, this gives for those in an object store.
    """
    own = files.groupBy(name.alias("_name")).agg(F.min_by("content", "path").alias("content"))
    both = photos.select("order_id", "image_idx", "url").join(own, F.col("url") == F.col("_name"), "left")
    return both.select("order_id", "image_idx", "url", "content", F.when(F.col("content").isNull(), "missing").otherwise("ok").alias("status"))
