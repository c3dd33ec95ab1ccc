"""Cutting lineage by tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: What holds while a table is written: a step's shuffle files aren't needed once its table stands, and Python workers get batches
#: of few rows, which may be whole texts or blocks.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def scratch(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset, a temporary one in local mode, and an error on a cluster, whose
    executors would each write to a folder of their own."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="sealstone-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


class Tables:
    """Tables that the steps of one operator write to the shared folder and read again.

    Later steps neither compute them twice nor depend on the executors that did. A table that no later step reads is dropped; what
    a returned DataFrame reads stays, and the cluster's owner expires the folder.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.paths[name] = f"{scratch(self.spark)}/{name}-{uuid.uuid4().hex}"
        conf = self.spark.conf
        before = {k: conf.get(k, None) for k in WRITING}
        for k, v in WRITING.items():
            conf.set(k, v)
        try:
            df.write.parquet(path)
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again, for as long as a DataFrame may need it."""
    return Tables(df.sparkSession).save(df, name)
