"""The ids of judged orders, kept apart from the results so that a run needs neither the results nor all ids to go on.

Each batch adds a segment of its ids, a folder for each bucket of the ids' hash. Every FAN segments of a level are merged into one of the next,
so that n batches are covered by (FAN - 1) segments of each level at most, of which there are log(n). A batch reads only the buckets that its own ids
fall into. Segments are named by level and first batch; a batch that is run again writes its own anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS, FAN = 32, 8
SCHEMA = "order_id string, error string, bucket int"


class DoneIds:
    """path: the folder of segments; results: the folder of results, from which segments that aren't there are made (of runs before this index)."""

    def __init__(self, spark: SparkSession, path: str, results: str, buckets: int = BUCKETS, fan: int = FAN) -> None:
        self.spark, self.path, self.results, self.buckets, self.fan = spark, path.rstrip("/"), results.rstrip("/"), buckets, fan

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("order_id"), F.lit(self.buckets)).cast("int")

    def segments(self, n: int) -> list[tuple[int, int]]:
        """(level, first batch) of the segments that cover batches 0 to n - 1, the largest first."""
        out, first, level = [], 0, 0
        while self.fan ** (level + 1) <= n:
            level += 1
        for k in range(level, -1, -1):
            while first + self.fan**k <= n:
                out.append((k, first))
                first += self.fan**k
        return out

    def _folder(self, level: int, first: int) -> str:
        return f"{self.path}/level={level}-first={first}"

    def _there(self, folder: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def _write(self, ids: DataFrame, level: int, first: int) -> None:
        dealt = ids.select("order_id", "error").distinct().withColumn("bucket", self.bucket()).repartition("bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(self._folder(level, first))

    def _of(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(SCHEMA).option("basePath", self.path).parquet(*folders) if folders else self.spark.createDataFrame([], SCHEMA)

    def _segment(self, level: int, first: int) -> str:
        """A segment's folder; it is made if it isn't there."""
        folder = self._folder(level, first)
        if not self._there(f"{folder}/_SUCCESS"):
            if level:
                self.merge(level, first)
            else:
                self.add(first)
        return folder

    def add(self, batch_id: int) -> None:
        """The segment of a batch whose results are written."""
        own = f"{self.results}/batch_id={batch_id}"
        ids = self.spark.read.parquet(own) if self._there(own) else self.spark.createDataFrame([], SCHEMA)
        self._write(ids.select("order_id", (F.col("error") if "error" in ids.columns else F.lit(None)).cast("string").alias("error")), 0, batch_id)

    def merge(self, level: int, first: int) -> None:
        below = self.fan ** (level - 1)
        self._write(self._of([self._segment(level - 1, first + i * below) for i in range(self.fan)]), level, first)

    def close(self, batch_id: int) -> None:
        """After a batch: its segment, and the merges that it completes."""
        self.add(batch_id)
        level = 1
        while (batch_id + 1) % self.fan**level == 0:
            self.merge(level, batch_id + 1 - self.fan**level)
            level += 1

    def before(self, batch_id: int, orders: DataFrame) -> DataFrame:
        """(order_id, error) of earlier batches, of the buckets of these orders' ids only."""
        folders = [self._segment(*s) for s in self.segments(batch_id)]
        touched = [r[0] for r in orders.select(self.bucket()).distinct().collect()] if folders else []  # BUCKETS at most
        return self._of(folders).where(F.col("bucket").isin(touched)).select("order_id", "error")
