"""Incremental runs: new order files become appended verdicts, each order once."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sealstone.operators.photos import resume
from sealstone.schema import ORDERS
from sealstone.streaming.done import DoneIds


def new_orders(spark: SparkSession, path: str, fmt: str = "csv", schema: str = ORDERS, files_per_batch: int = 100) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


@dataclass
class Progress:
    """What a run has done when it reaches a step: of how many orders, with how many errors, in how many seconds since it began."""

    done: int
    total: int | None
    failed: int
    seconds: float

    @property
    def avg_s(self) -> float:
        return self.seconds / self.done

    @property
    def eta_h(self) -> float | None:
        return None if self.total is None else (self.total - self.done) * self.avg_s / 3600

    @property
    def percent(self) -> float | None:
        return None if self.total is None else 100 * self.done / max(self.total, 1)


def run_available(
    orders: DataFrame, judge: Callable[[DataFrame], DataFrame], results: str, checkpoint: str, once_per_order: bool = False, retry_errors: bool = False,
    progress: Callable[[int, int, int], None] | None = None, steps: Callable[[Progress], None] | None = None, every: int = 50, total: int | None = None,
) -> StreamingQuery:
    """Judges what has come since the last run, batch by batch, and appends it to `results` (Parquet, a folder for each batch).

    Orders whose id was judged in an earlier batch are skipped; they are looked up among the ids beside the results (see done), never in the results.
    Orders repeated within a batch are all judged, unless once_per_order. A batch that is run again after a failure overwrites its own folder
    and ids and doesn't see its own earlier rows, so results stay exact.
    progress: is told each batch's id, its orders and those of them with an error (where judge gives an error), counted as they are written.
    steps: is told a Progress for each `every`-th order; a batch finishes as a whole, so its steps share its time. total: how many orders
    this run will judge, where it is known.
    """
    began, done_so_far = time.monotonic(), [0, 0]

    def write(batch: DataFrame, batch_id: int) -> None:
        ids = DoneIds(batch.sparkSession, f"{results.rstrip('/')}.done", results)
        left = resume(batch, ids.before(batch_id, batch), retry_errors)
        if once_per_order:
            left = left.dropDuplicates(["order_id"])
        judged, seen = judge(left), Observation()
        failed = F.count("error") if "error" in judged.columns else F.lit(0).cast("long")
        judged.observe(seen, F.count(F.lit(1)).alias("done"), failed.alias("failed")).write.mode("overwrite").parquet(f"{results}/batch_id={batch_id}")
        ids.close(batch_id)
        if progress:
            progress(batch_id, seen.get["done"], seen.get["failed"])
        if steps:
            before, now = done_so_far[0], done_so_far[0] + seen.get["done"]
            done_so_far[:] = now, done_so_far[1] + seen.get["failed"]
            for n in range((before // every + 1) * every, now + 1, every):
                steps(Progress(n, total, done_so_far[1], time.monotonic() - began))

    return orders.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def once_within(orders: DataFrame, at: str, delay: str) -> DataFrame:
    """Each order once, with state bounded by an event-time watermark."""
    return orders.withWatermark(at, delay).dropDuplicatesWithinWatermark(["order_id"])
