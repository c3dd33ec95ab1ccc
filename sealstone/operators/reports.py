"""Counts and rates over verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sealstone.checkpoints import saved


def summary(verdicts: DataFrame) -> DataFrame:
    """The run's counts in one pass."""
    n = lambda c: F.count_if(c)
    p, d = F.col("position_valid"), F.col("dual_code")
    counts = {
        "total": F.count("*"), "compliant": n(F.col("is_compliant") == 1), "not_compliant": n(F.col("is_compliant") == 0), "with_seal": n(F.col("seal_exists") == 1),
        "in_place": n(p == 1), "misplaced": n(p == 0), "flat": n(p == 2), "turned": n(p == 3), "foreign": n(p == 4), "no_front_photo": n(p == -1), "dual": n(d == 1), "double_seal": n(d == 2),
    }
    return verdicts.agg(*[c.alias(k) for k, c in counts.items()])


def summary_v1(verdicts: DataFrame) -> DataFrame:
    s = F.col("seal_exists")
    return verdicts.agg(F.count_if(s == 1).alias("with_seal"), F.count_if(s == 0).alias("without_seal"), F.count_if(s == -1).alias("failed"), F.count_if(F.col("paste_error") == 1).alias("paste_errors"))


def distribution(verdicts: DataFrame, column: str) -> DataFrame:
    """Rows by value, null as a value, the most frequent first."""
    return verdicts.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def distributions(verdicts: DataFrame) -> DataFrame:
    """By product line and by method of rectification, in one pass."""
    return verdicts.groupingSets([["lob"], ["rectify_method"]], "lob", "rectify_method").agg(F.grouping("lob").alias("not_by_lob"), F.count("*").alias("n"))


def rate_by_lob(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("lob").agg(F.count("*").alias("n"), F.round(F.avg("is_compliant"), 6).alias("rate"))


def throughput(events: DataFrame, order: list[str], time: str, every: int = 50, by: list[str] = ()) -> DataFrame:
    """Each `every`-th completion: how many are done and which share of all (percent), the average seconds of one since the first, and the hours
    that the rest will take at that pace (eta_h).

    Without `by` (a day, a worker), ranges of the order are numbered each by itself, on top of the rows before it.
    """
    n, begins = F.lit(0), F.lit(None)
    totals = events.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.count("*").alias("_total"))
    if not by:
        events = saved(events.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
        before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
        sizes = events.groupBy("_range").agg(F.count("*").alias("_n"), F.min(time).alias("_t"))
        starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.min("_t").over(before).alias("_begun"))
        events, n, begins = events.join(F.broadcast(starts), "_range"), F.col("_before"), F.col("_begun")
    w = Window.partitionBy(*(by or ["_range"])).orderBy(*order)
    begun = F.least(begins, F.min(time).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    seconds = F.col(time).cast("timestamp").cast("double") - begun.cast("timestamp").cast("double")
    numbered = events.select("*", (F.row_number().over(w) + n).alias("done"), seconds.alias("_s"))
    steps = numbered.where(F.col("done") % every == 0)
    steps = steps.join(totals, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])) if by else steps.crossJoin(F.broadcast(totals))  # one row
    pace = F.col("_s") / F.col("done")
    left = (F.col("_total") - F.col("done")) * pace / 3600
    return steps.select(*by, "done", F.round(pace, 4).alias("avg_s"), F.round(left, 4).alias("eta_h"), F.round(100 * F.col("done") / F.col("_total"), 4).alias("percent"))
