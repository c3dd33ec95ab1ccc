"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a 48-bit hash of its id and text. Words are summed by source and by the hash's top 12 bits; the running sum over
buckets tells in which bucket a source's budget ends. Only that bucket's documents are summed again, by the next 12 bits, and
so on down to the last 12. What remains is one threshold for each source, and the documents are filtered by comparing their
hash with it: nothing is sorted, and no task ever holds more than 4,096 sums of one source. Only documents whose hash is the
threshold itself, repeats of one row, are numbered, and as many are taken as the budget has room for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sealstone.llm.common import n_words, saved, table

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3.0
LEVELS, BITS = 4, 12
#: Repeats of one row at a threshold are numbered in groups of about so many.
GROUP = 1000


def _hash48(doc_id: Column, text: Column) -> Column:
    """The first 48 bits of the MD5 of the id and the MD5 of the text; nulls hash as empty."""
    own = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(own), 1, 12), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.0, most: float = MOST_REPEATS) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources in code-point order, null last, take the weights in turn. share x all sizes is dealt by weight; what a source
    would get beyond most x its size goes to the others by weight, until none is above. That is the level L for which the sum
    of least(most x size, L x weight) is the total: sources fill up in the order of size / weight, so L is found with one
    running sum over the sources (not over documents).
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", w.alias("w")).withColumn("cap", most * F.col("source_size"))
    by_fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    level = (share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("w").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    # The first source, in this order, that the level doesn't fill ends the search; from there on none is filled.
    found = ranked.withColumn("level", level).withColumn("nth", F.row_number().over(by_fill))
    found = found.withColumn("level", F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("nth", "level"))).over(every)["level"])
    return found.select("source", "source_size", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("w"))).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.0, most: float = MOST_REPEATS, keep: Column | None = None) -> DataFrame:
    """doc_id, size, source_size, target and taken for each row of docs (doc_id, text, source), and `kept`, a struct of docs' own columns, if keep is given.

    A source whose target is r times its size takes every document floor(r) times and once more those whose hash is under the
    threshold for the fraction; so its words come within one document of the target, and no document exceeds `most` times its size.
    Null or empty texts have size 0 and take 0 words; null ids and null sources are values like others; rows with one id (or none)
    are told apart by their texts, and of rows that are equal in both some may be taken once more than others; an empty table
    gives an empty result. Other columns of docs play no part.
    """
    kept = [keep.alias("kept")] if keep is not None else []
    sized = saved(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), _hash48(F.col("doc_id"), F.col("text")).alias("h"), F.monotonically_increasing_id().alias("r"), *kept), "mix-sizes")
    goals = saved(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")
    goals = goals.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goals = goals.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # Nested thresholds: `under` is the first hash not yet known to be taken, `rest` the words still wanted from there.
    cut = goals.select("source", "rest", F.lit(0).cast("long").alias("under"))
    for level in range(LEVELS):
        step = 1 << (BITS * (LEVELS - 1 - level))
        inside = sized.select("source", "size", "h")
        if level:
            at = cut.select(F.col("source").alias("s"), "under")
            inside = inside.join(at, F.col("source").eqNullSafe(F.col("s")) & (F.col("h") >= F.col("under")) & (F.col("h") < F.col("under") + step * (1 << BITS))).select("source", "size", "h")
        sums = inside.groupBy("source", F.expr(f"h div {step}").alias("bucket")).agg(F.sum("size").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
        sums = sums.withColumn("upto", upto).join(cut.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
        # The boundary bucket is the first whose end passes the budget; at the last level a bucket is one hash.
        edge = sums.groupBy("source").agg(F.min(F.when(F.col("upto") > F.col("rest"), F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("n")).alias("rest")))).alias("edge"))
        beyond = 1 << (BITS * LEVELS)
        edge = edge.select("source", F.coalesce(F.col("edge.rest"), F.lit(0.0)).alias("rest"), F.coalesce(F.col("edge.bucket") * step, F.lit(beyond)).alias("under"))
        if level:  # a source without documents at its boundary keeps its threshold
            old = cut.select(F.col("source").alias("s"), F.col("under").alias("was"))
            edge = old.join(edge, F.col("source").eqNullSafe(F.col("s")), "left").select(
                F.col("s").alias("source"), F.coalesce("rest", F.lit(0.0)).alias("rest"),
                F.when(F.col("was") >= beyond, F.lit(beyond)).otherwise(F.when(F.coalesce(F.col("under"), F.lit(beyond)) >= beyond, F.col("was") + step * (1 << BITS)).otherwise(F.col("under"))).alias("under"))
        cut = saved(edge, f"mix-edge-{level}")
    plan = goals.join(cut.select(F.col("source").alias("s"), "under", F.col("rest").alias("left")), F.col("source").eqNullSafe(F.col("s")), "left").select(F.col("source").alias("of"), "source_size", "target", "whole", "under", "left")
    plan = saved(plan, "mix-plan")  # its size on disk tells Spark whether it may be broadcast
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("of")))
    once = rows.where("h <> under").withColumn("more", F.col("h") < F.col("under"))
    edge = _numbered(rows.where("h = under")).withColumn("more", (F.col("nth") + 0.5) * F.col("size") <= F.col("left")).drop("nth")
    passes = F.least(F.col("whole") + F.col("more").cast("long"), F.lit(int(most)))
    return once.unionByName(edge).select("doc_id", "size", "source_size", "target", (F.col("size") * passes).alias("taken"), "source", *(["kept", passes.alias("passes")] if kept else []))


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds nth, from 0, to the rows (r, source, ...) of each source, in groups of about GROUP."""
    same = F.col("source").eqNullSafe(F.col("s"))
    n = rows.groupBy(F.col("source").alias("s")).agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    dealt = rows.join(n, same).withColumn("g", F.pmod(F.xxhash64("r"), F.col("groups"))).drop("s", "groups")
    before = F.sum("n").over(Window.partitionBy("s").orderBy("_g")) - F.col("n")
    sizes = dealt.groupBy(F.col("source").alias("s"), F.col("g").alias("_g")).agg(F.count("*").alias("n")).select("s", "_g", before.alias("before"))
    nth = F.row_number().over(Window.partitionBy("source", "g").orderBy("r")) - 1
    return dealt.withColumn("nth", nth).join(sizes, same & (F.col("g") == F.col("_g"))).withColumn("nth", F.col("nth") + F.col("before")).drop("s", "_g", "g", "before")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once, or up to three times. Documents without words have size 0 and stay as
    often as their source's are taken whole; what mix says of nulls, ties, repeated rows, empty tables and other columns holds here."""
    mixed = mix(docs, keep=F.struct("*"))
    return mixed.select("kept", F.explode(F.array_repeat(F.lit(1), F.col("passes").cast("int"))).alias("copy")).select("kept.*")


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT AS h
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         3.0::DOUBLE * source_size AS cap FROM sources),
levels AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS nth, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
goals AS (
  SELECT source, source_size, least(cap, w * arg_min(level, nth) FILTER (WHERE level * w <= cap) OVER ()) AS target FROM levels),
runs AS (
  SELECT s.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END AS whole,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.h) AS n, row_number() OVER (PARTITION BY s.source, s.h) - 1 AS nth
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
edges AS (
  SELECT source, min({'h': h, 'rest': target - whole * source_size - (upto - n)}) FILTER (WHERE upto > target - whole * source_size) AS edge FROM runs GROUP BY source)
SELECT r.doc_id, r.size, r.source_size, r.target, (r.size * (r.whole + CASE WHEN e.edge IS NULL OR r.h < e.edge.h OR r.h = e.edge.h AND (nth + 0.5) * r.size <= e.edge.rest THEN 1 ELSE 0 END))::BIGINT AS taken, r.source
FROM runs r JOIN edges e ON r.source IS NOT DISTINCT FROM e.source
"""
