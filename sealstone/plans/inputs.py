"""The queries' inputs: orders, photos, text boxes, faces, stamps and pixels, derived from the given tables by whole-number arithmetic.

One text serves both engines; DIV stands for whole-number division.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sealstone.checkpoints import saved
from sealstone.functions.geometry import point

VIEWS = {
    "fx_orders": """
SELECT CAST(o_orderkey AS STRING) AS order_id, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CASE o_custkey % 7 WHEN 0 THEN 'iPhone' WHEN 1 THEN ' Watch '
  WHEN 2 THEN 'AirPods' WHEN 3 THEN 'Accy.' WHEN 4 THEN 'iPad' WHEN 5 THEN 'Mac' ELSE 'Vision' END END AS lob FROM orders""",
    "fx_boxes": """
SELECT CAST(l_orderkey AS STRING) AS order_id, CAST((l_linenumber - 1) % 4 + 1 AS INT) AS image_idx,
  CAST(row_number() OVER (PARTITION BY l_orderkey, (l_linenumber - 1) % 4 ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity, l_linenumber) - 1 AS INT) AS text_idx,
  CASE l_suppkey % 8 WHEN 0 THEN '扫码即领' WHEN 1 THEN '扫码即领' WHEN 2 THEN '扫码即领 1000' WHEN 3 THEN 'Apple授权专营店' WHEN 4 THEN '授权经销商'
    WHEN 5 THEN ' AUTHORIZED Reseller' WHEN 6 THEN 'iPhone 15' ELSE 'made in cn' END AS text,
  100 + (l_partkey * 37) % 520 AS cx, 80 + (l_suppkey * 53) % 420 AS cy, 10 + CAST(floor(l_quantity) AS INT) AS hw, 5 + (l_linenumber - 1) % 4 AS hh, (l_partkey % 21) - 10 AS sk
FROM lineitem""",
    "fx_photos": """
SELECT order_id, image_idx, 1000 AS img_w, 800 AS img_h, 200 + (sum(cx) % 5) * 80 AS w, 160 + (sum(cy) % 5) * 80 AS h,
  CASE WHEN sum(cx) % 10 = 0 THEN 'fallback' WHEN sum(cx) % 10 <= 2 THEN 'bright' ELSE 'edge' END AS method, min(cx) % 17 AS j,
  lpad(CAST(min(cx) % 24 AS STRING), 2, '0') || ':' || lpad(CAST(min(cy) % 60 AS STRING), 2, '0') || ' | 2024-01-0' || CAST(image_idx AS STRING) AS stamp_1,
  '西安' || repeat('x', CAST(min(cx) % 8 AS INT)) AS stamp_2
FROM fx_boxes GROUP BY order_id, image_idx""",
    "fx_stamps": """
SELECT CAST(o_orderkey AS STRING) AS order_id, lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':' || lpad(CAST(o_custkey % 60 AS STRING), 2, '0') || ' | ' || substr(CAST(o_orderdate AS STRING), 1, 10) AS stamp_1,
  '| ' AS stamp_2, '西安' || repeat('x', CAST(o_orderkey % 8 AS INT)) AS stamp_3, o_orderpriority AS stamp_4 FROM orders""",
    "fx_pixels": """
SELECT rn DIV 1600 AS image, CAST(rn % 40 AS INT) AS x, CAST((rn DIV 40) % 40 AS INT) AS y, CASE WHEN b THEN 100 ELSE 15 END AS h,
  CAST(CASE WHEN b THEN 200 ELSE 20 END + pk % 10 AS INT) AS s, CASE WHEN b THEN 120 ELSE 200 END AS v
FROM (SELECT rn, pk, ((rn % 40) DIV 8 + ((rn DIV 40) % 40) DIV 8 + rn DIV 1600) % 5 = 0 AS b
  FROM (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS rn, l_partkey AS pk FROM lineitem) n) m""",
    "fx_done": "SELECT order_id FROM fx_orders WHERE CAST(order_id AS BIGINT) % 3 = 0",
}
NEEDS = {"fx_orders": "orders", "fx_boxes": "lineitem", "fx_stamps": "orders", "fx_pixels": "lineitem"}


#: How fx_boxes numbers the boxes of a photo.
BOX_ORDER = ("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_linenumber")
_NTH = f"CAST(row_number() OVER (PARTITION BY l_orderkey, (l_linenumber - 1) % 4 ORDER BY {', '.join(BOX_ORDER)}) - 1 AS INT) AS text_idx"
_ORDER_ID = "CAST(l_orderkey AS STRING) AS order_id"
_IMAGE_IDX = "CAST((l_linenumber - 1) % 4 + 1 AS INT) AS image_idx"
#: How fx_pixels numbers the rows of lineitem.
PIXEL_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
_NUMBERED = f"(SELECT row_number() OVER (ORDER BY {', '.join(PIXEL_ORDER)}) - 1 AS rn, l_partkey AS pk FROM lineitem)"


def numbered(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """df with rn, its rows' number in this order from 0: each range of the order is numbered by itself, on top of the rows before it."""
    dealt = saved(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))  # a row for each range
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("_range", before.alias("_before")))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return dealt.withColumn("_rank", rank).join(starts, "_range").withColumn("rn", F.col("_rank") + F.col("_before")).drop("_range", "_rank", "_before")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of VIEWS; what it reads is passed by name, so that no view is left in the session."""
    text = VIEWS[name].replace("DIV", "div")
    source = NEEDS.get(name)
    of = spark.read.parquet(f"{sf_dir}/{source}.parquet") if source else view(spark, sf_dir, "fx_boxes" if name == "fx_photos" else "fx_orders")
    source = source or ("fx_boxes" if name == "fx_photos" else "fx_orders")
    if name == "fx_pixels":  # the same numbers as its SQL's, but not in one task
        of = numbered(of.select(*PIXEL_ORDER), PIXEL_ORDER)
        assert _NUMBERED in text
        text = text.replace(_NUMBERED, "(SELECT rn, l_partkey AS pk FROM lineitem)")
    return spark.sql(text.replace(f"FROM {source}", "FROM {source}"), source=of)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_orders")


def polygon(closed: bool = False) -> Column:
    """A text box's four points; closed: with the first once more behind them."""
    cx, cy, hw, hh, sk = (F.col(c) for c in ("cx", "cy", "hw", "hh", "sk"))
    pts = [point(cx - hw, cy - hh - sk), point(cx + hw, cy - hh + sk), point(cx + hw, cy + hh + sk), point(cx - hw, cy + hh - sk)]
    return F.array(*pts, *(pts[:1] if closed else ()))


#: Where each box begins.
BOX_AT = (100, 80)


def _box(sx: Column, sy: Column) -> Column:
    method = F.when(sx % 10 == 0, "fallback").when(sx % 10 <= 2, "bright").otherwise("edge")
    return F.struct(F.lit(BOX_AT[0]).alias("x"), F.lit(BOX_AT[1]).alias("y"), (200 + (sx % 5) * 80).cast("int").alias("w"), (160 + (sy % 5) * 80).cast("int").alias("h"), method.alias("method"))


def _stamp(low: Column, low_y: Column) -> Column:
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.array(F.concat(two(low % 24), F.lit(":"), two(low_y % 60), F.lit(" | 2024-01-0"), F.col("image_idx").cast("string")), F.concat(F.lit("西安"), F.repeat(F.lit("x"), (low % 8).cast("int"))))


def photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Photos with their text boxes nested; the boxes of one photo are few. One exchange, on order_id, serves the photos and what joins them."""
    text = VIEWS["fx_boxes"]
    assert _NTH in text  # the same order as its SQL's, but sorted within the photo
    text = text.replace(_NTH, f"struct({', '.join(BOX_ORDER)}) AS nth").replace("FROM lineitem", "FROM {lineitem}")
    b = spark.sql(text, lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet")).repartition("order_id").withColumn("poly", polygon())
    low = F.min("cx")
    boxes = F.sort_array(F.collect_list(F.struct("nth", "text", "poly")))
    numbered = F.transform(boxes, lambda d, i: F.struct(i.alias("text_idx"), d["text"].alias("text"), d["poly"].alias("poly")))
    return b.groupBy("order_id", "image_idx").agg(
        F.lit("ok").alias("status"), F.lit(1000).alias("img_w"), F.lit(800).alias("img_h"), _box(F.sum("cx"), F.sum("cy")).alias("box"), (low % 17).cast("int").alias("j"),
        _stamp(low, F.min("cy")).alias("stamp_texts"), numbered.alias("detections"),
    )


def ringed_photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """photos() with the boxes' polygons closed to rings. The rows are exchanged and sorted as they are read, before anything is made of them.
    The sort brings a photo's boxes together in their order, so that its windows collect them; grouping does it in two steps, and sorts each
    photo's list by interpreted code."""
    text = VIEWS["fx_boxes"]
    assert _ORDER_ID in text and _IMAGE_IDX in text and _NTH in text  # the same as its SQL's, but numbered after the sort
    text = text.replace(_ORDER_ID, "order_id").replace(_IMAGE_IDX, "image_idx").replace(_NTH, ", ".join(BOX_ORDER)).replace("FROM lineitem", "FROM {rows}")
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.expr(_ORDER_ID), *BOX_ORDER).repartition("order_id")
    rows = rows.select("order_id", F.expr(_IMAGE_IDX), *BOX_ORDER).sortWithinPartitions("order_id", "image_idx", *BOX_ORDER)
    before = Window.partitionBy("order_id", "image_idx").orderBy(*BOX_ORDER)
    b = spark.sql(text, rows=rows).withColumn("text_idx", F.row_number().over(before) - 1).withColumn("poly", polygon(closed=True))
    ofs = {"sx": F.sum("cx"), "sy": F.sum("cy"), "low": F.min("cx"), "low_y": F.min("cy"), "detections": F.collect_list(F.struct("text_idx", "text", "poly"))}
    of_photo = before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    p = b.select("order_id", "image_idx", "text_idx", *[v.over(of_photo).alias(k) for k, v in ofs.items()]).where("text_idx = 0")
    return p.select(
        "order_id", "image_idx", F.lit("ok").alias("status"), F.lit(1000).alias("img_w"), F.lit(800).alias("img_h"), _box(F.col("sx"), F.col("sy")).alias("box"),
        (F.col("low") % 17).cast("int").alias("j"), _stamp(F.col("low"), F.col("low_y")).alias("stamp_texts"), "detections",
    )


def faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Photos with quads, three candidate faces of each photo's box, two of which are near duplicates. The boxes' polygons are closed rings,
    whose mean isn't the middle of their bounding box."""
    x, y, w, h, j = F.col("box.x"), F.col("box.y"), F.col("box.w"), F.col("box.h"), F.col("j")

    def one(k: int) -> Column:
        d = 120 if k == 2 else 0
        pts = F.array(point(x + 11 * k + d, y + 7 * k), point(x + w - 5 * k + d, y + 3 * k + j), point(x + w - 3 * k + d, y + h - 9 * k), point(x + 2 * k + j + d, y + h - 4 * k))
        return F.struct(F.lit("split" if k == 1 else "edge").alias("source"), pts.alias("pts"))

    return ringed_photos(spark, sf_dir).withColumn("quads", F.array(*map(one, range(3))))


def faced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Photos of each way to be rectified: the first and third with four candidate faces, one of them a near duplicate and one of a line's own
    detection; the second with a contour, a turned rectangle with a dent; the fourth with neither. All stand off whole
    numbers, so that no result is a tie."""
    x, y = (at + 0.25 for at in BOX_AT)
    sides = {"_w": F.col("box.w"), "_h": F.col("box.h"), "_j": F.col("j"), "_a": F.floor(F.col("box.w") / 5), "_b": F.floor(F.col("box.h") / 5)}
    w, h, j, a, b = (F.col(c) for c in sides)  # whole numbers and quarters: sums are exact in any order, and few, so that the JVM compiles them

    def one(k: int, d: int, e: int, source: str) -> Column:
        pts = F.array(point(F.lit(x + 11 * k + d), F.lit(y + 7 * k + e)), point(w + (x - 5 * k + d), j + (y + 3 * k + e)), point(w + (x - 3 * k + d), h + (y - 9 * k + e)), point(j + (x + 2 * k + d), h + (y - 4 * k + e)))
        return F.struct(F.lit(source).alias("source"), pts.alias("pts"))

    def sum_of(start: float, *terms: tuple[Column, float]) -> Column:
        return reduce(lambda s, t: s + (t[0] if t[1] == 1 else t[0] * t[1]), [t for t in terms if t[1]], F.lit(start))

    at = lambda u, v: point(sum_of(x + 0.25, (b, 3 - 3 * v), (a, 4 * u)), sum_of(y + 0.25, (a, 3 * u), (b, 4 * v)))
    quads = F.array(one(0, 0, 0, "edge"), one(0, 9, 5, "edge"), one(1, 0, 64, "split"), one(2, 120, 0, "edge"))
    contour = F.array(at(0, 0), at(0.5, 0.25), at(1, 0), at(1, 0.5), at(1, 1), at(0, 1))
    of = ringed_photos(spark, sf_dir).withColumns({c: v.cast("double") for c, v in sides.items()})
    return of.withColumn("quads", F.when(F.col("image_idx") % 2 == 1, quads)).withColumn("contour", F.when(F.col("image_idx") == 2, contour)).drop(*sides)


def photo_pixels(spark: SparkSession, sf_dir: str, wanted: DataFrame | None = None) -> DataFrame:
    """fx_pixels as the frames of four photos of each fortieth order; every second of these has no coloured block. wanted (order_id, image_idx):
    only the frames of these photos, without making the others."""
    plain = (F.col("image") + F.col("image_idx")) % 2 == 0
    of, idx = view(spark, sf_dir, "fx_pixels"), F.array(*map(F.lit, range(1, 5)))
    if wanted is None:
        of = of.withColumn("image_idx", F.explode(idx))
    else:
        there = wanted.where(F.array_contains(idx, F.col("image_idx"))).select(F.col("order_id").alias("_of"), "image_idx").distinct()
        of = of.join(there.hint("merge"), (F.col("image") * 40).cast("string") == F.col("_of")).drop("_of")
    hsv = (F.when(plain, 15).otherwise(F.col("h")).alias("h"), F.when(plain, F.least("s", F.lit(29))).otherwise(F.col("s")).alias("s"), F.when(plain, 200).otherwise(F.col("v")).alias("v"))
    return of.select((F.col("image") * 40).cast("string").alias("order_id"), "image_idx", "x", "y", *hsv)


def urls(of: DataFrame) -> DataFrame:
    """order_id and four url columns, with gaps, an empty one and a literal nan."""
    url = F.when(F.col("box.method") == "fallback", "").when(F.col("j") == 3, "nan").otherwise(F.concat_ws("/", F.lit("img"), "order_id", "image_idx"))
    return of.groupBy("order_id").pivot("image_idx", [1, 2, 3, 4]).agg(F.first(url)).withColumnsRenamed({str(i): f"img_{i}" for i in range(1, 5)})
