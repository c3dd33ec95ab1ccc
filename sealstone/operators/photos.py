"""Orders and photos: unpivot, product lines, candidate photos."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sealstone.functions.text import strip
from sealstone.rules import FRONT_MIN_RATIO, UNKNOWN_LOB

PHOTO_COLUMNS = ("img_1", "img_2", "img_3", "img_4")


def unpivot_photos(orders: DataFrame, columns=PHOTO_COLUMNS, clean: bool = False) -> DataFrame:
    """(order_id, image_idx, url): one row for each photo; the index is the column's place, absent columns are skipped, null and
    empty urls dropped. clean: also blank urls and the literal nan."""
    there = [F.struct(F.lit(i).alias("image_idx"), F.col(c).alias("url")) for i, c in enumerate(columns, 1) if c in orders.columns]
    rows = orders.select("order_id", F.explode(F.array(*there)).alias("p")).select("order_id", "p.*").where("url <> ''")
    return rows.where((F.trim("url") != "") & (F.col("url") != "nan")) if clean else rows


def with_rules(orders: DataFrame, rules: DataFrame) -> DataFrame:
    """Orders with their rule; lob becomes the rule's name, or UNKNOWN_LOB. The rule book has a row for each product line, so it is
    joined by name; Spark broadcasts it by its size."""
    book = rules.select(F.col("lob").alias("_lob"), *[c for c in rules.columns if c != "lob"])
    joined = orders.join(book, strip(F.col("lob")) == F.col("_lob"), "left")
    return joined.withColumn("lob", F.coalesce("_lob", F.lit(UNKNOWN_LOB))).drop("_lob")


def known(lob: Column) -> Column:
    return lob != UNKNOWN_LOB


def box_ratio(box: Column, img_w: Column, img_h: Column) -> Column:
    return box["w"] * box["h"] / F.greatest(img_w * img_h, F.lit(1))


def is_front(box: Column, img_w: Column, img_h: Column, least: float = FRONT_MIN_RATIO) -> Column:
    """Whether a box was found, and is large enough, for a photo to show the whole front."""
    return F.coalesce((box["method"] != "fallback") & (box_ratio(box, img_w, img_h) >= least), F.lit(False))


def resume(orders: DataFrame, done: DataFrame, retry_errors: bool = False) -> DataFrame:
    """Orders whose id isn't in `done`; a null id matches a null id, and repeated orders all stay. retry_errors: those whose result has an
    error are done anew."""
    finished = done.where("error is null") if retry_errors and "error" in done.columns else done
    ids = finished.select(F.col("order_id").alias("_done")).distinct()
    return orders.join(ids, F.col("order_id").eqNullSafe(F.col("_done")), "left_anti")


def tiered_box(contours: DataFrame, photos: DataFrame, least_area: float = 0.08, tops: dict | None = None) -> DataFrame:
    """The box of each photo: of the 10 largest edge contours (tier 0) the first that is large and not too long, else of the 5
    largest colour contours (tier 1), else the whole image.

    contours: order_id, image_idx, tier, nth, area, bx, by, bw, bh; photos: order_id, image_idx, img_w, img_h.
    """
    tops = tops or {0: 10, 1: 5}
    both = contours.join(photos.select("order_id", "image_idx", "img_w", "img_h"), ["order_id", "image_idx"])
    size = F.col("img_w") * F.col("img_h")
    aspect = F.col("bw") / F.greatest(F.col("bh"), F.lit(1))
    fits = (F.col("area") >= least_area * size) & aspect.between(0.2, 5.0) & F.when(F.col("tier") == 0, F.col("bw") * F.col("bh") >= least_area * size).otherwise(F.lit(True))
    ranked = both.groupBy("order_id", "image_idx", "tier").agg(F.collect_list(F.struct((-F.col("area")).alias("k"), "nth", fits.alias("fits"), "bx", "by", "bw", "bh")).alias("c"))  # contours of one photo
    top = reduce(lambda w, t: w.when(F.col("tier") == t, F.slice(F.array_sort("c"), 1, tops[t])), tops, F)
    first = F.get(F.filter(top, lambda c: c["fits"]), F.lit(0))
    picked = ranked.select("order_id", "image_idx", "tier", first.alias("c")).where("c is not null")
    best = picked.groupBy("order_id", "image_idx").agg(F.min(F.struct("tier", "c")).alias("b"))
    method = F.when(F.col("b").isNull(), "fallback").when(F.col("b.tier") == 0, "edge").otherwise("bright")
    whole = {"bx": F.lit(0), "by": F.lit(0), "bw": F.col("img_w"), "bh": F.col("img_h")}
    box = F.struct(*[F.coalesce(F.col(f"b.c.{c}"), whole[c]).cast("int").alias(c[1]) for c in whole], method.alias("method"))
    return photos.join(best, ["order_id", "image_idx"], "left").select("order_id", "image_idx", box.alias("box"))
