"""The verdicts of orders: by photos' keywords (v1), and by placement (v2)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sealstone.checkpoints import saved
from sealstone.functions import geometry as G
from sealstone.functions import text as T
from sealstone.operators import faces, grid, photos, seals
from sealstone.rules import ANGLE_MAX, FRONT_MIN_RATIO, TOLERANCE
from sealstone.schema import VERDICT


def first_stamp(of: DataFrame) -> DataFrame:
    """order_id and stamp (time, place) of the first photo that was fetched, even if nothing can be read from it."""
    first = of.where("status = 'ok'").groupBy("order_id").agg(F.min_by("stamp_texts", "image_idx").alias("stamp"))
    return first.withColumn("stamp", T.parse_stamp(F.col("stamp")))


def verdict_v1(orders: DataFrame, of: DataFrame) -> DataFrame:
    """For each order: 1 if a photo has a seal keyword, the keyword and the paste error of the first such photo, and the stamp.

    orders keep all their columns and repeated rows; photos: order_id, image_idx, status, detections, stamp_texts.
    """
    text = T.joined(F.col("detections"))
    read = of.where("status = 'ok'").select("order_id", "image_idx", T.keyword_hit(text).alias("keyword"), T.keyword_cooccur(text).alias("paste_error"), T.parse_stamp(F.col("stamp_texts")).alias("stamp"))
    hit = F.when(F.col("keyword").isNotNull(), F.struct("image_idx", "keyword", "paste_error"))
    found = read.groupBy("order_id").agg(F.min(hit).alias("hit"), F.min_by("stamp", "image_idx").alias("stamp"))
    new = [F.col("hit").isNotNull().cast("int").alias("seal_exists"), F.coalesce("hit.keyword", F.lit("")).alias("keyword"), F.coalesce("hit.paste_error", F.lit(0)).alias("paste_error"), F.coalesce("stamp.time", F.lit("")).alias("stamp_time"), F.coalesce("stamp.place", F.lit("")).alias("stamp_place")]
    return orders.join(found, "order_id", "left").select(*[F.col(c) for c in orders.columns], *new)


def best_photos(of: DataFrame, front_ratio: float = FRONT_MIN_RATIO) -> DataFrame:
    """One row for each order: best, the front photo with a seal and the largest box (the first of equals); dealer, the first dealer-only text;
    stamp."""
    box, w, h = F.col("box"), F.col("img_w"), F.col("img_h")
    candidate = T.photo_has_seal(F.col("detections")) & photos.is_front(box, w, h, front_ratio)
    # What the winner needs goes along with its rank: one aggregation, no join back.
    carried = F.struct(photos.box_ratio(box, w, h).alias("ratio"), (-F.col("image_idx")).alias("first"))
    row = F.struct("image_idx", "img_w", "img_h", "box", "detections", *[c for c in ("quads", "contour", "foreign") if c in of.columns])
    ok = of.where("status = 'ok'").withColumn("_rank", F.when(candidate, carried)).withColumn("_dealer", T.dealer_only(F.col("detections")))
    found = ok.groupBy("order_id").agg(
        F.max_by(F.when(F.col("_rank").isNotNull(), row), F.col("_rank")).alias("best"),
        F.min_by("_dealer", F.when(F.col("_dealer").isNotNull(), F.col("image_idx"))).alias("dealer"),
        F.min_by("stamp_texts", "image_idx").alias("stamp"),
    )
    return found.withColumn("stamp", T.parse_stamp(F.col("stamp")))


def foreign_photos(orders: DataFrame, of: DataFrame, rules: DataFrame, pixels: DataFrame, front_ratio: float = FRONT_MIN_RATIO, tile: int = grid.TILE) -> DataFrame:
    """(order_id, image_idx) of the chosen photos with a foreign sticker, by their rule's colour check.

    pixels: order_id, image_idx, x, y, h, s, v, dense in the frame of the box. Two phases: the best photos of orders whose rule has its colour check
    enabled are chosen first, and only their pixels are kept before anything is grouped; then those are judged by the rule's mode and thresholds.
    """
    box, w, h = F.col("box"), F.col("img_w"), F.col("img_h")
    front = of.where("status = 'ok'").where(T.photo_has_seal(F.col("detections")) & photos.is_front(box, w, h, front_ratio))
    best = front.groupBy("order_id").agg(F.max_by("image_idx", F.struct(photos.box_ratio(box, w, h), -F.col("image_idx"))).alias("image_idx"))
    return foreign_among(orders, best, rules, lambda own: pixels.join(own.hint("merge"), ["order_id", "image_idx"], "left_semi"), tile)


def foreign_among(orders: DataFrame, best: DataFrame, rules: DataFrame, pixels_of: Callable[[DataFrame], DataFrame], tile: int = grid.TILE) -> DataFrame:
    """foreign_photos where the best photos (order_id, image_idx) are known. pixels_of takes those whose colour is checked and gives their pixels."""
    checked = photos.with_rules(orders, rules).where(photos.known(F.col("lob")) & F.col("color")["enabled"]).select("order_id", "color").dropDuplicates(["order_id"])
    own = best.join(checked.hint("merge"), "order_id").select(F.struct("order_id", "image_idx").alias("image"), "color.*")
    own = saved(own.withColumn("mode", F.coalesce("mode", F.lit("white_box"))), "foreign-rules")
    wanted = pixels_of(own.select("image.*")).select(F.struct("order_id", "image_idx").alias("image"), "x", "y", "h", "s", "v")
    found = grid.foreign_patches(grid.masked(grid.inset(saved(wanted, "foreign-pixels")), own), own, tile)
    return found.select("image.*").distinct()


def verdict_v2(
    orders: DataFrame, of: DataFrame, rules: DataFrame, double_seal_policy: str = "accept", tolerance: float = TOLERANCE, angle_max: float = ANGLE_MAX, front_ratio: float = FRONT_MIN_RATIO
) -> DataFrame:
    """One verdict (the columns of schema.VERDICT) beside each order's own columns.

    photos: order_id, image_idx, img_w, img_h, status, detections, stamp_texts, box and, where known, quads (candidate faces: array of
    struct(source, pts)), contour (the largest: array of points) and foreign (whether a foreign patch was found, see foreign_photos). All photos are aggregated by order; those of
    unknown product lines are dropped after the join. One exchange on order_id for each of the tables. Orders without photos, null ids and null
    product lines get verdicts too. double_seal_policy: accept, or reject_single_only. tolerance: of zones; angle_max: degrees that a seal may be
    turned by; front_ratio: the share of the image that a box must have.
    """
    return judged(orders, best_photos(of, front_ratio), rules, double_seal_policy, tolerance, angle_max)


def judged(orders: DataFrame, best: DataFrame, rules: DataFrame, double_seal_policy: str = "accept", tolerance: float = TOLERANCE, angle_max: float = ANGLE_MAX) -> DataFrame:
    """verdict_v2 where the best photos are known, as best_photos gives them."""
    found, has = photos.with_rules(orders.join(best, "order_id", "left"), rules), best.schema["best"].dataType.names
    b, quads = F.col("best"), "quads" in has or "contour" in has
    known = photos.known(F.col("lob"))
    staged = found.withColumn("best", F.when(known, F.col("best")))
    if quads:
        centers = seals.seal_centers(b["detections"])
        none = F.array().cast("array<struct<source:string,pts:array<struct<x:double,y:double>>>>")
        candidates = faces.prepared(F.coalesce(b["quads"], none), F.col("lob")) if "quads" in has else none
        contour = b["contour"] if "contour" in has else None
        rect = faces.rectified(candidates, centers, F.col("aspect_lo"), F.col("aspect_hi"), b["box"], b["img_w"], b["img_h"], contour)
    else:  # without candidate faces there is nothing to rectify
        rect = faces.axis_aligned(b["box"])
    staged = staged.withColumn("rect", F.when(b.isNotNull(), rect))
    r = F.col("rect")
    into = (lambda p: G.mapped(p, r["matrix"], b["box"]["x"], b["box"]["y"])) if quads else (lambda p: G.moved(p, b["box"]["x"], b["box"]["y"]))
    moved = F.transform(b["detections"], lambda d: F.struct(d["text_idx"].alias("text_idx"), d["text"].alias("text"), into(d["poly"]).alias("poly")))
    staged = staged.withColumn("dets", moved).withColumn("seals", seals.find_seals(F.col("dets")))
    staged = staged.withColumn("main", seals.main_seal(F.col("seals"), r["w"], r["h"], F.col("scan_zones")))
    staged = staged.withColumn("place", F.when(F.col("main").isNotNull(), seals.placement(F.col("dets"), F.col("main"), r["w"], r["h"], F.col("scan_zones"), tolerance, angle_max)))
    height = F.when(r["h"] > 0, r["h"]).otherwise(b["img_h"])
    staged = staged.withColumn("dual", seals.dual_status(seals.distinct_seals(F.col("seals"), height), seals.any_auth(F.col("dets")), F.col("sticker_count")))
    staged = staged.withColumn("auth", seals.auth_position(F.col("dets"), r["w"], r["h"], F.col("auth_zones"), tolerance))

    place, dual, auth = F.col("place"), F.col("dual"), F.col("auth")
    foreign = F.coalesce(b["foreign"], F.lit(False)) & F.coalesce(F.col("color")["enabled"], F.lit(False)) if "foreign" in has else F.lit(False)
    second = dual["has_auth"] & F.col("auth_zones").isNotNull()
    twice = F.lit(1) if double_seal_policy == "accept" else (F.col("sticker_count") != "single_only").cast("int")

    def verdict(compliant, exists, position, code, detail, why: Column | str, seen: bool = True) -> Column:
        as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
        return F.struct(as_col(compliant).alias("is_compliant"), as_col(exists).alias("seal_exists"), as_col(position).alias("position_valid"), as_col(code).alias("dual_code"), as_col(detail).alias("detail"), as_col(why).alias("dual_detail"), F.lit(seen).alias("placed"))

    skipped = "skipped"
    told = F.concat(F.lit("["), r["method"], F.lit("] "), place["detail"])
    there = lambda what: F.concat(F.lit(f"second seal {what} ("), T.placed(auth["rel_x"], auth["rel_y"]), F.lit(")"))
    exits = (
        F.when(~known, verdict(0, 0, -1, -1, "unknown product line", skipped, False))
        .when(b.isNull() & F.col("dealer").isNotNull(), verdict(0, 0, 0, -1, F.concat(F.lit("dealer's own sticker: "), F.substring("dealer", 1, 50)), skipped, False))
        .when(b.isNull(), verdict(0, 0, -1, -1, "no photo of the front with a seal", skipped, False))
        .when(foreign, verdict(0, 1, 4, -1, "foreign sticker", skipped, False))
        .when(F.col("main").isNull(), verdict(0, 0, -1, -1, "seal not located", skipped, False))
        .when(place["position_valid"] != 1, verdict(0, 1, place["position_valid"], -1, told, skipped))
        .when(dual["code"] == 2, verdict(twice, 1, 1, 2, told, dual["detail"]))
        .when(dual["code"] == 3, verdict(0, 1, 1, 3, told, dual["detail"]))
        .when(second & ~auth["found"], verdict(1, 1, 1, 0, told, "second seal outside the box"))
        .when(second & ~auth["ok"], verdict(0, 1, 1, 1, told, there("misplaced")))
        .when(second, verdict(1, 1, 1, 1, told, there("in place")))
        .otherwise(verdict(1, 1, 1, dual["code"], told, dual["detail"]))
    )
    staged = staged.withColumn("v", exits)
    seen = b.isNotNull() & known
    placed = lambda c: F.when(F.col("v.placed"), place[c])
    out = {
        "lob": F.col("lob"), "is_compliant": F.col("v.is_compliant"), "seal_exists": F.col("v.seal_exists"), "position_valid": F.col("v.position_valid"),
        "rel_x": placed("rel_x"), "rel_y": placed("rel_y"), "sticker_angle": placed("angle"), "box_method": b["box"]["method"],
        "rectify_method": F.coalesce(r["method"], F.lit("axis_aligned")), "box_quad_src": F.when(seen, G.corners_json(r["corners"])),
        "color_checked": F.when(seen, F.coalesce(F.col("color")["enabled"], F.lit(False)).cast("int")).otherwise(0),
        "color_mode": F.when(seen & F.col("color")["enabled"], F.col("color")["mode"]).otherwise(""),
        "detail": F.col("v.detail"), "dual_code": F.col("v.dual_code"), "dual_detail": F.col("v.dual_detail"),
        "stamp_time": F.when(known, F.coalesce("stamp.time", F.lit(""))).otherwise(""), "stamp_place": F.when(known, F.coalesce("stamp.place", F.lit(""))).otherwise(""),
    }
    return staged.select(*[F.col(c) for c in orders.columns if c != "lob"], *[out[c].alias(c) for c in VERDICT])


def failures(recognised: DataFrame) -> DataFrame:
    """(order_id, error) of the orders with a photo of which the recogniser failed, from what sources.hooks.recognised returns; the error
    is that of the first such photo."""
    return recognised.where("error is not null").groupBy("order_id").agg(F.min_by("error", "image_idx").alias("error"))


#: What a failed order's row has in these columns; texts say ERROR, all else is null.
FAILED = {"seal_exists": -1, "position_valid": -1, "paste_error": -1, "dual_code": -1, "detail": "ERROR", "dual_detail": "ERROR", "keyword": "ERROR", "stamp_time": "ERROR", "stamp_place": "ERROR"}


def quarantined(verdicts: DataFrame, failed: DataFrame) -> DataFrame:
    """Verdicts of either version with an error column; orders in failed (order_id, error) keep their other columns and have FAILED in the
    verdict's own, whatever it said."""
    bad = failed.select(F.col("order_id").alias("_failed"), F.col("error").alias("_error"))
    own = {*FAILED, *VERDICT} - {"lob"}
    both = verdicts.join(bad, F.col("order_id") == F.col("_failed"), "left")
    keep = lambda c: F.when(F.col("_failed").isNull(), F.col(c)).otherwise(F.lit(FAILED.get(c)).cast(verdicts.schema[c].dataType)).alias(c) if c in own else F.col(c)
    return both.select(*[keep(c) for c in verdicts.columns], F.col("_error").alias("error"))
