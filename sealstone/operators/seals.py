"""Seals of a photo, from its text boxes: arrays in, arrays and structs out, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sealstone.functions import geometry as G
from sealstone.functions import zones as Z
from sealstone.functions.text import contains_any, endpiece, number
from sealstone.rules import ANGLE_MAX, AUTH_WORDS, DEALER, SCAN, TOLERANCE


def _boxed(d: Column) -> Column:
    fields = lambda b: F.struct(d["text_idx"].alias("text_idx"), *[b[k].alias(k) for k in ("x1", "y1", "x2", "y2", "cx", "cy")], d["poly"].alias("poly"), d["text"].alias("text"))
    return G.let(G.bbox(d["poly"]), fields)


def _seals(detections: Column) -> Column:
    return F.filter(detections, lambda d: d["text"].contains(SCAN) & d["poly"].isNotNull())


def find_seals(detections: Column) -> Column:
    """The texts with the seal's keyword and a polygon, with their bounding boxes, in order."""
    return F.transform(_seals(detections), _boxed)


def seal_centers(detections: Column) -> Column:
    """The mean centres of the same, without the boxes."""
    return F.transform(_seals(detections), lambda d: G.mean_center(d["poly"]))


def find_auth(detections: Column, w: Column, h: Column) -> Column:
    """The second-seal texts whose centre lies in the frame, its edge included; everywhere if the frame has no size."""
    boxes = F.transform(F.filter(detections, lambda d: contains_any(d["text"], AUTH_WORDS) & d["poly"].isNotNull()), _boxed)
    return F.filter(boxes, lambda b: (w <= 0) | (h <= 0) | (b["cx"].between(F.lit(0), w) & b["cy"].between(F.lit(0), h)))


def main_seal(seals: Column, w: Column, h: Column, zones: Column) -> Column:
    """The seal nearest to a zone, then the highest, then the first; the first if there are no zones or the frame has no size."""

    def key(s: Column, i: Column) -> Column:
        x, y = G.relative(s["cx"], w), G.relative(s["cy"], h)
        free = zones.isNull() | (w <= 0) | (h <= 0)
        return F.struct(F.when(free, 0.0).otherwise(Z.distance(x, y, zones)).alias("d"), F.when(free, 0.0).otherwise(y).alias("y"), i.alias("i"), s.alias("s"))

    return F.array_min(F.transform(seals, key))["s"]


def flat(detections: Column, anchor: Column, w: Column, h: Column, rect: Column | None = None) -> Column:
    """Whether a seal lies flat: a text of its end piece shows in the frame, far from the anchor seal. rect: the anchor's min_area_rect, if it is known."""

    dealers = lambda d: d["text"].contains(DEALER) & ~d["text"].contains("扫码") & ~d["text"].contains("Apple")
    named = lambda d: (d["text_idx"] != anchor["text_idx"]) & d["poly"].isNotNull() & (endpiece(d["text"]) | dealers(d))

    def tells(d: Column, a: Column) -> Column:
        c, height = a["center"], a["height"]

        def far(o: Column) -> Column:
            away = G.edge(o, c)
            inside = (w <= 0) | (h <= 0) | (o["x"].between(F.lit(0), w) & o["y"].between(F.lit(0), h))
            dealer = dealers(d) & (away > 5 * height) & (F.greatest(G.min_area_rect(d["poly"])["short"], F.lit(1.0)) > 0.8 * height)
            return inside & ((endpiece(d["text"]) & (away > 2 * height)) | dealer)

        return G.let(G.mean_center(d["poly"]), far)

    # Few photos have such a text; only theirs are measured.
    rect = G.min_area_rect(anchor["poly"]) if rect is None else rect
    own = F.struct(G.mean_center(anchor["poly"]).alias("center"), F.greatest(rect["short"], F.lit(1.0)).alias("height"))
    measured = lambda ds: F.when(F.size(ds) > 0, G.let(own, lambda a: F.exists(ds, lambda d: tells(d, a))))
    return F.coalesce(G.let(F.filter(detections, named), measured), F.lit(False))


def angle_check(poly: Column, box_angle: float = 0.0, most: float = ANGLE_MAX, rect: Column | None = None) -> Column:
    """struct(ok, angle): the long axis against the box, in [-90, 90]; a polygon that can't be used is ok, with a null angle. rect: its
    min_area_rect, if it is known."""
    rect = G.min_area_rect(poly) if rect is None else rect
    wrapped = lambda d: F.when(d.between(-90.0, 90.0), d).otherwise(90 - F.pmod(90 - d, F.lit(180.0)))
    delta = G.let(rect["angle"] - box_angle, wrapped)
    return G.let(delta, lambda d: F.struct(F.coalesce(F.abs(d) <= most, F.lit(True)).alias("ok"), F.round(d, 2).alias("angle")))


def placement(detections: Column, seal: Column, w: Column, h: Column, zones: Column, tolerance: float = TOLERANCE, angle_max: float = ANGLE_MAX) -> Column:
    """struct(position_valid, rel_x, rel_y, angle, detail) of the main seal: zone (0), angle (3), flat (2), else right (1). Only a seal in its zone
    is measured, once, by its different points: a closed ring has its first twice."""

    def judged(p: Column) -> Column:
        zone, angle, code = p["zone"], p["angle"], p["code"]
        turned = F.concat(F.lit("turned by "), number(angle["angle"], 1, True), F.lit(f"°, limit ±{angle_max:.0f}°"))
        detail = F.when(code == 3, turned).when(code == 2, "flat: its end piece shows").otherwise(Z.explained(p["x"], p["y"], zone, tolerance))
        return F.struct(code.alias("position_valid"), F.round(p["x"], 4).alias("rel_x"), F.round(p["y"], 4).alias("rel_y"), F.when(zone["ok"], angle["angle"]).alias("angle"), detail.alias("detail"))

    def tested(p: Column) -> Column:
        code = F.when(~p["zone"]["ok"], 0).when(~p["angle"]["ok"], 3).when(flat(detections, seal, w, h, p["rect"]), 2).otherwise(1)
        return F.struct(*[p[k].alias(k) for k in ("x", "y", "zone", "angle")], code.alias("code"))

    xy = F.struct(G.relative(seal["cx"], w).alias("x"), G.relative(seal["cy"], h).alias("y"))
    keep = lambda p, *ks: [p[k].alias(k) for k in ks]
    zoned = G.let(xy, lambda p: F.struct(*keep(p, "x", "y"), Z.check(p["x"], p["y"], zones, tolerance).alias("zone")))
    measured = G.let(zoned, lambda p: F.struct(*keep(p, "x", "y", "zone"), F.when(p["zone"]["ok"], G.let(F.array_distinct(seal["poly"]), G.min_area_rect)).alias("rect")))
    both = G.let(measured, lambda p: F.struct(*keep(p, "x", "y", "zone", "rect"), F.when(p["zone"]["ok"], angle_check(seal["poly"], most=angle_max, rect=p["rect"])).alias("angle")))
    return G.let(G.let(both, tested), judged)


def distinct_seals(seals: Column, h: Column) -> Column:
    """How many seals there are: one counts unless it is, in height, within a fifth of the frame (50 at least) of one counted before."""
    apart = F.greatest(0.2 * h, F.lit(50.0))
    kept = F.aggregate(seals["cy"], F.array().cast("array<double>"), lambda acc, y: F.when(F.exists(acc, lambda k: F.abs(k - y) < apart), acc).otherwise(F.concat(acc, F.array(y))))
    return F.coalesce(F.size(kept), F.lit(0))


def dual_status(n_seals: Column, any_auth: Column, mode: Column) -> Column:
    """struct(code, has_auth, detail) by the number of seals, whether any text anywhere is a second seal's, and the rule's mode."""

    def coded(s: Column) -> Column:
        n, auth = s["n"], s["auth"]
        code = F.when(n <= 0, -1).when(n >= 2, 2).when(mode == "single_only", 0).when(auth, 1).when(mode == "dual_required", 3).otherwise(0)
        return F.struct(code.alias("code"), ((mode != "single_only") & auth).alias("has_auth"))

    def told(s: Column) -> Column:
        code = s["code"]
        detail = F.when(code == -1, "no seal").when(code == 2, "two seals").when(code == 1, "seal and second seal").when(code == 3, "second seal missing").otherwise("one seal")
        return F.struct(code.alias("code"), s["has_auth"].alias("has_auth"), detail.alias("detail"))

    return G.let(G.let(F.struct(n_seals.alias("n"), any_auth.alias("auth")), coded), told)


def any_auth(detections: Column) -> Column:
    return F.coalesce(F.exists(detections, lambda d: contains_any(d["text"], AUTH_WORDS)), F.lit(False))


def auth_position(detections: Column, w: Column, h: Column, zones: Column, tolerance: float = TOLERANCE) -> Column:
    """struct(found, ok, rel_x, rel_y): the first second seal in its zone, else the first of all; nothing without zones or seals."""

    def one(a: Column, i: Column) -> Column:
        x, y = G.relative(a["cx"], w), G.relative(a["cy"], h)
        ok = Z.in_any(x, y, zones, tolerance)
        return F.struct((~ok).alias("bad"), i.alias("i"), F.round(x, 4).alias("rel_x"), F.round(y, 4).alias("rel_y"))

    best = F.when(zones.isNotNull(), F.array_min(F.transform(find_auth(detections, w, h), one)))
    return G.let(best, lambda b: F.struct(b.isNotNull().alias("found"), F.coalesce(~b["bad"], F.lit(False)).alias("ok"), b["rel_x"].alias("rel_x"), b["rel_y"].alias("rel_y")))
