"""Candidate faces of a photo, as an array of struct(source, pts)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sealstone.functions import geometry as G
from sealstone.rules import SPLIT_LOBS


def united(first: Column, second: Column) -> Column:
    """All candidates of both kinds, those of the first before."""
    return F.concat(first, second)


def dedup_centers(quads: Column, threshold: float = 50.0) -> Column:
    """Greedily, in order: a face stays unless a kept one's centre is closer than the threshold."""
    centered = F.transform(quads, lambda q: F.struct(G.mean_center(q["pts"]).alias("c"), q.alias("q")))
    kept = F.aggregate(centered, F.filter(centered, lambda c: F.lit(False)), lambda acc, c: F.when(F.exists(acc, lambda k: G.edge(k["c"], c["c"]) < threshold), acc).otherwise(F.concat(acc, F.array(c))))
    return kept["q"]


def top_faces(quads: Column, most: int = 8, least_area: Column | None = None) -> Column:
    """The largest faces, largest first, equals in their order."""
    keyed = F.transform(quads, lambda q, i: F.struct((-G.face_area(q["pts"])).alias("k"), i.alias("i"), q.alias("q")))
    if least_area is not None:
        keyed = F.filter(keyed, lambda k: -k["k"] >= least_area)
    return F.slice(F.array_sort(keyed), 1, most)["q"]


def prepared(quads: Column, lob: Column, split_lobs: tuple[str, ...] = SPLIT_LOBS, most: int = 8) -> Column:
    """The candidates to choose from: those of the general detection, for some product lines those of their own detection (source
    split) behind them, without near duplicates, the largest first, `most` of them."""
    of = lambda own: F.filter(quads, lambda q: (q["source"] == "split") == own)
    both = united(of(False), F.when(lob.isin(*split_lobs), of(True)).otherwise(F.filter(quads, lambda q: F.lit(False))))
    return top_faces(dedup_centers(both), most)


#: A photo's seals that are looked for in a face by compiled code; Spark interprets functions over arrays, which more seals need.
SEALS_WRITTEN_OUT = 3


def _inside(pts: Column, centers: Column) -> Column:
    """Whether a seal's centre is in the face."""
    has = lambda c: F.coalesce(G.face_contains(pts, c["x"], c["y"]), F.lit(False))
    some = reduce(lambda a, b: a | b, [has(F.get(centers, F.lit(i))) for i in range(SEALS_WRITTEN_OUT)])
    return F.when(F.size(centers) <= SEALS_WRITTEN_OUT, some).otherwise(F.coalesce(F.exists(centers, has), F.lit(False)))


def _points(inside: Column, aspect: Column, area: Column, low: Column, high: Column, img_area: Column) -> Column:
    off = F.greatest(low - aspect, aspect - high)
    shape = F.when(low.isNull() | high.isNull(), 0.0).when(off <= 0, 1.5).otherwise(F.greatest(F.lit(0.0), 1 - 0.6 * off))
    return F.when(inside, 2.0).otherwise(0.0) + shape + 0.15 * F.least(F.lit(1.0), F.sqrt(area / F.greatest(img_area, F.lit(1))))


def score(pts: Column, centers: Column, low: Column, high: Column, img_area: Column) -> Column:
    """2 if a seal's centre is inside; up to 1.5 for the aspect; up to 0.15 for the size."""
    inside = F.coalesce(F.exists(centers, lambda c: G.face_contains(pts, c["x"], c["y"])), F.lit(False))
    aspect = G.let(G.order_corners(pts), lambda c: G.face_size(c)["aspect"])
    return G.let(aspect, lambda a: _points(inside, a, G.face_area(pts), low, high, img_area))


def each_face(of: DataFrame, quads: Column, *kept: Column | str, k: str = "k", q: str = "q") -> DataFrame:
    """kept, k (its number) and q of each face. Exploded as if photos without faces had a row, which goes behind it: else Spark asks for the
    array's size before, for which it builds the faces once more, in a method that may be too long for the JVM to compile."""
    return of.select(*kept, F.posexplode_outer(quads).alias(k, q)).where(F.col(k).isNotNull())


def scored(of: DataFrame, pts: Column, centers: Column, low: Column, high: Column, img_area: Column) -> DataFrame:
    """of (one row for each face) with score: score(), but what it uses several times is a column, so that all of it is compiled."""
    kept = of.columns
    of = of.withColumn("_pts", pts).withColumn("_corners", G.order_corners(F.col("_pts"))).withColumn("_sides", G.face_sides(F.col("_corners")))
    of = of.withColumns({"_aspect": G.face_aspect(F.col("_sides.w"), F.col("_sides.h")), "_inside": _inside(F.col("_pts"), centers)})
    return of.select(*kept, _points(F.col("_inside"), F.col("_aspect"), G.face_area(F.col("_pts")), low, high, img_area).alias("score"))


def _rank(points: Column, q: Column, i: Column) -> Column:
    return F.struct(F.round(points, 9).alias("s"), G.face_area(q["pts"]).alias("a"), (-i).alias("i"))


def front_face(quads: Column, centers: Column, low: Column, high: Column, img_area: Column) -> Column:
    """The face with the highest score, then the largest, then the first; a single face is it without a score."""
    keyed = lambda cs: F.transform(quads, lambda q, i: F.struct(_rank(score(q["pts"], cs, low, high, img_area), q, i).alias("k"), q.alias("q")))
    best = G.let(centers, lambda cs: F.array_max(keyed(cs)))["q"]  # the centres once, not for each face
    return F.when(F.size(quads) == 1, F.get(quads, F.lit(0))).when(F.size(quads) > 1, best)


def front_faces(of: DataFrame, keys: list[str], quads: Column, centers: Column, low: Column, high: Column, img_area: Column) -> DataFrame:
    """keys and face, the front_face() of each photo that has faces, for many photos: its faces are rows, and a photo's keys bring them together."""
    each = each_face(of, quads, *keys, centers.alias("_centers"), low.alias("_low"), high.alias("_high"), img_area.alias("_img"), k="_i", q="_q")
    each = scored(each, F.col("_q.pts"), *map(F.col, ("_centers", "_low", "_high", "_img")))
    return each.groupBy(*keys).agg(F.max_by("_q", _rank(F.col("score"), F.col("_q"), F.col("_i"))).alias("face"))


def axis_aligned(box: Column) -> Column:
    """The last tier: the upright box itself, without a matrix."""
    upright = F.array(*[G.point(box["x"] + a * box["w"], box["y"] + b * box["h"]) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))])
    return F.struct(F.lit("axis_aligned").alias("method"), box["w"].cast("int").alias("w"), box["h"].cast("int").alias("h"), F.lit(None).cast("array<double>").alias("matrix"), upright.alias("corners"))


def rectified(quads: Column, centers: Column, low: Column, high: Column, box: Column, img_w: Column, img_h: Column, contour: Column | None = None) -> Column:
    """struct(method, w, h, matrix, corners): perspective by the front face, else by the smallest rectangle around the largest contour (any
    number of points) where that covers 8 % of the image, else the upright box."""
    nothing = F.lit(None).cast("array<struct<x:double,y:double>>")
    face = front_face(quads, centers, low, high, img_w * img_h)["pts"]
    turned = G.min_area_box(F.when(G.area(contour) >= 0.08 * img_w * img_h, contour)) if contour is not None else nothing

    def by(pts: Column, method: str) -> Column:
        def framed(cf: Column) -> Column:
            corners, frame = cf["c"], cf["f"]
            return F.struct(F.lit(method).alias("method"), frame["w"].alias("w"), frame["h"].alias("h"), G.homography(corners, frame["w"], frame["h"]).alias("matrix"), corners.alias("corners"))

        corners = G.let(pts, G.order_corners)
        found = G.let(G.let(corners, lambda c: F.struct(c.alias("c"), G.target_frame(c).alias("f"))), framed)
        return F.when(pts.isNotNull(), G.let(found, lambda r: F.when(r["matrix"].isNotNull(), r)))

    return F.coalesce(G.let(face, lambda p: by(p, "perspective")), G.let(turned, lambda p: by(p, "rotation")), axis_aligned(box))
