"""Geometry on polygons (arrays of points x, y) and 3 x 3 matrices, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, of) -> Column:
    """of(value), with the value computed once, however often `of` uses it."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def bbox(poly: Column) -> Column:
    xs, ys = poly["x"], poly["y"]
    ends = F.struct(F.array_min(xs).alias("x1"), F.array_max(xs).alias("x2"), F.array_min(ys).alias("y1"), F.array_max(ys).alias("y2"))
    return let(ends, _box)


def _box(e: Column) -> Column:
    x1, x2, y1, y2 = (e[k] for k in ("x1", "x2", "y1", "y2"))
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), ((x1 + x2) / 2).alias("cx"), ((y1 + y2) / 2).alias("cy"))


def mean_center(poly: Column) -> Column:
    mean = lambda v: F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.greatest(F.size(v), F.lit(1))
    return point(mean(poly["x"]), mean(poly["y"]))


def scaled(poly: Column, sx: Column, sy: Column) -> Column:
    return F.transform(poly, lambda p: point(p["x"] * sx, p["y"] * sy))


def order_corners(pts: Column) -> Column:
    """TL, TR, BR, BL of a face's four points, by the extremes of x + y and x - y; the first point wins, and one may be taken twice.

    Written out, without functions of arrays, so that it is compiled.
    """
    p = [F.get(pts, F.lit(i)) for i in range(4)]

    def first(key, over) -> Column:
        k = [key(x) for x in p]
        return F.when(over(k[0], k[1]) & over(k[0], k[2]) & over(k[0], k[3]), p[0]).when(over(k[1], k[2]) & over(k[1], k[3]), p[1]).when(over(k[2], k[3]), p[2]).otherwise(p[3])

    total, diff = (lambda p: p["x"] + p["y"]), (lambda p: p["x"] - p["y"])
    least, most = (lambda a, b: a <= b), (lambda a, b: a >= b)
    return F.array(first(total, least), first(diff, most), first(total, most), first(diff, least))


def edge(a: Column, b: Column) -> Column:
    dx, dy = a["x"] - b["x"], a["y"] - b["y"]
    return F.sqrt(dx * dx + dy * dy)


def face_sides(corners: Column) -> Column:
    """Width and height of ordered corners: the longer of two opposite sides each."""
    p = [corners[i] for i in range(4)]
    return F.struct(F.greatest(edge(p[0], p[1]), edge(p[3], p[2])).alias("w"), F.greatest(edge(p[0], p[3]), edge(p[1], p[2])).alias("h"))


def face_aspect(w: Column, h: Column) -> Column:
    """Long by short side, the short one at least 1."""
    return F.greatest(w, h) / F.greatest(F.least(w, h), F.lit(1.0))


def face_size(corners: Column) -> Column:
    """Width, height and aspect of ordered corners."""
    return let(face_sides(corners), lambda s: F.struct(s["w"].alias("w"), s["h"].alias("h"), face_aspect(s["w"], s["h"]).alias("aspect")))


def area(pts: Column) -> Column:
    n = F.size(pts)
    terms = F.transform(pts, lambda p, i: p["x"] * F.get(pts, (i + 1) % n)["y"] - F.get(pts, (i + 1) % n)["x"] * p["y"])
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)) / 2


def contains(pts: Column, x: Column, y: Column) -> Column:
    """Whether a convex polygon, of either sense, has the point inside or on its boundary."""
    n = F.size(pts)

    def cross(p: Column, i: Column) -> Column:
        q = F.get(pts, (i + 1) % n)
        return (q["x"] - p["x"]) * (y - p["y"]) - (q["y"] - p["y"]) * (x - p["x"])

    c = F.transform(pts, cross)
    return F.forall(c, lambda v: v >= 0) | F.forall(c, lambda v: v <= 0)


def face_area(pts: Column) -> Column:
    """area() of a face's four points, written out."""
    p = [F.get(pts, F.lit(i)) for i in range(4)]
    terms = [a["x"] * b["y"] - b["x"] * a["y"] for a, b in zip(p, p[1:] + p[:1])]
    return F.abs(terms[0] + terms[1] + terms[2] + terms[3]) / 2


def face_contains(pts: Column, x: Column, y: Column) -> Column:
    """contains() for a face's four points, written out."""
    p = [F.get(pts, F.lit(i)) for i in range(4)]
    c = [(b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"]) for a, b in zip(p, p[1:] + p[:1])]
    return (F.least(*c) >= 0) | (F.greatest(*c) <= 0)


def target_frame(corners: Column, longest: int = 1200) -> Column:
    """Whole width and height of the upright frame, shrunk so that the longer side is at most `longest`."""

    whole = lambda v: F.greatest(F.bround(v), F.lit(1.0))

    def fitted(s: Column) -> Column:
        fit = lambda v: F.when(s["scale"] < 1, whole(v * s["scale"])).otherwise(v).cast("int")
        return F.struct(fit(s["w"]).alias("w"), fit(s["h"]).alias("h"))

    rounded = lambda size: F.struct(whole(size["w"]).alias("w"), whole(size["h"]).alias("h"))
    scaled_by = lambda s: F.struct(s["w"].alias("w"), s["h"].alias("h"), (longest / F.greatest(s["w"], s["h"])).alias("scale"))
    return let(let(let(face_size(corners), rounded), scaled_by), fitted)


def homography(corners: Column, w: Column, h: Column) -> Column:
    """The matrix that takes ordered corners to (0, 0), (w-1, 0), (w-1, h-1), (0, h-1); null for a degenerate face.

    The map from the unit square to the face has a closed form; its adjugate is its inverse up to scale.
    """
    (x0, y0), (x1, y1), (x2, y2), (x3, y3) = ((corners[i]["x"], corners[i]["y"]) for i in range(4))
    dx1, dx2, dx3 = x1 - x2, x3 - x2, x0 - x1 + x2 - x3
    dy1, dy2, dy3 = y1 - y2, y3 - y2, y0 - y1 + y2 - y3
    den = dx1 * dy2 - dx2 * dy1

    def forward(gk: Column) -> Column:
        g, k = gk["g"], gk["k"]
        return F.struct(*[v.alias(n) for n, v in zip("abcdefgk", (x1 - x0 + g * x1, x3 - x0 + k * x3, x0, y1 - y0 + g * y1, y3 - y0 + k * y3, y0, g, k))])

    def inverse(m: Column) -> Column:
        a, b, c, d, e, f, g, k = (m[n] for n in "abcdefgk")
        rows = ((e - f * k, c * k - b, b * f - c * e), (f * g - d, a - c * g, c * d - a * f), (d * k - e * g, b * g - a * k, a * e - b * d))
        scale = (w - 1, h - 1, F.lit(1.0))
        by_last = lambda r: F.when(r[8] != 0, F.array(*[r[3 * i + j] * scale[i] / r[8] for i in range(3) for j in range(3)]))
        return let(F.array(*[rows[i][j] for i in range(3) for j in range(3)]), by_last)

    tilt = let(F.when(den != 0, den), lambda n: F.struct(((dx3 * dy2 - dx2 * dy3) / n).alias("g"), ((dx1 * dy3 - dx3 * dy1) / n).alias("k")))
    return F.when(den != 0, let(let(tilt, forward), inverse))


def moved(poly: Column, x0: Column, y0: Column) -> Column:
    return F.transform(poly, lambda p: point(p["x"] - x0, p["y"] - y0))


def mapped(poly: Column, matrix: Column, x0: Column, y0: Column) -> Column:
    """A polygon through the matrix, or, where that is null, less the frame's origin."""

    def through(p: Column) -> Column:
        at = lambda r: matrix[3 * r] * p["x"] + matrix[3 * r + 1] * p["y"] + matrix[3 * r + 2]
        return let(F.struct(at(0).alias("x"), at(1).alias("y"), at(2).alias("z")), lambda q: F.when(q["z"] != 0, point(q["x"] / q["z"], q["y"] / q["z"])).otherwise(point(F.lit(None), F.lit(None))))

    return F.when(matrix.isNull(), moved(poly, x0, y0)).otherwise(F.transform(poly, through))


def relative(v: Column, size: Column) -> Column:
    return F.when(size > 0, v / size).otherwise(F.lit(-1.0))


def min_area_rect(poly: Column) -> Column:
    """struct(area, short, long, angle) of the smallest rectangle around a polygon; angle is the long axis's, in degrees, in (-90, 90].

    The smallest one has a side along an edge of the hull, so the directions of all pairs of points are enough. Widths are differences of
    products with the whole direction, divided by its length once: of whole-number points they are exact but for that division.
    """
    n = F.size(poly)
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.transform(F.sequence(i + 1, n - 1), lambda j: F.struct((F.get(poly, j)["x"] - F.get(poly, i)["x"]).alias("x"), (F.get(poly, j)["y"] - F.get(poly, i)["y"]).alias("y")))))

    def spread(u: Column) -> Column:
        along = F.transform(poly, lambda p: p["x"] * u["x"] + p["y"] * u["y"])
        across = F.transform(poly, lambda p: p["y"] * u["x"] - p["x"] * u["y"])
        wide = lambda v: let(v, lambda xs: F.array_max(xs) - F.array_min(xs))
        sized = lambda size: F.struct((wide(along) / size).alias("a"), (wide(across) / size).alias("b"), F.degrees(F.atan2(u["y"], u["x"])).alias("t"))
        return let(F.sqrt(u["x"] * u["x"] + u["y"] * u["y"]), sized)

    def box(s: Column) -> Column:
        a, b = s["a"], s["b"]
        angle = F.round(90 - F.pmod(90 - s["t"] - F.when(a >= b, 0.0).otherwise(90.0), F.lit(180.0)), 9)
        return let(angle, lambda t: F.struct(F.round(a * b, 6).alias("area"), F.abs(t).alias("near"), F.least(a, b).alias("short"), F.greatest(a, b).alias("long"), t.alias("angle")))

    usable = F.filter(pairs, lambda u: (u["x"] != 0) | (u["y"] != 0))
    return F.when(n >= 2, F.array_min(F.transform(F.transform(usable, spread), box)))


def hull(points: Column) -> Column:
    """The convex hull of any number of points, from the leftmost on, without points on its sides.

    A chain takes the points in order; a new one goes behind the last of the chain that it still turns left from.
    """
    empty = F.filter(points, lambda p: F.lit(False))
    ordered = F.array_sort(F.array_distinct(points))

    def chain(some: Column) -> Column:
        def add(kept: Column, p: Column) -> Column:
            def stays(q: Column, i: Column) -> Column:
                before = F.get(kept, i - 1)
                turn = (q["x"] - before["x"]) * (p["y"] - before["y"]) - (q["y"] - before["y"]) * (p["x"] - before["x"])
                return F.when((i == 0) | (turn > 0), i + 1)

            return F.concat(F.slice(kept, 1, F.coalesce(F.array_max(F.transform(kept, stays)), F.lit(0))), F.array(p))

        return F.aggregate(some, empty, add)

    without_last = lambda c: let(c, lambda x: F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(1))))
    both = lambda ps: F.when(F.size(ps) < 3, ps).otherwise(F.concat(without_last(chain(ps)), without_last(chain(F.reverse(ps)))))
    return let(ordered, both)


def min_area_box(contour: Column) -> Column:
    """The four corners of the smallest rectangle around a contour of any length; of equal ones the least turned; to four
    decimals. It has a side along one of the hull's. Null for fewer than three hull points."""

    def around(h: Column) -> Column:
        n = F.size(h)

        def along(p: Column, i: Column) -> Column:
            q = F.get(h, (i + 1) % n)
            return F.struct((q["x"] - p["x"]).alias("x"), (q["y"] - p["y"]).alias("y"))

        def unit(e: Column) -> Column:
            size = F.sqrt(e["x"] * e["x"] + e["y"] * e["y"])
            return F.struct((e["x"] / size).alias("x"), (e["y"] / size).alias("y"))

        def spread(u: Column) -> Column:
            a, b = F.transform(h, lambda p: p["x"] * u["x"] + p["y"] * u["y"]), F.transform(h, lambda p: p["y"] * u["x"] - p["x"] * u["y"])
            ends = {"u": u, "a0": F.array_min(a), "a1": F.array_max(a), "b0": F.array_min(b), "b1": F.array_max(b)}
            return F.struct(*[v.alias(k) for k, v in ends.items()])

        def keyed(s: Column) -> Column:
            quarter = F.pmod(F.degrees(F.atan2(s["u"]["y"], s["u"]["x"])), F.lit(90.0))
            return F.struct(F.round((s["a1"] - s["a0"]) * (s["b1"] - s["b0"]), 6).alias("area"), F.round(F.least(quarter, 90 - quarter), 6).alias("turn"), s.alias("s"))

        return F.when(n >= 3, F.array_min(F.transform(F.transform(F.transform(F.transform(h, along), unit), spread), keyed)))

    def corners(r: Column) -> Column:
        s, u = r["s"], r["s"]["u"]
        at = lambda a, b: point(F.round(s[a] * u["x"] - s[b] * u["y"], 4), F.round(s[a] * u["y"] + s[b] * u["x"], 4))
        return F.when(r.isNotNull(), F.array(at("a0", "b0"), at("a1", "b0"), at("a1", "b1"), at("a0", "b1")))

    return let(let(hull(contour), around), corners)


def quad_bbox(pts: Column, img_w: Column, img_h: Column) -> Column:
    """x, y, w, h of the upright box around a face, cut to the image."""
    b = bbox(pts)
    x1, y1 = F.greatest(F.floor(b["x1"]), F.lit(0)), F.greatest(F.floor(b["y1"]), F.lit(0))
    x2, y2 = F.least(F.ceil(b["x2"]), img_w), F.least(F.ceil(b["y2"]), img_h)
    return F.struct(x1.cast("int").alias("x"), y1.cast("int").alias("y"), (x2 - x1).cast("int").alias("w"), (y2 - y1).cast("int").alias("h"))


def corners_json(pts: Column) -> Column:
    return F.to_json(F.transform(pts, lambda p: F.array(p["x"], p["y"])))
