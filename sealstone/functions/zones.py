"""Zones: tolerance-banded tests and distances; a missing bound doesn't bind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sealstone.functions import geometry as G
from sealstone.functions import text as T
from sealstone.rules import TOLERANCE

BOUNDS = ("x_min", "x_max", "y_min", "y_max")


def axis_ok(v: Column, low: Column, high: Column, tolerance: float = TOLERANCE) -> Column:
    tol = max(float(tolerance), 0.0)
    return F.coalesce(v >= low - tol, F.lit(True)) & F.coalesce(v <= high + tol, F.lit(True))


def in_any(x: Column, y: Column, zones: Column, tolerance: float = TOLERANCE) -> Column:
    return F.coalesce(F.exists(zones, lambda z: axis_ok(x, z["x_min"], z["x_max"], tolerance) & axis_ok(y, z["y_min"], z["y_max"], tolerance)), F.lit(False))


def check(x: Column, y: Column, zones: Column, tolerance: float = TOLERANCE) -> Column:
    """struct(ok, x_ok, y_ok, zone, bounds, zones): the first zone that fits, else the first that fits on most axes, its bounds, and how many
    there are; none: false, false."""

    def tried(z: Column, i: Column) -> Column:
        x_ok, y_ok = axis_ok(x, z["x_min"], z["x_max"], tolerance), axis_ok(y, z["y_min"], z["y_max"], tolerance)
        return F.struct((x_ok.cast("int") + y_ok.cast("int")).alias("score"), (-i).alias("i"), x_ok.alias("x_ok"), y_ok.alias("y_ok"), F.struct(*[z[b].alias(b) for b in BOUNDS]).alias("bounds"))

    no = F.lit(False)
    told = lambda best: F.struct(F.coalesce(best["score"] == 2, no).alias("ok"), F.coalesce(best["x_ok"], no).alias("x_ok"), F.coalesce(best["y_ok"], no).alias("y_ok"), (-best["i"]).alias("zone"), best["bounds"].alias("bounds"), F.size(zones).alias("zones"))
    return G.let(F.array_max(F.transform(zones, tried)), told)


def explained(x: Column, y: Column, checked: Column, tolerance: float = TOLERANCE) -> Column:
    """What check found, in words: where the point is, or on which axes and by which bounds it fails."""
    where = F.concat(F.lit("in place ("), T.placed(x, y), F.lit(f", tolerance ±{tolerance:.2f})"))
    text = lambda b: F.coalesce(checked["bounds"][b].cast("string"), F.lit("any"))
    fails = lambda axis, v: F.when(~checked[f"{axis}_ok"], F.concat(F.lit(f"{axis.upper()}="), T.number(v, 3), F.lit(" not in ["), text(f"{axis}_min"), F.lit(","), text(f"{axis}_max"), F.lit(f"]±{tolerance:.2f}")))
    many = F.when(checked["zones"] > 1, F.concat(F.lit(" (any of "), checked["zones"].cast("string"), F.lit(")"))).otherwise("")
    outside = F.when(checked["zones"] > 0, F.concat(F.lit("outside the zone"), many, F.lit(": "), F.concat_ws("; ", fails("x", x), fails("y", y)))).otherwise("no zone, not checked")
    return F.when(checked["ok"], where).otherwise(outside)


def distance(x: Column, y: Column, zones: Column) -> Column:
    """From a point to the nearest zone, without tolerance; infinite without zones."""
    gap = lambda v, low, high: F.greatest(F.coalesce(low - v, F.lit(0.0)), F.coalesce(v - high, F.lit(0.0)), F.lit(0.0))

    def one(z: Column) -> Column:
        dx, dy = gap(x, z["x_min"], z["x_max"]), gap(y, z["y_min"], z["y_max"])
        return F.sqrt(dx * dx + dy * dy)

    return F.coalesce(F.array_min(F.transform(zones, one)), F.lit(float("inf")))
