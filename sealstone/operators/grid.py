"""Foreign patches on pixel tables (image, x, y, h, s, v), dense from 0 in the frame of the box.

Neighbourhoods are window frames over rows and columns of a tile and its halo, the pixels around it that its own ones can see; one exchange
on the tile satisfies all of them, however large an image is. Regions, and their holes, are linked as runs of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sealstone.checkpoints import saved
from sealstone.functions import geometry as G

#: Pixels of a tile's side.
TILE = 256
#: Pixels that a task holds while it sorts tiles, unless its tiles alone are more.
TASK_PIXELS = 500_000
# Thresholds of the colour rules.
WHITE = {"ref_v": 180, "ref_s": 55, "ref_rows": 200, "offset": 10, "above": 55, "v_min": 40, "v_max": 230}
BROWN = {"h": (5, 30), "s_min": 30, "v": (40, 200), "white_s": 30, "white_v": 200, "own_s": 80, "own_v": (50, 240)}
AREA_SHARE, SOLIDITY, EDGE = 0.015, 0.45, 6.0


def inset(pixels: DataFrame, share: float = 0.02, least: int = 10) -> DataFrame:
    """Pixels less `share` of the frame (1 at least) on each side, counted from 0 again; frames below `least` before or after are left out."""
    frame = pixels.groupBy("image").agg((F.max("x") + 1).alias("w"), (F.max("y") + 1).alias("ht"))
    mx, my = (F.greatest(F.floor(F.col(c) * share), F.lit(1)) for c in ("w", "ht"))
    frame = frame.select(F.col("image").alias("_i"), "w", "ht", mx.alias("mx"), my.alias("my")).where(f"least(w, ht) >= {least} and least(w - 2 * mx, ht - 2 * my) >= {least}")
    inner = pixels.join(_merged(frame), F.col("image") == F.col("_i")).where("x >= mx and x < w - mx and y >= my and y < ht - my")
    return inner.select("image", (F.col("x") - F.col("mx")).cast("int").alias("x"), (F.col("y") - F.col("my")).cast("int").alias("y"), "h", "s", "v")


def baseline(pixels: DataFrame) -> DataFrame:
    """image, ref: the 90th percentile of s over bright pale pixels, 0 if there are too few."""
    pale = (F.col("v") > WHITE["ref_v"]) & (F.col("s") < WHITE["ref_s"])
    p = F.percentile(F.when(pale, F.col("s")), F.lit(0.9))
    return pixels.groupBy("image").agg(F.when(F.count_if(pale) > WHITE["ref_rows"], p).otherwise(0.0).alias("ref"))


def _white(s: Column, v: Column, ref: Column) -> tuple[Column, Column]:
    above = F.least(F.greatest(s - ref - WHITE["offset"], F.lit(0.0)), F.lit(255.0))
    return F.floor(above).cast("double"), (above > WHITE["above"]) & (v > WHITE["v_min"]) & (v < WHITE["v_max"])


def _brown(h: Column, s: Column, v: Column) -> tuple[Column, Column]:
    brown = h.between(*BROWN["h"]) & (s >= BROWN["s_min"]) & v.between(*BROWN["v"])
    white = (s <= BROWN["white_s"]) & (v >= BROWN["white_v"])
    return s.cast("double"), ~brown & ~white & (s >= BROWN["own_s"]) & v.between(*BROWN["own_v"])


def white_mask(pixels: DataFrame) -> DataFrame:
    """Adds signal, the whole part of the saturation above the baseline, and mask."""
    ref = baseline(pixels).select(F.col("image").alias("_i"), "ref")
    signal, mask = _white(F.col("s"), F.col("v"), F.col("ref"))
    return pixels.join(_merged(ref), F.col("image") == F.col("_i")).select("image", "x", "y", "h", "s", "v", signal.alias("signal"), mask.alias("mask"))


def brown_mask(pixels: DataFrame) -> DataFrame:
    """Adds signal, the saturation, and mask."""
    signal, mask = _brown(F.col("h"), F.col("s"), F.col("v"))
    return pixels.select("image", "x", "y", "h", "s", "v", signal.alias("signal"), mask.alias("mask"))


def masked(pixels: DataFrame, modes: DataFrame) -> DataFrame:
    """Adds signal and mask by each image's mode (image, mode): brown_box, or else white_box. Images without a row, or with a null mode, are
    left out: their colour isn't checked."""
    own = modes.where("mode is not null").select(F.col("image").alias("_m"), "mode")
    wanted = pixels.join(_merged(own), F.col("image") == F.col("_m"))
    ref = baseline(wanted.where("mode <> 'brown_box'")).select(F.col("image").alias("_i"), "ref")
    both = wanted.join(_merged(ref), F.col("image") == F.col("_i"), "left")
    brown = F.col("mode") == "brown_box"
    of_brown, of_white = _brown(F.col("h"), F.col("s"), F.col("v")), _white(F.col("s"), F.col("v"), F.col("ref"))
    signal, mask = (F.when(brown, x).otherwise(y) for x, y in zip(of_brown, of_white))
    return both.select("image", "x", "y", "h", "s", "v", signal.alias("signal"), mask.alias("mask"))


def _tiled(pixels: DataFrame, halo: int, tile: int) -> DataFrame:
    """Each pixel in its tile (tx, ty) and in those that see it in their halo; one exchange on the tile. Its parts follow the number of pixels: Spark
    would join parts by their compressed bytes, of which pixels have few."""
    near = lambda c: F.sequence(F.greatest(F.floor((F.col(c) - halo) / tile), F.lit(0)), F.floor((F.col(c) + halo) / tile))
    out = pixels.withColumn("tx", F.explode(near("x"))).withColumn("ty", F.explode(near("y")))
    parts = max(pixels.sparkSession.sparkContext.defaultParallelism, -(-pixels.count() // TASK_PIXELS))
    return out.repartition(parts, "image", "tx", "ty")


def _merged(df: DataFrame) -> DataFrame:
    """df for a join with what grows as it does. The size of a saved table is that of its compressed files: by it, Spark would collect and broadcast
    tables of many times the bound."""
    return df.hint("merge")


def _own(tiled: DataFrame, tile: int) -> DataFrame:
    """The tiles' own pixels, each once."""
    return tiled.where(f"x div {tile} = tx and y div {tile} = ty").drop("tx", "ty")


_TILE = ("image", "tx", "ty")


def _around(kind, column: str, along: str, across: str, reach: int) -> Column:
    return kind(F.col(column)).over(Window.partitionBy(*_TILE, across).orderBy(along).rangeBetween(-reach, reach))


def closing(masked: DataFrame, reach: int = 4, tile: int = TILE) -> DataFrame:
    """mask dilated and then eroded by a square of 2 x reach + 1; what lies outside the frame doesn't count."""
    out = _tiled(masked, 2 * reach, tile).withColumn("m", F.col("mask").cast("int"))
    for kind in (F.max, F.min):
        out = out.withColumn("m", _around(kind, "m", "x", "y", reach)).withColumn("m", _around(kind, "m", "y", "x", reach))
    return _own(out.withColumn("mask", F.col("m") == 1).drop("m"), tile)


def regions(masked: DataFrame) -> DataFrame:
    """image, x, y, region of the mask's pixels; region is the smallest y * 65536 + x of its 8-connected region.

    Runs of a row are the nodes; touching runs of neighbouring rows are linked, and the smallest number spreads over links, doubling its
    reach by following labels, until no label changes.
    """
    on = masked.where("mask").select("image", "x", "y", F.col("signal") if "signal" in masked.columns else F.lit(0.0).alias("signal"))
    row = Window.partitionBy("image", "y").orderBy("x")
    on = on.withColumn("i", F.col("x") - F.row_number().over(row))
    on = saved(on.withColumn("run", F.col("y").cast("long") * 65536 + F.min("x").over(Window.partitionBy("image", "y", "i"))).drop("i"), "grid-on")
    runs = saved(on.groupBy("image", "y", "run").agg(F.min("x").alias("a"), F.max("x").alias("b")), "grid-runs")
    labels = _linked(runs, 1, "image")
    return on.join(_merged(labels), ["image", "run"]).select("image", "x", "y", F.col("label").alias("region"))


def _linked(runs: DataFrame, apart: int, *keys: str) -> DataFrame:
    """Runs (keys, y, run, a, b) to (keys, run, label): runs of neighbouring rows are linked if they overlap or are at most `apart` columns apart."""
    below = runs.select(*keys, (F.col("y") - 1).alias("y"), F.col("run").alias("other"), F.col("a").alias("c"), F.col("b").alias("d"))
    touch = runs.join(_merged(below), [*keys, "y"]).where(f"a <= d + {apart} and c <= b + {apart}").select(*keys, "run", "other")
    links = saved(touch.unionByName(touch.select(*keys, F.col("other").alias("run"), F.col("run").alias("other"))), "grid-links")
    labels, before = runs.select(*keys, "run", F.col("run").alias("label")), None
    while True:
        reach = links.join(_merged(labels.withColumnsRenamed({"run": "other", "label": "l"})), [*keys, "other"]).groupBy(*keys, "run").agg(F.min("l").alias("l"))
        labels = labels.join(_merged(reach), [*keys, "run"], "left").select(*keys, "run", F.least("label", F.coalesce("l", "label")).alias("label"))
        jump = labels.select(*keys, F.col("run").alias("label"), F.col("label").alias("l"))
        labels = saved(labels.join(_merged(jump), [*keys, "label"]).select(*keys, "run", F.col("l").alias("label")), "grid-labels")
        now = labels.agg(F.sum("label")).first()[0]
        if now == before:
            return labels
        before = now


def gradient(masked: DataFrame, tile: int = TILE) -> DataFrame:
    """image, x, y, grad: the magnitude of the 3 x 3 Sobel gradient of signal; the frame's border is mirrored."""
    row, col = Window.partitionBy(*_TILE, "y").orderBy("x"), Window.partitionBy(*_TILE, "x").orderBy("y")

    def beside(c: str, w) -> tuple[Column, Column]:
        before, after = F.lag(c).over(w), F.lead(c).over(w)
        return F.coalesce(before, after, F.col(c)), F.coalesce(after, before, F.col(c))

    left, right = beside("signal", row)
    out = _tiled(masked.select("image", "x", "y", "signal"), 1, tile).select(*_TILE, "x", "y", "signal", (right - left).alias("dx"), (left + 2 * F.col("signal") + right).alias("sx"))
    (du, dd), (su, sd) = beside("dx", col), beside("sx", col)
    gx, gy = du + 2 * F.col("dx") + dd, sd - su
    return _own(out.select(*_TILE, "x", "y", F.sqrt(gx * gx + gy * gy).alias("grad")), tile)


def edge_strength(labelled: DataFrame, masked: DataFrame, tile: int = TILE) -> DataFrame:
    """image, region, edge: the mean gradient over the pixels within one of the region, less those whose neighbours all belong to it."""
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    near = labelled.select("image", "region", "x", "y", F.explode(steps).alias("d")).select("image", "region", (F.col("x") + F.col("d.i")).alias("x"), (F.col("y") + F.col("d.j")).alias("y"))
    near = near.groupBy("image", "region", "x", "y").agg(F.count("*").alias("own"))
    frame = masked.groupBy("image").agg(F.max("x").alias("mx"), F.max("y").alias("my"))
    there = lambda c, m: 3 - (F.col(c) == 0).cast("int") - (F.col(c) == F.col(m)).cast("int")
    ring = near.join(_merged(frame), "image").where(F.col("own") < there("x", "mx") * there("y", "my"))
    return ring.join(_merged(gradient(masked, tile)), ["image", "x", "y"]).groupBy("image", "region").agg(F.avg("grad").alias("edge"))


def _rows(labelled: DataFrame) -> DataFrame:
    """image, region, y, and the region's runs [a, b] there, in order."""
    row = Window.partitionBy("image", "region", "y").orderBy("x")
    on = labelled.select("image", "region", "y", "x", (F.col("x") - F.row_number().over(row)).alias("i"))
    runs = on.groupBy("image", "region", "y", "i").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    return runs.groupBy("image", "region", "y").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("runs"))


def filled(labelled: DataFrame) -> DataFrame:
    """image, region, y, a, b: the regions' runs of rows, with holes filled.

    A gap between two runs of a row is a hole unless it is linked, over gaps of neighbouring rows, with what lies beyond the region's ends there.
    """
    rows = saved(_rows(labelled), "grid-rows")
    gap = lambda r, i: F.struct((r["b"] + 1).alias("a"), (F.get("runs", i + 1)["a"] - 1).alias("b"))
    gaps = rows.select("image", "region", "y", F.explode(F.transform(F.slice("runs", 1, F.size("runs") - 1), gap)).alias("g")).select("image", "region", "y", "g.a", "g.b")
    gaps = saved(gaps.withColumn("run", F.col("y").cast("long") * 65536 + F.col("a")), "grid-gaps")
    if gaps.isEmpty():
        return rows.select("image", "region", "y", F.explode("runs").alias("r")).select("image", "region", "y", "r.a", "r.b")
    ends = rows.select("image", "region", "y", F.get("runs", F.lit(0))["a"].alias("first"), F.element_at("runs", -1)["b"].alias("last"))
    beside = gaps.select("image", "region", "run", "a", "b", F.explode(F.array(F.col("y") - 1, F.col("y") + 1)).alias("y"))
    outer = beside.join(_merged(ends), ["image", "region", "y"], "left").where("first is null or a < first or b > last").select("image", "region", "run").distinct()
    labels = _linked(gaps, 0, "image", "region")
    open_ = labels.join(_merged(outer), ["image", "region", "run"]).select("image", "region", "label").distinct()
    holes = labels.join(_merged(open_), ["image", "region", "label"], "left_anti").join(_merged(gaps), ["image", "region", "run"]).select("image", "region", "y", "a", "b")
    parts = rows.select("image", "region", "y", F.explode("runs").alias("r")).select("image", "region", "y", "r.a", "r.b").unionByName(holes)
    row = Window.partitionBy("image", "region", "y").orderBy("a")
    begins = F.coalesce(F.col("a") > F.lag("b").over(row) + 1, F.lit(True)).cast("int")  # runs and the holes between them meet
    nth = F.sum("begins").over(row)
    return parts.withColumn("begins", begins).withColumn("nth", nth).groupBy("image", "region", "y", "nth").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("nth")


def _corners(solid: DataFrame) -> DataFrame:
    """image, region, p: the ends of a region's rows that may be corners of its hull: its first and last row, and where an end stands out
    between those of the rows above and below (any others lie on a line between two ends, or inside)."""
    ends = solid.groupBy("image", "region", "y").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    rows = Window.partitionBy("image", "region").orderBy("y")
    both = lambda c: F.lag(c).over(rows) + F.lead(c).over(rows)
    ends = ends.withColumns({"_a": both("a"), "_b": both("b"), "_near": F.lead("y").over(rows) - F.lag("y").over(rows)})
    inner = F.coalesce(F.col("_near") == 2, F.lit(False))  # the rows beside it are the next ones
    out = lambda c, stands: F.when(~inner | stands, G.point(F.col(c), F.col("y")))
    points = F.array(out("a", 2 * F.col("a") < F.col("_a")), out("b", 2 * F.col("b") > F.col("_b")))
    return ends.select("image", "region", F.explode(points).alias("p")).where("p is not null")


def solidity(labelled: DataFrame) -> DataFrame:
    """image, region, area (pixels), solidity: the area within the outer contour, through pixel centres, over its hull's; 0 if the hull has less than 1.

    Between two rows, a square of four neighbouring centres counts whole if all are filled, and half if three are. The hull needs only the
    ends of rows.
    """
    solid = saved(filled(labelled), "grid-filled")
    below = solid.select("image", "region", (F.col("y") - 1).alias("y"), F.col("a").alias("c"), F.col("b").alias("d"))
    half = lambda *tests: sum((F.expr(t).cast("int") for t in tests), F.lit(0))
    full = F.greatest(F.least("b", "d") - F.greatest("a", "c"), F.lit(0))
    halves = half("d between a and b - 1", "c - 1 between a and b - 1", "b between c and d - 1", "a - 1 between c and d - 1")
    inner = solid.join(_merged(below), ["image", "region", "y"]).groupBy("image", "region").agg(F.sum(full + halves / 2).alias("inner"))
    hulls = _corners(solid).groupBy("image", "region").agg(G.area(G.hull(F.collect_list("p"))).alias("hull"))
    size = labelled.groupBy("image", "region").agg(F.count("*").alias("area"))
    share = F.when(F.col("hull") >= 1, F.coalesce("inner", F.lit(0.0)) / F.col("hull")).otherwise(0.0)
    return size.join(_merged(hulls), ["image", "region"]).join(_merged(inner), ["image", "region"], "left").select("image", "region", "area", share.alias("solidity"))


def foreign_patches(masked: DataFrame, rules: DataFrame | None = None, tile: int = TILE) -> DataFrame:
    """image, region, area, solidity, edge of the regions that are large, compact and sharp enough to be a foreign sticker.

    rules: image, area_ratio, solidity_min, edge_grad_min, as the rule book's color has them; where they are missing or null, AREA_SHARE, SOLIDITY and EDGE hold.
    """
    closed = saved(closing(saved(masked.select("image", "x", "y", "signal", "mask"), "grid-masked"), tile=tile), "grid-closed")
    labelled = saved(regions(closed), "grid-regions")
    size = closed.groupBy("image").agg(F.count("*").alias("zone"))
    bounds = {"area_ratio": AREA_SHARE, "solidity_min": SOLIDITY, "edge_grad_min": EDGE}
    if rules is not None:
        size = size.join(_merged(rules.select(F.col("image").alias("_r"), *bounds)), F.col("image") == F.col("_r"), "left").drop("_r")
    size = size.select("image", "zone", *[F.coalesce(F.col(c) if rules is not None else F.lit(None), F.lit(v)).alias(c) for c, v in bounds.items()])
    large = labelled.groupBy("image", "region").agg(F.count("*").alias("n")).join(_merged(size), "image").where(F.col("n") / F.col("zone") >= F.col("area_ratio")).drop("n", "zone")
    large = saved(large, "grid-large")
    compact = solidity(labelled.join(_merged(large), ["image", "region"], "left_semi")).join(_merged(large), ["image", "region"]).where("solidity >= solidity_min")
    compact = saved(compact, "grid-compact")
    sharp = edge_strength(labelled.join(_merged(compact), ["image", "region"], "left_semi"), closed.join(_merged(compact), "image", "left_semi"), tile)
    return compact.join(_merged(sharp), ["image", "region"]).where("edge >= edge_grad_min").select("image", "region", "area", "solidity", "edge")
