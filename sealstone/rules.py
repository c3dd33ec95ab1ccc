"""The rule book: one row for each product line."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sealstone.schema import RULES, ZONES

UNKNOWN_LOB = "UNKNOWN LOB"
TOLERANCE, ANGLE_MAX, FRONT_MIN_RATIO = 0.15, 30.0, 0.02

# What the rules of the existing programme prescribe.
# lob, seal count, scan zones, second-seal zones (x_min, x_max, y_min, y_max), aspect range, colour mode
RULE_BOOK = (
    ("iPhone", "single_or_dual", ((0.50, 0.95, 0.00, 0.30),), ((0.50, 0.95, 0.70, 1.00),), (1.6, 2.4), "white_box"),
    ("Watch", "single_or_dual", ((None, None, 0.00, 0.45), (None, None, 0.55, 1.00)), ((None, None, 0.00, 0.45), (None, None, 0.55, 1.00)), (2.5, 5.0), "white_box"),
    ("AirPods", "single_only", ((0.50, 0.95, 0.00, 0.50),), None, (0.85, 1.35), "white_box"),
    ("Accy.", "single_only", ((0.50, 0.95, 0.00, 0.50),), None, (None, None), "white_box"),
    ("iPad", "single_or_dual", ((0.50, 0.95, 0.00, 0.30),), ((0.50, 0.95, 0.70, 1.00),), (1.2, 1.7), "white_box"),
    ("Mac", "single_or_dual", ((0.25, 0.75, 0.70, 1.00),), ((0.05, 0.50, 0.00, 0.30),), (1.2, 2.0), "brown_box"),
)
#: Product lines whose faces are also looked for by their own colour.
SPLIT_LOBS = ("Mac",)
SCAN = "扫码即领"
STORE = "Apple授权专营店"
DEALER = "授权经销商"
AUTH_WORDS = (STORE, "授权专营店", "在你身边")
# A photo with any of these is not a dealer's own.
OFFICIAL_WORDS = (SCAN, "Apple", "apple", DEALER, "Authorized Reseller", "Authorised Reseller", STORE, "authorized reseller")


COUNTS, MODES = ("single_only", "single_or_dual", "dual_required"), ("white_box", "brown_box")
_BOUNDS = ("x_min", "x_max", "y_min", "y_max")
#: A rule as users write it: zones are one mapping of bounds, or a list of them.
BOOK = "struct<sticker_count:string,scan_sticker:string,auth_sticker:string,front_face_aspect_range:array<double>,unofficial_color:struct<enabled:boolean,mode:string,area_ratio:double,solidity_min:double,edge_grad_min:double>>"


def _zones(json: Column) -> Column:
    """zones() on JSON text: null for none, else the mappings in it."""
    one = f"struct<{','.join(f'{b}:double' for b in _BOUNDS)}>"
    listed = F.from_json(F.when(json.startswith("["), json), "array<string>")
    maps = F.filter(F.coalesce(listed, F.array(json)), lambda z: F.trim(z).startswith("{"))
    return F.when(json.isNotNull(), F.transform(maps, lambda z: F.from_json(z, one)).cast(ZONES))


def load_rules(book: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A user's book (lob, rule as JSON) to the rules (schema.RULES) and to what is refused (lob, reasons).

    Refused are rules without a name or with UNKNOWN_LOB's, names that come twice (all of them), what isn't JSON, unknown counts and colour modes, missing scan
    zones, zones and ranges whose ends are in the wrong order or a zone's outside [0, 1], and thresholds below zero. Defaults: single_or_dual, no second
    seal's zones, no aspect range, colour check off, white_box.
    """
    n = book.groupBy(F.trim("lob").alias("_name")).agg(F.count("*").alias("_n"))
    r = F.from_json("rule", BOOK)
    rows = book.select(F.trim("lob").alias("lob"), r.alias("r"), F.get_json_object("rule", "$").isNull().alias("broken"))
    rows = rows.join(n, F.col("lob").eqNullSafe(F.col("_name"))).drop("_name")
    color, aspect = F.col("r.unofficial_color"), F.col("r.front_face_aspect_range")
    rows = rows.select(
        "lob", "broken", "_n", F.coalesce("r.sticker_count", F.lit("single_or_dual")).alias("sticker_count"), _zones(F.col("r.scan_sticker")).alias("scan_zones"), _zones(F.col("r.auth_sticker")).alias("auth_zones"),
        F.get(aspect, F.lit(0)).alias("aspect_lo"), F.get(aspect, F.lit(1)).alias("aspect_hi"), F.size(aspect).alias("_ends"),
        F.struct(F.coalesce(color["enabled"], F.lit(False)).alias("enabled"), F.coalesce(color["mode"], F.lit("white_box")).alias("mode"), *[color[c].alias(c) for c in ("area_ratio", "solidity_min", "edge_grad_min")]).alias("color"))
    wrong = lambda z: reduce(lambda a, b: a | b, [F.coalesce(~z[b].between(0, 1), F.lit(False)) for b in _BOUNDS]) | F.coalesce((z["x_min"] > z["x_max"]) | (z["y_min"] > z["y_max"]), F.lit(False))
    below = reduce(lambda a, b: a | b, [F.coalesce(F.col("color")[c] < 0, F.lit(False)) for c in ("area_ratio", "solidity_min", "edge_grad_min")])
    tests = {
        "no name": F.coalesce(F.col("lob") == "", F.lit(True)), "reserved name": F.col("lob") == UNKNOWN_LOB, "name comes twice": F.col("_n") > 1, "not JSON": F.col("broken"),
        "unknown sticker_count": ~F.col("sticker_count").isin(*COUNTS), "no scan zone": ~F.col("broken") & (F.coalesce(F.size("scan_zones"), F.lit(-1)) <= 0),
        "bad zone": F.exists(F.concat(F.coalesce("scan_zones", F.array()), F.coalesce("auth_zones", F.array())), wrong),
        "bad aspect range": (F.col("_ends") >= 0) & (F.col("_ends") != 2) | (F.col("aspect_lo") > F.col("aspect_hi")), "unknown color mode": ~F.col("color.mode").isin(*MODES), "negative threshold": below,
    }
    rows = rows.withColumn("reasons", F.filter(F.array(*[F.when(test, name) for name, test in tests.items()]), lambda x: x.isNotNull()))
    good = rows.where(F.size("reasons") == 0).select("lob", "sticker_count", "scan_zones", "auth_zones", "aspect_lo", "aspect_hi", "color")
    return good, rows.where(F.size("reasons") > 0).select("lob", "reasons")


def zones(value) -> list[tuple] | None:
    """A rule's zones from none, one mapping of bounds, or a list of which only the mappings count."""
    some = [] if value is None else [value] if isinstance(value, dict) else [z for z in value if isinstance(z, dict)]
    return [tuple(z.get(b) for b in ("x_min", "x_max", "y_min", "y_max")) for z in some]


def rule_book(spark: SparkSession, book=RULE_BOOK, color_enabled: bool = True) -> DataFrame:
    """The rules as a table; users pass their own book, or read a table of the same schema."""
    zone = lambda z: dict(zip(_BOUNDS, z))
    color = lambda mode: {"enabled": color_enabled, "mode": mode, "area_ratio": 0.015, "solidity_min": 0.45, "edge_grad_min": 6.0}
    rows = [
        {"lob": lob, "sticker_count": count, "scan_zones": [*map(zone, scan)], "auth_zones": auth and [*map(zone, auth)], "aspect_lo": aspect[0], "aspect_hi": aspect[1], "color": color(mode)}
        for lob, count, scan, auth, aspect, mode in book
    ]
    # An Arrow table is a local relation, whose size Spark knows: it is broadcast.
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(StructType.fromDDL(RULES))))
