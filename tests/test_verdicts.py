"""Golden rows for each way a verdict can end, and the rules of the parts."""

import pytest
from pyspark.sql import functions as F

from sealstone.functions import geometry as G
from sealstone.functions import text as T
from sealstone.functions import zones as Z
from sealstone.operators import faces, photos, seals, verdict
from sealstone.rules import RULE_BOOK, rule_book, zones
from sealstone.schema import ORDERS, PHOTOS, VERDICT

SCAN = "扫码即领"


def box(i, text, cx, cy, turned=False):
    if cx is None:
        return (i, text, None)
    d = ((-8, -2), (2, -8), (8, 2), (-2, 8)) if turned else ((-10, -5), (10, -5), (10, 5), (-10, 5))
    return (i, text, [(float(cx + x), float(cy + y)) for x, y in d])


GOLDEN = {
    "G1": ("Vision", [(SCAN, 70, 30)], {}, (0, 0, -1, -1)),
    "G2": ("iPhone", [("hello", 1, 1), ("world", 2, 2)], {}, (0, 0, 0, -1)),
    "G3": ("iPhone", [("Apple", 1, 1)], {}, (0, 0, -1, -1)),
    "G3b": ("iPhone", [(SCAN, 70, 30)], {"method": "fallback"}, (0, 0, -1, -1)),
    "G4": ("iPhone", [(SCAN, 70, 30)], {"foreign": True}, (0, 1, 4, -1)),
    "G5": ("iPhone", [(SCAN, None, None)], {}, (0, 0, -1, -1)),
    "G6a": ("iPhone", [(SCAN, 20, 30)], {}, (0, 1, 0, -1)),
    "G6b": ("iPhone", [(SCAN, 70, 30, True)], {}, (0, 1, 3, -1)),
    "G6c": ("iPhone", [(SCAN, 70, 30), ("Authorized Reseller", 70, 90)], {}, (0, 1, 2, -1)),
    "G7": ("iPhone", [(SCAN, 70, 30), (SCAN, 70, 120)], {}, (1, 1, 1, 2)),
    "G7b": ("AirPods", [(SCAN, 70, 30), (SCAN, 70, 120)], {}, (1, 1, 1, 2)),
    "G8": ("Strict", [(SCAN, 70, 30)], {}, (0, 1, 1, 3)),
    "G9": ("iPhone", [(SCAN, 70, 30), ("在你身边", 150, 170)], {}, (1, 1, 1, 0)),
    "G10": ("iPhone", [(SCAN, 70, 30), ("授权专营店", 70, 100)], {}, (0, 1, 1, 1)),
    "G11": ("iPhone", [(SCAN, 70, 30), ("授权专营店", 70, 170)], {}, (1, 1, 1, 1)),
    "G12": ("iPhone", [(SCAN, 70, 30)], {}, (1, 1, 1, 0)),
    "G13": ("Watch", [(SCAN, 70, 100)], {}, (1, 1, 1, 0)),
}


def tables(spark):
    orders = spark.createDataFrame([(k, v[0], None, None, None, None) for k, v in GOLDEN.items()] + [(None, None, None, None, None, None), ("empty", "iPad", None, None, None, None)], ORDERS)
    rows = [
        (k, 1, "u", 200, 300, "ok", [box(i, *t) for i, t in enumerate(texts)], ["10:20 | 2024-01-02", "西安x"], (0, 0, 100, 200, more.get("method", "edge")), more.get("foreign", False))
        for k, (_, texts, more, _) in GOLDEN.items()
    ]
    of = spark.createDataFrame(rows, PHOTOS + ", foreign boolean")
    return orders, of, rule_book(spark, (*RULE_BOOK, ("Strict", "dual_required", *RULE_BOOK[0][2:])))


def test_golden_rows(spark):
    orders, of, rules = tables(spark)
    got = {r["order_id"]: r for r in verdict.verdict_v2(orders, of, rules).collect()}
    assert {k: tuple(got[k][c] for c in ("is_compliant", "seal_exists", "position_valid", "dual_code")) for k in GOLDEN} == {k: v[3] for k, v in GOLDEN.items()}
    assert (got["G6a"]["rel_x"], got["G6a"]["rel_y"], got["G6a"]["sticker_angle"]) == (0.2, 0.15, None)
    assert got["G12"]["stamp_time"] == "10:20 2024-01-02" and got["G12"]["stamp_place"] == "西安x"
    assert got["empty"]["position_valid"] == -1 and got[None]["lob"] == "UNKNOWN LOB"
    strict = {r["order_id"]: r["is_compliant"] for r in verdict.verdict_v2(orders, of, rules, "reject_single_only").collect()}
    assert (strict["G7"], strict["G7b"]) == (1, 0)


def test_verdict_keeps_columns_and_rows(spark):
    orders, of, rules = tables(spark)
    twice = orders.unionByName(orders).withColumn("extra", F.lit(7))
    out = verdict.verdict_v2(twice, of, rules)
    assert out.columns == [*[c for c in twice.columns if c != "lob"], *VERDICT] and out.count() == 2 * orders.count()
    assert verdict.verdict_v2(orders.limit(0), of, rules).count() == 0
    assert verdict.verdict_v1(twice, of.drop("foreign")).count() == 2 * orders.count()


def test_verdict_through_a_homography(spark):
    """A face that is the box itself gives the same verdicts by perspective; a degenerate one falls back."""
    orders, of, rules = tables(spark)
    face = lambda *p: F.array(F.struct(F.lit("edge").alias("source"), F.array(*[G.point(F.lit(x), F.lit(y)) for x, y in p]).alias("pts")))
    plain = {r["order_id"]: r for r in verdict.verdict_v2(orders, of, rules).collect()}
    seen = {r["order_id"]: r for r in verdict.verdict_v2(orders, of.withColumn("quads", face((0, 0), (100, 0), (100, 200), (0, 200))), rules).collect()}
    codes = ("is_compliant", "seal_exists", "position_valid", "dual_code")
    assert {k: [r[c] for c in codes] for k, r in seen.items()} == {k: [r[c] for c in codes] for k, r in plain.items()}
    assert seen["G12"]["rectify_method"] == "perspective"
    flat = {r["order_id"]: r["rectify_method"] for r in verdict.verdict_v2(orders, of.withColumn("quads", face(*[(5, 5)] * 4)), rules).collect()}
    assert flat["G12"] == "axis_aligned"


def test_plan_has_no_python_and_broadcasts_the_rules(spark):
    orders, of, rules = tables(spark)
    plan = verdict.verdict_v2(orders, of, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "BroadcastHashJoin [regexp_replace(lob" in plan


CODES = ("is_compliant", "seal_exists", "position_valid", "dual_code")


def test_contours_turn_photos_upright(spark):
    """A contour that is the box itself gives the same verdicts by rotation, also where the faces are degenerate; a small one does nothing."""
    orders, of, rules = tables(spark)
    ring = lambda *p: F.array(*[G.point(F.lit(x), F.lit(y)) for x, y in p])
    whole = ring((0, 0), (50, 0), (100, 0), (100, 90), (100, 200), (0, 200), (0, 7))
    plain = {r["order_id"]: [r[c] for c in CODES] for r in verdict.verdict_v2(orders, of, rules).collect()}
    flat = F.array(F.struct(F.lit("edge").alias("source"), ring(*[(5, 5)] * 4).alias("pts")))
    for more in (of.withColumn("contour", whole), of.withColumn("contour", whole).withColumn("quads", flat)):
        seen = {r["order_id"]: r for r in verdict.verdict_v2(orders, more, rules).collect()}
        assert {k: [r[c] for c in CODES] for k, r in seen.items()} == plain
        assert seen["G12"]["rectify_method"] == "rotation" and seen["G12"]["box_quad_src"] == "[[0.0,0.0],[100.0,0.0],[100.0,200.0],[0.0,200.0]]"
    small = of.withColumn("contour", ring((0, 0), (60, 0), (60, 60)))
    assert {r["rectify_method"] for r in verdict.verdict_v2(orders, small, rules).collect()} == {"axis_aligned"}


def test_prepared_faces(spark):
    at = lambda x, s, size=100.0: (s, [(x, 0.0), (x + size, 0.0), (x + size, size), (x, size)])
    quads = [at(0.0, "split"), at(10.0, "edge"), at(40.0, "edge"), at(90.0, "edge", 50.0), *[at(1000.0 + 200 * i, "edge", 10.0 + i) for i in range(9)]]
    df = spark.createDataFrame([("Mac", quads), ("iPad", quads), ("iPad", [])], "lob string, q array<struct<source:string,pts:array<struct<x:double,y:double>>>>")
    got = [[(q["source"], q["pts"][0]["x"]) for q in r["p"]] for r in df.select(faces.prepared(F.col("q"), F.col("lob")).alias("p")).collect()]
    assert got[0][:2] == [("edge", 10.0), ("edge", 90.0)] and got[0] == got[1] and len(got[1]) == 8 and got[1][2] == ("edge", 2600.0) and got[2] == []
    far = df.withColumn("q", F.transform("q", lambda q, i: F.when(i == 0, F.struct(q["source"].alias("source"), F.transform(q["pts"], lambda p: G.point(p["x"] - 400, p["y"])).alias("pts"))).otherwise(q)))
    kept = [{q["source"] for q in r["p"]} for r in far.select(faces.prepared(F.col("q"), F.col("lob")).alias("p")).collect()]
    assert kept == [{"split", "edge"}, {"edge"}, set()]


def test_foreign_stickers_of_chosen_photos(spark):
    orders, of, rules = tables(spark)
    patch = "case when x between 8 and 19 and y between 8 and 19 then 200 else 10 end"
    grid_ = spark.range(1600).selectExpr("int(id % 40) x", "int(id div 40) y").selectExpr("x", "y", "100 h", f"{patch} s", f"case when {patch} = 200 then 120 else 200 end v")
    keys = spark.createDataFrame([("G12", 1), ("G11", 2), ("G1", 1), ("G3", 1), ("G8", 1)], "order_id string, image_idx int")
    plain = spark.createDataFrame([("G9", 1)], "order_id string, image_idx int").crossJoin(grid_.withColumn("s", F.lit(10)))
    pixels = keys.crossJoin(grid_).unionByName(plain)
    off = rules.withColumn("color", F.when(F.col("lob") != "Strict", F.col("color")).otherwise(F.col("color").withField("enabled", F.lit(False))))
    found = {(r["order_id"], r["image_idx"]) for r in verdict.foreign_photos(orders.unionByName(orders), of, off, pixels).collect()}
    assert found == {("G12", 1)}  # G11's is of another photo, G1's line is unknown, G3 has no seal, G8's rule is off
    strict = rules.withColumn("color", F.col("color").withField("area_ratio", F.lit(0.5)))
    assert verdict.foreign_photos(orders, of, strict, pixels).count() == 0
    flagged = of.drop("foreign").join(verdict.foreign_photos(orders, of, off, pixels).withColumn("foreign", F.lit(True)), ["order_id", "image_idx"], "left")
    got = {r["order_id"]: r for r in verdict.verdict_v2(orders, flagged, off).collect()}
    assert [got["G12"][c] for c in CODES] == [0, 1, 4, -1] and got["G4"]["position_valid"] == 1 and got["G9"]["position_valid"] == 1
    assert verdict.foreign_photos(orders, of, off, pixels.limit(0)).count() == 0


def test_parameters_of_the_verdict(spark):
    orders, of, rules = tables(spark)
    by = lambda **more: {r["order_id"]: r for r in verdict.verdict_v2(orders, of, rules, **more).collect()}
    none = by(tolerance=0.0)
    assert none["G13"]["position_valid"] == 0 and none["G12"]["detail"].endswith("tolerance ±0.00)")
    assert by(angle_max=60.0)["G6b"]["position_valid"] == 1 and by(front_ratio=0.9)["G12"]["position_valid"] == -1


@pytest.mark.parametrize("x, y, ok", [(0.35, 0.2, True), (0.349, 0.2, False), (0.7, 0.45, False), (0.7, 0.449, True), (1.10, 0.2, False), (None, None, True)])
def test_zone_bounds(spark, x, y, ok):
    z = F.lit(None).cast("double")
    zone = F.array(F.struct(F.lit(0.5).alias("x_min"), F.lit(0.95).alias("x_max"), z.alias("y_min"), F.lit(0.30).alias("y_max")))
    df = spark.createDataFrame([(x, y)], "x double, y double")
    assert df.select(Z.check(F.col("x"), F.col("y"), zone)["ok"]).first()[0] is ok


def test_zone_rules():
    assert zones(None) == [] and zones({"x_min": 0.1}) == [(0.1, None, None, None)] and len(zones([{"y_max": 1.0}, "no", None])) == 1


@pytest.mark.parametrize(
    "mode, n, auth, code, has",
    [("single_only", 2, True, 2, False), ("single_only", 1, True, 0, False), ("single_only", 0, True, -1, False), ("single_or_dual", 1, True, 1, True), ("single_or_dual", 1, False, 0, False), ("dual_required", 1, False, 3, False), ("dual_required", 1, True, 1, True), ("dual_required", 2, True, 2, True)],
)
def test_dual_table(spark, mode, n, auth, code, has):
    r = spark.range(1).select(seals.dual_status(F.lit(n), F.lit(auth), F.lit(mode)).alias("s")).first()["s"]
    assert (r["code"], r["has_auth"]) == (code, has)


def test_score_goldens(spark):
    def face(w, h):
        return F.array(*[G.point(F.lit(x), F.lit(y)) for x, y in ((0, 0), (w, 0), (w, h), (0, h))])

    inside, low, high = F.array(G.point(F.lit(5), F.lit(5))), F.lit(1.2), F.lit(2.0)
    got = [spark.range(1).select(F.round(faces.score(face(w, h), inside, low, high, F.lit(w * h / share)), 4)).first()[0] for w, h, share in ((117, 100, 0.265), (102, 100, 0.70))]
    assert got == [3.0592, 3.0175]


def test_homography_and_rectangle(spark):
    import random

    rng = random.Random(5)
    rows = []
    for _ in range(50):
        j = [rng.uniform(0, 30) for _ in range(8)]
        rows.append(([(0 + j[0], 0 + j[1]), (200 + j[2], 0 + j[3]), (200 + j[4], 150 + j[5]), (0 + j[6], 150 + j[7])],))
    df = spark.createDataFrame(rows, "pts array<struct<x:double,y:double>>").withColumn("c", G.order_corners(F.col("pts")))
    df = df.withColumn("m", G.homography(F.col("c"), F.lit(300), F.lit(200))).withColumn("t", G.mapped(F.col("c"), F.col("m"), F.lit(0), F.lit(0))).withColumn("r", G.min_area_rect(F.col("pts"))).withColumn("b", G.bbox(F.col("pts"))).withColumn("a", G.area(F.col("pts")))
    for r in df.collect():
        for p, (x, y) in zip(r["t"], ((0, 0), (299, 0), (299, 199), (0, 199))):
            assert abs(p["x"] - x) < 1e-6 and abs(p["y"] - y) < 1e-6
        assert r["a"] - 1e-6 <= r["r"]["area"] <= (r["b"]["x2"] - r["b"]["x1"]) * (r["b"]["y2"] - r["b"]["y1"]) + 1e-6
    flat = spark.range(1).select(G.homography(F.array(*[G.point(F.lit(1), F.lit(1))] * 4), F.lit(3), F.lit(2))).first()[0]
    assert flat is None


def test_faces_keep_the_first_of_near_ones(spark):
    at = lambda x: ("edge", [(x, 0.0), (x + 10, 0.0), (x + 10, 10.0), (x, 10.0)])
    df = spark.createDataFrame([([at(0.0), at(49.0), at(60.0), at(100.0)],), ([],), (None,)], "q array<struct<source:string,pts:array<struct<x:double,y:double>>>>")
    once = df.select(faces.dedup_centers(F.col("q")).alias("q"))
    assert [r["q"] and [q["pts"][0]["x"] for q in r["q"]] for r in once.collect()] == [[0.0, 60.0], [], None]
    assert once.select(faces.dedup_centers(F.col("q")).alias("q")).collect() == once.collect()


def test_stamps(spark):
    cases = [(["09:15 | 2024-05-01", "| ", "西安xxx", "abc"], ("09:15 2024-05-01", "西安xxx")), (["星期三｜晴", "西安xxxx"], ("星期三 晴", "")), ([], ("", "")), (["　 10:30 　"], ("10:30", ""))]
    df = spark.createDataFrame([(c,) for c, _ in cases], "s array<string>")
    assert [tuple(r["p"]) for r in df.select(T.parse_stamp(F.col("s")).alias("p")).collect()] == [e for _, e in cases]


def test_unpivot_and_resume(spark):
    orders = spark.createDataFrame([("1", "a", "", "nan", None), ("1", "a", " ", None, "b"), (None, None, None, None, None)], "order_id string, img_1 string, img_2 string, img_3 string, img_4 string")
    assert [r["image_idx"] for r in photos.unpivot_photos(orders).collect()] == [1, 3, 1, 2, 4]
    assert [r["image_idx"] for r in photos.unpivot_photos(orders.drop("img_4"), clean=True).collect()] == [1, 1]
    done = spark.createDataFrame([(None, None), ("9", "bad")], "order_id string, error string")
    assert photos.resume(orders, done).count() == 2
    again = spark.createDataFrame([("9",), ("1",)], "order_id string")
    assert photos.resume(again, done).count() == 1 and photos.resume(again, done, retry_errors=True).count() == 2


def test_decimals_are_rounded_by_exact_value(spark):
    values = [k / n for n in (400, 320, 2000, 7) for k in range(-40, 900)] + [0.0625, 0.1875, 2.5, 1e-9, 123456.0005]
    df = spark.createDataFrame([(float(v),) for v in [*values]], "v double").coalesce(1)
    got = df.select("v", *[T.number(F.col("v"), d).alias(f"d{d}") for d in (0, 1, 2, 3)], T.number(F.col("v"), 1, True).alias("s")).collect()
    for r in got:
        assert [r["d0"], r["d1"], r["d2"], r["d3"], r["s"]] == [format(r["v"], f) for f in (".0f", ".1f", ".2f", ".3f", "+.1f")], r
    assert spark.range(1).select(T.number(F.lit(None).cast("double"), 3)).first()[0] is None


def test_widths_are_exact_where_distances_tie(spark):
    """The width of a box of whole numbers, and whether a text is farther than twice that: equal isn't farther."""
    boxes = [(cx, cy, hw, hh, sk) for cx, cy in ((3, 7), (517, 311)) for hw in (11, 12, 24, 37, 60) for hh in (5, 8) for sk in range(-10, 11)]
    poly = lambda cx, cy, hw, hh, sk: [(float(cx - hw), float(cy - hh - sk)), (float(cx + hw), float(cy - hh + sk)), (float(cx + hw), float(cy + hh + sk)), (float(cx - hw), float(cy + hh - sk))]
    df = spark.createDataFrame([(*b, poly(*b)) for b in boxes], "cx int, cy int, hw int, hh int, sk int, p array<struct<x:double,y:double>>")
    rows = df.select("*", G.min_area_rect(F.col("p"))["short"].alias("short")).collect()
    assert len(rows) == len(boxes) and all(r["short"] == 2 * r["hh"] * r["hw"] / (r["hw"] ** 2 + r["sk"] ** 2) ** 0.5 for r in rows)
    seal = (0, SCAN, poly(100, 100, 12, 5, 9))  # 8 wide: 16 away is not farther than twice that
    df = spark.createDataFrame([(i, [seal, (1, "Authorized Reseller", poly(100, 100 + d, 12, 5, 9))]) for i, d in enumerate((16, 17))], "i int, d array<struct<text_idx:int,text:string,poly:array<struct<x:double,y:double>>>>")
    main = seals.find_seals(F.col("d"))[0]
    assert [r["flat"] for r in df.withColumn("m", main).select("i", seals.flat(F.col("d"), F.col("m"), F.lit(1000), F.lit(800)).alias("flat")).orderBy("i").collect()] == [False, True]


def test_scores_in_columns(spark):
    """Up to twelve faces and five seals, more than are written out; null faces, ties, no seals, no aspect range."""
    import random

    rng = random.Random(8)
    point = lambda: (rng.randint(0, 40) / 4, rng.randint(0, 40) / 4)
    rows = []
    for i in range(60):
        quads = [("edge", None if i % 12 == 11 and k == 1 else [point() for _ in range(4)]) for k in range(i % 12)]
        quads += quads[:1] if i % 5 == 0 else []  # a tie
        rows.append((i, quads if i != 50 else None, [point() for _ in range(i % 6)] if i % 7 else None, *((None, None) if i % 4 == 0 else (1.1, 1.6))))
    pt = "array<struct<x:double,y:double>>"
    df = spark.createDataFrame(rows, f"i int, quads array<struct<source:string,pts:{pt}>>, centers {pt}, low double, high double")
    args = (F.col("centers"), F.col("low"), F.col("high"), F.lit(100))
    each = df.select("*", F.posexplode("quads").alias("k", "q"))
    both = faces.scored(each.withColumn("one", faces.score(F.col("q.pts"), *args)), F.col("q.pts"), *args).where("q.pts is not null").collect()
    assert len(both) > 300 and all(r["one"] == r["score"] for r in both)
    area = {(r["i"], r["k"]): r["a"] for r in each.select("i", "k", G.face_area(F.col("q.pts")).alias("a")).collect()}
    scores = {(r["i"], r["k"]): (round(r["one"], 9), area[r["i"], r["k"]], -r["k"]) for r in both}
    one = df.select("i", faces.front_face(F.col("quads"), *args).alias("face"))
    many = faces.front_faces(df, ["i"], F.col("quads"), *args)
    for got, of_all in (({r["i"]: r["face"] for r in one.collect()}, True), ({r["i"]: r["face"] for r in many.collect()}, False)):
        for i, quads, *_ in rows:
            of = [k for k in range(len(quads or [])) if (i, k) in scores]
            best = 0 if len(quads or []) == 1 else max(of, key=lambda k: scores[i, k], default=None)
            assert of_all or (i in got) == bool(quads)
            face = got.get(i)
            assert (face and [tuple(p) for p in face["pts"]]) == (None if best is None else quads[best][1]), i


def test_scores_are_compiled(spark):
    """Above the faces' rows no value is bound by a function over an array, which Spark interprets."""
    import __spark_entry__

    plan = __spark_entry__.queries()["score_face"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(array(" not in plan


def test_photos_are_collected_in_order(spark):
    """A photo's boxes come sorted to what collects them: no grouping in two steps, no lists sorted or closed to rings by interpreted code, and
    no method that is too long for the JVM to compile (8,000 bytes)."""
    import re

    import __spark_entry__

    for name in ("score_face", "front_face", "points_in_quads"):
        text = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "sort_array(" not in text and "concat(" not in text, name
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            df = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")
            code = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
        assert sizes and max(sizes) < 8000, (name, sizes)
    assert "ObjectHashAggregate" not in __spark_entry__.queries()["score_face"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_full_verdict_at_scale(spark):
    """The faces of photos are made by compiled code; a seal is measured once; pixels are made of the wanted photos only."""
    import re

    from sealstone.plans import inputs

    sf = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = spark._jvm.PythonSQLUtils.explainString(inputs.faced(spark, sf)._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)) < 8000
    box = "struct<text_idx:int,text:string,poly:array<struct<x:double,y:double>>,cx:double,cy:double>"
    ring = [(100.0, 95.0), (124.0, 104.0), (124.0, 112.0), (100.0, 103.0), (100.0, 95.0)]
    own, other = (0, SCAN, ring, 112.0, 103.5), (1, "Authorized Reseller", [(x, y + 40) for x, y in ring], 112.0, 143.5)
    zone = [(0.0, 1.0, 0.0, 1.0)]
    df = spark.createDataFrame([(1, [own], own, zone), (2, [own, other], own, zone), (3, [own], own, [(0.9, 1.0, 0.9, 1.0)])], f"i int, d array<{box}>, m {box}, z array<struct<x_min:double,x_max:double,y_min:double,y_max:double>>")
    placed = df.select("i", seals.placement(F.col("d"), F.col("m"), F.lit(400), F.lit(300), F.col("z")).alias("p"), F.round(G.min_area_rect(F.col("m.poly"))["angle"], 2).alias("angle"))
    got = {r["i"]: r for r in placed.collect()}
    assert [got[i]["p"]["position_valid"] for i in (1, 2, 3)] == [1, 2, 0] and got[1]["p"]["angle"] == got[1]["angle"] and got[3]["p"]["angle"] is None
    plan = df.select(seals.placement(F.col("d"), F.col("m"), F.lit(400), F.lit(300), F.col("z")).alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ATAN2") == 2  # the main seal's and, where there is one, a dealer's text's
    wanted = spark.createDataFrame([("0", 2), ("40", 1), ("80", 9), ("7", 1)], "order_id string, image_idx int")
    every = inputs.photo_pixels(spark, sf).join(wanted, ["order_id", "image_idx"], "left_semi")
    some = inputs.photo_pixels(spark, sf, wanted).select(every.columns)
    assert some.count() == every.count() > 1600 and some.exceptAll(every).isEmpty()
