"""One query for each operator, over the inputs of plans.inputs."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sealstone.checkpoints import saved, scratch
from sealstone.functions import geometry as G
from sealstone.functions import text as T
from sealstone.functions import zones as Z
from sealstone.operators import faces, grid, photos, reports, seals, verdict
from sealstone.plans import inputs
from sealstone.plans.oracle import FX, stamp
from sealstone.plans.verdicts import verdict_v1, verdict_v2
from sealstone.rules import rule_book
from sealstone.sources import hooks, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = FX + sql
        return f

    return register


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"


def _photos(spark, d) -> DataFrame:
    return inputs.photos(spark, d)


def _texts(spark, sf_dir) -> DataFrame:
    """order_id, image_idx and one text box each."""
    d = F.struct("text_idx", "text", inputs.polygon().alias("poly"))
    return inputs.view(spark, sf_dir, "fx_boxes").select("order_id", "image_idx", d.alias("d"))


def _with_orders(spark, d, of: DataFrame) -> DataFrame:
    """Photos with their order's rule. The photos stay where they are, unsorted; the narrow orders come to them, and the rules to both."""
    return photos.with_rules(of.join(inputs.orders(spark, d).hint("shuffle_hash"), "order_id"), rule_book(spark))


def _ruled(spark, d) -> DataFrame:
    """Photos in the frame of their boxes, with their order's rule."""
    p = _with_orders(spark, d, _photos(spark, d))
    return p.withColumn("dets", F.transform("detections", lambda x: F.struct(x["text_idx"].alias("text_idx"), x["text"].alias("text"), G.moved(x["poly"], F.col("box.x"), F.col("box.y")).alias("poly"))))


def _sealed(spark, d) -> DataFrame:
    """One row for each seal, in the frame of its box."""
    s = _ruled(spark, d).withColumn("seal", F.explode(seals.find_seals(F.col("dets"))))
    return s.withColumn("rx", G.relative(F.col("seal.cx"), F.col("box.w"))).withColumn("ry", G.relative(F.col("seal.cy"), F.col("box.h")))


# Scans, sinks and reshaping


@query("SELECT * FROM fx_orders")
def scan_orders(spark, d):
    """Orders through a CSV file, ids and product lines as text."""
    path = _fresh(spark, "orders-csv")
    inputs.orders(spark, d).write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return tables.read_orders(spark, path, schema="order_id string, lob string")


@query("SELECT order_id, is_compliant, dual_code FROM verdict")
def scan_results(spark, d):
    path = _fresh(spark, "results-csv")
    verdict_v2(spark, d).select("order_id", "is_compliant", "dual_code").write.mode("overwrite").option("header", True).csv(path)
    return tables.read_results(spark, path, "order_id string, is_compliant int, dual_code int")


@query("SELECT order_id, keyword, paste_error FROM verdict1")
def export_results(spark, d):
    """Appended in two parts, then exported as one."""
    path, out = _fresh(spark, "appended"), _fresh(spark, "exported")
    v = saved(verdict_v1(spark, d).select("order_id", "keyword", "paste_error"), "v1")
    first = F.pmod(F.xxhash64("order_id"), F.lit(2)) == 0
    tables.append_csv(v.where(first), path)
    tables.append_csv(v.where(~first), path)
    return tables.export(spark, path, out, schema="order_id string, keyword string, paste_error int").withColumn("keyword", F.coalesce("keyword", F.lit("")))


_URLS = "CASE WHEN method = 'fallback' THEN '' WHEN j = 3 THEN 'nan' ELSE 'img/' || order_id || '/' || image_idx END AS url"


@query(f"SELECT * FROM (SELECT order_id, image_idx, {_URLS} FROM fx_photos) t WHERE url <> ''")
def unpivot_photos(spark, d):
    return photos.unpivot_photos(inputs.urls(_photos(spark, d)))


@query(f"SELECT * FROM (SELECT order_id, image_idx, {_URLS} FROM fx_photos) t WHERE url NOT IN ('', 'nan')")
def unpivot_photos_clean(spark, d):
    return photos.unpivot_photos(inputs.urls(_photos(spark, d)), clean=True)


@query("SELECT order_id, lob FROM ord")
def resolve_lob(spark, d):
    return photos.with_rules(inputs.orders(spark, d), rule_book(spark)).select("order_id", "lob")


@query("SELECT order_id, is_compliant, seal_exists, position_valid, dual_code FROM verdict WHERE lob = 'UNKNOWN LOB'")
def unknown_lob_branch(spark, d):
    return verdict_v2(spark, d).where(~photos.known(F.col("lob"))).select("order_id", "is_compliant", "seal_exists", "position_valid", "dual_code")


@query("SELECT order_id, image_idx, keyword FROM keyed")
def keyword_hit(spark, d):
    return _photos(spark, d).select("order_id", "image_idx", T.keyword_hit(T.joined(F.col("detections"))).alias("keyword"))


@query("SELECT order_id, image_idx, err FROM keyed")
def keyword_cooccur(spark, d):
    return _photos(spark, d).select("order_id", "image_idx", T.keyword_cooccur(T.joined(F.col("detections"))).alias("err"))


@query("SELECT order_id, image_idx, contains(t, '扫码即领') AS has_seal FROM joined")
def photo_has_seal(spark, d):
    return _photos(spark, d).select("order_id", "image_idx", T.photo_has_seal(F.col("detections")).alias("has_seal"))


@query("SELECT order_id, image_idx, CASE WHEN texts >= 2 AND NOT official THEN substr(first_text, 1, 40) END AS dealer FROM photo")
def dealer_only(spark, d):
    return _photos(spark, d).select("order_id", "image_idx", T.dealer_only(F.col("detections")).alias("dealer"))


@query("SELECT order_id, image_idx, round(w * h / 800000, 6) AS ratio FROM fx_photos WHERE method <> 'fallback' AND w * h / 800000 >= 0.1")
def front_photo_filter(spark, d):
    of = (F.col("box"), F.col("img_w"), F.col("img_h"))
    return _photos(spark, d).where(photos.is_front(*of, least=0.1)).select("order_id", "image_idx", F.round(photos.box_ratio(*of), 6).alias("ratio"))


@query("SELECT o.order_id, role, nth, x_min, x_max, y_min, y_max FROM ord o JOIN zones z ON o.lob = z.lob")
def rules_zones(spark, d):
    o = photos.with_rules(inputs.orders(spark, d), rule_book(spark))
    role = lambda n: o.select("order_id", F.lit(n).alias("role"), F.posexplode(f"{n}_zones").alias("nth", "z")).select("order_id", "role", "nth", "z.*")
    return role("scan").unionByName(role("auth"))


@query("SELECT order_id, image_idx, text_idx, ok FROM seals")
def zone_check(spark, d):
    return _sealed(spark, d).select("order_id", "image_idx", "seal.text_idx", Z.in_any(F.col("rx"), F.col("ry"), F.col("scan_zones")).alias("ok"))


@query("SELECT order_id, image_idx, text_idx, ok, x_ok, y_ok FROM seals")
def zone_explain(spark, d):
    return _sealed(spark, d).withColumn("c", Z.check(F.col("rx"), F.col("ry"), F.col("scan_zones"))).select("order_id", "image_idx", "seal.text_idx", "c.ok", "c.x_ok", "c.y_ok")


@query("SELECT order_id, coalesce(CAST(rel_x AS VARCHAR), '') <> '' AS has_x, coalesce(box_method, '') AS box_method, coalesce(box_quad_src, '') AS box_quad_src FROM verdict")
def verdict_projection(spark, d):
    """The verdict as a sink wants it, without nulls in texts."""
    v = verdict_v2(spark, d)
    return v.select("order_id", F.col("rel_x").isNotNull().alias("has_x"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("box_method", "box_quad_src")])


@query("""SELECT order_id, CASE WHEN bad THEN NULL ELSE is_compliant END AS is_compliant, CASE WHEN bad THEN -1 ELSE seal_exists END AS seal_exists, CASE WHEN bad THEN -1 ELSE position_valid END AS position_valid,
  CASE WHEN bad THEN 'ERROR' ELSE detail END AS detail, CASE WHEN bad THEN 'ValueError: unreadable' END AS error FROM verdict JOIN (SELECT o.order_id, coalesce(bool_or(j = 3), false) AS bad FROM fx_orders o LEFT JOIN fx_photos p USING (order_id) GROUP BY 1) USING (order_id)""")
def quarantine(spark, d):
    """A recogniser that fails for some photos: their orders become error rows, beside the others' verdicts."""

    def recognise(content: bytes) -> str:
        if content == b"!":
            raise ValueError("unreadable")
        return "{}"

    read = _photos(spark, d).select("order_id", "image_idx", "status", F.when(F.col("j") == 3, "!").otherwise("").cast("binary").alias("content"))
    failed = saved(verdict.failures(hooks.recognised(read, lambda: recognise)), "failed")
    v = verdict_v2(spark, d).select("order_id", "is_compliant", "seal_exists", "position_valid", "detail")
    return verdict.quarantined(v, failed)


@query("SELECT o.*, length(o.order_id) AS extra, seal_exists, keyword FROM fx_orders o JOIN verdict1 v ON v.order_id = o.order_id")
def passthrough(spark, d):
    o = inputs.orders(spark, d).withColumn("extra", F.length("order_id"))
    return verdict.verdict_v1(o, _photos(spark, d)).select(*o.columns, "seal_exists", "keyword")


# Joins


@query("SELECT order_id, lob, mode, aspect_lo, aspect_hi, color FROM ord")
def join_rules(spark, d):
    o = photos.with_rules(inputs.orders(spark, d), rule_book(spark))
    return o.select("order_id", "lob", F.col("sticker_count").alias("mode"), "aspect_lo", "aspect_hi", F.col("color.mode").alias("color"))


@query("SELECT order_id, image_idx, text_idx, nth FROM tried WHERE x_ok AND y_ok")
def join_zone_range(spark, d):
    """Flat seals joined with flat zones: product line equal, both axes in the band."""
    book = rule_book(spark).select(F.col("lob").alias("z_lob"), F.posexplode("scan_zones").alias("nth", "z"))
    on = (F.col("lob") == F.col("z_lob")) & Z.axis_ok(F.col("rx"), F.col("z.x_min"), F.col("z.x_max")) & Z.axis_ok(F.col("ry"), F.col("z.y_min"), F.col("z.y_max"))
    return _sealed(spark, d).join(book, on).select("order_id", "image_idx", "seal.text_idx", "nth")


@query("SELECT * FROM fx_orders WHERE order_id NOT IN (SELECT order_id FROM fx_done)")
def resume_anti_join(spark, d):
    return photos.resume(inputs.orders(spark, d), inputs.view(spark, d, "fx_done"))


_CORNERS = """
corners AS (SELECT order_id, image_idx, k, 100 + 11 * k + d AS x0, 80 + 7 * k AS y0, 100 + w - 5 * k + d AS x1, 80 + 3 * k + j AS y1, 100 + w - 3 * k + d AS x2, 80 + h - 9 * k AS y2, 100 + 2 * k + j + d AS x3, 80 + h - 4 * k AS y3, w, h, j
  FROM (SELECT *, CASE WHEN k = 2 THEN 120 ELSE 0 END AS d FROM fx_photos, (VALUES (0), (1), (2)) t(k))),
quads AS MATERIALIZED (SELECT *, abs((x0 * y1 - x1 * y0) + (x1 * y2 - x2 * y1) + (x2 * y3 - x3 * y2) + (x3 * y0 - x0 * y3)) / 2 AS area, (x0 + x1 + x2 + x3) / 4 AS mx, (y0 + y1 + y2 + y3) / 4 AS my FROM corners),
sized AS (SELECT *, greatest(sqrt(power(x0 - x1, 2) + power(y0 - y1, 2)), sqrt(power(x3 - x2, 2) + power(y3 - y2, 2))) AS qw, greatest(sqrt(power(x0 - x3, 2) + power(y0 - y3, 2)), sqrt(power(x1 - x2, 2) + power(y1 - y2, 2))) AS qh FROM quads),
inside AS (SELECT q.order_id, q.image_idx, q.k, b.text_idx, ((x1 - x0) * (b.ring_y - y0) - (y1 - y0) * (b.ring_x - x0)) AS c0, ((x2 - x1) * (b.ring_y - y1) - (y2 - y1) * (b.ring_x - x1)) AS c1, ((x3 - x2) * (b.ring_y - y2) - (y3 - y2) * (b.ring_x - x2)) AS c2, ((x0 - x3) * (b.ring_y - y3) - (y0 - y3) * (b.ring_x - x3)) AS c3
  FROM quads q JOIN (SELECT *, (5 * cx - hw) / 5.0::DOUBLE AS ring_x, (5 * cy - hh - sk) / 5.0::DOUBLE AS ring_y FROM pb) b ON q.order_id = b.order_id AND q.image_idx = b.image_idx WHERE b.is_seal),
within AS MATERIALIZED (SELECT order_id, image_idx, k, text_idx FROM inside WHERE least(c0, c1, c2, c3) >= 0 OR greatest(c0, c1, c2, c3) <= 0),
scored AS (SELECT s.*, o.aspect_lo, o.aspect_hi, CASE WHEN i.k IS NOT NULL THEN 2 ELSE 0 END
    + CASE WHEN aspect_lo IS NULL THEN 0 WHEN greatest(qw, qh) / greatest(least(qw, qh), 1) BETWEEN aspect_lo AND aspect_hi THEN 1.5
      ELSE greatest(0, 1 - 0.6 * greatest(aspect_lo - greatest(qw, qh) / greatest(least(qw, qh), 1), greatest(qw, qh) / greatest(least(qw, qh), 1) - aspect_hi)) END
    + 0.15 * least(1, sqrt(area / 800000)) AS score
  FROM sized s JOIN ord o ON s.order_id = o.order_id LEFT JOIN (SELECT DISTINCT order_id, image_idx, k FROM within) i ON i.order_id = s.order_id AND i.image_idx = s.image_idx AND i.k = s.k)
"""


def face_query(sql: str):
    return query(f", {_CORNERS} {sql}")


def _faces(spark, d) -> DataFrame:
    return inputs.faces(spark, d)


def _each_face(spark, d) -> DataFrame:
    return faces.each_face(_faces(spark, d), F.col("quads"), "order_id", "image_idx", "box", "img_w", "img_h", "detections")


@face_query("SELECT order_id, image_idx, k, text_idx FROM within")
def points_in_quads(spark, d):
    """The test for inside is bound to the face's points: written out in a filter it makes a method that is too long for the JVM to compile."""
    s = _faces(spark, d).select("order_id", "image_idx", "quads", F.explode(seals.find_seals(F.col("detections"))).alias("s"))
    f = faces.each_face(s.withColumn("c", G.mean_center(F.col("s.poly"))), F.col("quads"), "order_id", "image_idx", "s.text_idx", "c")
    inside = G.let(F.col("q.pts"), lambda pts: G.face_contains(pts, F.col("c.x"), F.col("c.y")))
    return f.where(inside).select("order_id", "image_idx", "k", "text_idx")


@query("SELECT order_id, image_idx, text_idx, text FROM fx_boxes WHERE text_idx < 1")
def zip_texts_polys(spark, d):
    """Texts and polygons aligned by their place, here with a polygon for the first text only."""
    p = _photos(spark, d).select("order_id", "image_idx", F.col("detections.text").alias("t"), F.slice("detections.poly", 1, 1).alias("p"))
    zipped = F.filter(F.transform("t", lambda t, i: F.struct(i.alias("text_idx"), t.alias("text"), F.get("p", i).alias("poly"))), lambda z: z["poly"].isNotNull())
    return p.select("order_id", "image_idx", F.explode(zipped).alias("z")).select("order_id", "image_idx", "z.text_idx", "z.text")


@query("SELECT order_id, image_idx, text_idx FROM flat")
def flat_self_join(spark, d):
    s = _sealed(spark, d)
    return s.where(seals.flat(F.col("dets"), F.col("seal"), F.col("box.w"), F.col("box.h"))).select("order_id", "image_idx", "seal.text_idx")


@face_query("""SELECT a.order_id, a.image_idx, 1 + (sqrt(power(b.mx - a.mx, 2) + power(b.my - a.my, 2)) >= 50)::INT + (CASE WHEN sqrt(power(b.mx - a.mx, 2) + power(b.my - a.my, 2)) >= 50
  THEN sqrt(power(c.mx - a.mx, 2) + power(c.my - a.my, 2)) >= 50 AND sqrt(power(c.mx - b.mx, 2) + power(c.my - b.my, 2)) >= 50 ELSE sqrt(power(c.mx - a.mx, 2) + power(c.my - a.my, 2)) >= 50 END)::INT AS kept
  FROM quads a JOIN quads b ON a.order_id = b.order_id AND a.image_idx = b.image_idx AND a.k = 0 AND b.k = 1 JOIN quads c ON a.order_id = c.order_id AND a.image_idx = c.image_idx AND c.k = 2""")
def dedup_centers(spark, d):
    return _faces(spark, d).select("order_id", "image_idx", F.size(faces.dedup_centers(F.col("quads"))).alias("kept"))


@query("SELECT order_id, image_idx, text_idx, cx, cy FROM pb WHERE is_seal")
def seal_polys(spark, d):
    c = G.bbox(F.col("s.poly"))
    return _photos(spark, d).select("order_id", "image_idx", F.explode(seals.find_seals(F.col("detections"))).alias("s")).select("order_id", "image_idx", "s.text_idx", c["cx"].cast("long").alias("cx"), c["cy"].cast("long").alias("cy"))


# Aggregations


@query("SELECT count(*) AS total, count(*) FILTER (WHERE is_compliant = 1) AS compliant, count(*) FILTER (WHERE is_compliant = 0) AS not_compliant, count(*) FILTER (WHERE seal_exists = 1) AS with_seal, count(*) FILTER (WHERE position_valid = 1) AS in_place, count(*) FILTER (WHERE position_valid = 0) AS misplaced, count(*) FILTER (WHERE position_valid = 2) AS flat, count(*) FILTER (WHERE position_valid = 3) AS turned, count(*) FILTER (WHERE position_valid = 4) AS foreign, count(*) FILTER (WHERE position_valid = -1) AS no_front_photo, count(*) FILTER (WHERE dual_code = 1) AS dual, count(*) FILTER (WHERE dual_code = 2) AS double_seal FROM verdict")
def summary_counts(spark, d):
    return reports.summary(verdict_v2(spark, d))


@query("SELECT count(*) FILTER (WHERE seal_exists = 1) AS with_seal, count(*) FILTER (WHERE seal_exists = 0) AS without_seal, count(*) FILTER (WHERE seal_exists = -1) AS failed, count(*) FILTER (WHERE paste_error = 1) AS paste_errors FROM verdict1")
def summary_counts_v1(spark, d):
    return reports.summary_v1(verdict_v1(spark, d))


@query("SELECT lob, count(*) AS n FROM fx_orders GROUP BY lob")
def dist_lob(spark, d):
    """Of the lines as they stand in the orders, null among them."""
    return reports.distribution(inputs.orders(spark, d), "lob")


@query("SELECT rectify_method, count(*) AS n FROM verdict GROUP BY rectify_method")
def dist_rectify(spark, d):
    return reports.distribution(verdict_v2(spark, d), "rectify_method")


@query("SELECT lob, rectify_method, grouping(lob) AS not_by_lob, count(*) AS n FROM verdict GROUP BY GROUPING SETS ((lob), (rectify_method))")
def dist_grouping_sets(spark, d):
    return reports.distributions(verdict_v2(spark, d))


@query("SELECT lob, count(*) AS n, round(avg(is_compliant), 6) AS rate FROM verdict GROUP BY lob")
def rate_by_lob(spark, d):
    return reports.rate_by_lob(verdict_v2(spark, d))


@query("SELECT * FROM joined")
def text_concat(spark, d):
    return _photos(spark, d).select("order_id", "image_idx", T.joined(F.col("detections")).alias("t"))


@query("SELECT order_id, image_idx, any_auth FROM photo")
def any_keyword(spark, d):
    return _photos(spark, d).select("order_id", "image_idx", seals.any_auth(F.col("detections")).alias("any_auth"))


@query("SELECT order_id, image_idx, text_idx, cx - hw AS x1, cy - hh - abs(sk) AS y1, cx + hw AS x2, cy + hh + abs(sk) AS y2, cx, cy FROM fx_boxes")
def poly_bbox(spark, d):
    b = _texts(spark, d).withColumn("b", G.bbox(F.col("d.poly")))
    return b.select("order_id", "image_idx", "d.text_idx", *[F.col(f"b.{k}").cast("long").alias(k) for k in ("x1", "y1", "x2", "y2", "cx", "cy")])


@face_query("SELECT order_id, image_idx, k, mx, my FROM quads")
def poly_mean_center(spark, d):
    return _each_face(spark, d).withColumn("c", G.mean_center(F.col("q.pts"))).select("order_id", "image_idx", "k", F.col("c.x").alias("mx"), F.col("c.y").alias("my"))


@query("SELECT order_id, image_idx, n FROM counted")
def distinct_seals(spark, d):
    s = _ruled(spark, d).withColumn("s", seals.find_seals(F.col("dets"))).where(F.size("s") > 0)
    return s.select("order_id", "image_idx", seals.distinct_seals(F.col("s"), F.col("box.h")).alias("n"))


@query("SELECT image, CASE WHEN count(*) FILTER (WHERE v > 180 AND s < 55) > 200 THEN quantile_cont(s, 0.9) FILTER (WHERE v > 180 AND s < 55) ELSE 0 END AS ref FROM fx_pixels GROUP BY image")
def baseline_percentile(spark, d):
    return grid.baseline(inputs.view(spark, d, "fx_pixels"))


@query("""SELECT done, round(s / done, 4) AS avg_s, round((total - done) * (s / done) / 3600, 4) AS eta_h, round(100 * done / total, 4) AS percent
  FROM (SELECT (epoch_us(ts) - epoch_us(min(ts) OVER ())) / 1e6 AS s, row_number() OVER (ORDER BY ts, event_id) AS done, count(*) OVER () AS total FROM events) t WHERE done % 50 = 0""")
def throughput_every_50(spark, d):
    return reports.throughput(spark.read.parquet(f"{d}/events.parquet"), ["ts", "event_id"], "ts")


# Ranking


@query("SELECT DISTINCT ON (order_id) order_id, image_idx FROM fx_photos ORDER BY order_id, w * h DESC, image_idx")
def best_photo(spark, d):
    ratio = photos.box_ratio(F.col("box"), F.col("img_w"), F.col("img_h"))
    return _photos(spark, d).groupBy("order_id").agg(F.max_by("image_idx", F.struct(ratio, -F.col("image_idx"))).alias("image_idx"))


def _main(spark, d) -> DataFrame:
    s = _ruled(spark, d).withColumn("m", seals.main_seal(seals.find_seals(F.col("dets")), F.col("box.w"), F.col("box.h"), F.col("scan_zones")))
    return s.where("m is not null")


@query("SELECT order_id, image_idx, text_idx FROM seals WHERE rank = 1")
def main_seal(spark, d):
    return _main(spark, d).select("order_id", "image_idx", "m.text_idx")


def _centered(spark, d) -> DataFrame:
    f = _with_orders(spark, d, _faces(spark, d))
    return f.withColumn("centers", seals.seal_centers(F.col("detections")))


@face_query("SELECT order_id, image_idx, arg_max(x0, (round(score, 9), area, -k)) AS x0, arg_max(y0, (round(score, 9), area, -k)) AS y0 FROM scored GROUP BY order_id, image_idx")
def front_face(spark, d):
    f = faces.front_faces(_centered(spark, d), ["order_id", "image_idx"], F.col("quads"), F.col("centers"), F.col("aspect_lo"), F.col("aspect_hi"), F.lit(800000))
    return f.select("order_id", "image_idx", F.col("face.pts")[0]["x"].cast("long").alias("x0"), F.col("face.pts")[0]["y"].cast("long").alias("y0"))


@face_query("SELECT order_id, image_idx, k, round(score, 6) AS score FROM scored")
def score_face(spark, d):
    f = faces.each_face(_centered(spark, d), F.col("quads"), "order_id", "image_idx", "centers", "aspect_lo", "aspect_hi")
    f = faces.scored(f, F.col("q.pts"), F.col("centers"), F.col("aspect_lo"), F.col("aspect_hi"), F.lit(800000))
    return f.select("order_id", "image_idx", "k", F.round("score", 6).alias("score"))


@face_query("SELECT order_id, image_idx, rank, area FROM (SELECT *, row_number() OVER (PARTITION BY order_id, image_idx ORDER BY area DESC, k) - 1 AS rank FROM quads) t WHERE rank < 2")
def top_faces(spark, d):
    f = _faces(spark, d).select("order_id", "image_idx", F.posexplode(faces.top_faces(F.col("quads"), 2)).alias("rank", "q"))
    return f.select("order_id", "image_idx", F.col("rank").cast("long").alias("rank"), G.area(F.col("q.pts")).alias("area"))


@query("SELECT order_id, keyword, err FROM hits")
def first_hit(spark, d):
    text = T.joined(F.col("detections"))
    p = _photos(spark, d).select("order_id", "image_idx", T.keyword_hit(text).alias("keyword"), T.keyword_cooccur(text).alias("err")).where("keyword is not null")
    return p.groupBy("order_id").agg(F.min_by(F.struct("keyword", "err"), "image_idx").alias("h")).select("order_id", "h.*")


@query("SELECT order_id, stamp_time, stamp_place FROM stamps")
def first_stamp(spark, d):
    return verdict.first_stamp(_photos(spark, d)).select("order_id", F.col("stamp.time").alias("stamp_time"), F.col("stamp.place").alias("stamp_place"))


@query("SELECT order_id, dealer FROM dealers")
def first_dealer_text(spark, d):
    p = _photos(spark, d).select("order_id", "image_idx", T.dealer_only(F.col("detections")).alias("dealer")).where("dealer is not null")
    return p.groupBy("order_id").agg(F.min_by("dealer", "image_idx").alias("dealer"))


@query("SELECT * FROM auth")
def auth_pick(spark, d):
    a = _ruled(spark, d).withColumn("a", seals.auth_position(F.col("dets"), F.col("box.w"), F.col("box.h"), F.col("auth_zones")))
    return a.where("a.found").select("order_id", "image_idx", "a.ok", "a.rel_x", "a.rel_y")


@face_query("""SELECT order_id, image_idx, CASE WHEN k IS NULL THEN 'fallback' WHEN k % 2 = 0 THEN 'edge' ELSE 'bright' END AS method, coalesce(bw, 1000) AS bw, coalesce(bh, 800) AS bh FROM fx_photos p LEFT JOIN (
  SELECT DISTINCT ON (order_id, image_idx) order_id, image_idx, k, bw, bh FROM (SELECT *, greatest(x0, x1, x2, x3) - least(x0, x1, x2, x3) AS bw, greatest(y0, y1, y2, y3) - least(y0, y1, y2, y3) AS bh FROM quads) t
  WHERE area >= 64000 AND bw / bh BETWEEN 0.2 AND 5 AND (k % 2 = 1 OR bw * bh >= 64000) ORDER BY order_id, image_idx, k % 2, area DESC, k) c USING (order_id, image_idx)""")
def tiered_box(spark, d):
    """Faces stand for contours: the first and third for edges, the second for colour."""
    p = saved(_faces(spark, d), "faces")
    b = G.bbox(F.col("q.pts"))
    c = p.select("order_id", "image_idx", F.posexplode("quads").alias("nth", "q")).select("order_id", "image_idx", "nth", (F.col("nth") % 2).alias("tier"), G.area(F.col("q.pts")).alias("area"), b["x1"].alias("bx"), b["y1"].alias("by"), (b["x2"] - b["x1"]).alias("bw"), (b["y2"] - b["y1"]).alias("bh"))
    return photos.tiered_box(c, p).select("order_id", "image_idx", "box.method", F.col("box.w").alias("bw"), F.col("box.h").alias("bh"))


@face_query("""SELECT order_id, image_idx, CASE WHEN image_idx = 1 THEN 'perspective' WHEN image_idx = 2 AND area >= 64000 THEN 'rotation' ELSE 'axis_aligned' END AS rectify_method
  FROM quads WHERE k = 0""")
def tiered_rectify(spark, d):
    """Photo 1 has candidate faces, photo 2 only a rotated rectangle, the others neither."""
    f = _centered(spark, d).withColumn("q", F.when(F.col("image_idx") == 1, F.col("quads")).otherwise(F.filter("quads", lambda q: F.lit(False))))
    turned = F.when(F.col("image_idx") == 2, F.get("quads", F.lit(0))["pts"])  # a contour of four points
    r = faces.rectified(F.col("q"), F.col("centers"), F.col("aspect_lo"), F.col("aspect_hi"), F.col("box"), F.col("img_w"), F.col("img_h"), turned)
    return f.withColumn("r", r).select("order_id", "image_idx", F.col("r.method").alias("rectify_method"))


@query("SELECT order_id, string_agg(image_idx::VARCHAR, ',' ORDER BY image_idx) AS photos FROM fx_photos GROUP BY order_id")
def photo_order(spark, d):
    return _photos(spark, d).groupBy("order_id").agg(F.array_join(F.array_sort(F.collect_list("image_idx")), ",").alias("photos"))


@face_query("SELECT order_id, image_idx, row_number() OVER (PARTITION BY order_id, image_idx ORDER BY k = 1, k) - 1 AS nth, x0 FROM quads")
def union_faces(spark, d):
    f = _faces(spark, d)
    own = lambda s: F.filter("quads", lambda q: q["source"] == s)
    u = f.select("order_id", "image_idx", F.posexplode(faces.united(own("edge"), own("split"))).alias("nth", "q"))
    return u.select("order_id", "image_idx", F.col("nth").cast("long").alias("nth"), F.col("q.pts")[0]["x"].cast("long").alias("x0"))


# Scalars


@query("SELECT order_id, image_idx, text_idx, text = ' AUTHORIZED Reseller' AS is_end FROM fx_boxes")
def endpiece_text(spark, d):
    return _texts(spark, d).select("order_id", "image_idx", "d.text_idx", T.endpiece(F.col("d.text")).alias("is_end"))


_STAMP = stamp("[stamp_1, stamp_2, stamp_3, stamp_4]")


@query(f"SELECT order_id, {_STAMP[0]} AS time, {_STAMP[1]} AS place FROM fx_stamps")
def stamp_parse(spark, d):
    s = inputs.view(spark, d, "fx_stamps").withColumn("s", T.parse_stamp(F.array("stamp_1", "stamp_2", "stamp_3", "stamp_4")))
    return s.select("order_id", "s.*")


@query("SELECT order_id, round(2 / (2 + length(stamp_3) - 2), 6) AS share, length(stamp_3) <= 5 AS kept FROM fx_stamps")
def cjk_ratio_filter(spark, d):
    share = T.cjk_share(F.col("stamp_3"))
    return inputs.view(spark, d, "fx_stamps").select("order_id", F.round(share, 6).alias("share"), (share >= T.CJK_SHARE).alias("kept"))


@query("SELECT order_id, image_idx, text_idx, printf('rel_x=%.3f, rel_y=%.3f', cx / 2000, cy / 320) AS detail FROM fx_boxes")
def detail_text(spark, d):
    """Many of the numbers are halves of a thousandth, some of them exact in binary."""
    f = inputs.view(spark, d, "fx_boxes")
    return f.select("order_id", "image_idx", "text_idx", T.placed(F.col("cx") / 2000, F.col("cy") / 320).alias("detail"))


@query("SELECT order_id, image_idx, text_idx, round((cx + 0.01) / 7000, 4) AS r4, round((cy + 0.01) / 70, 2) AS r2 FROM fx_boxes")
def round_rel(spark, d):
    f = inputs.view(spark, d, "fx_boxes")
    return f.select("order_id", "image_idx", "text_idx", F.round((F.col("cx") + 0.01) / 7000, 4).alias("r4"), F.round((F.col("cy") + 0.01) / 70, 2).alias("r2"))


@face_query("SELECT order_id, image_idx, k, '[[' || x0 || '.0,' || y0 || '.0],[' || x1 || '.0,' || y1 || '.0],[' || x2 || '.0,' || y2 || '.0],[' || x3 || '.0,' || y3 || '.0]]' AS json FROM quads")
def quad_json(spark, d):
    return _each_face(spark, d).select("order_id", "image_idx", "k", G.corners_json(F.col("q.pts")).alias("json"))


@query("SELECT order_id, image_idx, text_idx, text, CASE WHEN text_idx < 1 THEN cx - hw END AS x0 FROM fx_boxes")
def parse_recogniser_json(spark, d):
    """Texts and fewer polygons, in the recogniser's JSON, under boxes for odd photos."""
    polys = F.transform(F.slice("detections.poly", 1, 1), lambda p: F.transform(p, lambda q: F.array(q["x"], q["y"])))
    odd = F.col("image_idx") % 2 == 1
    res = F.struct(F.col("detections.text").alias("rec_texts"), F.when(~odd, polys).alias("dt_polys"), F.when(odd, polys).alias("boxes"))
    j = _photos(spark, d).select("order_id", "image_idx", F.to_json(F.struct(res.alias("res"))).alias("json"))
    t = j.select("order_id", "image_idx", F.explode(hooks.parsed(F.col("json"))).alias("d"))
    return t.select("order_id", "image_idx", "d.text_idx", "d.text", F.get("d.poly", F.lit(0))["x"].cast("long").alias("x0"))


# Geometry


@query("SELECT order_id, image_idx, text_idx, (cx - hw) * 1.5::DOUBLE AS x0, (cy - hh - sk) * 0.5::DOUBLE AS y0 FROM fx_boxes")
def scale_polys(spark, d):
    t = _texts(spark, d).withColumn("p", G.scaled(F.col("d.poly"), F.lit(1.5), F.lit(0.5)))
    return t.select("order_id", "image_idx", "d.text_idx", F.col("p")[0]["x"].alias("x0"), F.col("p")[0]["y"].alias("y0"))


@face_query("SELECT order_id, image_idx, k, x0, y0, x2, y2 FROM quads")
def order_corners(spark, d):
    """Of faces whose points are turned by one place first."""
    pts = F.col("q.pts")
    f = _each_face(spark, d).withColumn("c", G.order_corners(F.array(pts[2], pts[3], pts[0], pts[1])))
    return f.select("order_id", "image_idx", "k", *[F.col("c")[i][a].cast("long").alias(f"{a}{i}") for i in (0, 2) for a in "xy"])


@face_query("SELECT order_id, image_idx, k, round(qw, 6) AS qw, round(qh, 6) AS qh, round(greatest(qw, qh) / greatest(least(qw, qh), 1), 6) AS aspect FROM sized")
def face_aspect(spark, d):
    f = _each_face(spark, d).withColumn("c", G.order_corners(F.col("q.pts"))).withColumn("s", G.face_size(F.col("c")))
    return f.select("order_id", "image_idx", "k", F.round("s.w", 6).alias("qw"), F.round("s.h", 6).alias("qh"), F.round("s.aspect", 6).alias("aspect"))


@face_query("SELECT order_id, image_idx, k, area FROM quads")
def poly_area(spark, d):
    return _each_face(spark, d).select("order_id", "image_idx", "k", G.area(F.col("q.pts")).alias("area"))


_FRAME = "CASE WHEN greatest(round_even(qw, 0), round_even(qh, 0)) > 400 THEN greatest(round_even(round_even({0}, 0) * (400 / greatest(round_even(qw, 0), round_even(qh, 0))), 0), 1) ELSE greatest(round_even({0}, 0), 1) END::INT AS {1}"


@face_query(f"SELECT order_id, image_idx, k, {_FRAME.format('qw', 'w')}, {_FRAME.format('qh', 'h')} FROM sized")
def rect_dims(spark, d):
    f = _each_face(spark, d).withColumn("c", G.order_corners(F.col("q.pts"))).withColumn("f", G.target_frame(F.col("c"), 400))
    return f.select("order_id", "image_idx", "k", "f.w", "f.h")


def _mapped(spark, d) -> DataFrame:
    f = _each_face(spark, d).withColumn("c", G.order_corners(F.col("q.pts")))
    return f.withColumn("m", G.homography(F.col("c"), F.lit(300), F.lit(200)))


@face_query("SELECT order_id, image_idx, k, 0 AS x0, 0 AS y0, 299 AS x1, 0 AS y1, 299 AS x2, 199 AS y2, 0 AS x3, 199 AS y3 FROM quads")
def homography(spark, d):
    """Corners go to the frame's corners."""
    f = _mapped(spark, d).withColumn("t", G.mapped(F.col("c"), F.col("m"), F.lit(0), F.lit(0)))
    return f.select("order_id", "image_idx", "k", *[F.round(F.col("t")[i][a], 6).cast("int").alias(f"{a}{i}") for i in range(4) for a in "xy"])


_TILT = """tilt AS (SELECT *, x1 - x2 AS dx1, x3 - x2 AS dx2, x0 - x1 + x2 - x3 AS dx3, y1 - y2 AS dy1, y3 - y2 AS dy2, y0 - y1 + y2 - y3 AS dy3 FROM quads),
persp AS (SELECT *, (dx3 * dy2 - dx2 * dy3) / (dx1 * dy2 - dx2 * dy1) AS g, (dx1 * dy3 - dx3 * dy1) / (dx1 * dy2 - dx2 * dy1) AS q FROM tilt),
lin AS (SELECT *, x1 - x0 + g * x1 AS a, x3 - x0 + q * x3 AS b, y1 - y0 + g * y1 AS dd, y3 - y0 + q * y3 AS e FROM persp),
uv AS (SELECT order_id, image_idx, k, mx, my, a - g * mx AS p, b - q * mx AS r, mx - x0 AS s, dd - g * my AS t, e - q * my AS u, my - y0 AS v FROM lin)"""


@face_query(f", {_TILT} SELECT order_id, image_idx, k, round(299 * (s * u - r * v) / (p * u - r * t), 4) AS x, round(199 * (p * v - s * t) / (p * u - r * t), 4) AS y FROM uv")
def map_polys(spark, d):
    """Where a face's mean centre goes; the SQL solves the two linear equations of the inverse map instead."""
    f = _mapped(spark, d).withColumn("t", G.mapped(F.array(G.mean_center(F.col("c"))), F.col("m"), F.lit(0), F.lit(0))[0])
    return f.select("order_id", "image_idx", "k", F.round("t.x", 4).alias("x"), F.round("t.y", 4).alias("y"))


@query("SELECT order_id, image_idx, text_idx, round(rx, 6) AS rx, round(ry, 6) AS ry, -1.0::DOUBLE AS none FROM pb WHERE is_seal")
def rel_coords(spark, d):
    return _sealed(spark, d).select("order_id", "image_idx", "seal.text_idx", F.round("rx", 6).alias("rx"), F.round("ry", 6).alias("ry"), G.relative(F.col("seal.cx"), F.lit(0)).alias("none"))


@query("SELECT order_id, image_idx, text_idx, round(coalesce(gap, 'infinity'::DOUBLE), 6) AS gap FROM seals")
def zone_distance(spark, d):
    return _sealed(spark, d).select("order_id", "image_idx", "seal.text_idx", F.round(Z.distance(F.col("rx"), F.col("ry"), F.col("scan_zones")), 6).alias("gap"))


@query("SELECT order_id, image_idx, text_idx, round(short, 4) AS short, round(2 * (sqrt(hw * hw + sk * sk) + hh * abs(sk) / sqrt(hw * hw + sk * sk)), 4) AS long FROM pb")
def min_area_rect(spark, d):
    t = _texts(spark, d).withColumn("r", G.min_area_rect(F.col("d.poly")))
    return t.select("order_id", "image_idx", "d.text_idx", F.round("r.short", 4).alias("short"), F.round("r.long", 4).alias("long"))


@query("SELECT order_id, image_idx, text_idx, round(angle, 4) AS angle FROM pb")
def poly_angle(spark, d):
    return _texts(spark, d).select("order_id", "image_idx", "d.text_idx", F.round(G.min_area_rect(F.col("d.poly"))["angle"], 4).alias("angle"))


@query("SELECT order_id, image_idx, text_idx, abs(angle) <= 30 AS ok, round(round(angle, 9), 2) AS angle FROM pb")
def angle_check(spark, d):
    t = _texts(spark, d).withColumn("a", seals.angle_check(F.col("d.poly")))
    return t.select("order_id", "image_idx", "d.text_idx", "a.ok", "a.angle")


@face_query("SELECT order_id, image_idx, k, least(x0, x1, x2, x3) AS x, least(y0, y1, y2, y3) AS y, least(greatest(x0, x1, x2, x3), 500) - least(x0, x1, x2, x3) AS w, least(greatest(y0, y1, y2, y3), 400) - least(y0, y1, y2, y3) AS h FROM quads")
def quad_bbox(spark, d):
    """Cut to an image of 500 x 400."""
    f = _each_face(spark, d).withColumn("b", G.quad_bbox(F.col("q.pts"), F.lit(500), F.lit(400)))
    return f.select("order_id", "image_idx", "k", "b.*")


# Pixel grids


def _pixels(spark, d) -> DataFrame:
    return inputs.view(spark, d, "fx_pixels")


@query("SELECT image, x - 1 AS x, y - 1 AS y, h, s, v FROM fx_pixels JOIN (SELECT image, max(x) AS mx, max(y) AS my FROM fx_pixels GROUP BY image) USING (image) WHERE x BETWEEN 1 AND mx - 1 AND y BETWEEN 1 AND my - 1 AND least(mx, my) >= 11")
def grid_inset(spark, d):
    return grid.inset(_pixels(spark, d))


_REF = "refs AS (SELECT image, CASE WHEN count(*) FILTER (WHERE v > 180 AND s < 55) > 200 THEN quantile_cont(s, 0.9) FILTER (WHERE v > 180 AND s < 55) ELSE 0 END AS ref FROM fx_pixels GROUP BY image)"


@query(f", {_REF} SELECT image, x, y FROM fx_pixels JOIN refs USING (image) WHERE s - ref - 10 > 55 AND v > 40 AND v < 230")
def grid_white_mask(spark, d):
    return grid.white_mask(_pixels(spark, d)).where("mask").select("image", "x", "y")


@query("SELECT image, x, y FROM fx_pixels WHERE NOT (h BETWEEN 5 AND 30 AND s >= 30 AND v BETWEEN 40 AND 200) AND NOT (s <= 30 AND v >= 200) AND s >= 80 AND v BETWEEN 50 AND 240")
def grid_brown_mask(spark, d):
    return grid.brown_mask(_pixels(spark, d)).where("mask").select("image", "x", "y")


_BROWN = "brown AS (SELECT image, x, y, s, s >= 80 AND NOT h BETWEEN 5 AND 30 AS m FROM fx_pixels)"
_GROWN = """grown AS (SELECT DISTINCT p.image, p.x, p.y FROM brown b, (SELECT unnest(range(-2, 3)) AS i) a, (SELECT unnest(range(-2, 3)) AS j) c, brown p WHERE b.m AND p.image = b.image AND p.x = b.x + i AND p.y = b.y + j),
near AS (SELECT g.image, g.x + i AS x, g.y + j AS y, count(*) AS n FROM grown g, (SELECT unnest(range(-2, 3)) AS i) a, (SELECT unnest(range(-2, 3)) AS j) c GROUP BY ALL),
inframe AS (SELECT p.image, p.x, p.y, (least(p.x, 2) + 1 + least(mx - p.x, 2)) * (least(p.y, 2) + 1 + least(my - p.y, 2)) AS n FROM brown p JOIN (SELECT image, max(x) AS mx, max(y) AS my FROM brown GROUP BY image) USING (image)),
closed AS (SELECT i.image, i.x, i.y FROM inframe i JOIN near USING (image, x, y, n))"""


@query(f", {_BROWN}, {_GROWN} SELECT * FROM closed")
def grid_closing(spark, d):
    """By a square of 5 here."""
    return grid.closing(grid.brown_mask(_pixels(spark, d)), 2).where("mask").select("image", "x", "y")


_REGIONS = """blocks AS (SELECT image, y, x // 8 AS bx, min(y * 65536 + x) AS id FROM brown WHERE m GROUP BY ALL),
reach AS (SELECT image, id, id AS seen, y, bx FROM blocks UNION SELECT r.image, r.id, b.id, b.y, b.bx FROM reach r JOIN blocks b ON r.image = b.image AND abs(b.y - r.y) <= 1 AND abs(b.bx - r.bx) <= 1),
low AS (SELECT image, id, min(seen) AS region FROM reach GROUP BY ALL)"""


@query(f", {_BROWN}, {_REGIONS} SELECT image, region, count(*) AS area FROM low JOIN (SELECT image, y * 65536 + (x // 8) * 8 AS id FROM brown WHERE m) USING (image, id) GROUP BY ALL")
def grid_regions(spark, d):
    return grid.regions(grid.brown_mask(_pixels(spark, d))).groupBy("image", "region").agg(F.count("*").alias("area"))


SQL["grid_regions"] = SQL["grid_regions"].replace("WITH ", "WITH RECURSIVE ", 1)


@query(f", {_BROWN}, px AS (SELECT image, x, y, s FROM brown), b AS (SELECT image, max(x) AS mx, max(y) AS my FROM px GROUP BY image), " + """
sob AS (SELECT p.image, p.x, p.y, sum(q.s * i * (2 - abs(j))) AS gx, sum(q.s * j * (2 - abs(i))) AS gy FROM px p JOIN b USING (image), (SELECT unnest([-1, 0, 1]) AS i) a, (SELECT unnest([-1, 0, 1]) AS j) c JOIN px q
  ON q.image = p.image AND q.x = CASE WHEN abs(p.x + i) > mx THEN 2 * mx - p.x - i ELSE abs(p.x + i) END AND q.y = CASE WHEN abs(p.y + j) > my THEN 2 * my - p.y - j ELSE abs(p.y + j) END GROUP BY p.image, p.x, p.y)
SELECT image, round(avg(sqrt(gx * gx + gy * gy)), 4) AS edge, count(*) AS n FROM sob GROUP BY image""")
def grid_edge_strength(spark, d):
    """The mean Sobel magnitude of each image; of a region's border in foreign_patch."""
    g = grid.gradient(grid.brown_mask(_pixels(spark, d)))
    return g.groupBy("image").agg(F.round(F.avg("grad"), 4).alias("edge"), F.count("*").alias("n"))


# The measures of regions: px (image, region, x, y) to area, solidity by squares of pixels and by the hull of columns, and edge over sob.
# No region of these images has a hole; tests hold those against brute force.
_MEASURES = """sizes AS (SELECT image, region, count(*) AS area FROM px GROUP BY ALL),
insides AS (SELECT image, region, sum(CASE n WHEN 4 THEN 1 WHEN 3 THEN 0.5 ELSE 0 END)::DOUBLE AS inside FROM (SELECT image, region, x + i AS x, y + j AS y, count(*) AS n FROM px, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j) GROUP BY ALL) GROUP BY ALL),
cols AS (SELECT image, region, x, max(y) AS t, min(y) AS b FROM px GROUP BY ALL),
env AS (SELECT c.image, c.region, c.x, max(CASE WHEN a.x = e.x THEN a.t ELSE a.t + (e.t - a.t) * (c.x - a.x) / (e.x - a.x) END) - min(CASE WHEN a.x = e.x THEN a.b ELSE a.b + (e.b - a.b) * (c.x - a.x) / (e.x - a.x) END) AS high
  FROM cols c JOIN cols a ON c.image = a.image AND c.region = a.region AND a.x <= c.x JOIN cols e ON c.image = e.image AND c.region = e.region AND e.x >= c.x GROUP BY ALL),
hulls AS (SELECT image, region, coalesce(sum((high + next) / 2), 0) AS hull FROM (SELECT *, lead(high) OVER (PARTITION BY image, region ORDER BY x) AS next FROM env) GROUP BY ALL),
measured AS (SELECT image, region, area, CASE WHEN hull >= 1 THEN inside / hull ELSE 0 END AS solidity FROM sizes JOIN insides USING (image, region) JOIN hulls USING (image, region))"""
# The 3 x 3 Sobel gradient of sig (image, x, y, s), mirrored at the frame b (image, mx, my).
_SOBEL = """sob AS (SELECT p.image, p.x, p.y, sum(q.s * i * (2 - abs(j))) AS gx, sum(q.s * j * (2 - abs(i))) AS gy FROM sig p JOIN b USING (image), (SELECT unnest([-1, 0, 1]) AS i) a, (SELECT unnest([-1, 0, 1]) AS j) c JOIN sig q
  ON q.image = p.image AND q.x = CASE WHEN abs(p.x + i) > mx THEN 2 * mx - p.x - i ELSE abs(p.x + i) END AND q.y = CASE WHEN abs(p.y + j) > my THEN 2 * my - p.y - j ELSE abs(p.y + j) END GROUP BY p.image, p.x, p.y),
near AS (SELECT image, region, x + i AS x, y + j AS y, count(*) AS own FROM px, (SELECT unnest([-1, 0, 1]) AS i) a, (SELECT unnest([-1, 0, 1]) AS j) c GROUP BY ALL),
edges AS (SELECT image, region, avg(sqrt(gx * gx + gy * gy)) AS edge FROM near JOIN b USING (image) JOIN sob USING (image, x, y) WHERE own < (3 - (x = 0)::INT - (x = mx)::INT) * (3 - (y = 0)::INT - (y = my)::INT) GROUP BY ALL)"""
_BROWN_PX = "px AS MATERIALIZED (SELECT image, region, x, y FROM low JOIN (SELECT image, x, y, y * 65536 + (x // 8) * 8 AS id FROM brown WHERE m) USING (image, id))"


def recursive_query(sql: str):
    def register(f):
        query(sql)(f)
        SQL[f.__name__] = SQL[f.__name__].replace("WITH ", "WITH RECURSIVE ", 1)
        return f

    return register


@recursive_query(f", {_BROWN}, {_REGIONS}, {_BROWN_PX}, {_MEASURES} SELECT image, region, area, round(solidity, 6) AS solidity FROM measured")
def grid_solidity(spark, d):
    return grid.solidity(grid.regions(grid.brown_mask(_pixels(spark, d)))).withColumn("solidity", F.round("solidity", 6))


@recursive_query(f", {_BROWN}, {_REGIONS}, {_BROWN_PX}, sig AS (SELECT image, x, y, s FROM brown), b AS (SELECT image, max(x) AS mx, max(y) AS my FROM brown GROUP BY image), {_SOBEL} SELECT image, region, round(edge, 4) AS edge FROM edges")
def region_edge_strength(spark, d):
    m = grid.brown_mask(_pixels(spark, d))
    return grid.edge_strength(grid.regions(m), m).withColumn("edge", F.round("edge", 4))


def patches_sql(pixels: str, bounds: str) -> str:
    """SQL of patches (image, region, area, solidity, edge) for pixels (image, mode, x, y, h, s, v), already inset, where bounds holds."""
    sweep = lambda kind, along, across, of, to: f"{to} AS (SELECT image, x, y, {kind}(m) OVER (PARTITION BY image, {across} ORDER BY {along} RANGE BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS m FROM {of})"
    return f"""zone AS MATERIALIZED ({pixels}),
refs AS (SELECT image, CASE WHEN count(*) FILTER (WHERE v > 180 AND s < 55) > 200 THEN quantile_cont(s, 0.9) FILTER (WHERE v > 180 AND s < 55) ELSE 0 END AS ref FROM zone GROUP BY image),
raw AS (SELECT image, x, y, mode = 'brown_box' AS brown, h, s, v, least(greatest(s - ref - 10, 0), 255)::DOUBLE AS above FROM zone JOIN refs USING (image)),
sig AS MATERIALIZED (SELECT image, x, y, CASE WHEN brown THEN s ELSE floor(above) END AS s,
  CASE WHEN brown THEN NOT (h BETWEEN 5 AND 30 AND s >= 30 AND v BETWEEN 40 AND 200) AND NOT (s <= 30 AND v >= 200) AND s >= 80 AND v BETWEEN 50 AND 240 ELSE above > 55 AND v > 40 AND v < 230 END::INT AS m FROM raw),
b AS (SELECT image, max(x) AS mx, max(y) AS my, count(*) AS n FROM sig GROUP BY image),
{sweep("max", "x", "y", "sig", "d1")}, {sweep("max", "y", "x", "d1", "d2")}, {sweep("min", "x", "y", "d2", "d3")}, {sweep("min", "y", "x", "d3", "closed")},
island AS (SELECT image, x, y, x - row_number() OVER (PARTITION BY image, y ORDER BY x) AS i FROM closed WHERE m = 1),
runs AS MATERIALIZED (SELECT image, y, min(x) AS a, max(x) AS e, y * 65536 + min(x) AS id FROM island GROUP BY image, y, i),
reach AS (SELECT image, id, id AS seen, y, a, e FROM runs UNION SELECT r.image, r.id, o.id, o.y, o.a, o.e FROM reach r JOIN runs o ON r.image = o.image AND abs(o.y - r.y) = 1 AND o.a <= r.e + 1 AND r.a <= o.e + 1),
low AS (SELECT image, id, min(seen) AS region FROM reach GROUP BY ALL),
px AS MATERIALIZED (SELECT r.image, region, x, r.y FROM low JOIN runs r USING (image, id), (SELECT unnest(range(0, 4096)) AS x) g WHERE x BETWEEN a AND e),
{_MEASURES}, {_SOBEL}, patches AS (SELECT image, region, area, solidity, edge FROM measured JOIN edges USING (image, region) JOIN b USING (image) WHERE {bounds})"""


_INSET = "SELECT image, {0} AS mode, x - 1 AS x, y - 1 AS y, h, s, v FROM fx_pixels JOIN (SELECT image, max(x) AS mx, max(y) AS my FROM fx_pixels GROUP BY image) USING (image) WHERE x BETWEEN 1 AND mx - 1 AND y BETWEEN 1 AND my - 1 AND least(mx, my) >= 11"
_INSET_MODES = _INSET.format("CASE WHEN image % 2 = 0 THEN 'white_box' ELSE 'brown_box' END")


@recursive_query(f", {patches_sql(_INSET_MODES, 'area / n >= CASE WHEN image % 3 = 0 THEN 0.1 ELSE 0.015 END AND solidity >= 0.45 AND edge >= 6')} SELECT image, region, area, round(solidity, 6) AS solidity, round(edge, 4) AS edge FROM patches")
def foreign_patch(spark, d):
    """Images in turn are of white and of brown boxes, and each is masked by its mode; each third one's rule wants larger patches."""
    pixels = saved(grid.inset(_pixels(spark, d)), "pixels")
    own = pixels.select("image").distinct().withColumn("mode", F.when(F.col("image") % 2 == 0, "white_box").otherwise("brown_box"))
    none = F.lit(None).cast("double")
    rules = own.select("image", F.when(F.col("image") % 3 == 0, 0.1).alias("area_ratio"), none.alias("solidity_min"), none.alias("edge_grad_min"))
    found = grid.foreign_patches(grid.masked(pixels, own), rules)
    return found.withColumn("solidity", F.round("solidity", 6)).withColumn("edge", F.round("edge", 4))


# Composites


@query("SELECT order_id, image_idx, text_idx, cx, cy FROM pb WHERE is_seal")
def find_seals(spark, d):
    s = _photos(spark, d).select("order_id", "image_idx", F.explode(seals.find_seals(F.col("detections"))).alias("s"))
    return s.select("order_id", "image_idx", "s.text_idx", F.col("s.cx").cast("long").alias("cx"), F.col("s.cy").cast("long").alias("cy"))


@query("SELECT order_id, image_idx, text_idx, x, y FROM pb WHERE is_auth AND x BETWEEN 0 AND w AND y BETWEEN 0 AND h")
def find_auth(spark, d):
    s = _ruled(spark, d).select("order_id", "image_idx", F.explode(seals.find_auth(F.col("dets"), F.col("box.w"), F.col("box.h"))).alias("s"))
    return s.select("order_id", "image_idx", "s.text_idx", F.col("s.cx").cast("long").alias("x"), F.col("s.cy").cast("long").alias("y"))


@query("SELECT s.order_id, s.image_idx, s.text_idx, f.text_idx IS NOT NULL AS is_flat FROM seals s LEFT JOIN flat f USING (order_id, image_idx, text_idx) WHERE s.rank = 1")
def flat_check(spark, d):
    return _main(spark, d).select("order_id", "image_idx", "m.text_idx", seals.flat(F.col("dets"), F.col("m"), F.col("box.w"), F.col("box.h")).alias("is_flat"))


@query("SELECT order_id, image_idx, position, round(rx, 4) AS rel_x, round(ry, 4) AS rel_y, CASE WHEN ok THEN round(round(angle, 9), 2) END AS angle FROM placed WHERE rank = 1")
def placement(spark, d):
    p = _main(spark, d).withColumn("p", seals.placement(F.col("dets"), F.col("m"), F.col("box.w"), F.col("box.h"), F.col("scan_zones")))
    return p.select("order_id", "image_idx", F.col("p.position_valid").alias("position"), "p.rel_x", "p.rel_y", "p.angle")


@query("SELECT order_id, image_idx, code, second FROM dual WHERE lob <> 'UNKNOWN LOB'")
def dual_status(spark, d):
    p = _ruled(spark, d).where(photos.known(F.col("lob")))
    n = seals.distinct_seals(seals.find_seals(F.col("dets")), F.col("box.h"))
    p = p.withColumn("s", seals.dual_status(n, seals.any_auth(F.col("dets")), F.col("sticker_count")))
    return p.select("order_id", "image_idx", "s.code", F.col("s.has_auth").alias("second"))


@query("SELECT p.order_id, p.image_idx, a.order_id IS NOT NULL AS found, coalesce(a.ok, false) AS ok FROM photo p LEFT JOIN auth a USING (order_id, image_idx)")
def auth_position(spark, d):
    a = _ruled(spark, d).withColumn("a", seals.auth_position(F.col("dets"), F.col("box.w"), F.col("box.h"), F.col("auth_zones")))
    return a.select("order_id", "image_idx", "a.found", "a.ok")
