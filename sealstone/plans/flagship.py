"""The full verdict: faces prepared and chosen, contours turned upright, photos mapped, colours checked on pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sealstone.checkpoints import saved
from sealstone.operators import reports, verdict
from sealstone.plans import inputs
from sealstone.plans.checks import patches_sql
from sealstone.plans.oracle import FX, seal_steps, second_steps, verdict_steps
from sealstone.rules import rule_book


def verdict_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, rules = inputs.orders(spark, sf_dir), rule_book(spark)
    best = saved(verdict.best_photos(inputs.faced(spark, sf_dir)), "best")  # an order's best photo is chosen once, for its colours and its verdict
    chosen = best.where("best is not null").select("order_id", "best.image_idx")
    alien = verdict.foreign_among(orders, chosen, rules, lambda own: inputs.photo_pixels(spark, sf_dir, own))
    alien = alien.select("order_id", F.col("image_idx").alias("_foreign"))
    flagged = F.col("best").withField("foreign", F.col("_foreign").isNotNull())
    best = best.join(alien.hint("merge"), "order_id", "left").withColumn("best", F.when(F.col("best").isNotNull(), flagged)).drop("_foreign")
    return verdict.judged(orders, best, rules)


def ways_to_rectify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distribution(verdict_full(spark, sf_dir), "rectify_method")


_AT = "100.5::DOUBLE + 3 * b + 4 * a * {0} - 3 * b * {1} AS {2}, 80.5::DOUBLE + 3 * a * {0} + 4 * b * {1} AS {3}"
_PIXELS = """SELECT image, mode, x - 1 AS x, y - 1 AS y, CASE WHEN plain THEN 15 ELSE h END AS h, CASE WHEN plain THEN least(s, 29) ELSE s END AS s, CASE WHEN plain THEN 200 ELSE v END AS v FROM (
  SELECT o.order_id AS image, o.color AS mode, (p.image + o.image_idx) % 2 = 0 AS plain, p.x, p.y, p.h, p.s, p.v, max(p.x) OVER (PARTITION BY o.order_id) AS mx, max(p.y) OVER (PARTITION BY o.order_id) AS my
  FROM fx_pixels p JOIN best o ON o.order_id = (p.image * 40)::VARCHAR) t WHERE x BETWEEN 1 AND mx - 1 AND y BETWEEN 1 AND my - 1 AND least(mx, my) >= 11"""

#: Each step is the definition of its operator on flat rows: faces and boxes of best photos only; the inverse map solves two linear equations.
_FULL = f""",
f_cand AS (SELECT b.order_id, b.image_idx, b.lob, b.w, b.h, k, 100.25::DOUBLE + 11 * k + d AS x0, 80.25::DOUBLE + 7 * k + e AS y0, 100.25::DOUBLE + b.w - 5 * k + d AS x1, 80.25::DOUBLE + 3 * k + b.j + e AS y1, 100.25::DOUBLE + b.w - 3 * k + d AS x2, 80.25::DOUBLE + b.h - 9 * k + e AS y2, 100.25::DOUBLE + 2 * k + b.j + d AS x3, 80.25::DOUBLE + b.h - 4 * k + e AS y3
  FROM best b, (VALUES (0, 0, 0), (1, 0, 64), (2, 120, 0)) t(k, d, e) WHERE b.image_idx % 2 = 1 AND (k <> 1 OR b.lob = 'Mac')),
f_sized AS (SELECT *, abs((x0 * y1 - x1 * y0) + (x1 * y2 - x2 * y1) + (x2 * y3 - x3 * y2) + (x3 * y0 - x0 * y3)) / 2 AS area,
  greatest(sqrt(power(x0 - x1, 2) + power(y0 - y1, 2)), sqrt(power(x3 - x2, 2) + power(y3 - y2, 2))) AS qw, greatest(sqrt(power(x0 - x3, 2) + power(y0 - y3, 2)), sqrt(power(x1 - x2, 2) + power(y1 - y2, 2))) AS qh FROM f_cand),
f_cross AS (SELECT q.order_id, q.k, (x1 - x0) * (b.my - y0) - (y1 - y0) * (b.mx - x0) AS c0, (x2 - x1) * (b.my - y1) - (y2 - y1) * (b.mx - x1) AS c1, (x3 - x2) * (b.my - y2) - (y3 - y2) * (b.mx - x2) AS c2, (x0 - x3) * (b.my - y3) - (y0 - y3) * (b.mx - x3) AS c3
  FROM f_cand q JOIN (SELECT order_id, image_idx, (5 * cx - hw) / 5.0::DOUBLE AS mx, (5 * cy - hh - sk) / 5.0::DOUBLE AS my FROM pb WHERE is_seal) b USING (order_id, image_idx)),
f_in AS (SELECT DISTINCT order_id, k FROM f_cross WHERE least(c0, c1, c2, c3) >= 0 OR greatest(c0, c1, c2, c3) <= 0),
f_scored AS (SELECT s.*, CASE WHEN i.k IS NOT NULL THEN 2 ELSE 0 END + 0.15 * least(1, sqrt(area / 800000)) + CASE WHEN aspect_lo IS NULL THEN 0 ELSE
    CASE WHEN greatest(qw, qh) / greatest(least(qw, qh), 1) BETWEEN aspect_lo AND aspect_hi THEN 1.5 ELSE greatest(0, 1 - 0.6 * greatest(aspect_lo - greatest(qw, qh) / greatest(least(qw, qh), 1), greatest(qw, qh) / greatest(least(qw, qh), 1) - aspect_hi)) END END AS score
  FROM f_sized s JOIN ord o USING (order_id) LEFT JOIN f_in i ON s.order_id = i.order_id AND s.k = i.k),
f_front AS (SELECT DISTINCT ON (order_id) * FROM f_scored ORDER BY order_id, round(score, 9) DESC, area DESC, k % 2, k),
f_turned AS (SELECT order_id, image_idx, {_AT.format(0, 0, "x0", "y0")}, {_AT.format(1, 0, "x1", "y1")}, {_AT.format(1, 1, "x2", "y2")}, {_AT.format(0, 1, "x3", "y3")}, 5 * a AS qw, 5 * b AS qh
  FROM (SELECT *, w // 5 AS a, h // 5 AS b FROM best) t WHERE image_idx = 2 AND 25 * a * b * 7 / 8 >= 64000),
f_frame AS MATERIALIZED (
  SELECT order_id, image_idx, 'perspective' AS rectify_method, x0, y0, x1, y1, x2, y2, x3, y3, round_even(qw, 0)::INT AS w, round_even(qh, 0)::INT AS h FROM f_front
  UNION ALL SELECT order_id, image_idx, 'rotation', x0, y0, x1, y1, x2, y2, x3, y3, qw::INT, qh::INT FROM f_turned
  UNION ALL SELECT order_id, image_idx, 'axis_aligned', 100::DOUBLE, 80::DOUBLE, 100::DOUBLE + w, 80::DOUBLE, 100::DOUBLE + w, 80::DOUBLE + h, 100::DOUBLE, 80::DOUBLE + h, w::INT, h::INT FROM best WHERE image_idx = 4 OR image_idx = 2 AND order_id NOT IN (SELECT order_id FROM f_turned)),
f_lin AS (SELECT *, x1 - x0 + g * x1 AS a, x3 - x0 + q * x3 AS b, y1 - y0 + g * y1 AS dd, y3 - y0 + q * y3 AS e FROM (
  SELECT *, (dx3 * dy2 - dx2 * dy3) / (dx1 * dy2 - dx2 * dy1) AS g, (dx1 * dy3 - dx3 * dy1) / (dx1 * dy2 - dx2 * dy1) AS q FROM (
    SELECT *, x1 - x2 AS dx1, x3 - x2 AS dx2, x0 - x1 + x2 - x3 AS dx3, y1 - y2 AS dy1, y3 - y2 AS dy2, y0 - y1 + y2 - y3 AS dy3 FROM f_frame) t) t),
f_pts AS (SELECT p.order_id, p.image_idx, text_idx, n, w, h, rectify_method, x0, y0, a - g * px AS p, b - q * px AS r, px - x0 AS s, dd - g * py AS t, e - q * py AS u, py - y0 AS v, px, py FROM (
  SELECT order_id, image_idx, text_idx, n, cx + CASE WHEN n IN (0, 3) THEN -hw ELSE hw END AS px, cy + CASE n WHEN 0 THEN -hh - sk WHEN 1 THEN -hh + sk WHEN 2 THEN hh + sk ELSE hh - sk END AS py FROM pb, (VALUES (0), (1), (2), (3)) c(n)) p JOIN f_lin f USING (order_id, image_idx)),
f_map AS MATERIALIZED (SELECT order_id, image_idx, text_idx, n, CASE rectify_method WHEN 'axis_aligned' THEN px - x0 ELSE (w - 1) * (s * u - r * v) / (p * u - r * t) END AS x, CASE rectify_method WHEN 'axis_aligned' THEN py - y0 ELSE (h - 1) * (p * v - s * t) / (p * u - r * t) END AS y FROM f_pts),
f_mid AS (SELECT order_id, image_idx, text_idx, (min(x) + max(x)) / 2 AS x, (min(y) + max(y)) / 2 AS y, sum(CASE n WHEN 0 THEN 2 ELSE 1 END * x) / 5 AS mx, sum(CASE n WHEN 0 THEN 2 ELSE 1 END * y) / 5 AS my FROM f_map GROUP BY ALL),
f_dirs AS (SELECT i.order_id, i.image_idx, i.text_idx, i.n * 4 + j.n AS d, (j.x - i.x) / sqrt(power(j.x - i.x, 2) + power(j.y - i.y, 2)) AS ux, (j.y - i.y) / sqrt(power(j.x - i.x, 2) + power(j.y - i.y, 2)) AS uy
  FROM f_map i JOIN f_map j ON i.order_id = j.order_id AND i.text_idx = j.text_idx AND i.n < j.n),
f_wide AS (SELECT d.order_id, d.image_idx, d.text_idx, d, ux, uy, max(x * ux + y * uy) - min(x * ux + y * uy) AS a, max(y * ux - x * uy) - min(y * ux - x * uy) AS b FROM f_dirs d JOIN f_map m ON d.order_id = m.order_id AND d.text_idx = m.text_idx GROUP BY ALL),
f_turn AS (SELECT *, degrees(atan2(uy, ux)) + CASE WHEN a >= b THEN 0 ELSE 90 END AS t FROM f_wide),
f_rect AS (SELECT DISTINCT ON (order_id, image_idx, text_idx) order_id, image_idx, text_idx, least(a, b) AS short, angle FROM (SELECT *, round(90 - ((90 - t) - 180 * floor((90 - t) / 180)), 9) AS angle FROM f_turn) t ORDER BY order_id, image_idx, text_idx, round(a * b, 6), abs(angle), least(a, b), greatest(a, b), angle),
f_pb AS MATERIALIZED (SELECT b.order_id, b.image_idx, b.text_idx, b.text, b.lob, b.mode, b.has_auth, b.is_seal, b.is_auth, m.x, m.y, m.mx, m.my, f.w, f.h, m.x / f.w AS rx, m.y / f.h AS ry, r.short, r.angle
  FROM pb b JOIN f_frame f USING (order_id, image_idx) JOIN f_mid m USING (order_id, image_idx, text_idx) JOIN f_rect r USING (order_id, image_idx, text_idx)),
{seal_steps("f_")},
f_photo AS (SELECT b.order_id, b.image_idx, f.w, f.h, b.method, b.lob, b.mode, b.has_auth, b.color, coalesce(c.n, 0) AS n_seals, b.any_auth FROM best b JOIN f_frame f USING (order_id, image_idx) LEFT JOIN f_counted c USING (order_id, image_idx)),
{second_steps("f_")},
{patches_sql(_PIXELS, "area / b.n >= 0.015 AND solidity >= 0.45 AND edge >= 6")},
f_best AS (SELECT d.*, f.rectify_method, d.order_id IN (SELECT image FROM patches) AS alien, '[[' || x0 || ',' || y0 || '],[' || x1 || ',' || y1 || '],[' || x2 || ',' || y2 || '],[' || x3 || ',' || y3 || ']]' AS quad FROM f_dual d JOIN f_frame f USING (order_id, image_idx)),
{verdict_steps("f_")}"""
_SQL = FX.replace("WITH ", "WITH RECURSIVE ", 1) + _FULL

QUERIES = {"verdict_full": verdict_full, "ways_to_rectify": ways_to_rectify}
SQL = {"verdict_full": _SQL + "SELECT * FROM f_verdict", "ways_to_rectify": _SQL + "SELECT rectify_method, count(*) AS n FROM f_verdict GROUP BY rectify_method"}
