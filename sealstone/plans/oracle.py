"""The SQL of the same inputs and of what the verdicts build on, flat: one row for each text box."""

from __future__ import annotations

from sealstone.plans.inputs import VIEWS
from sealstone.rules import RULE_BOOK


def _v(x) -> str:
    return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else f"{x}::DOUBLE"


_RULES = ", ".join(f"({_v(lob)}, {_v(mode)}, {_v(asp[0])}, {_v(asp[1])}, {'true' if auth else 'false'}, {_v(color)})" for lob, mode, _, auth, asp, color in RULE_BOOK)
_ZONES = ", ".join(f"({_v(r[0])}, '{role}', {n}, {', '.join(_v(b) for b in z)})" for r in RULE_BOOK for role, zs in (("scan", r[2]), ("auth", r[3] or ())) for n, z in enumerate(zs))

_NEAR = "coalesce(rx >= z.x_min - 0.15, true) AND coalesce(rx <= z.x_max + 0.15, true) AS x_ok, coalesce(ry >= z.y_min - 0.15, true) AND coalesce(ry <= z.y_max + 0.15, true) AS y_ok"
_GAP = "sqrt(power(greatest(coalesce(z.x_min - rx, 0), coalesce(rx - z.x_max, 0), 0), 2) + power(greatest(coalesce(z.y_min - ry, 0), coalesce(ry - z.y_max, 0), 0), 2))"


def stamp(parts: str) -> tuple[str, str]:
    """SQL of the time and the place in a list of segments."""
    is_time = r"regexp_matches(s, '\d{1,2}:\d{2}|\d{4}[-–]\d{2}[-–]\d{2}|星期[一二三四五六日]')"
    kept = rf"list_filter(list_transform({parts}, lambda s: trim(s)), lambda s: s <> '' AND NOT regexp_matches(s, '^[|｜\s]+$'))"
    share = r"len(regexp_extract_all(s, '[\x{4E00}-\x{9FFF}]')) / greatest(length(replace(s, ' ', '')), 1)"
    squeeze = lambda x: rf"trim(regexp_replace(array_to_string({x}, ' '), '\s+', ' ', 'g'))"
    time = squeeze(f"list_transform(list_filter({kept}, lambda s: {is_time}), lambda s: trim(regexp_replace(s, '[|｜]', ' ', 'g')))")
    return time, squeeze(f"list_filter({kept}, lambda s: NOT {is_time} AND {share} >= 0.4)")


def seal_steps(p: str = "") -> str:
    """From the text boxes of {p}pb to {p}placed and {p}counted."""
    return rf"""{p}tried AS (SELECT order_id, image_idx, text_idx, nth, z.x_min, z.x_max, z.y_min, z.y_max, {_NEAR}, {_GAP} AS gap FROM {p}pb pb JOIN zones z ON z.lob = pb.lob AND z.role = 'scan' WHERE is_seal),
{p}zoned AS (
  SELECT order_id, image_idx, text_idx, bool_or(x_ok AND y_ok) AS ok, arg_max(x_ok, 10 * (x_ok::INT + y_ok::INT) - nth) AS x_ok, arg_max(y_ok, 10 * (x_ok::INT + y_ok::INT) - nth) AS y_ok, min(gap) AS gap,
         count(*) AS n_zones, {", ".join(f"arg_max({b}, 10 * (x_ok::INT + y_ok::INT) - nth) AS {b}" for b in ("x_min", "x_max", "y_min", "y_max"))}
  FROM {p}tried GROUP BY ALL),
{p}seals AS (
  SELECT pb.*, coalesce(ok, false) AS ok, coalesce(x_ok, false) AS x_ok, coalesce(y_ok, false) AS y_ok, gap, n_zones, x_min, x_max, y_min, y_max,
         row_number() OVER (PARTITION BY order_id, image_idx ORDER BY CASE WHEN lob <> 'UNKNOWN LOB' THEN gap ELSE 0 END, CASE WHEN lob <> 'UNKNOWN LOB' THEN ry ELSE 0 END, text_idx) AS rank
  FROM {p}pb pb LEFT JOIN {p}zoned USING (order_id, image_idx, text_idx) WHERE is_seal),
{p}flat AS (
  SELECT DISTINCT m.order_id, m.image_idx, m.text_idx FROM {p}seals m JOIN {p}pb o ON m.order_id = o.order_id AND m.image_idx = o.image_idx AND m.text_idx <> o.text_idx
  WHERE o.mx BETWEEN 0 AND o.w AND o.my BETWEEN 0 AND o.h
    AND (o.text = ' AUTHORIZED Reseller' AND sqrt(power(m.mx - o.mx, 2) + power(m.my - o.my, 2)) > 2 * greatest(m.short, 1)
      OR o.text = '授权经销商' AND greatest(o.short, 1) > 0.8 * greatest(m.short, 1) AND sqrt(power(m.mx - o.mx, 2) + power(m.my - o.my, 2)) > 5 * greatest(m.short, 1))),
{p}placed AS (
  SELECT s.*, CASE WHEN NOT ok THEN 0 WHEN abs(angle) > 30 THEN 3 WHEN f.text_idx IS NOT NULL THEN 2 ELSE 1 END AS position
  FROM {p}seals s LEFT JOIN {p}flat f USING (order_id, image_idx, text_idx)),
{p}counted AS (
  SELECT order_id, image_idx, len(list_reduce(list([y::DOUBLE] ORDER BY text_idx), lambda acc, e: CASE WHEN len(list_filter(acc, lambda k: abs(k - e[1]) < greatest(0.2 * h, 50))) > 0 THEN acc ELSE list_concat(acc, e) END)) AS n
  FROM {p}seals GROUP BY order_id, image_idx, h)"""


def second_steps(p: str = "") -> str:
    """From {p}photo and {p}pb to {p}dual and {p}auth."""
    return rf"""{p}dual AS (
  SELECT *, CASE WHEN n_seals = 0 THEN -1 WHEN n_seals >= 2 THEN 2 WHEN mode = 'single_only' OR NOT any_auth THEN CASE WHEN mode = 'dual_required' THEN 3 ELSE 0 END ELSE 1 END AS code,
         coalesce(mode <> 'single_only' AND any_auth, false) AS second FROM {p}photo),
{p}auth_tried AS (
  SELECT order_id, image_idx, text_idx, rx, ry, bool_or({_NEAR.split(" AS x_ok, ")[0]} AND {_NEAR.split(" AS x_ok, ")[1].removesuffix(" AS y_ok")}) AS ok
  FROM {p}pb pb JOIN zones z ON z.lob = pb.lob AND z.role = 'auth' WHERE is_auth AND x BETWEEN 0 AND w AND y BETWEEN 0 AND h GROUP BY ALL),
{p}auth AS (SELECT DISTINCT ON (order_id, image_idx) order_id, image_idx, ok, round(rx, 4) AS rel_x, round(ry, 4) AS rel_y FROM {p}auth_tried ORDER BY order_id, image_idx, ok DESC, text_idx)"""


def verdict_steps(p: str = "") -> str:
    """From {p}best, {p}placed and {p}auth to {p}verdict."""
    return rf"""{p}verdicts AS (
  SELECT o.order_id, o.lob, b.image_idx, b.method, b.color, b.rectify_method, b.quad, m.position, m.rx, m.ry, m.angle, m.ok, m.x_ok, m.y_ok, m.n_zones, m.x_min, m.x_max, m.y_min, m.y_max, a.rel_x AS ax, a.rel_y AS ay, d.dealer, b.code, b.second AND o.has_auth AS second, a.order_id IS NOT NULL AS found, coalesce(a.ok, false) AS auth_ok,
         CASE WHEN o.lob = 'UNKNOWN LOB' THEN 1 WHEN b.order_id IS NULL THEN CASE WHEN d.dealer IS NOT NULL THEN 2 ELSE 3 END WHEN b.alien THEN 4 WHEN m.position <> 1 THEN 6 WHEN b.code = 2 THEN 7 WHEN b.code = 3 THEN 8
           WHEN b.second AND o.has_auth THEN CASE WHEN a.order_id IS NULL THEN 9 WHEN NOT a.ok THEN 10 ELSE 11 END ELSE 12 END AS way, t.stamp_time, t.stamp_place
  FROM ord o LEFT JOIN {p}best b USING (order_id) LEFT JOIN {p}placed m ON m.order_id = b.order_id AND m.image_idx = b.image_idx AND m.rank = 1
  LEFT JOIN dealers d ON d.order_id = o.order_id LEFT JOIN {p}auth a ON a.order_id = b.order_id AND a.image_idx = b.image_idx LEFT JOIN stamps t ON t.order_id = o.order_id),
{p}verdict AS (
  SELECT order_id, lob, CASE WHEN way IN (7, 9, 11, 12) THEN 1 ELSE 0 END AS is_compliant, CASE WHEN way <= 3 THEN 0 ELSE 1 END AS seal_exists,
    CASE WHEN way = 2 THEN 0 WHEN way <= 3 THEN -1 WHEN way = 4 THEN 4 WHEN way = 6 THEN position ELSE 1 END AS position_valid,
    CASE WHEN way > 4 THEN round(rx, 4) END AS rel_x, CASE WHEN way > 4 THEN round(ry, 4) END AS rel_y, CASE WHEN way > 4 AND ok THEN round(round(angle, 9), 2) END AS sticker_angle,
    CASE WHEN way > 3 THEN method END AS box_method, CASE WHEN way > 3 THEN rectify_method ELSE 'axis_aligned' END AS rectify_method,
    CASE WHEN way > 3 THEN quad END AS box_quad_src,
    CASE WHEN way > 3 THEN 1 ELSE 0 END AS color_checked, CASE WHEN way > 3 THEN color ELSE '' END AS color_mode,
    CASE WHEN way = 1 THEN 'unknown product line' WHEN way = 2 THEN 'dealer''s own sticker: ' || dealer WHEN way = 3 THEN 'no photo of the front with a seal'
      WHEN way = 4 THEN 'foreign sticker' ELSE '[' || rectify_method || '] ' || CASE WHEN position = 0 THEN 'outside the zone' || CASE WHEN n_zones > 1 THEN ' (any of ' || n_zones || ')' ELSE '' END || ': '
          || concat_ws('; ', CASE WHEN NOT x_ok THEN printf('X=%.3f', rx) || ' not in [' || x_min || ',' || x_max || ']±0.15' END, CASE WHEN NOT y_ok THEN printf('Y=%.3f', ry) || ' not in [' || y_min || ',' || y_max || ']±0.15' END)
        WHEN position = 3 THEN printf('turned by %+.1f', round(round(angle, 9), 2)) || '°, limit ±30°' WHEN position = 2 THEN 'flat: its end piece shows'
        ELSE printf('in place (rel_x=%.3f, rel_y=%.3f', rx, ry) || ', tolerance ±0.15)' END END AS detail,
    CASE WHEN way <= 6 THEN -1 WHEN way IN (7, 8, 12) THEN code WHEN way = 9 THEN 0 ELSE 1 END AS dual_code,
    CASE way WHEN 7 THEN 'two seals' WHEN 8 THEN 'second seal missing' WHEN 9 THEN 'second seal outside the box' WHEN 10 THEN printf('second seal misplaced (rel_x=%.3f, rel_y=%.3f)', ax, ay)
      WHEN 11 THEN printf('second seal in place (rel_x=%.3f, rel_y=%.3f)', ax, ay)
      WHEN 12 THEN CASE code WHEN 1 THEN 'seal and second seal' ELSE 'one seal' END ELSE 'skipped' END AS dual_detail,
    CASE WHEN way > 1 THEN coalesce(stamp_time, '') ELSE '' END AS stamp_time, CASE WHEN way > 1 THEN coalesce(stamp_place, '') ELSE '' END AS stamp_place
  FROM {p}verdicts)"""


_OFTEN = ("fx_boxes", "fx_photos")  # what several steps read is computed once
FX = "WITH " + ",\n".join(f"{k} AS {'MATERIALIZED ' * (k in _OFTEN)}({v.replace('DIV', '//')})" for k, v in VIEWS.items()) + rf""",
rules(lob, mode, aspect_lo, aspect_hi, has_auth, color) AS (VALUES {_RULES}),
zones(lob, role, nth, x_min, x_max, y_min, y_max) AS (VALUES {_ZONES}),
ord AS (SELECT order_id, coalesce(r.lob, 'UNKNOWN LOB') AS lob, mode, aspect_lo, aspect_hi, coalesce(has_auth, false) AS has_auth, color FROM fx_orders o LEFT JOIN rules r ON trim(o.lob) = r.lob),
pb AS MATERIALIZED (
  SELECT b.*, cx - 100 AS x, cy - 80 AS y, cx - 100 AS mx, cy - 80 AS my, p.w, p.h, p.method, p.j, (cx - 100) / p.w AS rx, (cy - 80) / p.h AS ry, o.lob, o.mode, o.has_auth,
         2 * hh * hw / sqrt(hw * hw + sk * sk) AS short, degrees(atan2(sk, hw)) AS angle, contains(text, '扫码即领') AS is_seal,
         contains(text, '授权专营店') OR contains(text, '在你身边') AS is_auth
  FROM fx_boxes b JOIN fx_photos p USING (order_id, image_idx) JOIN ord o USING (order_id)),
{seal_steps()},
photo AS (
  SELECT p.*, o.lob, o.mode, o.has_auth, o.color, coalesce(c.n, 0) AS n_seals, a.any_auth, a.texts, a.first_text, a.official
  FROM fx_photos p JOIN ord o USING (order_id) LEFT JOIN counted c USING (order_id, image_idx)
  JOIN (SELECT order_id, image_idx, bool_or(is_auth) AS any_auth, count(*) AS texts, arg_min(text, text_idx) AS first_text,
          bool_or(contains(text, '扫码即领') OR contains(text, 'Apple') OR contains(text, 'apple') OR contains(text, '授权经销商') OR contains(text, 'Authorized Reseller') OR contains(text, 'authorized reseller')) AS official
        FROM pb GROUP BY ALL) a USING (order_id, image_idx)),
{second_steps()},
best AS (
  SELECT DISTINCT ON (order_id) *, 'axis_aligned' AS rectify_method, false AS alien,
    '[[100.0,80.0],[' || (100 + w) || '.0,80.0],[' || (100 + w) || '.0,' || (80 + h) || '.0],[100.0,' || (80 + h) || '.0]]' AS quad FROM dual WHERE n_seals > 0 AND method <> 'fallback' AND w * h / 800000 >= 0.02 AND lob <> 'UNKNOWN LOB' ORDER BY order_id, w * h DESC, image_idx),
dealers AS (SELECT order_id, arg_min(substr(first_text, 1, 40), image_idx) AS dealer FROM photo WHERE texts >= 2 AND NOT official GROUP BY order_id),
stamps AS (SELECT DISTINCT ON (order_id) order_id, {stamp("[stamp_1, stamp_2]")[0]} AS stamp_time, {stamp("[stamp_1, stamp_2]")[1]} AS stamp_place FROM fx_photos ORDER BY order_id, image_idx),
{verdict_steps()},
joined AS (SELECT order_id, image_idx, string_agg(text, ' ' ORDER BY text_idx) AS t FROM fx_boxes GROUP BY ALL),
keyed AS (SELECT *, CASE WHEN contains(t, '扫码即领') THEN '扫码即领' WHEN contains(t, 'Apple授权专营店') THEN 'Apple授权专营店' END AS keyword, (contains(t, '扫码即领') AND contains(t, '授权经销商'))::INT AS err FROM joined),
hits AS (SELECT DISTINCT ON (order_id) order_id, keyword, err FROM keyed WHERE keyword IS NOT NULL ORDER BY order_id, image_idx),
verdict1 AS (
  SELECT o.order_id, o.lob, (h.order_id IS NOT NULL)::INT AS seal_exists, coalesce(keyword, '') AS keyword, coalesce(err, 0) AS paste_error, coalesce(stamp_time, '') AS stamp_time, coalesce(stamp_place, '') AS stamp_place
  FROM fx_orders o LEFT JOIN hits h USING (order_id) LEFT JOIN stamps t USING (order_id))
"""
