"""Sinks, hooks, streams and pixel grids."""

import glob
import json
import math
import os
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from sealstone.functions import geometry as G
from sealstone.operators import grid, reports
from sealstone.plans import inputs
from sealstone.rules import load_rules, rule_book
from sealstone.sources import hooks, tables
from sealstone.streaming import incremental
from sealstone.streaming.done import DoneIds


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", "扫码", None), ("2", None, 3)], "order_id string, t string, n int")
    csv, js = str(tmp_path / "csv"), str(tmp_path / "json")
    for _ in range(2):
        tables.append_both(df, csv, js)
    assert tables.read_results(spark, csv).count() == 4
    lines = [json.loads(x) for p in (tmp_path / "json").glob("part*") for x in p.read_text().splitlines()]
    assert len(lines) == 4 and all(set(x) == {"order_id", "t", "n"} for x in lines) and any("扫码" in p.read_text() for p in (tmp_path / "json").glob("part*"))
    tables.create_empty(df, str(tmp_path / "empty"))
    assert tables.read_results(spark, str(tmp_path / "empty")).columns == df.columns
    assert tables.export(spark, csv, str(tmp_path / "out"), "csv").count() == 4
    (tmp_path / "bom.csv").write_text("﻿order_id,lob\n001,Mac\n", encoding="utf-8")
    assert tables.read_results(spark, str(tmp_path / "bom.csv")).first()["order_id"] == "001"
    assert tables.read_orders(spark, str(tmp_path / "bom.csv"), schema="order_id string, lob string").first().asDict() == {"order_id": "001", "lob": "Mac"}
    (tmp_path / "x.jpg").write_bytes(b"abc")
    assert tables.read_photos(spark, str(tmp_path / "x.jpg")).first()["length"] == 3


def test_hooks(spark):
    of = spark.createDataFrame([("1", 1, "good"), ("1", 2, "bad"), ("2", 1, None)], "order_id string, image_idx int, url string")

    def fetch(url):
        if url == "bad":
            raise OSError("gone")
        return url.encode()

    def make():
        return lambda content: json.dumps({"res": {"rec_texts": [content.decode(), "b"], "boxes": [[[1, 2], [3, 2], [3, 4], [1, 4]]]}})

    got = hooks.fetched(of, fetch)
    assert {(r["order_id"], r["image_idx"]): r["status"] for r in got.collect()} == {("1", 1): "ok", ("1", 2): "failed", ("2", 1): "missing"}
    seen = {(r["order_id"], r["image_idx"]): r["detections"] for r in hooks.recognised(got, make).collect()}
    assert [(d["text"], d["poly"] and d["poly"][1]["x"]) for d in seen["1", 1]] == [("good", 3.0), ("b", None)] and not seen["2", 1]
    failed = hooks.recognised(got, lambda: (lambda c: 1 / 0)).where("error is not null").collect()
    assert len(failed) == 1


def test_stream_resumes(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    schema = "order_id string, lob string"
    judge = lambda df: df.withColumn("n", F.length("order_id"))

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    def run(**more):
        q = incremental.run_available(incremental.new_orders(spark, src, "parquet", schema), judge, out, ck, **more)
        q.awaitTermination()
        return sorted((r["order_id"] or "") for r in spark.read.parquet(out).collect())

    add([("1", "a"), ("1", "a"), (None, "b")])
    assert run() == ["", "1", "1"]
    add([("1", "a"), ("2", "c"), (None, "b")])
    assert run() == ["", "1", "1", "2"]
    assert run() == ["", "1", "1", "2"]
    add([("3", "a"), ("3", "a")])
    assert run(once_per_order=True) == ["", "1", "1", "2", "3"]


def test_ids_are_found_in_few_files(spark, tmp_path):
    """However many batches there were, one reads a bounded number of segments, and of those the buckets of its own ids only."""
    ids = DoneIds(spark, str(tmp_path / "ids"), str(tmp_path / "results"), buckets=8, fan=3)
    files = []
    for n in range(28):
        batch = spark.createDataFrame([(f"{n}-{i}", "bad" if i == 1 else None) for i in range(4)] + [(None, None)], "order_id string, error string").coalesce(1)
        batch.write.parquet(f"{ids.results}/batch_id={n}")
        if n != 5:  # a segment that was lost is made again
            ids.close(n)
        again = spark.createDataFrame([(f"{k}-2",) for k in {0, n // 2, n - 1, n} if k >= 0], "order_id string")
        read = ids.before(n, again)
        if n in (0, 1, 5, 6, 9, 20, 27):
            found = {r["order_id"] for r in again.join(read, "order_id").collect()}
            assert found == {f"{k}-2" for k in {0, n // 2, n - 1} if 0 <= k < n}
            assert not n or "PartitionFilters: [" in read._jdf.queryExecution().executedPlan().toString()
            touched = {r[0] for r in again.select(ids.bucket()).distinct().collect()}
            files.append(sum(len(glob.glob(f"{ids._folder(*s)}/bucket={b}/*.parquet")) for s in ids.segments(n) for b in touched))
    assert max(len(ids.segments(n)) for n in range(200)) <= 2 * 5 and max(files) <= 3 * 2 * 4
    assert sum(3**level for level, _ in ids.segments(28)) == 28
    errors = ids.before(28, spark.createDataFrame([("3-1",), (None,)], "order_id string"))
    assert errors.where("order_id = '3-1'").first()["error"] == "bad" and errors.where("order_id is null").count() >= 1


def test_steps_of_a_run(spark, tmp_path):
    src, told = str(tmp_path / "in"), []
    for n in (70, 10, 130):
        spark.range(n).select(F.concat(F.lit(f"{n}-"), "id").alias("order_id")).coalesce(1).write.mode("append").parquet(src)
    stream = incremental.new_orders(spark, src, "parquet", "order_id string", files_per_batch=1)
    judge = lambda df: df.withColumn("error", F.when(F.col("order_id").endswith("-7"), "bad"))
    incremental.run_available(stream, judge, str(tmp_path / "out"), str(tmp_path / "ck"), steps=told.append, total=210).awaitTermination()
    assert [p.done for p in told] == [50, 100, 150, 200] and told[-1].failed == 3
    last = told[-1]
    assert last.percent == 100 * 200 / 210 and last.eta_h == 10 * last.seconds / 200 / 3600 and last.avg_s > 0


def test_recogniser_is_built_once_in_a_worker(spark, tmp_path):
    where = str(tmp_path)

    def make():
        with open(f"{where}/{os.getpid()}-{uuid.uuid4().hex}", "w"):
            pass
        return bytes.decode

    of = spark.range(3200).select(F.col("id").cast("string").alias("order_id"), F.lit(1).alias("image_idx"), F.lit(b"{}").alias("content"), F.lit("ok").alias("status")).repartition(32)
    for _ in range(2):
        assert hooks.recognised(of, make).where("error is null").count() == 3200
    pids = [f.split("-")[0] for f in os.listdir(where)]
    assert 1 <= len(pids) == len(set(pids)) <= 8


def test_rule_books(spark):
    good = [("Own", '{"scan_sticker": {"x_min": 0.1}}'), (" Full ", '{"sticker_count": "dual_required", "scan_sticker": [{"y_max": 0.4}, "no", {"y_min": 0.6}], "auth_sticker": {"x_max": 1}, "front_face_aspect_range": [1, 2.5], "unofficial_color": {"enabled": true, "mode": "brown_box", "area_ratio": 0.1}}')]
    bad = [(None, '{"scan_sticker": {}}'), ("A", "{"), ("B", None), ("C", '{"scan_sticker": null}'), ("D", '{"scan_sticker": {"x_min": 0.9, "x_max": 0.1}}'), ("E", '{"scan_sticker": {}}'), ("E", '{"scan_sticker": {}}'), ("F", '{"scan_sticker": {}, "front_face_aspect_range": [1]}'), ("G", '{"scan_sticker": {}, "unofficial_color": {"mode": "red", "area_ratio": -1}}')]
    rules, refused = load_rules(spark.createDataFrame(good + bad, "lob string, rule string"))
    got = {r["lob"]: r for r in rules.collect()}
    assert set(got) == {"Own", "Full"} and rules.schema.simpleString() == rule_book(spark).schema.simpleString()
    assert got["Own"]["sticker_count"] == "single_or_dual" and got["Own"]["auth_zones"] is None and got["Own"]["color"]["enabled"] is False and len(got["Own"]["scan_zones"]) == 1
    assert [z["y_min"] for z in got["Full"]["scan_zones"]] == [None, 0.6] and got["Full"]["aspect_hi"] == 2.5 and got["Full"]["color"]["mode"] == "brown_box"
    why = [(r["lob"], r["reasons"]) for r in refused.collect()]
    assert sorted(why, key=str) == sorted([(None, ["no name"]), ("A", ["not JSON"]), ("B", ["not JSON"]), ("C", ["no scan zone"]), ("D", ["bad zone"]), ("E", ["name comes twice"]), ("E", ["name comes twice"]), ("F", ["bad aspect range"]), ("G", ["unknown color mode", "negative threshold"])], key=str)


def test_once_within(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.sql("select '1' as order_id, timestamp'2024-01-01 00:00:00' as ts union all select '1', timestamp'2024-01-01 00:00:01' union all select '2', timestamp'2024-01-01 00:00:02'").coalesce(1).write.parquet(src)
    stream = incremental.once_within(spark.readStream.schema("order_id string, ts timestamp").parquet(src), "ts", "1 hour")
    q = stream.writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == 2


def square(n, on, s=200):
    return [("a", x, y, 100, s if (x, y) in on else 10, 120) for x in range(n) for y in range(n)]


PIXELS = "image string, x int, y int, h int, s int, v int"


def test_regions_and_patches(spark):
    on = {(x, y) for x in range(5, 15) for y in range(5, 15)} | {(15, 15)} | {(30, 30)}
    df = grid.brown_mask(spark.createDataFrame(square(40, on), PIXELS))
    sizes = sorted(r["n"] for r in grid.regions(df).groupBy("region").agg(F.count("*").alias("n")).collect())
    assert sizes == [1, 101]
    found = grid.foreign_patches(df).collect()
    assert len(found) == 1 and found[0]["solidity"] > 0.8 and found[0]["edge"] > 6
    ring = {(x, y) for x in range(5, 20) for y in range(5, 20) if x in (5, 19) or y in (5, 19)}
    snake = grid.regions(grid.brown_mask(spark.createDataFrame(square(30, ring), PIXELS)))
    assert snake.select("region").distinct().count() == 1
    assert grid.foreign_patches(grid.brown_mask(spark.createDataFrame([], PIXELS))).count() == 0


@pytest.mark.parametrize("reach,tile", [(2, 256), (2, 8), (4, 7), (4, 256)])
def test_closing_matches_numpy(spark, reach, tile):
    rng = np.random.default_rng(3)
    m = rng.random((30, 30)) < 0.04
    df = spark.createDataFrame([("a", int(x), int(y), bool(m[y, x])) for y in range(30) for x in range(30)], "image string, x int, y int, mask boolean")

    def sweep(a, kind, empty):
        p = np.pad(a, reach, constant_values=empty)
        return kind(np.stack([p[i : i + 30, j : j + 30] for i in range(2 * reach + 1) for j in range(2 * reach + 1)]), axis=0)

    want = sweep(sweep(m, np.max, False), np.min, True)
    got = np.zeros_like(m)
    closed = grid.closing(df, reach, tile) if (reach, tile) != (4, 256) else grid.closing(df)
    for r in closed.where("mask").collect():
        got[r["y"], r["x"]] = True
    assert (got == want).all() and closed.count() == 900


def plain_solidity(points):
    """By flooding the outside, counting squares, and a hull from all triples of directions."""
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    out, todo = set(), [(min(xs) - 1, min(ys) - 1)]
    while todo:
        x, y = todo.pop()
        if (x, y) in out or (x, y) in points or not (min(xs) - 1 <= x <= max(xs) + 1 and min(ys) - 1 <= y <= max(ys) + 1):
            continue
        out.add((x, y))
        todo += [(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)]
    full = {(x, y) for x in range(min(xs), max(xs) + 1) for y in range(min(ys), max(ys) + 1)} - out
    corners = [sum((x + i, y + j) in full for i in (0, 1) for j in (0, 1)) for x in range(min(xs) - 1, max(xs) + 1) for y in range(min(ys) - 1, max(ys) + 1)]
    inner = corners.count(4) + corners.count(3) / 2
    # Of each direction the farthest point is on the hull; directions between all pairs' normals are enough.
    dirs = sorted({math.atan2(b[1] - a[1], b[0] - a[0]) + t for a in full for b in full if a != b for t in (math.pi / 2 - 1e-6, math.pi / 2 + 1e-6)})
    hull = []
    for t in dirs:
        p = max(full, key=lambda p: p[0] * math.cos(t) + p[1] * math.sin(t))
        if not hull or hull[-1] != p:
            hull.append(p)
    area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(hull, hull[1:] + hull[:1]))) / 2 if hull else 0
    return len(points), round(min(1, inner / area), 6) if area >= 1 else 0.0


def test_solidity_fills_holes(spark):
    rng = np.random.default_rng(5)
    shapes = {
        "square": {(x, y) for x in range(3, 9) for y in range(2, 9)}, "ring": {(x, y) for x in range(7) for y in range(7) if x in (0, 6) or y in (0, 6)},
        "diamond": {(x, y) for x in range(9) for y in range(9) if abs(x - 4) + abs(y - 4) == 4}, "line": {(x, 3) for x in range(9)}, "dot": {(4, 4)}, "slope": {(i, i) for i in range(6)},
        "cup": {(x, y) for x in range(7) for y in range(7) if x in (0, 6) or y == 6}, "nested": {(x, y) for x in range(11) for y in range(11) if max(abs(x - 5), abs(y - 5)) in (5, 4)} | {(5, 5)},
        "leak": {(x, y) for x in range(7) for y in range(7) if x in (0, 6) or y in (0, 6)} - {(6, 3)}, "saw": {(x, y) for x in range(10) for y in range(6) if y < 2 + x % 3},
    }
    shapes |= {f"noise{i}": {(int(x), int(y)) for x, y in rng.integers(0, 9, (45, 2))} for i in range(6)}
    labelled = spark.createDataFrame([(k, 0, x, y) for k, v in shapes.items() for x, y in v], "image string, region long, x int, y int")
    got = {r["image"]: (r["area"], round(r["solidity"], 6)) for r in grid.solidity(labelled).collect()}
    # A region is connected; the noise isn't, and is only tested where it is.
    linked = {r["image"] for r in grid.regions(labelled.select("image", "x", "y", F.lit(True).alias("mask"))).groupBy("image").agg(F.countDistinct("region").alias("n")).where("n = 1").collect()}
    assert {"ring", "diamond", "leak"} <= linked
    assert {k: got[k] for k in linked} == {k: plain_solidity(shapes[k]) for k in linked}


def test_patches_by_rule_and_by_tile(spark):
    on = {(x, y) for x in range(5, 15) for y in range(5, 15)} | {(x, y) for x in range(24, 36) for y in range(20, 32) if x in (24, 25, 34, 35) or y in (20, 21, 30, 31)}
    px = spark.createDataFrame([(f"{name}", *r[1:]) for name in "ab" for r in square(40, on)], PIXELS)
    df = grid.brown_mask(px).cache()
    rules = spark.createDataFrame([("a", None, None, None), ("b", 0.08, None, None)], "image string, area_ratio double, solidity_min double, edge_grad_min double")
    whole = sorted(map(tuple, grid.foreign_patches(df, rules).collect()))
    assert [r[0] for r in whole] == ["a", "a", "b"] and whole[2][1] == 20 * 65536 + 24
    assert sorted(map(tuple, grid.foreign_patches(df, rules, tile=8).collect())) == whole
    assert grid.foreign_patches(df, rules.withColumn("edge_grad_min", F.lit(1e6))).count() == 0


def test_hull_and_rectangle_of_contours(spark):
    rng = random.Random(8)
    clouds = [[(float(rng.randrange(20)), float(rng.randrange(20))) for _ in range(n)] for n in (1, 2, 3, 4, 9, 60, 300) for _ in range(4)]
    clouds += [[(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)], [(5.0, 5.0)] * 4, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0), (2.0, 0.0)]]
    turn = lambda x, y, t: (x * math.cos(t) - y * math.sin(t), x * math.sin(t) + y * math.cos(t))
    clouds.append([turn(x, y, 0.3) for x in range(11) for y in range(6)])
    df = spark.createDataFrame([(i, c) for i, c in enumerate(clouds)], "i int, p array<struct<x:double,y:double>>")
    for r in df.select("i", G.hull(F.col("p")).alias("h"), G.min_area_box(F.col("p")).alias("b")).collect():
        points = sorted(set(clouds[r["i"]]))
        h = [(p["x"], p["y"]) for p in r["h"]]
        cross = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        flat = all(abs(cross(points[0], points[-1], p)) < 1e-9 for p in points)
        if flat:
            assert r["b"] is None and len(h) <= 2
            continue
        edges = list(zip(h, h[1:] + h[:1]))
        assert set(h) <= set(points) and all(cross(a, b, p) >= -1e-9 for a, b in edges for p in points)
        assert all(cross(a, b, c) > (0 if r["i"] < len(clouds) - 1 else -1e-9) for a, b, c in zip(h, h[1:] + h[:1], h[2:] + h[:2]))
        box = [(p["x"], p["y"]) for p in r["b"]]
        area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(box, box[1:] + box[:1]))) / 2

        def by(t):
            q = [turn(x, y, -t) for x, y in points]  # noqa: B023
            return (max(x for x, _ in q) - min(x for x, _ in q)) * (max(y for _, y in q) - min(y for _, y in q))

        assert area <= min(by(k * math.pi / 720) for k in range(360)) + 1e-2
        assert all(min(cross(a, b, p) for a, b in zip(box, box[1:] + box[:1])) >= -1e-2 for p in points)


def test_reports(spark):
    v = spark.createDataFrame([("a", 1, 1, 1, 1), (None, 0, 0, -1, -1), (None, 0, 1, 4, -1)], "lob string, is_compliant int, seal_exists int, position_valid int, dual_code int")
    assert reports.summary(v).first().asDict() | {"total": 3, "compliant": 1, "foreign": 1, "no_front_photo": 1, "dual": 1} == reports.summary(v).first().asDict()
    assert [tuple(r) for r in reports.distribution(v, "lob").collect()] == [(None, 2), ("a", 1)]
    assert reports.summary(v.limit(0)).first()["total"] == 0


def test_rows_are_numbered_in_ranges(spark):
    df = spark.range(20000).select((F.col("id") * 7919 % 20011).alias("a"), (F.col("id") % 3).alias("b")).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = inputs.numbered(df, ("b", "a"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = {(r["b"], r["a"]): r["rn"] for r in out.collect()}
    assert got == {k: i for i, k in enumerate(sorted(got))} and len(got) == 20000
    ranges = [f for f in out.inputFiles() if "/ranges-" in f]
    assert len(ranges) > 1


def test_throughput_is_numbered_in_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 31 % 977).alias("ts")).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = reports.throughput(df, ["k"], "ts")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = {r["done"]: r["avg_s"] for r in out.collect()}
    times, want = [r["ts"].timestamp() for r in df.orderBy("k").collect()], {}
    for n in range(50, 5001, 50):
        want[n] = round((times[n - 1] - min(times[:n])) / n, 4)
    assert set(got) == set(want) and all(abs(got[n] - want[n]) < 2e-4 for n in want)
    assert len([f for f in out.inputFiles() if "/ranges-" in f]) > 1


def test_fetch_gives_up_after_a_while(spark):
    import time

    of = spark.createDataFrame([("1", i, u) for i, u in enumerate(["a", "slow", "b", "slow", "c"])], "order_id string, image_idx int, url string").coalesce(1)

    def fetch(url):
        if url == "slow":
            time.sleep(20)
        return url.encode()

    began = time.time()
    got = {r["image_idx"]: (r["status"], r["error"]) for r in hooks.fetched(of, fetch, threads=2, timeout=0.5).collect()}
    assert [got[i][0] for i in range(5)] == ["ok", "failed", "ok", "failed", "ok"] and "TimeoutError" in got[1][1] and time.time() - began < 15


def test_failed_orders_become_error_rows(spark):
    from sealstone.operators import verdict

    read = spark.createDataFrame([("1", 1, None), ("1", 2, "E: x"), ("1", 3, "E: y"), ("2", 1, None)], "order_id string, image_idx int, error string")
    for v in (spark.createDataFrame([("1", "Mac", 1, "在", 0)], "order_id string, lob string, seal_exists int, keyword string, paste_error int"), spark.createDataFrame([("1", "Mac", 1, 1, "x", 0.5)], "order_id string, lob string, seal_exists int, position_valid int, detail string, rel_x double")):
        out = verdict.quarantined(v, verdict.failures(read)).first().asDict()
        assert out["lob"] == "Mac" and out["seal_exists"] == -1 and out["error"] == "E: x" and out.get("keyword", "ERROR") == "ERROR" and out.get("detail", "ERROR") == "ERROR" and out.get("rel_x") is None
    assert verdict.quarantined(v.withColumn("order_id", F.lit("2")), verdict.failures(read)).first()["error"] is None


def test_masks_by_mode(spark):
    px = spark.createDataFrame([(i, x, y, 100, 20 if (x + y) % 7 else 200, 200 if (x + y) % 7 else 120) for i in range(3) for x in range(30) for y in range(30)], "image long, x int, y int, h int, s int, v int")
    modes = spark.createDataFrame([(0, "white_box"), (1, "brown_box"), (2, None)], "image long, mode string")
    got = {r["image"]: r["n"] for r in grid.masked(px, modes).where("mask").groupBy("image").agg(F.count("*").alias("n")).collect()}
    want = {0: grid.white_mask(px.where("image = 0")).where("mask").count(), 1: grid.brown_mask(px.where("image = 1")).where("mask").count()}
    assert got == want and all(want.values())


def test_pixels_are_neither_broadcast_nor_joined_into_few_parts(spark, monkeypatch):
    """Tables that grow with the pixels are merged, whatever their files' size; parts of tiles follow the number of pixels."""
    px = spark.range(1600).selectExpr("id div 400 as image", "int(id % 20) as x", "int(id div 20 % 20) as y", "15 as h", "20 as s", "200 as v", "id % 3 = 0 as mask", "double(id % 7) as signal")
    labelled = grid.regions(px)
    for df in (labelled, grid.inset(px), grid.solidity(labelled), grid.edge_strength(labelled, px)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(grid, "TASK_PIXELS", 100)
    assert grid._tiled(px, 4, 256).rdd.getNumPartitions() == 16


def test_photos_are_exchanged_once_and_stay_in_place(spark):
    """One exchange on order_id serves the boxes of a photo, the photo and its order; the photos are not broadcast."""
    from sealstone.plans import checks

    plan = lambda name: checks.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    ruled = plan("dual_status")
    assert ruled.count("Exchange hashpartitioning") == 2 and ruled.count("ShuffledHashJoin") == 1 and "Window" not in ruled
    assert plan("min_area_rect").count("Exchange hashpartitioning") == 1


def test_hulls_need_few_points(spark):
    """Of a region's rows only ends that stand out are kept, and the hull is that of all ends."""
    import random

    rng = random.Random(4)
    rows = [(0, 1, y, 3, 42) for y in range(40)]  # a rectangle
    for r in range(1, 30):
        a, b = 50, 60
        for y in range(rng.randint(1, 25)):
            a, b = max(0, a + rng.randint(-3, 3)), b + rng.randint(-3, 3)
            b = max(a, b)
            rows.append((r % 3, r + 1, 2 * y if r == 7 else y, a, b))  # rows of the seventh aren't next to each other
    solid = spark.createDataFrame(rows, "image int, region int, y int, a int, b int")
    kept = grid._corners(solid)
    assert kept.where("region = 1").count() == 4 and kept.count() < 2 * len(rows)  # each row has two ends
    all_ = solid.select("image", "region", F.explode(F.array(G.point(F.col("a"), F.col("y")), G.point(F.col("b"), F.col("y")))).alias("p"))
    hulls = lambda of: {(r["image"], r["region"]): r["h"] for r in of.groupBy("image", "region").agg(G.hull(F.collect_list("p")).alias("h")).collect()}
    assert hulls(kept) == hulls(all_)
