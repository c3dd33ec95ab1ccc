"""Hard negatives against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sealstone.llm import hard_negatives as H

COLS = "vec_id long, label int, embedding array<float>, a long, w int, n long, ts double, ids string, dims int, g long, score double, anchor string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, 3, 0.5, "i", 4, 5, 0.25, "x") for r in rows], COLS).repartition(parts)


def plain(rows, every=10):
    ok = [(i, c, np.floor(256 * np.array(x, dtype=np.float32).astype(float))) for i, c, x in rows if None not in (i, c, x) and None not in x and all(map(math.isfinite, x))]
    out = []
    for i, c, x in ok:
        if i % every:
            continue
        others = sorted(((-int(x @ y), j, d) for j, d, y in ok if j != i and len(y) == len(x)))
        for p, j, _ in [o for o in others if o[2] == c][:5]:
            fits = [o for o in others if o[2] != c and 30 * -p <= 100 * -o[0] <= 90 * -p][:10]
            out += [(i, j, rank, k, -p, -s) for rank, (s, k, _) in enumerate(fits, 1)]
    return sorted(out)


def vectors(rng, n, dims=20, close=0.0):
    centre = [rng.gauss(0, 1) for _ in range(dims)]
    return [(i, rng.randrange(4), [close * m + (1 - close) * rng.gauss(0, 1) for m in centre]) for i in range(n)]


@pytest.mark.parametrize("close", [0.0, 0.5, 0.9])
def test_against_all_pairs(spark, monkeypatch, close):
    monkeypatch.setattr(H, "CANDIDATES", 64)
    monkeypatch.setattr(H, "ANCHORS", 8)
    monkeypatch.setattr(H, "CELL", 1)
    rows = vectors(random.Random(3), 300, close=close)
    got = H.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == plain(rows) != []


def test_edges(spark):
    rng = random.Random(4)
    rows = vectors(rng, 60, dims=5)
    rows += [(100, 1, None), (None, 1, [1.0] * 5), (101, None, [1.0] * 5), (102, 1, [1.0, None, 1.0, 1.0, 1.0]), (103, 2, [float("nan")] * 5), (104, 2, [float("inf")] * 5)]
    rows += [(110, 1, [2.0, 1.0]), (111, 1, [2.0, 1.0]), (112, 2, [1.0, 1.0]), (120, 3, []), (130, 3, [0.0] * 5), (140, 0, [900.0] * 5), (141, 0, [-900.0] * 5), (150, 77, [1.0] * 5)]
    rows += [rows[7]] * 15 + [rows[10]]  # repeats of a candidate, and of an anchor: each such row is mined for itself
    got = sorted(map(tuple, H.mine(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()))
    assert got == plain(rows)
    assert H.mine(frame(spark, rows).limit(0), F.lit(True)).count() == 0
    assert H.mine(frame(spark, rows), F.lit(False)).count() == 0


def test_index_leaves_dimensions_out_and_prunes():
    rng = np.random.default_rng(0)
    for scale, most in ((0, 0.9), (1, 0.3), (2, 0.25)):
        e = np.exp(-scale * np.arange(64) / 8)[:, None]
        q, c = np.floor(256 * rng.normal(size=(64, 40)) * e), np.floor(256 * rng.normal(size=(64, 300)) * e)
        full, work = q.T @ c, []
        t = 0.9 * full.max(axis=1)
        qi, ci, s = H.reaching(q, c, t, work)
        assert set(zip(qi.tolist(), ci.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(full >= t[:, None])))) and (s == full[qi, ci]).all()
        assert sum(work) < most * full.size * 64
    for t in (np.zeros(40), np.full(40, -np.inf), np.full(40, np.inf)):
        assert len(H.reaching(q, c, t)[0]) == (full >= t[:, None]).sum()


def test_thresholds_are_lowered(spark, monkeypatch):
    """Windows whose best negatives lie low fill in later rounds, or end unfilled at their lower ends."""
    rounds = []
    whole = H.join
    monkeypatch.setattr(H, "join", lambda *a: (rounds.append(a[2]), whole(*a))[1])
    far = [(i, i % 2, [1.0, 0.0] if i < 20 and i % 2 == 0 else [0.35 + 0.001 * i, 1.0]) for i in range(60)]
    got = H.mine(frame(spark, far), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == plain(far) != []
    assert rounds.count(False) > 1
