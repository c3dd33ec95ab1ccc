"""The log-bilinear model: derivatives, normalisation, held-out gain, and the query's sums against brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sealstone.llm import log_bilinear as L

COLS = "doc_id long, text string, lang string, source string, n_chars long, r long, n long, word string, ids string, x int, bucket int, words int, held_out int"
HELD = "crc32(string(doc_id)) % 5 = 1"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "en", "s", 1, 2, 3, "w", "i", 4, 5, 6, 7) for i, t in rows], COLS).repartition(parts)


def corpus(n, seed=1):
    """Two languages, whose words don't mix within a text."""
    rng = random.Random(seed)
    words = [[f"{a}{i}{z}" for i in range(60)] for a, z in (("w", "ing"), ("v", "eau"))]
    return [(i, " ".join(rng.choice(words[i % 2]) if rng.random() < 0.9 else f"x{rng.randrange(10**6)}{'ng' if i % 2 else 'au'}" for _ in range(60))) for i in range(n)]


def test_gradients_are_derivatives():
    rng = np.random.default_rng(2)
    model = L.Model(rng.random(L.CLASSES) + 0.1)
    for k in ("inputs", "outputs", "bias", "places"):
        setattr(model, k, getattr(model, k).astype("f8"))
    docs, noise = [rng.integers(0, 9, n).astype(np.int16) for n in (1, 7, 22)], rng.integers(0, 9, 8)
    target, before = L.windows(docs)
    lines = L.segments(docs, 8)
    assert (lines[:, L.CONTEXT :] != L.BEGIN).sum() == 30
    for k, g in zip(("inputs", "outputs", "bias", "places"), model.gradients(lines, noise)):
        x = getattr(model, k)
        for at in zip(*(rng.choice(i, 12) for i in np.nonzero(g))):
            was, e = x[at], 1e-5
            x[at] = was + e
            up = model.loss(before, target, noise)
            x[at] = was - e
            down = model.loss(before, target, noise)
            x[at] = was
            assert (up - down) / (2 * e) == pytest.approx(g[at], rel=1e-3, abs=1e-4)


def test_classes_sum_to_one_and_windows_begin_anew():
    rng = np.random.default_rng(3)
    model = L.Model(rng.random(L.CLASSES) + 0.1)
    docs = [rng.integers(0, L.CLASSES, n).astype(np.int16) for n in (1, 5, 9)]
    target, before = L.windows(docs)
    assert (target == np.concatenate(docs)).all()
    assert (before[0] == L.BEGIN).all() and (before[1] == L.BEGIN).all() and before[4].tolist() == [*docs[1][2::-1], L.BEGIN]
    assert np.exp(model.log_probs(before)).sum(axis=1) == pytest.approx(1, abs=1e-4)
    model.bias[3] = 200  # too far above the others for float32
    assert np.isfinite(model.target_log_probs(before, target)).all() and model.target_log_probs(before, target) == pytest.approx(model.log_probs(before)[np.arange(len(target)), target], rel=1e-4, abs=1e-4)
    each = [sum(model.log_probs(L.windows([d])[1])[np.arange(len(d)), d]) for d in docs]
    assert L.score_classes(model, docs) == pytest.approx(each, rel=1e-4)


def test_words_and_unknown_words_sum_to_one(spark):
    rows = corpus(200)
    texts = frame(spark, [x for x in rows if not held(x[0])])
    counts = L.word_counts(texts).cache()
    v = L.Vocabulary(counts, texts.count())
    short = {w.decode() for w, i in v.index.items() if i < L.SHORT}
    share = np.zeros(L.BUCKETS)
    for r in counts.collect():
        if r["word"] not in short:
            share[r["bucket"]] += r["n"] / v.sums[r["bucket"]]
    assert share + (v.once + 1) / v.sums == pytest.approx(1)


@pytest.mark.parametrize("head", [1 << 16, 40, 1])
def test_sums_against_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(L, "HEAD", head)
    monkeypatch.setattr(L, "FLUSH", 50)
    rows = corpus(120) + [(500, None), (501, ""), (502, " \n\t"), (None, "Lone WORD w1ing"), (503, "É É É"), (504, "w1ing " * 30000), (504, "again"), (0, corpus(1)[0][1])]
    rows += [(i, "never seen before") for i in range(600, 700) if held(i)]
    got = L.score(frame(spark, rows), F.expr(HELD)).collect()
    tokens = lambda t: (t or "").encode().lower().split()
    count, docs = Counter(), 0
    for i, t in rows:
        if not held(i):
            count.update(tokens(t))
            docs += 1
    n, types = sum(count.values()) + docs, len(count) + 1
    base = lambda c: math.log10((c + 0.5) / (n + 0.5 * (types + 1)))
    want = sorted((str(i), held(i), len(tokens(t)) + 1, sum(count[w] > 0 for w in tokens(t)) + 1, n, round(sum(base(count[w]) for w in tokens(t)) + base(docs), 4)) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_scores_do_not_depend_on_where_counts_are(spark, monkeypatch):
    rows = corpus(60)
    one = {r["doc_id"]: r for r in L.score(frame(spark, rows, 1), F.expr(HELD)).collect()}
    monkeypatch.setattr(L, "HEAD", L.SHORT + 40)
    two = {r["doc_id"]: r for r in L.score(frame(spark, rows, 1), F.expr(HELD)).collect()}
    for i, _ in rows:
        assert one[i]["base_score"] == pytest.approx(two[i]["base_score"]) and one[i]["n_known"] == two[i]["n_known"]


def test_held_out_texts_gain(spark):
    got = [r for r in L.score(frame(spark, corpus(1500)), F.expr(HELD)).collect() if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in got)
    assert sum(r["score"] - r["base_score"] for r in got) / tokens > 0.15  # log10 2 less what unseen words cost


def test_edges(spark):
    assert L.score(frame(spark, corpus(3)).limit(0), F.expr(HELD)).count() == 0
    got = L.score(frame(spark, corpus(30)), F.lit(True)).collect()  # nothing to learn from
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in got)
