"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sealstone.llm import manifest
from sealstone.llm.common import lower_ascii

COLS = "doc_id long, text string, lang string, source string, n_chars long, tree string, digest string, nth long, n long, block long, path string, root string, r long, p int, last int"
TAMPERED = "crc32(string(doc_id)) % 5 = 0"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(digests):
    """The root, and for each leaf its runs: (place, run)."""
    paths, now, at = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(now) > 1:
        for leaf, i in enumerate(at):
            paths[leaf].append((i % 16, now[i - i % 16 : i - i % 16 + 16]))
        now, at = [h(*now[i : i + 16]) for i in range(0, len(now), 16)], [i // 16 for i in at]
    return now[0], paths


def plain(rows):
    by = {}
    for doc_id, text, lang, source, n_chars in rows:
        make = lambda t: h(*map(field, (doc_id, source, lang, n_chars, t)))  # noqa: B023, E731
        bad = make(text if text is None else lower(text)) if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 else None
        by.setdefault(source, []).append((doc_id, make(text), bad))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = climb([x[1] for x in by[s]])
    root, over = climb([trees[s][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for (doc_id, leaf, bad), path in zip(by[s], trees[s][1]):
            siblings, fold = [], bad or leaf
            for i, run in path + over[k]:
                siblings += run[:i] + run[i + 1 :]
                fold = h(*run[:i], fold, *run[i + 1 :])
            out.append((doc_id, leaf, trees[s][0], root, h(*siblings), fold, fold == root))
    return sorted(out, key=str)


def run(spark, rows, parts=3):
    more = [(*r, "t", "d", 1, 2, 3, "p", "r", 4, 5, 6) for r in rows]
    got = manifest.manifest(spark.createDataFrame(more, COLS).repartition(parts), F.expr(TAMPERED), lower_ascii(F.col("text"))).collect()
    return sorted(map(tuple, got), key=str)


@pytest.mark.parametrize("n,sources", [(1, 1), (2, 1), (16, 1), (17, 1), (40, 40), (300, 3), (700, 1)])
def test_against_a_plain_tree(spark, monkeypatch, n, sources):
    monkeypatch.setattr(manifest, "RANGE", 100)
    rng = random.Random(n)
    rows = [(i * 3, "".join(rng.choice("aBcÉ |\n") for _ in range(rng.randrange(30))), rng.choice(["en", None]), f"s{rng.randrange(sources)}", i) for i in range(n)]
    assert run(spark, rows) == plain(rows)


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(manifest, "RANGE", 20)
    rows = [(i, f"Text {i}", "en", "hot", 6) for i in range(60)] + [(7, "Copy", "de", "hot", 4)] * 40 + [(i, None, None, None, None) for i in range(5)]
    rows += [(None, "", "", "", 0), (None, None, None, None, None), (None, "Z", "x", "hot", 1), (-5, "Ü" * 5000, "en", "Ünder", 5000), (2**40, "x:1", "-", "a,b", -1), (1, "é😀", "en", "😀", 3), (2, "z", "en", "￿", 1)]
    got = run(spark, rows)
    assert got == plain(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)
    none = spark.createDataFrame([], COLS)
    assert manifest.manifest(none, F.expr(TAMPERED), lower_ascii(F.col("text"))).count() == 0


def test_sweeps_of_one_subtree():
    leaves = [h(str(i)) for i in range(37)]
    runs = manifest.forward("".join(leaves), 2)
    root, paths = climb(leaves)
    assert runs[3, 0] == root
    got = dict(manifest.backward(runs, 2, ""))
    assert sorted(got) == list(range(37))
    assert got[20].split(",") == [f"{i}:{''.join(run)}" for i, run in paths[20]]
    assert manifest.fold(leaves[20], got[20]) == root and manifest.fold(leaves[21], got[20]) != root
