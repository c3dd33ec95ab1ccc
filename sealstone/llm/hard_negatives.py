"""Hard-negative mining by threshold joins in the manner of L2AP.

Vectors stand in blocks, in vertical layout. A join of a block of anchors with a block of candidates at given thresholds first builds the
block's inverted index: dimensions come in the order of their energy, and a candidate's last ones, from where on the product of its suffix
norm with an anchor's can't reach any anchor's threshold, are left out of it. Candidates are ordered by how many dimensions they have in the index,
so that a dimension's postings are the first so many of them. Partial scores are accumulated group by group of postings, candidates
that can't reach any threshold with the norms that remain are pruned, and what is left is verified on the dimensions that were left out.

An anchor's positives are found with the threshold that one block proves. Its windows of negatives start with a threshold near their
upper ends; anchors whose windows aren't full join again with lower thresholds, down to the windows' lower ends.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sealstone.llm.common import saved, table

SCALE, EVERY, SWAPPED, LABELS = 256.0, 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
#: A window's ends as percentages of the positive's score.
LOW, HIGH = 30, 90
#: Thresholds of the rounds, as shares of a window's upper end; the last is below its lower end.
STEPS = (0.9, 0.75, 0.5, 0.0)
CANDIDATES, ANCHORS, GROUP = 4096, 512, 8
#: Blocks of a kind that meet in one task.
CELL = 8


def reaching(q: np.ndarray, c: np.ndarray, t: np.ndarray, work: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """q and c: dimensions x vectors, whole numbers. All pairs whose inner product is at least t (one for each of q): indexes and products.
    work: gets the products of components that were accumulated and verified."""
    t = t - 1e-6 * np.maximum(1, np.abs(t, where=np.isfinite(t), out=np.zeros(len(t))))
    order = np.argsort(-(q * q).mean(axis=1) * (c * c).mean(axis=1), kind="stable")
    q, c = q[order], c[order]
    edges = [*range(0, len(q), GROUP), len(q)]
    # Suffix norms, at each edge, of what comes from there on.
    q_rest, c_rest = (np.sqrt(np.stack([(x[e:] ** 2).sum(axis=0) for e in edges])) for x in (q, c))
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(t > 0, q_rest / t, np.inf)
    reach = np.where(np.isnan(share), 0.0, share).max(axis=1, initial=0.0)
    reach[-1] = 0.0
    # The first edge from which on a candidate's dimensions aren't in the index.
    ends = (c_rest * np.nan_to_num(reach, posinf=1e300)[:, None] < 1).argmax(axis=0)
    if np.isinf(reach[:-1]).any():
        ends[:] = len(edges) - 1
    own = np.argsort(-ends, kind="stable")
    own = own[ends[own] > 0]
    ends, score = ends[own], np.zeros((len(t), len(own)))
    for g in range(len(edges) - 1):
        n = np.searchsorted(-ends, -g, side="left")  # the first n have this group in the index
        if not n:
            break
        a, b = edges[g], edges[g + 1]
        score[:, :n] += q[a:b].T @ c[a:b, own[:n]]
        if work is not None:
            work.append(len(t) * n * (b - a))
        going = (score[:, :n] + q_rest[g + 1][:, None] * c_rest[g + 1, own[:n]][None, :] >= t[:, None]).any(axis=0)
        if going.mean() < 0.9:
            left = np.concatenate((np.flatnonzero(going), np.arange(n, len(own))))
            own, ends, score = own[left], ends[left], score[:, left]
    found = []
    for g in np.unique(ends):
        seg = np.flatnonzero(ends == g)
        qi, ci = np.nonzero(score[:, seg] + q_rest[g][:, None] * c_rest[g, own[seg]][None, :] >= t[:, None])
        ci = seg[ci]
        part, rest = score[qi, ci], slice(edges[g], None)
        if edges[g] < len(q):
            part = part + np.einsum("ij,ij->j", q[rest][:, qi], c[rest][:, own[ci]])
            if work is not None:
                work.append(len(qi) * (len(q) - edges[g]))
        keep = part >= t[qi]
        found.append((qi[keep], own[ci[keep]], part[keep]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def best(groups: np.ndarray, ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Indexes of each group's `most` largest scores, ties to the smaller id."""
    order = np.lexsort((ids, -scores, groups))
    g = groups[order]
    return order[np.arange(len(g)) - np.searchsorted(g, g, side="left") < most]


class Block:
    """A row of a block table: its columns as arrays, and its vectors, dimensions x vectors."""

    def __init__(self, row, prefix: str = "") -> None:
        read = lambda c, kind: np.frombuffer(getattr(row, prefix + c), kind)
        self.ids, self.labels = read("ids", "<i8"), read("labels", "<i8")
        self.vals = read("vals", getattr(row, prefix + "kind")).reshape(row.dims, -1).astype(np.float64)
        for c in ("a", "ts", "ps"):
            if hasattr(row, prefix + c):
                setattr(self, c, read(c, "<i8" if c == "a" else "<f8"))
        if hasattr(self, "ps"):
            self.ts, self.ps = self.ts.reshape(len(self.ids), -1), self.ps.reshape(len(self.ids), -1)


COLS = "ids binary, labels binary, dims int, kind string, vals binary"


def blocks(vectors: DataFrame, size: int, *more: str) -> DataFrame:
    """vectors (vec_id, label, embedding of whole numbers; more: a, and arrays ts and ps) to rows of about `size` vectors, columns as bytes."""

    def block(some: pd.DataFrame):
        dims = some["embedding"].map(len)
        for d, own in some.groupby(dims):
            values = np.stack(own["embedding"].to_numpy()).astype(np.float64).reshape(len(own), d).T
            kind = "<i2" if np.abs(values).max(initial=0) < 2**15 else "<f8"
            row = {"ids": own["vec_id"].to_numpy("<i8").tobytes(), "labels": own["label"].to_numpy("<i8").tobytes(), "dims": d, "kind": kind, "vals": np.ascontiguousarray(values.astype(kind)).tobytes()}
            row |= {c: np.stack(own[c].to_numpy()).astype("<i8" if c == "a" else "<f8").tobytes() for c in more}
            yield pd.DataFrame([row])

    def build(batches):
        left = None
        for pdf in batches:
            left = pdf if left is None else pd.concat([left, pdf])
            while len(left) >= size:
                yield from block(left.iloc[:size])
                left = left.iloc[size:]
        if left is not None and len(left):
            yield from block(left)

    rows = vectors.select("vec_id", "label", "embedding", *more)
    return rows.repartition(max(1, -(-rows.count() // size))).mapInPandas(build, ", ".join([COLS, *[f"{c} binary" for c in more]]))


def _meet(anchors: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each block of anchors with each block of candidates of its dimensions, dealt over a grid of cells."""
    g, h = (max(1, -(-x.count() // CELL)) for x in (candidates, anchors))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    c = candidates.withColumn("g", F.pmod(F.xxhash64("ids"), F.lit(g))).withColumn("h", every(h))
    q = anchors.select(*[F.col(x).alias(f"q_{x}") if x != "dims" else F.col(x) for x in anchors.columns])
    q = q.withColumn("h", F.pmod(F.xxhash64("q_a"), F.lit(h))).withColumn("g", every(g))
    return c.join(q, ["dims", "g", "h"]).drop("g", "h")


def join(anchors: DataFrame, candidates: DataFrame, same: bool, most: int) -> DataFrame:
    """a, w, id, score, ended: for each anchor's window w, the `most` best candidates in it at or above its threshold, ranked (rank), and how many
    there are (n). same: candidates have the anchor's label, and windows no ends; else another label, and the window of the positive's score ps.
    ended: the threshold is at or below the window's lower end. Windows whose threshold is infinite are closed."""

    def compare(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                q, c = Block(row, "q_"), Block(row)
                qi, ci, score = reaching(q.vals, c.vals, q.ts.min(axis=1))
                fits = (q.ids[qi] != c.ids[ci]) & ((q.labels[qi] == c.labels[ci]) == same)
                qi, ci, score = qi[fits], ci[fits], score[fits]
                for w in range(q.ts.shape[1]):
                    ps, ts = q.ps[qi, w], q.ts[qi, w]
                    inside = (score >= ts) & np.isfinite(ps) if same else (score >= ts) & (100 * score >= LOW * ps) & (100 * score <= HIGH * ps)
                    k = np.flatnonzero(inside)
                    k = k[best(qi[k], c.ids[ci[k]], score[k], most)]
                    ended = 100 * q.ts[qi[k], w] <= LOW * q.ps[qi[k], w]
                    yield pd.DataFrame({"a": q.a[qi[k]], "w": w, "id": c.ids[ci[k]], "score": score[k].astype(np.int64), "ended": ended})

    found = _meet(anchors, candidates).mapInPandas(compare, "a long, w int, id long, score long, ended boolean")
    own = Window.partitionBy("a", "w")
    ranked = found.withColumn("rank", F.row_number().over(own.orderBy(F.desc("score"), "id"))).where(F.col("rank") <= most)
    return ranked.withColumn("n", F.count("*").over(own))


def _bars(anchors: DataFrame, candidates: DataFrame, most: int) -> DataFrame:
    """Blocks of anchors with a threshold that at least `most` candidates of the anchor's label reach: what is the last of these in one block, or
    minus infinity where it has fewer."""
    cols = anchors.columns
    first = candidates.groupBy("dims").agg(F.min_by(F.struct("ids", "labels", "kind", "vals"), F.xxhash64("ids")).alias("c"))
    both = anchors.join(first, "dims").select(*cols, *[F.col(f"c.{x}").alias(f"c_{x}") for x in ("ids", "labels", "kind", "vals")])

    def bars(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples():
                q, c = Block(row), Block(row, "c_")
                fits = (q.ids[:, None] != c.ids[None, :]) & (q.labels[:, None] == c.labels[None, :])
                score = np.where(fits, q.vals.T @ c.vals, -np.inf)
                bar = np.partition(score, -most, axis=1)[:, -most] if score.shape[1] >= most else np.full(len(q.ids), -np.inf)
                out.append(bar.astype("<f8").tobytes())
            yield pdf[cols].assign(ts=out, ps=[np.zeros(len(x) // 8).tobytes() for x in out])

    return both.mapInPandas(bars, ", ".join([COLS, "a binary, ts binary, ps binary"]))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: float = SCALE) -> DataFrame:
    """vectors (vec_id, label, embedding) to anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of floor(scale x), exact below 2^53. For each row where is_anchor holds, and each of its `positives` best rows of
    the same label, the `negatives` best rows of other labels whose score is LOW to HIGH percent of the positive's; ties go to the smaller id.

    Rows with a null id, label or vector, without components, or with null or non-finite ones, take no part; vectors are compared with those of their own
    length; rows with an anchor's vec_id are its own row, and each anchor row is mined for itself; other rows with equal ids each count; a
    positive without negatives in its window has no rows; an empty table gives an empty result; other columns play no part.
    """
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & whole)
    e = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    usable = saved(usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), e.alias("embedding"), is_anchor.alias("anchor")), "mining-vectors")
    candidates = saved(blocks(usable, CANDIDATES), "mining-candidates")
    anchors = saved(usable.where("anchor").select(F.monotonically_increasing_id().alias("a"), "vec_id", "label", "embedding"), "mining-anchors")
    bars = saved(_bars(blocks(anchors, ANCHORS, "a"), candidates, positives), "mining-bars")
    near = saved(join(bars, candidates, True, positives), "mining-positives").select("a", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    of = near.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("w", "positive_score"))).alias("p"))
    ps = F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda i: F.coalesce(F.get("p", i - 1)["positive_score"].cast("double"), F.lit(float("nan"))))
    now = anchors.join(of, "a").withColumn("ps", ps).drop("p")
    # A closed window has an infinite threshold; windows of positives that don't exist, or with scores below zero, are closed from the start.
    start = lambda step: F.transform("ps", lambda p: F.when(p >= 0, F.greatest(F.lit(LOW / 100) * p, F.lit(step * HIGH / 100) * p)).otherwise(F.lit(float("inf"))))
    now = now.withColumn("ps", F.transform("ps", lambda p: F.when(F.isnan(p), F.lit(-1.0)).otherwise(p)))
    now = saved(now.withColumn("ts", start(STEPS[0])), "mining-open")
    done = []
    for nth, step in enumerate(STEPS):
        found = saved(join(saved(blocks(now, ANCHORS, "a", "ts", "ps"), "mining-blocks"), candidates, False, negatives), "mining-found")
        done.append(found.where(f"n = {negatives} OR ended"))
        if nth == len(STEPS) - 1:
            break
        full = found.where(f"n = {negatives} AND rank = 1").groupBy("a").agg(F.collect_set("w").alias("full"))
        low = F.transform("ts", lambda t, w: F.when(F.coalesce(F.array_contains("full", w), F.lit(False)) | (t == float("inf")) | (100 * t <= LOW * F.get("ps", w)), F.lit(float("inf"))).otherwise(F.get("next", w)))
        now = now.join(full, "a", "left").withColumn("next", start(STEPS[nth + 1])).withColumn("ts", low).where(F.exists("ts", lambda t: t != float("inf"))).drop("full", "next")
        now = saved(now, "mining-open")
        if now.isEmpty():
            break
    found = done[0]
    for x in done[1:]:
        found = found.unionByName(x)
    names = anchors.select("a", F.col("vec_id").alias("anchor_id"))
    return found.join(near, ["a", "w"]).join(names, "a").select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % SWAPPED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", label), F.col("vec_id") % EVERY == 0)


OP11_SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % {SWAPPED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE}::DOUBLE * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % {EVERY} = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INT AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same AND 100 * n.score BETWEEN {LOW} * p.positive_score AND {HIGH} * p.positive_score
QUALIFY rank <= {NEGATIVES}
"""
