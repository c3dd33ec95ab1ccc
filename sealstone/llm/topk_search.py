"""Exact top-k search by columnar branch-and-bound.

Vectors stand in blocks, in vertical layout: one row for each dimension. First every block of queries meets one block of
candidates, all of it, and each query's k-th best score there is its bar in all others. Then a block of queries meets a block of
candidates: their inner products are summed one group of dimensions after the other, those with the most energy first. What the
remaining groups can still add is at most the sum of the products of their norms (Cauchy-Schwarz, group by group). Candidates that
can't reach a query's bar are dropped, and the survivors are compacted as soon as that is less work than going on with all. Each
pair of blocks gives k rows at most for each query, of which the k best stay.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sealstone.llm.common import BROADCAST, saved, table

TOP, EVERY, SCALE = 5, 50, 256.0
CANDIDATES, QUERIES, GROUP = 4096, 512, 16
#: Multiplying a whole block takes so much less time for each pair than multiplying chosen pairs.
DENSE = 0.1


def best_in_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, top: int = TOP, bar: np.ndarray | None = None, work: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """q and c: dimensions x vectors, whole numbers. Query ids, candidate ids and scores of each query's best in this block that reach
    its bar. work: gets the pairs and dimensions that were multiplied."""
    energy = (q * q).mean(axis=1) * (c * c).mean(axis=1)
    order = np.argsort(-energy, kind="stable")
    groups = [order[a : a + GROUP] for a in range(0, len(q), GROUP)]
    norms = [np.stack([np.sqrt((x[g] ** 2).sum(axis=0)) for g in groups]) for x in (q, c)]
    score = np.zeros((q.shape[1], c.shape[1]))
    alive = q_ids[:, None] != c_ids[None, :]
    bar = np.full(q.shape[1], -np.inf) if bar is None else bar.astype(np.float64)
    qi = ci = part = None
    for n, g in enumerate(groups):
        if work is not None:
            work.append((score.size if qi is None else len(qi), len(g)))
        q_rest, c_rest = (x[n + 1 :] * (1 + 1e-9) for x in norms)
        if qi is None:
            score += q[g].T @ c[g]
            slack = q_rest.T @ c_rest + 1e-6
            if c.shape[1] > top:
                lower = np.where(alive, score - slack, -np.inf)
                bar = np.maximum(bar, np.partition(lower, -top, axis=1)[:, -top])
            alive &= score + slack >= bar[:, None]
            if alive.mean() < DENSE:
                qi, ci = np.nonzero(alive)
                part = score[qi, ci]
        else:
            part = part + np.einsum("ij,ij->j", q[g][:, qi], c[g][:, ci])
            keep = part + np.einsum("ij,ij->j", q_rest[:, qi], c_rest[:, ci]) + 1e-6 >= bar[qi]
            qi, ci, part = qi[keep], ci[keep], part[keep]
    if qi is None:
        qi, ci = np.nonzero(alive)
        part = score[qi, ci]
    order = np.lexsort((c_ids[ci], -part, qi))
    qi, ci, part = qi[order], ci[order], part[order]
    nth = np.arange(len(qi)) - np.searchsorted(qi, qi, side="left")
    keep = nth < top
    return q_ids[qi[keep]], c_ids[ci[keep]], part[keep]


def bars_in_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, top: int = TOP) -> np.ndarray:
    """Each query's score of rank `top` in this block, multiplied in full."""
    score = np.where(q_ids[:, None] != c_ids[None, :], q.T @ c, -np.inf)
    return np.partition(score, -top, axis=1)[:, -top] if len(c_ids) >= top else np.full(len(q_ids), -np.inf)


def _array(ids: bytes, dims: int, kind: str, vals: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(vals, dtype=kind).reshape(dims, -1).astype(np.float64)


def _blocks(vectors: DataFrame, size: int, scale: float) -> DataFrame:
    """vec_id, embedding to blocks: ids, dims and values as bytes, dimensions x vectors; vectors with holes are left out."""

    def block(some: pd.DataFrame):
        rows = {}
        for i, x in zip(some["vec_id"], some["embedding"]):
            rows.setdefault(len(x), []).append((i, x))
        for dims, own in rows.items():
            values = np.floor(scale * np.array([x for _, x in own], dtype=np.float64).reshape(len(own), dims)).T
            kind = "<i2" if np.abs(values).max(initial=0) < 2**15 else "<f8"
            yield pd.DataFrame({"ids": [np.array([i for i, _ in own], dtype="<i8").tobytes()], "dims": [dims], "kind": [kind], "vals": [np.ascontiguousarray(values.astype(kind)).tobytes()]})

    def build(batches):
        left = None
        for pdf in batches:
            left = pdf if left is None else pd.concat([left, pdf])
            while len(left) >= size:
                yield from block(left.iloc[:size])
                left = left.iloc[size:]
        if left is not None:
            yield from block(left)

    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    usable = usable.repartition(max(1, -(-usable.count() // size)))  # full blocks, however many partitions the table has
    return usable.mapInPandas(build, "ids binary, dims int, kind string, vals binary")


def search(vectors: DataFrame, is_query: Column, top: int = TOP, scale: float = SCALE) -> DataFrame:
    """vectors (vec_id, embedding) to query_id, rank, vec_id, score: for each row where is_query holds, the `top` largest inner
    products of floor(scale x) with the other rows, ties to the smaller vec_id.

    Vectors that are null or have no components, or hold null or non-finite ones, and rows with null ids take no part; vectors are compared with
    those of their own length; rows with a query's vec_id are its own row; other rows with equal ids each count; queries with no
    candidate have no rows; an empty table gives an empty result. Scores are exact below 2^53.
    """
    candidates = saved(_blocks(vectors, CANDIDATES, scale), "topk-candidates")
    queries = saved(_blocks(vectors.where(is_query), QUERIES, scale), "topk-queries")
    first = candidates.groupBy("dims").agg(F.min_by(F.struct("ids", "kind", "vals"), F.xxhash64("ids")).alias("c"))  # one block

    def with_bars(batches):
        for pdf in batches:
            bars = []
            for r in pdf.itertuples():
                bars.append(bars_in_block(*_array(r.ids, r.dims, r.kind, r.vals), *_array(r.c_ids, r.dims, r.c_kind, r.c_vals), top).tobytes())
            yield pdf[["ids", "dims", "kind", "vals"]].assign(bar=bars)

    queries = queries.join(first, "dims").select("ids", "dims", "kind", "vals", *[F.col(f"c.{x}").alias(f"c_{x}") for x in ("ids", "kind", "vals")])
    queries = saved(queries.mapInPandas(with_bars, "ids binary, dims int, kind string, vals binary, bar binary"), "topk-bars")
    # A stated query set against all rows, block by block: where the queries are few they go to every task, else each query block
    # goes to every group of candidate blocks.
    size = queries.agg(F.coalesce(F.sum(F.length("vals") + 2 * F.length("ids")), F.lit(0))).first()[0]
    if size <= BROADCAST:
        pairs = candidates.alias("c").join(F.broadcast(queries).alias("q"), F.col("c.dims") == F.col("q.dims"))
    else:
        n = max(1, candidates.count())
        grouped = candidates.withColumn("g", F.pmod(F.xxhash64("ids"), F.lit(n)))
        queries = queries.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
        pairs = grouped.alias("c").join(queries.alias("q"), (F.col("c.g") == F.col("q.g")) & (F.col("c.dims") == F.col("q.dims")))
    pairs = pairs.select("c.dims", "q.bar", *[F.col(f"{t}.{x}").alias(f"{t}_{x}") for t in "cq" for x in ("ids", "kind", "vals")])

    def compare(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                query, vec, score = best_in_block(*_array(r.q_ids, r.dims, r.q_kind, r.q_vals), *_array(r.c_ids, r.dims, r.c_kind, r.c_vals), top, np.frombuffer(r.bar))
                yield pd.DataFrame({"query_id": query, "vec_id": vec, "score": score.astype(np.int64)})

    found = pairs.mapInPandas(compare, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op5_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


OP5_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE}::DOUBLE * x::DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= {TOP}
"""
