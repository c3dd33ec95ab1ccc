"""Toxicity as an ordered grade, by cumulative-link regression on sparse text features.

P(grade <= k) = sigmoid(threshold[k] - w.x): one weight vector for all thresholds, and the thresholds are kept in order by learning
the logarithms of their gaps. A document's severity is its expected grade, the sum of P(grade > k) over k. x says which words
and which beginnings and ends of words a text has. The model is fitted on at most MAX_LABELLED labelled documents; scoring reads
every whole text.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sealstone.llm.common import saved, table

#: The bound of the training sample: the labelled documents whose ids have the smallest hashes.
MAX_LABELLED = 20_000
#: Features of the model: all that are more frequent in toxic than in other documents of the sample, with a z of at least MIN_Z.
MIN_Z, MIN_DOCS = 4.0, 5
GRADES = 3
#: The share of clean documents of the sample that may fall above the cut; the cut is a probability of a half at most.
FALSE_SHARE = 0.002
TOKEN = re.compile(r"\w+")


def features(text: str) -> set[str]:
    """= before a word, ^ before its first 3 to 5 characters, $ before its last 4."""
    out = set()
    for w in set(TOKEN.findall(text.lower())):
        out.add("=" + w)
        n = len(w)
        if n > 3:
            out.add("^" + w[:3])
            if n > 4:
                out.update(("^" + w[:4], "$" + w[-4:]))
                if n > 5:
                    out.add("^" + w[:5])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_ordinal(row: np.ndarray, col: np.ndarray, grade: np.ndarray, width: int, grades: int = GRADES, l2: float = 1e-4, rounds: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds for documents with features (row[i], col[i]); Adam on the whole bounded sample."""
    n, w = len(grade), np.zeros(width)
    # Grade 0 weighs as much as all others together, so that P(grade > 0) passes a half as soon as the features speak for it.
    clean = (grade == 0).mean() if n else 0.5
    weight = np.where(grade == 0, 0.5 / max(clean, 1e-9), 0.5 / max(1 - clean, 1e-9))
    share = np.clip([weight[grade <= k].sum() / n if n else 0.5 for k in range(grades - 1)], 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    free = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 1e-2))))
    params = np.concatenate((w, free))
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, rounds + 1 if n else 1):
        w, free = params[:width], params[width:]
        theta = np.concatenate((free[:1], free[0] + np.cumsum(np.exp(free[1:]))))
        s = np.bincount(row, weights=w[col], minlength=n)
        up = np.where(grade[:, None] < grades - 1, _sigmoid(np.append(theta, 60)[grade] - s)[:, None], 1.0)[:, 0]
        down = np.where(grade > 0, _sigmoid(np.append(theta, 60)[grade - 1] - s), 0.0)
        p = np.maximum(up - down, 1e-12)
        du, dd = np.where(grade < grades - 1, up * (1 - up), 0.0) * weight / p, np.where(grade > 0, down * (1 - down), 0.0) * weight / p
        gw = np.bincount(col, weights=(du - dd)[row], minlength=width) / n + l2 * w
        gt = np.array([-(du[grade == k].sum() - dd[grade == k + 1].sum()) / n for k in range(grades - 1)])
        gf = np.concatenate(([gt.sum()], np.exp(free[1:]) * np.cumsum(gt[::-1])[::-1][1:]))
        g = np.concatenate((gw, gf))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        params[:width] = np.maximum(params[:width], 0)  # a feature that marks toxic documents never speaks against toxicity
    w, free = params[:width], params[width:]
    return w, np.concatenate((free[:1], free[0] + np.cumsum(np.exp(free[1:]))))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[dict[str, float], np.ndarray, float]:
    """docs (doc_id, text) and labels (doc_id, toxic 0 or 1) to each feature's weight, the thresholds, and the least probability
    of toxicity that is rejected. Equal texts count once, lest copies pass for evidence.

    Labels are 0 or 1, so toxic documents get their grade from how many of the chosen features they have: 1 up to the median, 2 above. Features are counted by Spark; the driver gets the chosen features and, for each document of the bounded
    sample, which of them it has.
    """
    wanted = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    wanted = wanted.select(F.col("doc_id").alias("labelled"), "toxic")
    sample = docs.select("doc_id", "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("labelled"))  # at most max_labelled rows of two numbers

    sample = sample.groupBy("text").agg(F.max("toxic").alias("toxic"))

    def read(batches):
        for pdf in batches:
            texts = pdf["text"].fillna("")
            yield pd.DataFrame({"toxic": pdf["toxic"], "features": [list(features(t)) for t in texts]})

    sample = saved(sample.select("text", "toxic").mapInPandas(read, "toxic int, features array<string>"), "toxicity-sample")
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return {}, np.array([60.0] * (GRADES - 1) if not n1 else [-60.0] * (GRADES - 1)), 0.5
    counts = sample.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
    p = (F.col("n") / (n1 + n0)).cast("double")
    z = (F.col("a") / n1 - (F.col("n") - F.col("a")) / n0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / n1 + 1 / n0))
    chosen = counts.where(F.col("n") >= MIN_DOCS).withColumn("z", z).where(F.col("z") >= MIN_Z).select("feature").orderBy("feature").collect()
    index = {r["feature"]: i for i, r in enumerate(chosen)}

    def select(batches):
        for pdf in batches:
            yield pd.DataFrame({"toxic": pdf["toxic"], "cols": [[index[x] for x in f if x in index] for f in pdf["features"]]})

    rows = sample.mapInPandas(select, "toxic int, cols array<int>").toPandas()
    marks = rows["cols"].map(len)
    grade = (rows["toxic"] * (1 + (marks > marks[rows["toxic"] == 1].median()))).to_numpy(dtype=np.int64)
    cols = [np.sort(np.asarray(c, dtype=np.int64)) for c in rows["cols"]]
    order = sorted(range(len(cols)), key=lambda i: (grade[i], cols[i].tobytes()))  # sums in one order: reruns agree
    cols = [cols[i] for i in order]
    row, col = np.repeat(np.arange(len(cols)), [len(c) for c in cols]), np.concatenate([*cols, np.empty(0, dtype=np.int64)])
    w, theta = fit_ordinal(row, col, grade[order], len(index))
    p = _sigmoid(np.bincount(row, weights=w[col], minlength=len(cols)) - theta[0])
    cut = min(0.5, float(np.quantile(p[grade[order] == 0], 1 - FALSE_SHARE)) + 0.02)
    return {f: float(w[i]) for f, i in index.items()}, theta, cut


def score(docs: DataFrame, model: tuple[dict[str, float], np.ndarray, float]) -> DataFrame:
    """row (docs' columns, whatever their names), severity (0 to GRADES - 1) and p_toxic (the probability of a grade of 1 or more) of
    each row of docs, which has a text. Null and empty texts have no features.
    """
    weights, theta, _ = model
    whole, start, end = ({f[1:]: w for f, w in weights.items() if f[0] == kind} for kind in "=^$")

    def of(text: str) -> float:
        total, seen = 0.0, set()
        for w in set(TOKEN.findall(text.lower())):
            if w in whole:
                total += whole[w]
            n = len(w)
            if n > 3:
                seen.add(w[:3])
                if n > 4:
                    seen.add(w[:4])
                    if (e := w[-4:]) in end:
                        seen.add("$" + e)
                    if n > 5:
                        seen.add(w[:5])
        return total + sum(end[x[1:]] if x[0] == "$" else start[x] for x in sorted(seen) if x in start or x[0] == "$" and x[1:] in end)

    @F.pandas_udf("severity double, p_toxic double")
    def graded(texts: pd.Series) -> pd.DataFrame:
        above = _sigmoid(np.array([of(t) for t in texts.fillna("")], dtype=float)[:, None] - theta)
        return pd.DataFrame({"severity": above.sum(axis=1), "p_toxic": above[:, 0]})

    return docs.select(F.struct("*").alias("row"), graded("text").alias("graded")).select("row", "graded.severity", "graded.p_toxic")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float | None = None, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, severity, p_toxic and rejected of each row of docs (doc_id, text), by labels (doc_id, toxic).

    Null ids are scored but never labelled; a document labelled twice counts once, as toxic if any label says so; repeated rows are
    scored alike; without labels of both kinds all documents get the one kind there is; an empty table gives an empty result.
    """
    model = train(docs, labels, max_labelled)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("row.doc_id", F.round("severity", 6).alias("severity"), F.round("p_toxic", 6).alias("p_toxic"), (F.col("p_toxic") >= (model[2] if threshold is None else threshold)).alias("rejected"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that are rejected, with all their columns. Null and empty texts, and repeated rows, are judged like others and stay
    unless rejected; what toxicity says of labels and empty tables holds here."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).where(F.col("p_toxic") < model[2]).select("row.*")
