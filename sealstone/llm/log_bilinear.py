"""Language-model scoring with a log-bilinear neural model, trained by noise-contrastive estimation.

The model predicts a token's class from the four classes before it. The classes are the end, the most frequent words, one each, and
buckets of all other words by their last two bytes; within a bucket, a word's share is its count, and words unknown to the training
documents together have the share that words seen once suggest. So the probabilities of all known words and of each bucket's unknown
word sum to one. A context's vector is the sum of its classes' vectors, each scaled by its place; its product with the classes' output vectors,
a matrix product for thousands of tokens at a time, gives all classes' scores, which are normalised over the classes.

Training goes over all training documents, in rounds: in each, every partition takes its next share of documents and learns from
where all partitions stood, telling each token from noise drawn from the classes' frequencies, and the partitions' parameters are averaged by
tokens in a shuffle. Only the parameters and the words of the head, both of fixed size, come to the driver. Rare words are looked up in the table of
counts by a shuffled join.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sealstone.llm.common import saved, table

#: Words with a class of their own, and buckets; with the end, 256 classes.
SHORT, BUCKETS = 127, 128
CLASSES = 1 + SHORT + BUCKETS
END, BEGIN = 0, CLASSES
CONTEXT, DIMS, NOISE, BATCH, ROUNDS, RATE = 4, 32, 64, 512, 4, 0.15
#: A batch has lines of so many tokens each, from all over a chunk: neighbours share their contexts' vectors.
LINE = 32
#: Words whose counts each worker knows, at most; the others' counts are joined. Distinct words that a worker counts before it hands them on.
HEAD, FLUSH = 1 << 16, 1 << 18
#: Tokens of a matrix product in scoring; tokens that are shuffled together in training.
PRODUCT, CHUNK = 1 << 9, 1 << 14
FOLDS, HELD_OUT = 5, 1


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased: of bytes, the methods know only ASCII and its white space."""
    return text.encode().lower().split() if text else []


def bucket(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % BUCKETS


class Model:
    """Vectors of the classes as context (and of the begin) and as output, with biases, and the scales of the places, in float32."""

    def __init__(self, frequency: np.ndarray, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.noise = frequency / frequency.sum()
        self.inputs = rng.normal(0, 0.3, (CLASSES + 1, DIMS)).astype("f4")
        self.outputs = rng.normal(0, 0.1, (CLASSES, DIMS)).astype("f4")
        self.bias = np.log(self.noise).astype("f4")
        self.places = np.full((CONTEXT, DIMS), 0.5, dtype="f4")

    def rows(self) -> np.ndarray:
        """All parameters, one row for each vector; the last column has the biases."""
        pad = lambda x: np.pad(x, ((0, 0), (0, 1)))
        return np.concatenate((pad(self.inputs), np.column_stack((self.outputs, self.bias)), pad(self.places)))

    def set_rows(self, rows: np.ndarray) -> None:
        a, b = CLASSES + 1, 2 * CLASSES + 1
        rows = rows.astype("f4")
        self.inputs, self.outputs, self.bias, self.places = rows[:a, :-1].copy(), rows[a:b, :-1].copy(), rows[a:b, -1].copy(), rows[b:, :-1].copy()

    def context(self, before: np.ndarray) -> np.ndarray:
        """before: the classes before each token, nearest first."""
        q = (self.inputs * self.places[0]).take(before[:, 0], axis=0)
        for k in range(1, CONTEXT):
            q += (self.inputs * self.places[k]).take(before[:, k], axis=0)
        return q

    def log_probs(self, before: np.ndarray) -> np.ndarray:
        """The natural log-probability of each class, for each row of before."""
        score = self.context(before) @ self.outputs.T + self.bias
        score -= score.max(axis=1, keepdims=True)
        return score - np.log(np.exp(score).sum(axis=1, keepdims=True))

    def target_log_probs(self, before: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each row's target alone: minus the logarithm of the sum of the exponentials of all scores less the target's own, which one matrix
        product gives; where that sum is too large, by log_probs."""
        q = self.context(before)
        own = np.einsum("ij,ij->i", q, self.outputs.take(target, axis=0)) + self.bias.take(target)
        one = np.ones((len(q), 1), dtype=q.dtype)
        classes = np.column_stack((self.outputs, self.bias, np.ones(CLASSES, dtype=q.dtype)))
        more = np.concatenate((q, one, -own[:, None]), axis=1) @ classes.T
        with np.errstate(over="ignore"):
            out = -np.log(np.exp(more, out=more) @ np.ones(CLASSES, dtype=q.dtype))
        for i in np.flatnonzero(~np.isfinite(out)):
            out[i] = self.log_probs(before[i : i + 1])[0, target[i]]
        return out

    def gradients(self, lines: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the loss of telling the tokens of lines from noise, summed: inputs, outputs, bias, places. A line begins with the CONTEXT classes before
        its first token; where a begin stands there is no token."""
        x = self.inputs.take(lines, axis=0)
        at = lambda k: slice(CONTEXT - 1 - k, lines.shape[1] - 1 - k)  # noqa: E731  the classes k + 1 places before the tokens
        q = sum(x[:, at(k)] * self.places[k] for k in range(CONTEXT)).reshape(-1, DIMS)
        target = lines[:, CONTEXT:].ravel()
        there = target != BEGIN
        target = np.where(there, target, END)
        expected = self.outputs.take(target, axis=0)
        log_noise = np.log(len(noise) * self.noise).astype("f4")
        right = np.einsum("ij,ij->i", q, expected) + self.bias[target] - log_noise[target]
        wrong = q @ self.outputs[noise].T + (self.bias - log_noise)[noise]
        there = there.astype("f4")
        g_right, g_wrong = -there / (1 + np.exp(np.clip(right, -30, 30))), there[:, None] / (1 + np.exp(-np.clip(wrong, -30, 30)))
        g_right, g_wrong = g_right.astype(q.dtype), g_wrong.astype(q.dtype)
        d_q = (g_right[:, None] * expected + g_wrong @ self.outputs[noise]).reshape(len(lines), -1, DIMS)
        outs = np.concatenate((target, noise))
        d_outputs = _summed(outs, np.concatenate((g_right[:, None] * q, g_wrong.T @ q)), CLASSES)
        d_bias = np.bincount(outs, np.concatenate((g_right, g_wrong.sum(axis=0))), CLASSES)
        d_x = np.zeros_like(x)
        for k in range(CONTEXT):
            d_x[:, at(k)] += d_q * self.places[k]
        d_places = np.stack([np.einsum("ijk,ijk->k", x[:, at(k)], d_q) for k in range(CONTEXT)])
        return _summed(lines.ravel(), d_x.reshape(-1, DIMS), CLASSES + 1), d_outputs, d_bias, d_places

    def loss(self, before: np.ndarray, target: np.ndarray, noise: np.ndarray) -> float:
        score = self.context(before).astype("f8") @ self.outputs.T.astype("f8") + self.bias - np.log(len(noise) * self.noise)
        return float(np.log1p(np.exp(-score[np.arange(len(target)), target])).sum() + np.log1p(np.exp(score[:, noise])).sum())


def _summed(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Rows of values summed by where they go."""
    out = np.zeros((n, values.shape[1]), dtype=values.dtype)
    if len(at):
        order = np.argsort(at, kind="stable")
        at = at.take(order)
        first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        out[at[first]] = np.add.reduceat(values.take(order, axis=0), first)
    return out


def segments(docs: list[np.ndarray], length: int) -> np.ndarray:
    """The documents' classes one behind the other, each after CONTEXT begins, in lines of `length` tokens and the CONTEXT classes before them."""
    pad = np.full(CONTEXT, BEGIN, dtype=np.int16)
    line = np.concatenate([pad, *[x for d in docs for x in (pad, d)]])
    line = np.concatenate((line, np.full(-(len(line) - CONTEXT) % length, BEGIN, dtype=np.int16)))
    return np.lib.stride_tricks.sliding_window_view(line, CONTEXT + length)[::length]


def windows(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The documents' classes, and those before each, nearest first, beginning anew with each document."""
    pad = np.full(CONTEXT, BEGIN, dtype=np.int16)
    line = np.concatenate([x for d in docs for x in (pad, d)])
    own = np.concatenate([np.arange(len(d)) for d in docs]) + np.repeat(np.cumsum([0, *[len(d) + CONTEXT for d in docs[:-1]]]) + CONTEXT, [len(d) for d in docs])
    return line[own], np.stack([line[own - k - 1] for k in range(CONTEXT)], axis=1)


def train(model: Model, docs: Iterator[np.ndarray], seed: int) -> int:
    """Learns from each token of docs once, in batches, with step sizes that fall with what each parameter has moved (AdaGrad); how many."""
    rng = np.random.default_rng(seed)
    squares = [np.full(x.shape, 1.0, dtype="f4") for x in (model.inputs, model.outputs, model.bias, model.places)]
    cumulated, done = np.cumsum(model.noise), 0

    def learn(some: list[np.ndarray]) -> None:
        lines = segments(some, LINE)
        order = rng.permutation(len(lines))
        for at in range(0, len(order), BATCH // LINE):
            own = lines[order[at : at + BATCH // LINE]]
            noise = np.minimum(np.searchsorted(cumulated, rng.random(NOISE)), CLASSES - 1)
            for x, s, g in zip((model.inputs, model.outputs, model.bias, model.places), squares, model.gradients(own, noise)):
                g = g.astype("f4", copy=False)
                s += g * g
                g /= np.sqrt(s)
                g *= RATE
                x -= g

    some, size = [], 0
    for d in docs:
        some.append(d)
        size += len(d)
        if size >= CHUNK:
            learn(some)
            done, some, size = done + size, [], 0
    if some:
        learn(some)
    return done + size


def score_classes(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    """The natural log-probability of each document's classes."""
    target, before = windows(docs)
    own = np.concatenate([model.target_log_probs(before[a : a + PRODUCT], target[a : a + PRODUCT]) for a in range(0, len(target), PRODUCT)])
    return np.add.reduceat(own.astype("f8"), np.cumsum([0, *[len(d) for d in docs[:-1]]]))


def word_counts(texts: DataFrame) -> DataFrame:
    """word, bucket, n of all words of texts (text)."""

    def count(batches):
        seen = Counter()
        table_ = lambda: pd.DataFrame({"word": [w.decode() for w in seen], "bucket": [bucket(w) for w in seen], "n": list(seen.values())})
        for pdf in batches:
            for text in pdf["text"]:
                seen.update(tokens(text))
                if len(seen) >= FLUSH:
                    yield table_()
                    seen.clear()
        if seen:
            yield table_()

    return texts.select("text").mapInPandas(count, "word string, bucket int, n long").groupBy("word", "bucket").agg(F.sum("n").alias("n"))


class Vocabulary:
    """What workers know of the counts: the head's words, the totals of the corpus and of each bucket. Of fixed size."""

    def __init__(self, counts: DataFrame, n_docs: int) -> None:
        step = F.floor(8 * F.log2("n")).cast("int")
        found = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum("n").alias("n"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()  # a few hundred rows at most
        self.total, self.types = sum(r["n"] for r in found) + n_docs, sum(r["words"] for r in found) + bool(n_docs)
        self.least, words = None, 0  # the head is all words of at least this count
        for r in found:
            words += r["words"]
            if words > HEAD:
                break
            self.least = r["least"]
        head = [] if self.least is None else counts.where(F.col("n") >= self.least).collect()
        head.sort(key=lambda r: (-r["n"], r["word"]))
        own = counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("once")).collect()
        n, once = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for r in own:
            n[r["bucket"]], once[r["bucket"]] = r["n"], r["once"]
        for r in head[:SHORT]:
            n[r["bucket"]] -= r["n"]
            once[r["bucket"]] -= r["n"] == 1
        self.once, self.sums = once, n + once + 1
        self.index = {r["word"].encode(): i for i, r in enumerate(head)}
        self.counts = np.array([r["n"] for r in head], dtype=np.float64)
        buckets = np.array([r["bucket"] for r in head], dtype=np.int64)
        short = np.arange(len(head)) < SHORT
        self.classes = np.where(short, 1 + np.arange(len(head)), 1 + SHORT + buckets).astype(np.int16)
        self.base = np.log10((self.counts + 0.5) / self.base_sum())
        self.inner = np.where(short, 0.0, np.log10(self.counts / self.sums[buckets]))
        self.end_known, self.end_base = n_docs > 0, math.log10((n_docs + 0.5) / self.base_sum())
        self.frequency = np.concatenate(([n_docs], np.pad(self.counts[:SHORT], (0, SHORT - len(self.counts[:SHORT]))), n)) + 0.5

    def base_sum(self) -> float:
        return self.total + 0.5 * (self.types + 1)


def encode(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """docs (r, doc_id, held_out, text) with n_tokens, what the head's words and the end add (n_known, base_score, inner), the classes (ids), and the
    other words with their numbers (words, ns); a bucket's total is in inner for all words."""

    def each(batches):
        log_sums = np.log10(v.sums)
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                words = tokens(text)
                at = np.fromiter(map(v.index.get, words, repeat(-1)), dtype=np.int32, count=len(words))
                known = at[at >= 0]
                ids = np.zeros(len(words) + 1, dtype="<i2")
                rare = np.flatnonzero(at < 0).tolist()
                if len(known):
                    ids[:-1] = v.classes[at]
                inner, rest = v.inner[known].sum(), Counter()
                others = [words[i] for i in rare]
                if others:
                    rest = Counter(others)
                    of = {w: bucket(w) for w in rest}
                    b = np.fromiter(map(of.__getitem__, others), dtype=np.int64, count=len(others))
                    ids[rare] = 1 + SHORT + b
                    inner -= log_sums[b].sum()
                buckets = list(of.values()) if others else []
                out.append((len(ids), len(known) + v.end_known, v.base[known].sum() + v.end_base, inner, ids.tobytes(), [w.decode() for w in rest], buckets, list(rest.values())))
            yield pd.concat([pdf[["r", "doc_id", "held_out"]].astype({"doc_id": "Int64"}).reset_index(drop=True), pd.DataFrame(out, columns=["n_tokens", "n_known", "base_score", "inner", "ids", "words", "buckets", "ns"])], axis=1)

    return docs.mapInPandas(each, "r long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, inner double, ids binary, words array<string>, buckets array<int>, ns array<long>")


def fit(encoded: DataFrame, v: Vocabulary) -> Model:
    """The model, trained on the rows of encoded (r, held_out, ids) that aren't held out, each once."""
    model = Model(v.frequency)

    def learn(nth: int, rows: np.ndarray):
        def part(batches):
            own = Model(v.frequency)
            own.set_rows(rows)
            done = train(own, (np.frombuffer(x, "<i2") for pdf in batches for x in pdf["ids"]), nth)
            if done:
                yield pd.DataFrame({"j": np.arange(len(rows)), "n": done, "x": list(own.rows())})

        return part

    for nth in range(ROUNDS):
        share = encoded.where(~F.col("held_out") & (F.pmod(F.xxhash64("r"), F.lit(ROUNDS)) == nth)).select("ids")
        learnt = share.mapInPandas(learn(nth, model.rows()), "j int, n long, x array<float>")
        mean = learnt.groupBy("j").agg(*[(F.sum(F.col("n") * F.get("x", F.lit(i))) / F.sum("n")).alias(f"x{i}") for i in range(DIMS + 1)])
        got = mean.orderBy("j").collect()  # one row for each vector of the model
        if got:
            model.set_rows(np.array([r[1:] for r in got]))
    return model


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Each row of docs (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, learning from the rows that
    aren't held out.

    Tokens are the words and one end. base_score sums log10((c + 0.5) / (N + 0.5 (V + 1))) and score is the model's log10 probability. Null and empty texts
    have the end only; where held_out is null the row is learnt from; repeated rows and rows with one id are rows like others; with nothing
    to learn from, all words are unknown; an empty table gives an empty result; other columns play no part.
    """
    held = F.coalesce(held_out, F.lit(False))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text")
    counts = saved(word_counts(texts.where(~F.col("held_out"))), "lm-counts")
    v = Vocabulary(counts, texts.where(~F.col("held_out")).count())
    encoded = saved(encode(texts.withColumn("r", F.monotonically_increasing_id()), v), "lm-classes")
    model = fit(encoded, v)

    def each(batches):
        for pdf in batches:
            out, some, size = [], [], 0
            for x in map(lambda b: np.frombuffer(b, "<i2"), pdf["ids"]):
                some.append(x)
                size += len(x)
                if size >= CHUNK:
                    out.append(score_classes(model, some))
                    some, size = [], 0
            if some:
                out.append(score_classes(model, some))
            yield pdf[["r", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "inner"]].astype({"doc_id": "Int64"}).assign(classes=np.concatenate(out) / math.log(10))

    cols = "r long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, inner double"
    scored = encoded.select("r", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "inner", "ids").mapInPandas(each, f"{cols}, classes double")
    rest = encoded.select("r", F.explode(F.arrays_zip("words", "buckets", "ns")).alias("x")).select("r", F.col("x.words").alias("word"), F.col("x.buckets").alias("bucket"), F.col("x.ns").alias("ns"))
    others = counts.select("word", "n") if v.least is None else counts.where(F.col("n") < v.least).select("word", "n")
    n = F.coalesce("n", F.lit(0))
    unknown = F.log10(F.element_at(F.array(*[F.lit(float(x) + 1) for x in v.once]), F.col("bucket") + 1))
    rest = rest.join(others, "word", "left").groupBy("r").agg(
        F.sum(F.when(n > 0, F.col("ns")).otherwise(0)).alias("more_known"), F.sum(F.col("ns") * F.log10((n + 0.5) / v.base_sum())).alias("more_base"),
        F.sum(F.col("ns") * F.when(n > 0, F.log10(n)).otherwise(unknown)).alias("more_inner"))
    plus = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return scored.join(rest, "r", "left").select(
        "doc_id", "held_out", "n_tokens", plus("n_known", "more_known").alias("n_known"), F.lit(v.total).cast("long").alias("train_tokens"),
        plus("base_score", "more_base").alias("base_score"), (F.col("classes") + plus("inner", "more_inner")).alias("score"))


def op12_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT)
