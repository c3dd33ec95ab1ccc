"""Quality rules whose cutoffs are risk-controlled.

Four measures of a text each get a cutoff for each stratum (language). On labelled documents of good quality, a cutoff is
accepted only if the exact binomial test shows that it rejects at most the allowed share of good ones: with k of n good
documents rejected, P(Binomial(n, alpha) <= k) must be at most the level, which is the same as an exact (Clopper-Pearson) upper
bound of at most alpha. The error delta is split over strata and measures (Bonferroni); within a measure the cutoffs are
tested from the loosest to the strictest, and the first that isn't accepted ends the sequence (fixed-sequence testing).
alpha is split over the measures, so what all rules together falsely reject in a stratum stays within alpha.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sealstone.llm.common import saved, table, words

#: Measure and its cutoffs, loosest first; a document is rejected if the measure is above the cutoff.
CUTOFFS = {
    "symbol_share": (0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05),
    "dup_line_share": (0.8, 0.6, 0.5, 0.4, 0.3, 0.2),
    "repeat_share": (0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15),
    "mean_word_chars": (40.0, 30.0, 25.0, 20.0, 15.0, 12.0),
}
ALPHA, DELTA = 0.02, 0.05
WINDOW = 5
#: Terms of the binomial tail that are summed; what is left is bounded by a geometric series, and the bound is added.
TAIL_TERMS = 400


def _lgamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series at x + 10, good to about 1e-13."""
    z = x + 10.0
    below = sum((F.log(x + float(i)) for i in range(1, 10)), F.log(x))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5.0))) - below


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), never too small; 1 where k is at least the mean (a true value of about a half or more)."""
    k, n = k.cast("double"), n.cast("double")
    top = F.exp(_lgamma(n + 1) - _lgamma(k + 1) - _lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    ratio = lambda i: i / (n - i + 1) * ((1 - p) / p)  # noqa: E731  of the term below i to that at i
    zero = F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term"))
    steps = F.when(k >= 1, F.sequence(F.lit(0), F.least(k, F.lit(float(TAIL_TERMS))).cast("int") - 1)).otherwise(F.array().cast("array<int>"))

    def add(acc: Column, j: Column) -> Column:
        term = acc["term"] * ratio(k - j)
        return F.struct((acc["sum"] + term).alias("sum"), term.alias("term"))

    tail = F.aggregate(steps, zero, add)
    last = ratio(k - TAIL_TERMS)
    left = F.when(k > TAIL_TERMS, tail["term"] * last / (1 - last)).otherwise(F.lit(0.0))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(top * (tail["sum"] + left))


def measured(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, `more` and the counts of each text, row by row without a shuffle.

    Words in repeated windows: a window's hash is kept with its place; sorted by hash, windows found twice stand side by side;
    their places, sorted, cover WINDOW words each, less what the one before covers already.
    """
    n = F.size("w")
    start = docs.select("doc_id", *more, F.coalesce(F.col("text"), F.lit("")).alias("t")).withColumn("w", words(F.col("t")))
    hashed = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("w", i + j) for j in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = start.withColumn("h", hashed).withColumn("l", lines)
    out = out.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    twice = F.filter("s", lambda e, i: F.coalesce(e["x"] == F.get("s", i + 1)["x"], F.lit(False)) | F.when(i > 0, e["x"] == F.get("s", i - 1)["x"]).otherwise(F.lit(False)))
    out = out.withColumn("at", F.sort_array(F.transform(twice, lambda e: e["i"])))
    covered = F.aggregate("at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")), lambda acc, i: F.struct((acc["n"] + F.least(i - acc["last"], F.lit(WINDOW))).alias("n"), i.alias("last")))
    return out.select(
        "doc_id", *more,
        n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered["n"], F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        F.xxhash64("t").alias("th"),
    )


def _measures() -> dict[str, Column]:
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {"symbol_share": share("n_symbols", "word_chars"), "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words"), "mean_word_chars": share("word_chars", "n_words")}


def cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, the measures) of good documents to (stratum, rule, cutoff): the strictest accepted cutoffs."""
    grid = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"), F.col(r).alias("value")) for r, cs in CUTOFFS.items() for i, c in enumerate(cs)])
    tests = labelled.select("stratum", F.explode(grid).alias("g")).groupBy("stratum", "g.rule", "g.step", "g.cutoff").agg(F.count("*").alias("n"), F.count_if(F.col("g.value") > F.col("g.cutoff")).alias("k"))
    strata = labelled.agg((F.count_distinct("stratum") + F.max(F.col("stratum").isNull().cast("int"))).alias("strata"))
    level = delta / (F.col("strata") * len(CUTOFFS))
    tests = tests.crossJoin(F.broadcast(strata)).withColumn("ok", binomial_cdf(F.col("k"), F.col("n"), alpha / len(CUTOFFS)) <= level)  # strata is one row
    failed = tests.groupBy("stratum", "rule").agg(F.min(F.when(~F.col("ok"), F.col("step"))).alias("failed"), F.collect_list(F.struct("step", "cutoff")).alias("steps"))
    accepted = F.filter("steps", lambda s: s["step"] < F.coalesce(F.col("failed"), F.lit(1 << 30)))
    return failed.select("stratum", "rule", F.array_max(accepted)["cutoff"].alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """docs (doc_id, text, lang) and labels (doc_id, quality) to the counts, base_failed and kept of each row of docs.

    Null and empty texts have no words and fail the base rule; null languages are a stratum of their own; labels with null or
    unknown ids or null quality aren't used; the bounds need independent cases, so that each different text counts once in a
    language, however many documents and labels have it (near copies count each, which the guarantee leaves out); repeated rows are
    judged alike; without labels, or with too few for any guarantee, only the base rule rejects. Other columns play no part.
    """
    found = saved(measured(docs, "lang"), "quality-measures")
    found = found.withColumns(_measures())
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("labelled"))
    seen = found.join(good, F.col("doc_id") == F.col("labelled")).groupBy(F.col("lang").alias("stratum"), "th").agg(*[F.max(r).alias(r) for r in CUTOFFS])
    cuts = cutoffs(seen, alpha, delta).groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in CUTOFFS])
    cuts = saved(cuts, "quality-cutoffs")  # its size on disk tells Spark whether it may be broadcast
    above = F.lit(False)
    for r in CUTOFFS:
        above = above | F.coalesce(F.col(r) > F.col(f"cut_{r}"), F.lit(False))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.join(cuts, F.col("lang").eqNullSafe(F.col("stratum")), "left").select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & ~above).alias("kept"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_GRID = ", ".join(f"('{r}', {i}, {c}::DOUBLE)" for r, cs in CUTOFFS.items() for i, c in enumerate(cs))
_P = ALPHA / len(CUTOFFS)
OP9_SQL = rf"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l, row_number() OVER () AS r
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM texts WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM windows) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, range(5) AS o(j) GROUP BY r),
counts AS (
  SELECT doc_id, lang, t, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines
  FROM texts LEFT JOIN covered USING (r)),
measured AS (
  SELECT *, CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS symbol_share, CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_share,
         CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_share, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars
  FROM counts),
good AS (SELECT DISTINCT t, lang, {", ".join(CUTOFFS)} FROM measured m JOIN labels b ON m.doc_id = b.doc_id WHERE b.quality = 1),
grid(rule, step, cutoff) AS (VALUES {_GRID}),
tests AS (
  SELECT lang, rule, step, cutoff, count(*) AS n,
         count(*) FILTER (WHERE CASE rule {" ".join(f"WHEN '{r}' THEN {r}" for r in CUTOFFS)} END > cutoff) AS k
  FROM good, grid GROUP BY ALL),
level AS (SELECT {DELTA} / ({len(CUTOFFS)} * (count(DISTINCT lang) + max((lang IS NULL)::INT))) AS level FROM good),
tried AS (
  SELECT lang, rule, step, cutoff,
         k < n * {_P} AND list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_P}) + (n - i) * ln(1 - {_P})))) <= level AS ok
  FROM tests, level),
chosen AS (
  SELECT lang, rule, min(cutoff) AS cutoff FROM tried t
  WHERE step < coalesce((SELECT min(step) FROM tried f WHERE f.lang IS NOT DISTINCT FROM t.lang AND f.rule = t.rule AND NOT f.ok), 1000000) GROUP BY lang, rule),
cuts AS (SELECT lang AS stratum, {", ".join(f"max(cutoff) FILTER (WHERE rule = '{r}') AS cut_{r}" for r in CUTOFFS)} FROM chosen GROUP BY lang),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {" OR ".join(f"coalesce({r} > cut_{r}, false)" for r in CUTOFFS)} AS above
  FROM measured LEFT JOIN cuts ON lang IS NOT DISTINCT FROM stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT above AS kept FROM judged
"""
