"""Line dedup by an exact set-similarity join.

A line's tokens are its distinct five-word shingles; all the words of a shorter line are its one token. Exact copies of a line are
found by 128 bits of hashes of its words. For the others, two sets of Jaccard similarity t share a token among the first
n - ceil(t n) + 1 of each, in any order that all lines keep, and e + 1 tokens if the prefixes are e longer. A first pass takes
prefixes longer by EXTRA in the order of the tokens' hashes and leaves the lines that have enough of their tokens in common with
different lines. Only of those are the whole sets kept, and there tokens are put in order of rarity: first those that are in few
prefixes, by hash, then the frequent ones by how many prefixes have them. Pairs from the index of these prefixes pass a length, a
positional and a bitmap filter and are verified on the whole sets. Under one token each line meets the earliest line first; only
lines that this doesn't remove meet the others, so that a large group of near copies doesn't become all its pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sealstone.checkpoints import Tables
from sealstone.functions.geometry import let
from sealstone.llm.common import SPACE, bounded, table

SHINGLE, SIMILARITY = 5, 0.8
#: Tokens by which the first pass's prefixes are longer than one common token needs.
EXTRA = 2
#: Longs of the bitmap of a set: bit i is the parity of how many tokens fall on it, so two sets differ in as many tokens at least as their bitmaps do in bits.
LONGS = 4
BITS = [f"b{i}" for i in range(LONGS)]
#: Tokens in at most so many prefixes are rare, and need no order among them.
RARE = 8
#: Null ids come before all others.
NO_ID = -(1 << 63)


def _keys() -> list[Column]:
    """d and th: what tells the rows of documents apart, and orders them."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("th")]


def _lines(docs: DataFrame) -> DataFrame:
    """d, th, line and s (the text) of each line that has a word."""
    rows = docs.select(*_keys(), F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)).alias("line", "s"))
    return rows.where(F.col("s").rlike(r"[^\x20\x09-\x0D]"))


def _words() -> Column:
    """The words of s; other white space than single spaces is rare and costs a pattern."""
    s = F.col("s")
    odd = s.contains("\t") | s.contains("\x0b") | s.contains("\x0c") | s.contains("\r")
    return F.array_remove(F.split(F.when(odd, F.regexp_replace(s, SPACE, " ")).otherwise(s), " ", -1), "")


def _tokens() -> Column:
    """The distinct shingles' hashes in the order of these, of the hashes h of a line's words; a shorter line is one as it stands.

    Shingles by their number, written out for Spark to compile, cost more: all of them are computed, and each JVM compiles long code.
    """
    n = F.size("h")
    of = lambda h: F.transform(F.slice(h, 1, F.greatest(n - SHINGLE + 1, F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, SHINGLE)]))
    shingles = let(F.col("h"), of)  # bound, the hashes aren't taken from the row for each word
    return F.sort_array(F.array_distinct(F.when(n < SHINGLE, F.array(F.xxhash64("h"))).otherwise(shingles)))


def _prefix(tokens: Column, extra: int = 0) -> Column:
    n = F.size(tokens)
    return F.slice(tokens, F.lit(1), n - F.ceil(F.lit(SIMILARITY) * n - 1e-9).cast("int") + 1 + extra)


def _overlap(n: Column, m: Column) -> Column:
    """The least number of common tokens of sets of n and m that are similar."""
    return F.ceil(F.lit(SIMILARITY / (1 + SIMILARITY)) * (n + m) - 1e-9)


def _may_match(a: str, b: str) -> Column:
    """Length, positional and bitmap filter of two postings of one token.

    A similar pair passes at its first common token in the shared order, which is in both prefixes and has all other common
    tokens behind it; whether it passes at later ones doesn't matter.
    """
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    rest = 1 + F.least(n - F.col(f"{a}pos") - 1, m - F.col(f"{b}pos") - 1)
    differ = sum((F.bit_count(F.col(f"{a}b{i}").bitwiseXOR(F.col(f"{b}b{i}"))) for i in range(1, LONGS)), F.bit_count(F.col(f"{a}b0").bitwiseXOR(F.col(f"{b}b0"))))
    return (F.least(n, m) >= F.lit(SIMILARITY) * F.greatest(n, m) - 1e-9) & (rest >= _overlap(n, m)) & (differ <= n + m - 2 * _overlap(n, m))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """id of the later line of each pair (later, earlier) whose sets are similar."""
    both = pairs.join(sets.select(F.col("id").alias("later"), F.col("toks").alias("lt")), "later").join(sets.select(F.col("id").alias("earlier"), F.col("toks").alias("et")), "earlier")
    return both.where(F.size(F.array_intersect("lt", "et")) >= _overlap(F.size("lt"), F.size("et"))).select(F.col("later").alias("id")).distinct()


def _near(docs: DataFrame, lines: DataFrame, firsts: DataFrame, tables: Tables) -> DataFrame:
    """d, th and line of the first line of each set of words that a different, earlier line is similar to."""
    postings = lines.select("k1", F.explode("prefix").alias("tok"))
    shared = postings.groupBy("tok").agg(F.min("k1").alias("a"), F.max("k1").alias("b"), F.count("*").alias("c")).where("a <> b").select("tok", "c")
    shared = tables.save(shared, "line-shared")
    some = postings.join(bounded(shared.select("tok"), 8 * shared.count()), "tok", "left_semi").groupBy("k1").agg(F.count("*").alias("common"))
    enough = F.least(F.lit(EXTRA + 1), F.ceil(F.lit(SIMILARITY) * F.col("n") - 1e-9))  # of each of the c copies
    reps = tables.save(firsts.join(some, "k1").where(F.col("common") >= F.col("c") * enough).select("d", "th", "line"), "line-some")
    # Numbered in their order: of two lines the one with the smaller id is the earlier.
    reps = tables.save(reps.orderBy("d", "th", "line").select(F.monotonically_increasing_id().alias("id"), "d", "th", "line"), "line-reps")
    texts = _lines(docs).join(bounded(reps, 32 * reps.count()), ["d", "th", "line"]).groupBy("d", "th", "line", "id").agg(F.first("s").alias("s"))
    sets = texts.select("id", F.transform(_words(), lambda w: F.xxhash64(w)).alias("h")).select("id", _tokens().alias("toks"))
    sets = tables.save(sets, "line-sets")

    frequent = shared.where(F.col("c") > RARE)
    late = sets.select("id", F.explode("toks").alias("tok")).join(bounded(frequent, 16 * frequent.count()), "tok")
    late = late.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("c", "tok")))["tok"].alias("late"))  # of one line's own tokens
    bit = "if((tok >> 6 & {m}) = {i}, 1L << int(tok & 63), 0L)"
    bits = sets.select("id", F.explode("toks").alias("tok")).groupBy("id").agg(*[F.bit_xor(F.expr(bit.format(m=LONGS - 1, i=i))).alias(f"b{i}") for i in range(LONGS)])
    ordered = sets.join(bits, "id").join(late, "id", "left").withColumn("toks", F.when(F.col("late").isNull(), F.col("toks")).otherwise(F.concat(F.array_except("toks", "late"), "late")))
    index = tables.save(ordered.select("id", *BITS, F.size("toks").alias("n"), F.posexplode(_prefix(F.col("toks"))).alias("pos", "tok")), "line-index")
    more = index.groupBy("tok").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("tok")
    index = tables.save(index.join(more, "tok", "left_semi"), "line-postings")

    first = index.groupBy("tok").agg(F.min(F.struct("id", "n", "pos", *BITS)).alias("c")).select("tok", *[F.col(f"c.{x}").alias(f"c_{x}") for x in ("id", "n", "pos", *BITS)])
    star = index.join(first, "tok").where((F.col("id") != F.col("c_id")) & _may_match("", "c_"))
    star = tables.save(star.select(F.col("id").alias("later"), F.col("c_id").alias("earlier")).distinct(), "line-pairs")
    gone = tables.save(_verified(star, sets), "line-near")
    left = index.join(gone, "id", "left_anti").select("tok", *[F.col(c).alias(f"l_{c}") for c in ("id", "n", "pos", *BITS)])
    rest = left.join(index, "tok").where((F.col("id") < F.col("l_id")) & _may_match("", "l_")).select(F.col("l_id").alias("later"), F.col("id").alias("earlier")).distinct()
    rest = tables.save(rest.join(star, ["later", "earlier"], "left_anti"), "line-rest")
    return reps.join(gone.unionByName(_verified(rest, sets)), "id", "left_semi").select("d", "th", "line")


def removed_lines(docs: DataFrame) -> DataFrame:
    """d (the id), th (tells rows with one id apart) and line of each line that an earlier one is similar to, in the order of d, th and line."""
    tables = Tables(docs.sparkSession)
    lines = _lines(docs).select("d", "th", "line", _words().alias("w")).withColumn("h", F.transform("w", lambda w: F.xxhash64(w)))
    lines = lines.select("d", "th", "line", F.xxhash64("h").alias("k1"), F.xxhash64(F.lit(1), "w").alias("k2"), _tokens().alias("toks"))
    lines = tables.save(lines.select("d", "th", "line", "k1", "k2", F.size("toks").alias("n"), _prefix(F.col("toks"), EXTRA).alias("prefix")), "lines")
    firsts = lines.groupBy("k1", "k2").agg(F.min(F.struct("d", "th", "line", "n")).alias("first"), F.count("*").alias("c"))
    firsts = tables.save(firsts.select("k1", "k2", "first.*", "c"), "line-firsts")
    repeated = firsts.where("c > 1").select("k1", "k2", F.struct("d", "th", "line").alias("first"))
    copies = lines.select("d", "th", "line", "k1", "k2").join(repeated, ["k1", "k2"]).where(F.struct("d", "th", "line") != F.col("first")).select("d", "th", "line")
    gone = copies.unionByName(_near(docs, lines, firsts, tables)).groupBy("d", "th").agg(F.sort_array(F.collect_set("line")).alias("gone"))  # a document's own lines
    gone = Tables(docs.sparkSession).save(gone, "line-gone")
    tables.drop(*tables.paths)
    return gone


def _cleaned(docs: DataFrame) -> DataFrame:
    """row (docs' columns), text (what is left of it), n_lines and n_removed of each row of docs."""
    gone = removed_lines(docs)
    n = gone.agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.size("gone")), F.lit(0)).alias("lines")).first()
    rows = docs.select(F.struct("*").alias("row"), *_keys()).join(bounded(gone, 32 * n["docs"] + 4 * n["lines"]), ["d", "th"], "left")
    rows = rows.withColumn("parts", F.when(F.col("gone").isNotNull(), F.split("row.text", "\n", -1)))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone")), lambda i: F.get("parts", i))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    n_lines = 1 + F.length("row.text") - F.length(F.replace(F.col("row.text"), F.lit("\n"), F.lit("")))
    count = lambda x: F.coalesce(x, F.lit(0)).cast("long")
    return rows.select("row", text.alias("text"), count(n_lines).alias("n_lines"), count(F.when(F.col("gone").isNotNull(), F.size("gone"))).alias("n_removed"))


def _columns(docs: DataFrame) -> list[Column]:
    """docs' columns, of rows of _cleaned: the text is what is left, and n_chars, where there is one, its length."""
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None
    new = {"text": F.col("text"), "n_chars": length}
    return [(new[c].cast(docs.schema[c].dataType) if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]


def dedup(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) with its columns, the text without the removed lines.

    A line goes if an earlier line, of this or a document before it by id, shares at least SIMILARITY of their joint shingles; a
    line with fewer than SHINGLE words goes if an earlier one has the same words; lines without words stay. Null texts stay null;
    null ids come first; rows with one id and one text are one document and lose the same lines, rows with one id and different
    texts are ordered and told apart by the text's hash; other columns, whatever their names, go through, but n_chars follows the
    text; an empty table gives an empty result. Shingles are compared by 64 bits of their hash, whole lines by 128.
    """
    return _cleaned(docs).select(*_columns(docs))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _cleaned(table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_removed")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with the texts that remain; a document whose words are all removed goes. What dedup says of nulls, empty and long texts, ties,
    repeated rows, empty tables and other columns holds here."""
    empty = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _cleaned(docs).where(~F.coalesce(empty, F.lit(False))).select(*_columns(docs))


OP4_SQL = rf"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
words AS (
  SELECT doc_id, line, list_filter(regexp_split_to_array(s, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, unnest(l) AS s, unnest(range(len(l))) AS line FROM docs)),
sets AS (
  SELECT doc_id, line, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - {SHINGLE - 2}, 2)), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')))) AS t
  FROM words WHERE len(w) > 0),
firsts AS (SELECT t, min((doc_id, line)) AS first, row_number() OVER () AS id FROM sets GROUP BY t),
tokens AS (SELECT id, len(t) AS n, first, unnest(t) AS s FROM firsts),
near AS (
  SELECT b.id FROM tokens a JOIN tokens b ON a.s = b.s AND a.first < b.first GROUP BY a.id, b.id, a.n, b.n
  HAVING count(*) >= ceil({SIMILARITY / (1 + SIMILARITY)} * (a.n + b.n) - 1e-9)),
gone AS (
  SELECT s.doc_id, s.line FROM sets s JOIN firsts f ON s.t = f.t WHERE (s.doc_id, s.line) <> f.first OR f.id IN (SELECT id FROM near)),
gone_docs AS (SELECT doc_id, list(line) AS g FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN g IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(len(l)), lambda i: NOT list_contains(g, i)), lambda i: l[i + 1]), chr(10)) END AS text,
       coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(g), 0)::BIGINT AS n_removed
FROM docs d LEFT JOIN gone_docs x ON d.doc_id = x.doc_id
"""
