"""Personal data: patterns first, then terms that give a protected entity away.

The patterns find emails, IP addresses, card and phone numbers. Values are grouped into the entities they belong to, which recur: a
mail domain, a network of 256 addresses, a card issuer, a dialling prefix. Corpus co-occurrence then says how much a term
tells about an entity. All counts are of different documents, whole ones, equal texts once: of n documents n_e have the entity, n_t the
term and n_te both. With IC(e) = log2(n / n_e) bits in the entity, the term discloses PMI(t, e) = IC(e) + log2 P(e | t) of them;
P(e | t) is taken as the lower end of Wilson's interval for n_te of n_t, so that few documents prove little. A term is generalised
(replaced by its kind) at GENERALISE of IC(e) and removed at REMOVE, wherever it stands, also where the entity itself is absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sealstone.llm.common import WORD, bounded, saved, table, words

#: Kinds and patterns in the order of the result. A match begins where a run of its first class begins, or where the match before
#: ended; that and the possessive quantifiers find what the plain patterns find, in time linear in the text.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Documents that must have both; and how many standard errors the bound lies below the share.
MIN_DOCS, Z = 2, 1.645
GENERALISE, REMOVE = 0.8, 0.95
TERM = r"^[^0-9@]*\p{L}{3}[^0-9@]*$"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _valid(kind: Column, value: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    ip = F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.substring(part(p), 1, 3).cast("int") <= 255))
    digits = _digits(value)
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substring(digits, -i, F.lit(1)).cast("int"))
    luhn = F.aggregate(F.transform(each, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))), F.lit(0), lambda a, d: a + d)
    card = F.when((F.length(digits) >= 16) & (F.length(digits) <= 19), luhn % 10 == 0).otherwise(F.lit(False))
    return F.when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", (F.length(digits) >= 8) & (F.length(digits) <= 15)).otherwise(F.lit(True))


def mentions(docs: DataFrame) -> DataFrame:
    """One row for each row of docs, with uid, doc_id, th (the text's hash), its pattern matches (kind, nth, gap in code points since the
    match before, value) and, where it has any, its different terms."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def of_kind(k: int, gaps: str) -> Column:
        near = F.transform(F.regexp_extract_all(text, F.lit(PATTERNS[KINDS[k]]), F.lit(0)), lambda v, i: F.struct(F.lit(k).alias("kind"), i.alias("nth"), F.length(F.get(gaps, i)).alias("gap"), v.alias("value")))
        return F.when(F.col(gaps).isNotNull(), near).otherwise(F.array().cast("array<struct<kind:int,nth:int,gap:int,value:string>>"))

    per_kind = [(f"gaps_{kind}", F.when(text.rlike(PATTERNS[kind]), F.split(text, PATTERNS[kind], -1)), of_kind(k, f"gaps_{kind}")) for k, kind in enumerate(KINDS)]
    out = docs.select("doc_id", "text").withColumns({g: s for g, s, _ in per_kind})
    out = out.select("doc_id", "text", F.concat(*[n for _, _, n in per_kind]).alias("found"))
    return out.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.xxhash64(text).alias("th"), "found", F.when(F.size("found") > 0, _terms(text)).alias("terms"))


def _term(word: Column) -> Column:
    """A word without marks at its ends, in lower case."""
    return F.lower(F.regexp_replace(word, r"^[^\p{L}]+|[^\p{L}]+$", ""))


def _terms(text: Column) -> Column:
    """The different terms of a text."""
    return F.array_distinct(F.transform(F.filter(F.array_distinct(words(text)), lambda w: w.rlike(TERM)), _term))


def _entity(kind: Column, value: Column) -> Column:
    """What a value belongs to: its mail domain, network, card issuer or dialling prefix."""
    digits = _digits(value)
    name = F.when(kind == 0, F.concat(F.lit("email:"), F.lower(F.substring_index(value, "@", -1)))).when(kind == 1, F.concat(F.lit("ip:"), F.substring_index(value, ".", 3)))
    return name.when(kind == 2, F.concat(F.lit("card:"), F.left(digits, F.lit(6)))).otherwise(F.concat(F.lit("phone:"), F.left(digits, F.lit(4))))


def _share(n_te: Column, n_t: Column, n_e: Column, n: Column) -> Column:
    """PMI(t, e) / IC(e), by the lower bound of P(e | t)."""
    p = n_te / n_t
    low = (p + Z * Z / (2 * n_t) - Z * F.sqrt(F.greatest(p * (1 - p), F.lit(0.0)) / n_t + Z * Z / (4 * n_t * n_t))) / (1 + Z * Z / n_t)
    return F.when(n > n_e, 1 + F.log2(low) / F.log2(n / n_e))


def telling(docs: DataFrame, rows: DataFrame, base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, kind) of the terms that give an entity away, and (th, term) of the documents that have one of a few candidates."""
    entities = saved(base.select("th", _entity(F.col("kind"), F.col("value")).alias("entity")).distinct(), "pii-entities")
    n_e = entities.groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= MIN_DOCS)
    n = rows.select("th").distinct().agg(F.count("*").alias("n"))  # one row
    terms = rows.where(F.size("found") > 0).join(entities.select("th").distinct(), "th", "left_semi").groupBy("th").agg(F.first("terms").alias("terms"))
    terms = saved(terms.select("th", F.explode("terms").alias("term")), "pii-document-terms")
    pairs = terms.join(entities.join(n_e, "entity"), "th").groupBy("term", "entity").agg(F.count("*").alias("n_te"), F.first("n_e").alias("n_e")).where(F.col("n_te") >= MIN_DOCS)
    # A term stands in at least the documents where there is an entity, which rules common words out before all texts are counted.
    least = terms.groupBy("term").agg(F.count("*").alias("least_t"))
    pairs = pairs.join(least, "term").crossJoin(F.broadcast(n)).where(_share(F.col("n_te"), F.col("least_t"), F.col("n_e"), F.col("n")) >= GENERALISE - 1e-9)
    pairs = saved(pairs.select("term", "entity", "n_te", "n_e", "n"), "pii-pairs")
    wanted = saved(pairs.select("term").distinct(), "pii-terms")
    text = F.coalesce(F.col("text"), F.lit(""))
    size = wanted.agg(F.coalesce(F.sum(F.length("term") + 24), F.lit(0))).first()[0]
    has = docs.select(F.xxhash64(text).alias("th"), F.explode(_terms(text)).alias("term")).join(bounded(wanted, size), "term", "left_semi").distinct()
    has = saved(has, "pii-has")
    told = pairs.join(has.groupBy("term").agg(F.count("*").alias("n_t")), "term").withColumn("share", _share(F.col("n_te"), F.col("n_t"), F.col("n_e"), F.col("n")))
    told = told.where(F.col("share") >= GENERALISE).groupBy("term").agg(F.when(F.max("share") >= REMOVE, 5).otherwise(4).alias("kind"))
    return saved(told, "pii-telling"), has


def marked(docs: DataFrame, told: DataFrame, has: DataFrame) -> DataFrame:
    """th, kind, start, end and value of each place of a telling term, once for each different text."""
    where = saved(has.join(told, "term", "left_semi").select("th").distinct(), "pii-where")
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("th"), text.alias("t")).join(bounded(where, 8 * where.count()), "th", "left_semi").groupBy("th").agg(F.first("t").alias("t"))
    found = texts.select("th", F.posexplode(F.arrays_zip(F.split("t", WORD, -1).alias("gap"), F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("word"))).alias("nth", "w")).select("th", "nth", "w.*")
    upto = F.sum(F.length("gap") + F.coalesce(F.length("word"), F.lit(0))).over(Window.partitionBy("th").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0))
    found = found.withColumn("end", upto.cast("long")).where(F.col("word").rlike(TERM)).withColumn("term", _term(F.col("word")))
    return found.join(told, "term").select("th", "kind", (F.col("end") - F.length("word")).cast("long").alias("start"), "end", F.col("word").alias("value"))


def spans_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The saved rows (uid, doc_id) of docs, and the spans (uid, kind, start, end, value): base kinds 0 to 3, terms 4 (generalised) and 5 (removed)."""
    rows = saved(mentions(docs), "pii-mentions")
    each = rows.where(F.size("found") > 0).select("uid", "th", F.explode("found").alias("m")).select("uid", "th", "m.*")
    order = Window.partitionBy("uid", "kind").orderBy("nth")
    start = F.sum("gap").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(F.sum(F.length("value")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = each.withColumn("start", start.cast("long")).withColumn("end", F.col("start") + F.length("value"))
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    base = saved(each.where(_valid(name, F.col("value"))), "pii-base")
    told, has = telling(docs, rows, base)
    terms = rows.select("uid", "th").join(saved(marked(docs, told, has), "pii-marked"), "th").select("uid", "kind", "start", "end", "value")
    over = base.select(F.col("uid").alias("u"), F.col("start").alias("s"), F.col("end").alias("e"))
    terms = terms.join(over, (F.col("uid") == F.col("u")) & (F.col("start") < F.col("e")) & (F.col("end") > F.col("s")), "left_anti")
    return rows.select("uid", "doc_id"), base.select("uid", "kind", "start", "end", "value").unionByName(terms)


NAMES = (*KINDS, "term-generalised", "term-removed")


def find(docs: DataFrame) -> DataFrame:
    """doc_id and spans (array of kind, start, end, value; kind is an index of NAMES) of each row of docs (doc_id, text).

    Null and empty texts have no spans; null ids and repeated rows are looked through like others; an empty table gives an empty
    result; other columns play no part.
    """
    rows, spans = spans_of(docs)
    own = spans.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end", "value"))).alias("spans"))  # of one document
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,value:string>>")
    return rows.join(own, "uid", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with spans replaced by their kind in brackets, or cut out if a term is to be removed; of overlapping spans the first counts."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    name = lambda s: F.element_at(F.array(*[F.lit("" if n == "term-removed" else f"[{n}]") for n in NAMES]), s["kind"] + 1)
    begin = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def put(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.when(s["start"] < acc["at"], acc).otherwise(F.struct(F.concat(acc["done"], gap, name(s)).alias("done"), s["end"].alias("at")))

    return F.aggregate(ordered, begin, put, lambda acc: F.concat(acc["done"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    name = lambda s: F.element_at(F.array(*[F.lit("term" if n.startswith("term") else n) for n in NAMES]), s["kind"] + 1)
    text = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    terms = F.array_sort(F.transform(F.filter("spans", lambda s: s["kind"] >= len(KINDS)), lambda s: F.struct(F.lit(4).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    flat = F.concat(F.transform(base, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))), terms)
    return found.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)], F.sha2(text(base), 256).alias("base_sha256"), text(flat).alias("spans"))


_SQL_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_MATCHES = " UNION ALL ".join(
    f"SELECT uid, {k} AS kind, unnest(m) AS value, unnest(range(len(m))) AS nth, unnest(g[1:len(m)]) AS before, unnest(g[2:]) AS after FROM (SELECT uid, regexp_extract_all(t, '{p}') AS m, regexp_split_to_array(t, '{p}') AS g FROM texts) WHERE len(m) > 0"
    for k, p in enumerate(_SQL_PATTERNS.values())
)
OP7_SQL = rf"""
WITH texts AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS t FROM documents),
matches AS ({_MATCHES}),
placed AS (
  SELECT *, sum(length(before)) OVER w + sum(length(value)) OVER w - length(value) AS start, regexp_replace(value, '[^0-9]', '', 'g') AS digits
  FROM matches WINDOW w AS (PARTITION BY uid, kind ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
base AS (
  SELECT *, start + length(value) AS stop, CASE kind WHEN 0 THEN 'email:' || lower(string_split(value, '@')[-1]) WHEN 1 THEN 'ip:' || array_to_string(string_split(value, '.')[1:3], '.')
    WHEN 2 THEN 'card:' || left(digits, 6) ELSE 'phone:' || left(digits, 4) END AS entity FROM placed
  WHERE CASE kind WHEN 1 THEN len(list_filter(string_split(value, '.'), lambda p: p::HUGEINT > 255)) = 0
    WHEN 2 THEN length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
      CASE WHEN i % 2 = 1 THEN substr(digits, length(digits) - i + 1, 1)::INT ELSE (substr(digits, length(digits) - i + 1, 1)::INT * 2 - CASE WHEN substr(digits, length(digits) - i + 1, 1)::INT > 4 THEN 9 ELSE 0 END) END)) % 10 = 0
    WHEN 3 THEN length(digits) BETWEEN 8 AND 15 ELSE true END),
located AS (
  SELECT uid, t, word, sum(length(gap) + length(word)) OVER (PARTITION BY uid ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM (
    SELECT uid, t, unnest(w) AS word, unnest(g[1:len(w)]) AS gap, unnest(range(len(w))) AS nth
    FROM (SELECT uid, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, regexp_split_to_array(t, '[^\x20\x09-\x0D]+') AS g FROM texts))),
termed AS MATERIALIZED (
  SELECT *, stop - length(word) AS start, lower(regexp_replace(word, '^[^\p{{L}}]+|[^\p{{L}}]+$', '', 'g')) AS term FROM located WHERE regexp_matches(word, '{TERM}')),
entities AS (SELECT DISTINCT t, entity FROM base JOIN texts USING (uid)),
n_e AS (SELECT entity, count(*) AS n_e FROM entities GROUP BY entity HAVING n_e >= {MIN_DOCS}),
document_terms AS MATERIALIZED (SELECT DISTINCT t, term FROM termed),
n_t AS (SELECT term, count(*)::DOUBLE AS n_t FROM document_terms GROUP BY term),
pairs AS (SELECT term, entity, count(*)::DOUBLE AS n_te FROM document_terms JOIN entities USING (t) GROUP BY ALL HAVING n_te >= {MIN_DOCS}),
bounds AS (
  SELECT term, n_e, n, (n_te / n_t + {Z * Z} / (2 * n_t) - {Z} * sqrt(n_te / n_t * (1 - n_te / n_t) / n_t + {Z * Z} / (4 * n_t * n_t))) / (1 + {Z * Z} / n_t) AS low
  FROM pairs JOIN n_t USING (term) JOIN n_e USING (entity), (SELECT count(DISTINCT t)::DOUBLE AS n FROM texts) WHERE n > n_e),
told AS (SELECT DISTINCT term FROM bounds WHERE 1 + log2(low) / log2(n / n_e) >= {GENERALISE}),
terms AS (
  SELECT uid, start, stop FROM termed n JOIN told USING (term)
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.uid = n.uid AND n.start < b.stop AND n.stop > b.start)),
spans AS (SELECT uid, kind, start, stop FROM base UNION ALL SELECT uid, 4, start, stop FROM terms),
named AS (SELECT *, ['email', 'ip', 'card', 'phone', 'term'][kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT AS s FROM spans),
own AS (
  SELECT uid, count(*) FILTER (WHERE kind = 0) AS n_email, count(*) FILTER (WHERE kind = 1) AS n_ip, count(*) FILTER (WHERE kind = 2) AS n_card, count(*) FILTER (WHERE kind = 3) AS n_phone,
         string_agg(s, ',' ORDER BY kind, start) FILTER (WHERE kind < 4) AS base, string_agg(s, ',' ORDER BY kind, start) AS spans FROM named GROUP BY uid)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN own USING (uid)
"""
