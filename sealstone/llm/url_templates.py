"""URL filters by a tree of path templates.

Each url falls under a host, and its path is a sequence of segments. A segment that is lexically variable (digits, long
hexadecimal or coded names) becomes a wildcard; then, level by level, so does every child of a template that has more than
MOST_CHILDREN different children. What is left is a tree: overall, registered domain, host, and each beginning of a template.
Sibling branches whose share of blocked urls does not differ significantly are merged and pool their labels. A template's purity
is smoothed along its path, from the root down: a node's estimate is what it has itself, shrunk by PRIOR_WEIGHT towards a prior, the mean of
its parent's estimate and of what the same template has on other hosts (of its domain, shrunk towards all domains; nowhere labelled: the overall share).
The template itself has its labelled urls; a node above has its labelled branches, each of which counts once, so that many labels in one branch don't
condemn the others. Purity of MIN_PURITY rejects a template. Labels come from a table of labelled urls; the query uses the urls that
its rules decide, and asks the tree only about the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sealstone.llm.common import lower_ascii, saved, table

#: host, path, verdict
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
MOST_CHILDREN = 50
#: Numbers, dates and hexadecimal names, with or without a file's ending; and long names with a digit.
VARIABLE = r"^([0-9]+|[0-9A-Fa-f-]{16,}|[0-9]{4}-[0-9]{2}(-[0-9]{2})?)(\.[A-Za-z]{1,5})?$"
CODED = r"^[A-Za-z0-9_=-]{12,}(\.[A-Za-z]{1,5})?$"
#: Two siblings are merged if their shares differ by less than Z standard errors.
Z = 1.96
PRIOR_WEIGHT, MIN_PURITY = 10.0, 0.9


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null url or one without ://."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))
    return lower_ascii(host), path


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The name and verdict of the longest rule that fits the host, or a domain above it, and the path's start; else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def templates(urls: DataFrame) -> DataFrame:
    """Adds `segments`, the template of the path, to (host, path, ...).

    Only levels at which a host has more than MOST_CHILDREN different segments can have a template with so many children; one pass finds them.
    """
    parts = F.filter(F.split("path", "/", -1), lambda s: s != "")
    out = urls.withColumn("segments", F.transform(parts, lambda s: F.when(s.rlike(VARIABLE) | (s.rlike(CODED) & s.rlike("[0-9]")), F.lit("*")).otherwise(s)))
    # Distinct first, so that a hot host is counted before it is shuffled.
    wide = out.select("host", F.posexplode("segments").alias("level", "segment")).distinct().groupBy("host", "level").agg(F.count("*").alias("n"))
    for level in sorted(r[0] for r in wide.where(F.col("n") > MOST_CHILDREN).select("level").distinct().collect()):
        above = F.concat_ws("/", F.slice("segments", 1, level)) if level else F.lit("")
        here = F.get("segments", F.lit(level))
        children = out.where(here.isNotNull()).select(F.col("host").alias("h"), above.alias("above"), here.alias("child")).distinct()
        many = saved(children.groupBy("h", "above").agg(F.count("*").alias("n")).where(F.col("n") > MOST_CHILDREN).select("h", "above"), f"url-wide-{level}")
        if many.isEmpty():
            continue
        out = out.join(many, (F.col("host") == F.col("h")) & (above == F.col("above")), "left")
        wild = F.transform("segments", lambda s, i: F.when((i == level) & F.col("h").isNotNull(), F.lit("*")).otherwise(s))
        out = out.withColumn("segments", wild).drop("h", "above")
    return out


def _merged(nodes: DataFrame) -> DataFrame:
    """Siblings (host, parent) in the order of their share k / n; neighbours that don't differ significantly are one group and have its sums."""
    order = Window.partitionBy("host", "parent").orderBy(F.col("k") / F.col("n"), "node")  # MOST_CHILDREN branches and a wildcard at most
    k0, n0 = F.lag("k").over(order), F.lag("n").over(order)
    rate = (F.col("k") + k0) / (F.col("n") + n0)
    z = F.abs(F.col("k") / F.col("n") - k0 / n0) / F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-9)) * (1 / F.col("n") + 1 / n0))
    grouped = nodes.withColumn("new", F.coalesce(z >= Z, F.lit(True)).cast("int")).withColumn("group", F.sum("new").over(order))
    group = Window.partitionBy("host", "parent", "group")
    return grouped.select("host", "parent", "node", "depth", *[F.sum(c).over(group).alias(c) for c in ("n", "k", "own_n", "own_k")])


def tree(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labelled urls (host, segments, bad) to the nodes (host, node, depth; m and b, what a url below it goes by; own_n and own_k, what
    a url that ends there goes by), siblings merged, and the priors (domain, node, start): of a domain, of a template there, of a template
    anywhere (domain null), and overall (both null)."""
    counts = labelled.groupBy("host", "segments").agg(F.count("*").alias("n"), F.sum("bad").alias("k"))
    at = counts.select("host", "segments", "n", "k", F.explode(F.sequence(F.lit(0), F.size("segments"))).alias("depth"))
    node = lambda d: F.concat_ws("/", F.slice("segments", F.lit(1), d))
    ends = (F.col("depth") == F.size("segments")).cast("int")
    at = at.select("host", "depth", node(F.col("depth")).alias("node"), F.when(F.col("depth") > 0, node(F.col("depth") - 1)).alias("parent"), "n", "k", (ends * F.col("n")).alias("own_n"), (ends * F.col("k")).alias("own_k"))
    nodes = saved(at.groupBy("host", "depth", "node", "parent").agg(*[F.sum(c).alias(c) for c in ("n", "k", "own_n", "own_k")]), "url-nodes")
    # A parent goes by its branches as they are after merging, each once.
    below = nodes.where("depth > 0")
    merged = saved(_merged(below).unionByName(nodes.where("depth = 0").select("host", "parent", "node", "depth", "n", "k", "own_n", "own_k")), "url-merged")
    branches = merged.where("depth > 0").groupBy("host", F.col("parent").alias("p")).agg(F.count("*").alias("m"), F.sum(F.col("k") / F.col("n")).alias("b"))
    merged = merged.join(branches.withColumnRenamed("host", "h"), (F.col("host") == F.col("h")) & (F.col("node") == F.col("p")), "left")
    merged = merged.select("host", "node", "depth", F.coalesce("m", F.lit(0)).alias("m"), F.coalesce("b", F.lit(0.0)).alias("b"), "own_n", "own_k")
    hosts = nodes.where("depth = 0").select(registered(F.col("host")).alias("domain"), (F.col("k") / F.col("n")).alias("share"))
    domains = hosts.groupBy("domain").agg(F.count("*").alias("m"), F.sum("share").alias("b"))
    overall = domains.agg((F.coalesce(F.sum(F.col("b") / F.col("m")), F.lit(0.0)) / (F.count("*") + 1)).alias("overall"))  # one row; a domain not seen yet counts as clean
    shrunk = lambda b, m, prior: (F.col(b) + PRIOR_WEIGHT * F.col(prior)) / (F.col(m) + PRIOR_WEIGHT)
    starts = domains.crossJoin(F.broadcast(overall)).select("domain", F.lit(None).cast("string").alias("node"), shrunk("b", "m", "overall").alias("start"))
    alike = nodes.where("depth > 0").groupBy("node", registered(F.col("host")).alias("domain")).agg(F.count("*").alias("m"), F.sum(F.col("k") / F.col("n")).alias("b"))
    alike = saved(alike, "url-alike")
    of_all = alike.groupBy("node").agg(F.count("*").alias("m_all"), F.sum(F.col("b") / F.col("m")).alias("b_all")).crossJoin(F.broadcast(overall))
    of_all = of_all.select("node", shrunk("b_all", "m_all", "overall").alias("start"))
    of_domain = alike.join(of_all, "node").select("domain", "node", shrunk("b", "m", "start").alias("start"))
    of_all = of_all.select(F.lit(None).cast("string").alias("domain"), "node", "start")
    none = F.lit(None).cast("string")
    return merged, starts.unionByName(of_domain).unionByName(of_all).unionByName(overall.select(none.alias("domain"), none.alias("node"), F.col("overall").alias("start")))


def registered(host: Column) -> Column:
    """The last two names of a host."""
    return F.substring_index(host, ".", -2)


def purities(found: DataFrame, nodes: DataFrame, starts: DataFrame) -> DataFrame:
    """host, template and purity of each template (host, segments)."""
    found = found.select("host", "segments").distinct()
    at = found.select("host", F.concat_ws("/", "segments").alias("template"), F.size("segments").alias("size"), F.posexplode(F.transform(F.sequence(F.lit(0), F.size("segments")), lambda d: F.concat_ws("/", F.slice("segments", F.lit(1), d)))).alias("depth", "node"))
    at = at.join(nodes.withColumnRenamed("depth", "_d"), ["host", "node"], "left").withColumn("domain", registered(F.col("host")))
    at = at.join(starts.where("domain is not null and node is not null").withColumnRenamed("start", "t_own"), ["domain", "node"], "left")
    at = at.join(starts.where("domain is null and node is not null").select("node", F.col("start").alias("t_all")), "node", "left")
    overall = starts.where("domain is null and node is null").select(F.col("start").alias("overall"))  # one row
    at = at.crossJoin(F.broadcast(overall))
    ends = F.col("depth") == F.col("size")
    b, m = F.coalesce(F.when(ends, F.col("own_k")).otherwise(F.col("b")), F.lit(0.0)), F.coalesce(F.when(ends, F.col("own_n")).otherwise(F.col("m")), F.lit(0)).cast("double")
    mine = F.struct("depth", b.alias("b"), m.alias("m"), F.coalesce("t_own", "t_all", "overall").alias("t"))
    chain = at.groupBy("host", "domain", "template", "overall").agg(F.array_sort(F.collect_list(mine)).alias("chain"))  # of one path
    chain = chain.join(starts.where("domain is not null and node is null").select("domain", "start"), "domain", "left")
    prior = lambda p, x: F.when(x["depth"] == 0, p).otherwise((p + x["t"]) / 2)
    fold = F.aggregate("chain", F.coalesce("start", "overall"), lambda p, x: (x["b"] + PRIOR_WEIGHT * prior(p, x)) / (x["m"] + PRIOR_WEIGHT))
    return chain.select("host", "template", fold.alias("purity"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages (page_id, url) to page_id, host, path, rule, verdict and purity (of the template; 0 where nothing is labelled at all).

    Null urls and those without :// have empty host and path, fit no rule and fall under a template of their own; empty tables
    give an empty result; repeated rows count each and are judged alike; other columns play no part.
    """
    host, path = split_url(F.col("url"))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    urls = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("rule", name).withColumn("by_rule", verdict)
    found = saved(templates(urls), "url-templates")
    nodes, starts = tree(found.where("by_rule is not null").withColumn("bad", (F.col("by_rule") == "block").cast("long")))
    known = saved(purities(found, nodes, saved(starts, "url-starts")), "url-tree").select(F.col("host").alias("h"), F.col("template").alias("t"), "purity")
    out = found.join(known, (F.col("host") == F.col("h")) & (F.concat_ws("/", "segments") == F.col("t")))
    own = F.when(F.col("purity") >= MIN_PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", own).alias("verdict"), F.round("purity", 6).alias("purity"))


def op8_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def _case(what: str) -> str:
    longest = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    return "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p if what == 'rule' else v}'" for h, p, v in longest) + " END"


_DOMAIN = "array_to_string(string_split(host, '.')[greatest(len(string_split(host, '.')) - 1, 1):], '.')"
OP8_SQL = rf"""
WITH RECURSIVE parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
tree0 AS (
  SELECT page_id, host, path, {_case("rule")} AS rule, {_case("verdict")} AS by_rule,
         list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
           lambda s: CASE WHEN regexp_matches(s, '{VARIABLE}') OR regexp_matches(s, '{CODED}') AND regexp_matches(s, '[0-9]') THEN '*' ELSE s END) AS segments
  FROM parts),
levels AS (
  SELECT 0 AS level, * FROM tree0
  UNION ALL
  SELECT level + 1, page_id, host, path, rule, by_rule, CASE WHEN wide AND len(segments) > level THEN list_concat(segments[1:level], ['*'], segments[level + 2:]) ELSE segments END
  FROM (SELECT *, count(DISTINCT segments[level + 1]) OVER (PARTITION BY host, array_to_string(segments[1:level], '/'), len(segments) > level) > {MOST_CHILDREN} AS wide FROM levels)
  WHERE level < (SELECT max(len(segments)) FROM tree0)),
found AS MATERIALIZED (SELECT *, array_to_string(segments, '/') AS template FROM levels WHERE level = (SELECT max(len(segments)) FROM tree0)),
counts AS (SELECT host, segments, count(*) AS n, sum((by_rule = 'block')::INT) AS k FROM found WHERE by_rule IS NOT NULL GROUP BY ALL),
spread AS (SELECT *, unnest(range(len(segments) + 1)) AS depth FROM counts),
nodes AS MATERIALIZED (
  SELECT host, depth, array_to_string(segments[1:depth], '/') AS node, CASE WHEN depth > 0 THEN array_to_string(segments[1:depth - 1], '/') END AS parent, sum(n) AS n, sum(k) AS k,
         sum(CASE WHEN depth = len(segments) THEN n ELSE 0 END) AS own_n, sum(CASE WHEN depth = len(segments) THEN k ELSE 0 END) AS own_k FROM spread GROUP BY ALL),
lagged AS (SELECT *, lag(k) OVER w AS k0, lag(n) OVER w AS n0 FROM nodes WHERE depth > 0 WINDOW w AS (PARTITION BY host, parent ORDER BY k / n, node)),
broken AS (
  SELECT *, coalesce(abs(k / n - k0 / n0) / sqrt(greatest((k + k0) / (n + n0) * (1 - (k + k0) / (n + n0)), 1e-9) * (1 / n + 1 / n0)) >= {Z}, true)::INT AS new FROM lagged),
grouped AS (SELECT *, sum(new) OVER (PARTITION BY host, parent ORDER BY k / n, node) AS g FROM broken),
merged AS (
  SELECT host, parent, node, sum(n) OVER w AS n, sum(k) OVER w AS k, sum(own_n) OVER w AS own_n, sum(own_k) OVER w AS own_k FROM grouped WINDOW w AS (PARTITION BY host, parent, g)
  UNION ALL SELECT host, parent, node, n, k, own_n, own_k FROM nodes WHERE depth = 0),
branches AS (SELECT host, parent, count(*) AS m, sum(k / n) AS b FROM merged WHERE parent IS NOT NULL GROUP BY host, parent),
full_nodes AS MATERIALIZED (SELECT t.host, t.node, coalesce(m, 0) AS m, coalesce(b, 0) AS b, own_n, own_k FROM merged t LEFT JOIN branches c ON t.host = c.host AND t.node = c.parent),
domains AS (SELECT {_DOMAIN} AS domain, count(*) AS m, sum(k / n) AS b FROM nodes WHERE depth = 0 GROUP BY 1),
overall AS (SELECT coalesce(sum(b / m), 0) / (count(*) + 1) AS overall FROM domains),
alike AS (SELECT node, {_DOMAIN} AS domain, count(*) AS m, sum(k / n) AS b FROM nodes WHERE depth > 0 GROUP BY 1, 2),
alike_all AS (SELECT node, (sum(b / m) + {PRIOR_WEIGHT} * overall) / (count(*) + {PRIOR_WEIGHT}) AS t FROM alike, overall GROUP BY node, overall),
alike_own AS (SELECT node, domain, (b + {PRIOR_WEIGHT} * t) / (m + {PRIOR_WEIGHT}) AS t FROM alike JOIN alike_all USING (node)),
own AS (SELECT DISTINCT host, template, segments FROM found),
chains AS (
  SELECT o.host, template, list({{'t': CASE WHEN depth > 0 THEN coalesce(d.t, a.t, overall)::DOUBLE END, 'b': (CASE WHEN depth = len(segments) THEN coalesce(own_k, 0) ELSE coalesce(b, 0) END)::DOUBLE, 'm': (CASE WHEN depth = len(segments) THEN coalesce(own_n, 0) ELSE coalesce(m, 0) END)::DOUBLE}} ORDER BY depth) AS chain
  FROM (SELECT *, unnest(range(len(segments) + 1)) AS depth FROM own) o LEFT JOIN full_nodes f ON o.host = f.host AND array_to_string(segments[1:depth], '/') = f.node
  LEFT JOIN alike_all a ON array_to_string(segments[1:depth], '/') = a.node LEFT JOIN alike_own d ON array_to_string(segments[1:depth], '/') = d.node AND {_DOMAIN.replace("host", "o.host")} = d.domain, overall GROUP BY o.host, template),
purity AS (
  SELECT host, template, list_reduce(list_prepend({{'t': NULL::DOUBLE, 'b': coalesce((d.b + {PRIOR_WEIGHT} * overall) / (d.m + {PRIOR_WEIGHT}), overall)::DOUBLE, 'm': 0::DOUBLE}}, chain),
    lambda p, x: {{'t': NULL::DOUBLE, 'b': (x.b + {PRIOR_WEIGHT} * coalesce((p.b + x.t) / 2, p.b)) / (x.m + {PRIOR_WEIGHT}), 'm': 0::DOUBLE}}).b AS purity
  FROM chains c LEFT JOIN domains d ON {_DOMAIN} = domain, overall)
SELECT page_id, f.host, path, rule, coalesce(by_rule, CASE WHEN purity >= {MIN_PURITY} THEN 'block' ELSE 'allow' END) AS verdict, round(purity, 6) AS purity
FROM found f JOIN purity p ON f.host = p.host AND f.template = p.template
"""
