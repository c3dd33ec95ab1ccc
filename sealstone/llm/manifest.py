"""A Merkle manifest of a dataset by time-forward processing.

Each source's documents are the leaves of a tree whose nodes are the hashes of 16 children at most; the sources' roots are the
leaves of one more such tree. Nodes are labelled by level and number, so that a parent's label comes after its children's. A
forward sweep takes the nodes in the order of their labels: a node's digest is a message to its parent's label, put into a
priority queue that hands a node all its children's messages as soon as it is the next label. The queue is external: what
stays within a subtree of 256 leaves waits in a heap of that size, and what a subtree's top sends beyond is a row of a table in
the shared folder, which Spark's shuffle brings to the next subtree in the order of labels. A reversed sweep then takes the labels from the
root down, and each node's message to its child is the path from there to the root, the rest of the child's proof; so it
reaches the leaves. A sweep over n leaves needs a round for each factor of 256 in n, and no task ever holds more than one
subtree and its paths.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sealstone.llm.common import lower_ascii, saved, table

#: Children of a node; levels of the subtrees that one call sweeps; documents in a range whose ranks one task gives.
FAN, HEIGHT, RANGE = 16, 2, 1 << 16
HEX = 64
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
#: Every fifth document, by the checksum of its id, is tampered with.
TAMPER = 5


def levels(n: int) -> int:
    """Levels above n leaves until one node remains."""
    up = 0
    while n > 1:
        n, up = -(-n // FAN), up + 1
    return up


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def forward(leaves: str, height: int) -> dict[tuple[int, int], str]:
    """A subtree's leaves (digests, joined) to the digests of the children of each node (joined), by its label (level, number); the top's own
    digest is under (height + 1, 0)."""
    if not height:
        return {(1, 0): leaves}
    order, runs = len(leaves) // HEX, {}
    queue = [(1, k // FAN, k, leaves[HEX * k : HEX * k + HEX]) for k in range(order)]  # in order, hence a heap
    while queue:
        level, node = label = queue[0][:2]
        got = []
        while queue and queue[0][:2] == label:
            got.append(heapq.heappop(queue)[3])
        runs[label] = "".join(got)
        if level <= height:
            heapq.heappush(queue, (level + 1, node // FAN if level < height else 0, order, _hash(runs[label])))
            order += 1
    return runs


def backward(runs: dict[tuple[int, int], str], height: int, path: str) -> Iterator[tuple[int, str]]:
    """The path of the top to the paths of the leaves: (number, path), from the last. A path has `place:run` for each level, joined by commas, leaf
    first; a run has the digests of all children there, and place says which is one's own."""
    queue = [(-height, 0, path)]
    while queue:
        level, node, path = heapq.heappop(queue)
        if not level:
            yield -node, path
            continue
        run = runs[-level, -node]
        for k in range(len(run) // HEX):
            heapq.heappush(queue, (level + 1, node * FAN - k, f"{k}:{run},{path}" if path else f"{k}:{run}"))


def proof(path: str) -> str:
    """The hash of all siblings on a path, left to right, level by level."""
    steps = (step.partition(":") for step in path.split(",")) if path else ()
    return _hash("".join(run[: HEX * int(k)] + run[HEX * int(k) + HEX :] for k, _, run in steps))


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and the siblings on its path give."""
    for step in path.split(",") if path else ():
        k, _, run = step.partition(":")
        leaf = _hash(run[: HEX * int(k)] + leaf + run[HEX * int(k) + HEX :])
    return leaf


def numbered(leaves: DataFrame, *order: str) -> DataFrame:
    """Adds to leaves (tree, ...) each one's number in its tree (nth, from 0), in this order, and the tree's size (n).

    A tree may hold most of the rows, so they are ranked in ranges of about RANGE rows, each on top of what its tree has in the ranges before.
    """
    parts = max(1, -(-leaves.count() // RANGE))
    ranged = saved(leaves.repartitionByRange(parts, "tree", *order).withColumn("p", F.spark_partition_id()), "manifest-ranges")
    sizes = ranged.groupBy("tree", "p").agg(F.count("*").alias("own"))
    of_tree = Window.partitionBy("tree")
    before = F.sum("own").over(of_tree.orderBy("p")) - F.col("own")
    sizes = saved(sizes.select("tree", "p", before.alias("before"), F.sum("own").over(of_tree).alias("n")), "manifest-sizes")
    nth = F.row_number().over(Window.partitionBy("tree", "p").orderBy(*order)) - 1 + F.col("before")
    return ranged.join(sizes, ["tree", "p"]).withColumn("nth", nth.cast("long")).drop("p", "before")


def _subtrees(leaves: DataFrame, *more: str) -> DataFrame:
    """Leaves (tree, nth, n, digest, ...) to one row for each subtree: tree, block, n, leaves, and arrays of the other columns."""
    every = F.array_sort(F.collect_list(F.struct("nth", "digest", *more)))
    own = leaves.groupBy("tree", (F.expr(f"nth div {FAN**HEIGHT}")).alias("block")).agg(F.first("n").alias("n"), every.alias("x"))
    return own.select("tree", "block", "n", F.array_join("x.digest", "").alias("leaves"), *[F.col(f"x.{c}").alias(c) for c in more])


def _height(n: int) -> int:
    return min(HEIGHT, levels(n))


def sweep_up(leaves: DataFrame, *more: str) -> tuple[list[DataFrame], DataFrame]:
    """The subtrees of each round, and the roots (tree, last, digest; last: the round that ends there) of all trees."""

    def tops(batches):
        for pdf in batches:
            heights = [_height(n) for n in pdf["n"]]
            yield pdf[["tree", "block", "n"]].assign(digest=[forward(x, h)[h + 1, 0] for x, h in zip(pdf["leaves"], heights)])

    rounds, ended = [], []
    now = saved(_subtrees(leaves, *more), "manifest-subtrees")
    n_rounds = max(1, -(-levels(now.agg(F.max("n")).first()[0]) // HEIGHT))
    for last in range(n_rounds):
        rounds.append(now)
        up = saved(now.mapInPandas(tops, "tree string, block long, n long, digest string"), "manifest-tops")
        ended.append(up.where(f"n <= {FAN**HEIGHT}").select("tree", F.lit(last).alias("last"), "digest"))
        if last == n_rounds - 1:
            break
        beyond = up.where(f"n > {FAN**HEIGHT}").select("tree", F.col("block").alias("nth"), F.expr(f"(n + {FAN**HEIGHT - 1}) div {FAN**HEIGHT}").alias("n"), "digest")
        now = saved(_subtrees(beyond), "manifest-subtrees")
    roots = ended[0]
    for x in ended[1:]:
        roots = roots.unionByName(x)
    return rounds, saved(roots, "manifest-roots")


def sweep_down(rounds: list[DataFrame], roots: DataFrame) -> DataFrame:
    """The paths of the roots (tree, last, path, subroot, root) to those of the subtrees of the first round (tree, block, path, subroot, root)."""

    def down(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                h = _height(r.n)
                first = r.block * FAN**HEIGHT
                out += [(r.tree, first + i, path, r.subroot, r.root) for i, path in backward(forward(r.leaves, h), h, r.path)]
            yield pd.DataFrame(out, columns=["tree", "block", "path", "subroot", "root"])

    cols = ["tree", "block", "path", "subroot", "root"]
    sent = None
    for last in reversed(range(len(rounds))):
        own = roots.where(F.col("last") == last).withColumn("block", F.lit(0).cast("long")).select(cols)
        sent = own if sent is None else own.unionByName(sent)
        if last:
            sent = saved(rounds[last].join(sent, ["tree", "block"]).mapInPandas(down, "tree string, block long, path string, subroot string, root string"), "manifest-paths")
    return sent


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column | None = None) -> Column:
    """A document's hash; text: what stands for its own."""
    return F.sha2(F.concat(*[_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], _field(F.col("text") if text is None else text)), 256)


def manifest(docs: DataFrame, tampered: Column, altered: Column) -> DataFrame:
    """Each row of docs (doc_id, source, lang, n_chars, text) with its leaf, its source's root (subroot), the dataset's root, the hash of its proof,
    the root that is folded from its leaf (where `tampered`, with the text `altered`) and its siblings, and whether that is the root.

    Nulls are hashed as such; null sources are a source of their own, which comes first, and so do null ids in a source; rows with one id
    come in the order of their leaves, and equal rows have equal leaves side by side; an empty table gives an empty result; other columns
    play no part. A dataset of one row has its leaf as root and the hash of nothing as proof.
    """
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    bad = F.when(F.coalesce(tampered, F.lit(False)), leaf(altered))
    leaves = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), leaf().alias("digest"), bad.alias("bad"), F.monotonically_increasing_id().alias("r"))
    leaves = saved(leaves, "manifest-leaves")
    if leaves.isEmpty():
        return docs.sparkSession.createDataFrame([], RESULT)
    rounds, roots = sweep_up(numbered(leaves, "doc_id", "digest", "r"), "doc_id", "bad")
    tops = roots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "last", "digest")
    # The sources' tree, up and down again; there a leaf's own `last` is the round that ends in its source.
    over, top = sweep_up(numbered(tops, "source"), "source", "last")
    paths = sweep_down(over, top.select("tree", "last", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root")))

    def to_sources(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                h = _height(r.n)
                out += [(r.source[i], int(r.last[i]), path, r.leaves[HEX * i : HEX * i + HEX], r.root) for i, path in backward(forward(r.leaves, h), h, r.path)]
            yield pd.DataFrame(out, columns=["tree", "last", "path", "subroot", "root"])

    sent = saved(over[0].join(paths, ["tree", "block"]).mapInPandas(to_sources, "tree string, last int, path string, subroot string, root string"), "manifest-sources")
    paths = sweep_down(rounds, sent)

    def to_documents(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                h = _height(r.n)
                out = []
                for i, path in backward(forward(r.leaves, h), h, r.path):
                    own = r.leaves[HEX * i : HEX * i + HEX]
                    root = fold(r.bad[i] or own, path)
                    out.append((r.doc_id[i], own, r.subroot, r.root, proof(path), root, root == r.root))
                found = pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
                yield found.assign(doc_id=pd.array([None if x is None else int(x) for x in found["doc_id"]], dtype="Int64"))

    # As strings, since an array of whole numbers with nulls reaches Python as floats.
    return rounds[0].join(paths, ["tree", "block"]).withColumn("doc_id", F.col("doc_id").cast("array<string>")).mapInPandas(to_documents, RESULT)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPER == 0
    return manifest(table(spark, sf_dir, "documents"), tampered, lower_ascii(F.col("text")))


def _sql_field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x}::VARCHAR END"


def _sql_leaf(text: str) -> str:
    return f"sha256({' || '.join(_sql_field(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))})"


#: The checksum of doc_id's digits, bit by bit: a byte is xored in, then eight steps follow (-1).
_SQL_CRC = """xor(list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, 4294967295::BIGINT), 4294967295)"""
OP13_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS r, doc_id, source, {_sql_leaf("text")} AS leaf,
         CASE WHEN {_SQL_CRC} % {TAMPER} = 0 THEN {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS bad
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM leaves),
nodes AS (
  SELECT source, 0 AS level, i, n, leaf AS d FROM placed
  UNION ALL SELECT source, level + 1, i // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(d, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY source, level, i // {FAN}, n),
subroots AS (SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, i, n, d FROM subroots
  UNION ALL SELECT level + 1, i // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(d, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // {FAN}, n),
runs AS (SELECT source, level, i // {FAN} AS j, list(d ORDER BY i) AS run FROM nodes WHERE n > 1 GROUP BY ALL),
top_runs AS (SELECT level, i // {FAN} AS j, list(d ORDER BY i) AS run FROM tops WHERE n > 1 GROUP BY ALL),
walk AS (
  SELECT r, source, 0 AS level, i, '' AS proof, coalesce(bad, leaf) AS fold FROM placed
  UNION ALL SELECT r, w.source, w.level + 1, i // {FAN}, proof || array_to_string(run[: i % {FAN}] || run[i % {FAN} + 2 :], ''),
    sha256(array_to_string(run[: i % {FAN}] || [fold] || run[i % {FAN} + 2 :], ''))
  FROM walk w JOIN runs ON w.source IS NOT DISTINCT FROM runs.source AND w.level = runs.level AND i // {FAN} = j),
top_walk AS (
  SELECT r, 0 AS level, s.i, proof, fold FROM (SELECT r, source, arg_max(proof, level) AS proof, arg_max(fold, level) AS fold FROM walk GROUP BY r, source) w
  JOIN subroots s ON w.source IS NOT DISTINCT FROM s.source
  UNION ALL SELECT r, w.level + 1, i // {FAN}, proof || array_to_string(run[: i % {FAN}] || run[i % {FAN} + 2 :], ''),
    sha256(array_to_string(run[: i % {FAN}] || [fold] || run[i % {FAN} + 2 :], ''))
  FROM top_walk w JOIN top_runs t ON w.level = t.level AND i // {FAN} = j),
folded AS (SELECT r, sha256(arg_max(proof, level)) AS proof_sha256, arg_max(fold, level) AS folded_root FROM top_walk GROUP BY r)
SELECT p.doc_id, p.leaf, s.d AS subroot, t.d AS root, f.proof_sha256, f.folded_root, f.folded_root = t.d AS verified
FROM placed p JOIN folded f ON p.r = f.r JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source JOIN tops t ON t.n = 1
"""
