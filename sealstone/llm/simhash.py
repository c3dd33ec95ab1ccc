"""SimHash near-dedup with bit-sliced comparison.

Texts become 64-bit fingerprints; equal ones are one from there on. Fingerprints within the radius agree in whole blocks of
bits (pigeonhole), so each goes under the keys of all choices of blocks that such a pair must share. Under one key they are compared
bit-sliced: bit planes stand vertically, one XOR meets 64 fingerprints, a carry-save counter of a few bit planes adds to 64
distances at once, and what exceeds the radius throughout is abandoned. A key with many fingerprints is cut into chunks, and
pairs of chunks are compared in tasks of their own. Each comparison returns a spanning forest of its links, at most one link
for each fingerprint, and what is linked is joined into components by large-star and small-star rounds.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sealstone.llm.common import saved, table

SHINGLE, RADIUS, SEED = 3, 3, 42
#: The pipeline's stage takes shingles of five words.
STAGE_SHINGLE, STAGE_RADIUS, STAGE_CHUNK = 5, 24, 512
#: Two more blocks than the radius: a pair within it shares two blocks at least.
SPARE_BLOCKS = 2
#: Fingerprints under one key beyond which its comparison is cut into pairs of chunks.
CHUNK = 2048
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit by bit, 1 if set in over half of the shingles' XXH64; repeats count; 0 without words. As a signed long."""
    words = text.encode().lower().split()  # of bytes: A-Z and the six white-space characters only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        counts += np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def planes(fps: np.ndarray) -> np.ndarray:
    """64 rows, one for each bit, with a bit for each fingerprint, padded to whole words."""
    bits = np.zeros((-(-len(fps) // 64) * 64, 64), dtype=np.uint8)
    bits[: len(fps)] = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def _exceeding(differ, over: np.ndarray, radius: int) -> np.ndarray:
    """Bits of the distances above the radius. differ(plane, rows) has the words where the plane's bits differ; over: bits that don't matter."""
    over = over.copy()
    alive = np.flatnonzero(~(over == ONES).all(axis=1))
    counter = [np.zeros((len(alive), over.shape[1]), dtype=np.uint64) for _ in range(radius.bit_length())]
    now = over[alive]
    for plane in range(64):
        carry = differ(plane, alive)
        for c in counter:
            carry, c[...] = c & carry, c ^ carry
        now |= carry  # more than the counter holds
        if plane % 8 == 7:
            going = ~(now == ONES).all(axis=1)
            if not going.all():
                over[alive[~going]] = ONES
                alive, now, counter = alive[going], now[going], [c[going] for c in counter]
                if not len(alive):
                    return over
    above, equal = np.zeros_like(now), np.full_like(now, ONES)
    for i in reversed(range(len(counter))):  # counter > radius, from the highest bit
        if not radius >> i & 1:
            above |= equal & counter[i]
            equal &= ~counter[i]
        else:
            equal &= counter[i]
    over[alive] = now | above
    return over


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Whether left[i] and right[i] differ in at most `radius` bits; all pairs of many small blocks in one vertical layout."""
    if not len(left):
        return np.zeros(0, dtype=bool)
    a, b = planes(left), planes(right)
    width = 8
    pad = -a.shape[1] % width  # rows of 512 pairs, each abandoned as a whole
    a, b = (np.pad(x, ((0, 0), (0, pad))).reshape(64, -1, width) for x in (a, b))
    over = _exceeding(lambda p, rows: a[p, rows] ^ b[p, rows], np.zeros(a.shape[1:], dtype=np.uint64), radius)
    return np.unpackbits(over.astype("<u8").view(np.uint8).reshape(-1), bitorder="little")[: len(left)] == 0


def close_in_block(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Indexes i < j of the pairs of one block within the radius."""
    n, p = len(fps), planes(fps)
    found = []
    for at in range(0, n, 256):
        rows = np.arange(at, min(at + 256, n))
        mine = np.where(np.unpackbits(fps[rows].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T.astype(bool), ONES, np.uint64(0))
        no = np.arange(p.shape[1] * 64) <= rows[:, None]
        no[:, n:] = True
        over = np.packbits(no, axis=1, bitorder="little").view("<u8")
        over = _exceeding(lambda k, alive: p[k][None, :] ^ mine[k, alive][:, None], over, radius)
        i, j = np.nonzero(np.unpackbits(over.astype("<u8").view(np.uint8), axis=1, bitorder="little") == 0)
        found.append((rows[i], j))
    return tuple(np.concatenate(x) for x in zip(*found))


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest one it is linked with, over any number of links."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, j, label[i])
        np.minimum.at(new, i, label[j])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(blocks: list[np.ndarray], radius: int) -> list[np.ndarray]:
    """Links (two rows) of a batch of blocks: small ones' pairs are compared together, large ones on their own."""
    out, small = [], [b for b in blocks if len(b) <= 32]
    by_size = {}
    for b in small:
        by_size.setdefault(len(b), []).append(b)
    for n, same in by_size.items():
        each = np.array(same)
        i, j = np.triu_indices(n, 1)
        close = close_pairs(each[:, i].ravel(), each[:, j].ravel(), radius).reshape(len(each), -1)
        for b in np.flatnonzero(close.any(axis=1)):
            label = forest(n, i[close[b]], j[close[b]])
            out.append(np.stack((each[b][label], each[b]))[:, label != np.arange(n)])
    for b in (b for b in blocks if len(b) > 32):
        label = forest(len(b), *close_in_block(b, radius))
        out.append(np.stack((b[label], b))[:, label != np.arange(len(b))])
    return out


def _th() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("th")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, th (tells rows with one id apart) and fp of each row of docs (doc_id, text); a null text has no words."""

    def each(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "th": pdf["th"], "fp": np.array([fingerprint(t or "", shingle) for t in pdf["text"]], dtype=np.int64)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _th()).mapInPandas(each, "doc_id long, th long, fp long")


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct fps (fp) to links u, v that connect all fps within the radius, directly or over others."""
    n = radius + SPARE_BLOCKS
    ends = [64 * i // n for i in range(n + 1)]
    part = lambda i: F.shiftrightunsigned("fp", ends[i]).bitwiseAND((1 << (ends[i + 1] - ends[i])) - 1)
    choices = list(combinations(range(n), SPARE_BLOCKS))
    keys = F.array(*[F.struct(F.lit(i).alias("t"), *[part(b).alias(f"k{x}") for x, b in enumerate(c)]) for i, c in enumerate(choices)])
    keyed = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.*")
    by = ["t", *[f"k{x}" for x in range(SPARE_BLOCKS)]]
    many = keyed.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1")
    cut = keyed.join(many, by).withColumn("chunks", F.expr(f"int((n + {CHUNK} - 1) div {CHUNK})"))
    cut = cut.withColumn("c", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    blocks = cut.groupBy(*by, F.least("c", "o").alias("a"), F.greatest("c", "o").alias("b")).agg(F.array_sort(F.collect_list("fp")).alias("fps"))

    def compare(batches):
        for pdf in batches:
            found = _links([np.asarray(x, dtype=np.int64) for x in pdf["fps"] if len(x) > 1], radius)
            if found:
                yield pd.DataFrame(np.unique(np.concatenate(found, axis=1), axis=1).T, columns=["u", "v"])

    return blocks.select("fps").mapInPandas(compare, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Links u, v to (u, component): every node of a link that isn't the smallest of its component, and that smallest one.

    Large-star and small-star rounds alternate until nothing changes; each round is written to the shared folder. Only the number
    of links and a sum of their hashes come to the driver. A node with many links is counted before it is shuffled, and Spark can
    split the joins.
    """
    now, before = saved(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links"), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = saved(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return now.select("u", F.col("v").alias("component"))
        before = state


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, th, fp and component_id, the smallest doc_id that is reached over links of at most `radius` bits, for each row of docs.

    Null and empty texts have fingerprint zero and are linked like others; null ids are kept and are no component's name, unless it
    has no other; repeated rows are one another's copies; an empty table gives an empty result; other columns play no part.
    """
    fps = saved(fingerprints(docs, shingle), "simhash-fps")
    reps = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    nodes = components(links(reps.select("fp"), radius)).withColumnRenamed("u", "fp")
    of = reps.join(nodes, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = of.groupBy("component").agg(F.min("rep").alias("component_id"))
    of = saved(of.join(names, "component").select("fp", "component_id"), "simhash-components")
    return fps.join(of, "fp").select("doc_id", "th", "fp", "component_id")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _sets(text: str, shingle: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    k, digest = min(shingle, len(words)), xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(words[i : i + k]), SEED) for i in range(len(words) - k + 1)], dtype="<u8"))


def _described(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, th and, of the set of shingles: sig, n, fp (SimHash), anchors (the least hash of each of ANCHORS parts) and the set, 32 bits each."""

    def each(batches):
        for pdf in batches:
            out = []
            for text in pdf["text"]:
                h = _sets(text or "", shingle)
                part = (h >> np.uint64(61)).astype(np.int64)
                first = np.flatnonzero(np.diff(part, prepend=-1))  # sorted, so that each part's least comes first
                bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64) if len(h) else np.zeros(64)
                fp = np.packbits(2 * bits > len(h), bitorder="little").view("<i8")[0]
                short = np.unique((h & np.uint64(0xFFFFFFFF)).astype("<u4"))
                out.append((xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63), len(short), int(fp), h[first].view("<i8").tolist(), short.tobytes()))
            cols = pd.DataFrame(out, columns=["sig", "n", "fp", "anchors", "set"])
            yield pd.concat([pdf[["doc_id", "th"]].astype({"doc_id": "Int64"}).reset_index(drop=True), cols], axis=1)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _th()).mapInPandas(each, "doc_id long, th long, sig long, n long, fp long, anchors array<long>, set binary")


def _similar(block, anchor: int, similarity: float, radius: int) -> np.ndarray:
    """Links (two rows of sigs) that connect a block's sets of at least this Jaccard similarity.

    Bit-sliced comparison finds the pairs whose fingerprints are near enough; what it leaves is verified on the sets, unless an
    earlier anchor of both has their pair, or they are connected already.
    """
    sig = np.array([r["sig"] for r in block], dtype=np.int64)
    n = np.array([r["n"] for r in block], dtype=np.int64)
    i, j = close_in_block(np.array([r["fp"] for r in block], dtype=np.int64), radius)
    fits = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9
    i, j = i[fits], j[fits]
    sets = [np.frombuffer(r["set"], dtype="<u4") for r in block]
    earlier = [set(np.asarray(r["anchors"], dtype=np.int64)[np.asarray(r["anchors"], dtype=np.int64).view(np.uint64) < np.uint64(anchor & (1 << 64) - 1)].tolist()) for r in block]
    label = list(range(len(block)))

    def root(x: int) -> int:
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for a in np.unique(i):
        others = [b for b in j[i == a].tolist() if root(a) != root(b) and not earlier[a] & earlier[b]]
        if not others:
            continue
        values, sizes = np.concatenate([sets[b] for b in others]), np.array([len(sets[b]) for b in others])
        at = np.minimum(np.searchsorted(sets[a], values), len(sets[a]) - 1)
        common = np.add.reduceat((sets[a][at] == values).astype(np.int64), np.concatenate(([0], np.cumsum(sizes)[:-1])))
        for b, c, m in zip(others, common.tolist(), sizes.tolist()):
            if c >= similarity * (len(sets[a]) + m - c) - 1e-9:
                label[max(root(a), root(b))] = min(root(a), root(b))
    roots = np.array([root(x) for x in range(len(block))])
    return np.stack((sig[roots], sig))[:, roots != np.arange(len(block))]


def near_copies(docs: DataFrame, shingle: int = STAGE_SHINGLE, similarity: float = 0.8, radius: int = STAGE_RADIUS) -> DataFrame:
    """doc_id, th and component of each row of docs: what is connected over pairs whose sets of shingles have at least this Jaccard
    similarity. Texts with equal sets are one; texts without words are equal.

    No radius that pigeonhole keys can serve holds all such pairs, so the keys are anchors: the least hash of each of eight parts of a set.
    A pair at 0.8 shares one with a probability of 1 - 0.2^8, and lies within the radius, 24 of 64 bits, with one of over 0.999. Keys
    with many sets are cut into pairs of chunks; a comparison returns a spanning forest of its verified links.
    """
    rows = saved(_described(docs, shingle), "copies-sets")
    same = rows.groupBy("sig").agg(F.min(F.struct("doc_id", "th")).alias("rep"))
    reps = saved(same.select("sig", "rep.*"), "copies-distinct")
    keyed = rows.select("sig", "doc_id", "th", "anchors").join(reps.select(F.col("sig").alias("s"), F.col("doc_id").alias("d"), F.col("th").alias("t")), (F.col("sig") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")))
    keyed = keyed.select("sig", F.explode("anchors").alias("key")).distinct()
    many = keyed.groupBy("key").agg(F.count("*").alias("n_key")).where("n_key > 1")
    shared = saved(keyed.join(many, "key"), "copies-keys")
    wanted = saved(shared.select("sig").distinct(), "copies-wanted")
    sets = rows.join(wanted, "sig", "left_semi").groupBy("sig").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("anchors").alias("anchors"), F.first("set").alias("set"))
    cut = shared.join(sets, "sig").withColumn("chunks", F.expr(f"int((n_key + {STAGE_CHUNK} - 1) div {STAGE_CHUNK})"))
    cut = cut.withColumn("c", F.pmod(F.xxhash64("sig"), F.col("chunks")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    blocks = cut.groupBy("key", F.least("c", "o").alias("a"), F.greatest("c", "o").alias("b")).agg(F.array_sort(F.collect_list(F.struct("sig", "n", "fp", "anchors", "set"))).alias("block"))

    def compare(batches):
        for pdf in batches:
            found = [_similar(b, k, similarity, radius) for k, b in zip(pdf["key"], pdf["block"]) if len(b) > 1]
            if found and (links_ := np.concatenate(found, axis=1)).size:
                yield pd.DataFrame(np.unique(links_, axis=1).T, columns=["u", "v"])

    nodes = components(blocks.select("key", "block").mapInPandas(compare, "u long, v long").distinct()).withColumnRenamed("u", "sig")
    nodes = saved(nodes, "copies-components")
    return rows.select("doc_id", "th", "sig").join(nodes, "sig", "left").select("doc_id", "th", F.coalesce("component", "sig").alias("component"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest id, and of rows with that id the one with the smallest text
    hash. Near copies are those of near_copies: sets of shingles decide, and SimHash comparison rules pairs out before. Texts without
    words are one component; null ids come first; of repeated rows one stays; other columns go through; an empty table gives an empty one.
    """
    found = saved(near_copies(docs), "copies-found").withColumnRenamed("component", "component_id")
    chosen = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "th")).alias("k"))
    rows = found.groupBy("doc_id", "th").agg(F.count("*").alias("rows"))
    chosen = chosen.select("k.*").join(rows.withColumnsRenamed({"doc_id": "id", "th": "t"}), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("t")))
    chosen = saved(chosen.select("id", "t", "rows"), "simhash-chosen")
    kept = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), _th()).join(chosen, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("t")))
    once, repeated = kept.where("rows = 1"), kept.where("rows > 1").dropDuplicates(["doc_id", "th"])
    return once.unionByName(repeated).select("row.*")
