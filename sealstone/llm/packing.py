"""Best-fit packing of token sequences by best-two-fit, planned on the histogram of lengths.

A length is one of at most `capacity` values, so the plan needs only how many pieces have each: bins are filled greedily with
the longest piece that fits, then a bin's smallest piece gives way to the two unpacked ones that fill its gap more tightly. A
bin's pattern is used as often as the counts allow, so there are a few thousand patterns however many pieces there are. Spark
then ranks the pieces of each length, in groups of bounded size, and a piece's rank says in which bin and place it goes.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sealstone.llm.common import saved, table
from sealstone.llm.tokens import VOCABULARY, encode

CAPACITY = 2048
END = 0
#: Pieces of one length are ranked in groups of about so many.
GROUP = 1000


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Lengths and how many there are, to patterns and how often each is used; a pattern has lengths and how many of each."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns = []
    while left.any():
        used = np.zeros_like(left)
        gap = capacity
        while gap and (fits := np.flatnonzero((left - used)[1 : gap + 1])).size:  # the longest that fits
            longest = int(fits[-1]) + 1
            n = int(min(left[longest] - used[longest], gap // longest))
            used[longest] += n
            gap -= n * longest
        if gap and used.sum() > 1:
            smallest = int(np.flatnonzero(used)[0])
            free, room = left - used, gap + smallest
            a = np.flatnonzero(free[: room + 1])
            if a.size:
                b = a[np.maximum(np.searchsorted(a, room - a, side="right") - 1, 0)]  # for each a the longest that fits beside it
                # A length with one piece left can't pair with itself; its next shorter partner is as good.
                alone = (a == b) & (free[a] < 2)
                below = np.searchsorted(a, b) - 1
                b = np.where(alone, np.where(below >= 0, a[np.maximum(below, 0)], 0), b)
                total = np.where((b > 0) & (a + b <= room), a + b, 0)
                best = int(total.argmax())
                if total[best] > smallest:
                    used[smallest] -= 1
                    used[a[best]] += 1
                    used[b[best]] += 1
        kinds = np.flatnonzero(used)
        times = int((left[kinds] // used[kinds]).min())
        left -= used * times
        patterns.append(({int(k): int(used[k]) for k in kinds[::-1]}, times))
    return patterns


def places(patterns: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows of length, first rank, number in a pattern, first sequence, offset: where the pieces of a length go, by rank."""
    rows, ranks, sequence = [], Counter(), 0
    for pattern, times in patterns:
        offset = 0
        for length, n in pattern.items():
            rows.append((length, ranks[length], n, sequence, offset))
            ranks[length] += n * times
            offset += n * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each piece: the text's ids and END, cut where there are over `capacity`."""

    def cut(batches):
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                ids = np.array([*encode(text or "", vocabulary), END], dtype="<u4")
                first = (len(ids) - 1) % capacity + 1
                ends = range(first, len(ids) + 1, capacity)
                out += [(doc_id, i, max(0, e - capacity), e - max(0, e - capacity), zlib.crc32(ids[max(0, e - capacity) : e].tobytes())) for i, e in enumerate(ends)]
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64", "piece": "int32"})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, ...).

    Only the histogram of lengths, at most `capacity` numbers, comes to the driver, and only the places, bounded by the number
    of patterns, go out. Pieces of one length are dealt into groups of about GROUP by a hash; a piece's rank is its row number
    in its group after the sizes of the groups before. Rows that are the same in all columns may change places.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    where = spark.sparkContext.broadcast(places(best_two_fit(counts, capacity)))
    groups = F.array(*[F.lit(-(-counts.get(n, 0) // GROUP) or 1) for n in range(1, capacity + 1)])
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece"), F.element_at(groups, F.col("length").cast("int"))))
    sizes = dealt.groupBy("length", "_group").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = saved(sizes.select(F.col("length").alias("_l"), F.col("_group").alias("_g"), before.alias("_before")), "pack-groups")
    rank = F.row_number().over(Window.partitionBy("length", "_group").orderBy("doc_id", "piece")) - 1
    ranked = dealt.withColumn("_rank", rank).join(sizes, (F.col("length") == F.col("_l")) & (F.col("_group") == F.col("_g"))).withColumn("_rank", F.col("_rank") + F.col("_before"))
    ranked = ranked.select(*pieces.columns, "_rank")

    def put(batches):
        p = where.value
        keys = p[:, 0] << 44 | p[:, 1]
        for pdf in batches:
            at = p[np.searchsorted(keys, pdf["length"].to_numpy() << 44 | pdf["_rank"].to_numpy(), side="right") - 1] if len(pdf) else p[:0]
            nth = pdf.pop("_rank").to_numpy() - at[:, 1]
            yield pdf.assign(sequence_id=at[:, 3] + nth // np.maximum(at[:, 2], 1), offset=at[:, 4] + nth % np.maximum(at[:, 2], 1) * at[:, 0])

    kinds = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    return ranked.mapInPandas(put, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """docs (doc_id, text) to pieces and their places.

    A null text is empty and gives one piece, its END; null ids are kept; repeated rows are packed each; an empty table gives an
    empty result; other columns play no part.
    """
    return pack(saved(pieces_of(docs, capacity, vocabulary), "pack-pieces"), capacity)


def op6_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of docs and their places. What pack_documents says of nulls, empty and long texts, ties, repeated rows, empty tables and
    other columns holds here."""
    return pack_documents(docs)
