"""Token counts of sections by offset-mapped attribution.

A document is encoded once, as a whole. The lengths of its tokens give each token's span; the spans and the sections, both
sorted, are joined by where they overlap. A token that crosses a boundary goes to the section that has most of its bytes, the
earlier one if equal; a token that touches no section is counted under section null.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sealstone.llm.common import table
from sealstone.llm.tokens import VOCABULARY, byte_lengths, encode


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    r"""The spans of a text's lines, each with its \n, in code points; a text has as many as it has pieces between \n."""
    ends = np.cumsum([len(x) + 1 for x in text.split("\n")])
    ends[-1] -= 1
    return np.concatenate(([0], ends[:-1])), ends


def _attributed(text: str, starts: np.ndarray, ends: np.ndarray, vocabulary: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens of each section, those of them that cross a boundary, and tokens outside all sections."""
    if not text.isascii():  # from code points to bytes
        size = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        at = np.concatenate(([0], np.cumsum(1 + (size > 0x7F) + (size > 0x7FF) + (size > 0xFFFF))))
        starts, ends = at[starts], at[ends]
    stop = np.cumsum(byte_lengths(vocabulary)[np.array(encode(text, vocabulary, special=False), dtype=np.int64)])
    begin = np.concatenate(([0], stop[:-1])) if len(stop) else stop
    full = np.flatnonzero(ends > starts)  # empty sections have no bytes
    s, e = starts[full], ends[full]
    first, last = np.searchsorted(e, begin, side="right"), np.searchsorted(s, stop, side="left") - 1
    inside = first <= last
    own = first[inside]
    cross = np.flatnonzero(inside & ((first < last) | (begin < s[np.minimum(first, len(s) - 1)]) | (stop > e[np.minimum(first, len(s) - 1)]))) if len(s) else np.empty(0, dtype=np.int64)
    n, crossing = np.bincount(own, minlength=len(full)), np.zeros(len(full), dtype=np.int64)
    for i in cross:
        among = np.arange(first[i], last[i] + 1)
        best = among[np.argmax(np.minimum(e[among], stop[i]) - np.maximum(s[among], begin[i]))]
        n[first[i]] -= 1
        n[best] += 1
        crossing[best] += 1
    out = np.zeros((2, len(starts)), dtype=np.int64)
    out[:, full] = n, crossing
    return out[0], out[1], int((~inside).sum())


def attribute(docs: DataFrame, spans: Callable[[str], tuple[np.ndarray, np.ndarray]] | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """docs (doc_id, text, and, without `spans`, sections: array of start and end in code points, sorted and disjoint) to one row
    for each section: doc_id, section (from 0; null for tokens outside all), start, end, n_tokens, n_crossing. spans gives the
    starts and ends of a text's sections.

    Null texts are empty; empty texts and sections count 0; null or no sections leave all tokens to section null; repeated rows
    are counted each; an empty table gives an empty result; other columns play no part.
    """
    names = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]

    def count(batches):
        for pdf in batches:
            ids, parts = [], []
            own = map(spans, pdf["text"].fillna("")) if spans else zip(pdf["starts"], pdf["ends"])
            for doc_id, text, (start, end) in zip(pdf["doc_id"], pdf["text"].fillna(""), own):
                start, end = (np.array([] if x is None else x, dtype=np.int64) for x in (start, end))
                n, crossing, rest = _attributed(text, start, end, vocabulary)
                part = np.stack((np.arange(len(n)), start, end, n, crossing))
                if rest:
                    part = np.concatenate((part, [[-1], [-1], [-1], [rest], [0]]), axis=1)
                ids += [doc_id] * part.shape[1]
                parts.append(part)
            if ids:
                out = pd.DataFrame(np.concatenate(parts, axis=1).T, columns=names[1:]).astype({"section": "Int64", "start": "Int64", "end": "Int64"})
                outside = out["section"] < 0
                out.loc[outside, ["section", "start", "end"]] = pd.NA
                yield out.assign(doc_id=pd.array(ids, dtype="Int64"))[names]

    cols = [F.col("doc_id").cast("long").alias("doc_id"), "text"] + ([] if spans else [F.col("sections.start").alias("starts"), F.col("sections.end").alias("ends")])
    return docs.select(*cols).mapInPandas(count, ", ".join(f"{c} long" for c in names))


def op2_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of every document."""
    return attribute(table(spark, sf_dir, "documents"), line_spans)
