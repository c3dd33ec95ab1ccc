"""Hooks for what a user supplies: a recogniser of text and a fetcher of photos."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sealstone.schema import DETECTIONS

#: The recognisers that this Python worker has built, by the hash of their maker.
_BUILT: dict[str, Callable[[bytes], str]] = {}


def built(key: str, make: Callable[[], Callable[[bytes], str]]) -> Callable[[bytes], str]:
    """The worker's recogniser; Spark reuses workers, so later tasks find it built."""
    if key not in _BUILT:
        _BUILT[key] = make()
    return _BUILT[key]


RECOGNISED = "res struct<rec_texts:array<string>,dt_polys:array<array<array<double>>>,boxes:array<array<array<double>>>>"


def fetched(photos: DataFrame, fetch: Callable[[str], bytes], threads: int = 8, timeout: float = 15.0) -> DataFrame:
    """photos (order_id, image_idx, url) with content, status (ok, missing or failed) and error; a few threads fetch as many urls at a time.
    What isn't there after `timeout` seconds has failed, and threads that still wait are left to themselves."""

    def one(url):
        if not url:
            return None, "missing", None
        try:
            content = fetch(url)
            return (content, "ok", None) if content is not None else (None, "failed", None)
        except Exception as e:  # a photo that fails is a row, not the end of the job
            return None, "failed", f"{type(e).__name__}: {e}"

    def run(batches):
        pool = ThreadPoolExecutor(threads)
        for pdf in batches:
            out, urls = [], pdf["url"].tolist()
            for at in range(0, len(urls), threads):
                futures = [pool.submit(one, u) for u in urls[at : at + threads]]
                done, late = wait(futures, timeout)
                out += [f.result() if f in done else (None, "failed", f"TimeoutError: not there after {timeout:g} s") for f in futures]
                if late:
                    pool.shutdown(wait=False, cancel_futures=True)
                    pool = ThreadPoolExecutor(threads)
            yield pdf.join(pd.DataFrame(out, columns=["content", "status", "error"], index=pdf.index))
        pool.shutdown(wait=False)

    return photos.select("order_id", "image_idx", "url").mapInPandas(run, "order_id string, image_idx int, url string, content binary, status string, error string")


def recognised(photos: DataFrame, make: Callable[[], Callable[[bytes], str]]) -> DataFrame:
    """photos (order_id, image_idx, content, status) with the recogniser's JSON as detections. make() builds the recogniser once in
    each Python worker, when its first photo comes, and all tasks that run there use it; what fails has no detections and an error."""
    key = hashlib.sha256(cloudpickle.dumps(make)).hexdigest()

    def run(batches):
        from sealstone.sources import hooks  # the worker's own module, whose table outlives the task

        for pdf in batches:
            found, errors = [], []
            for content, status in zip(pdf["content"], pdf["status"]):
                text = error = None
                if status == "ok":
                    try:
                        text = hooks.built(key, make)(content)
                    except Exception as e:  # as above
                        error = f"{type(e).__name__}: {e}"
                found.append(text)
                errors.append(error)
            yield pdf[["order_id", "image_idx", "status"]].assign(json=found, error=errors)

    rows = photos.select("order_id", "image_idx", "content", "status").mapInPandas(run, "order_id string, image_idx int, status string, json string, error string")
    return rows.select("order_id", "image_idx", "status", parsed(F.col("json")).alias("detections"), "error")


def parsed(json: Column) -> Column:
    """A recogniser's result as detections; texts default to none, polygons to boxes, and a text without one has a null polygon."""
    res = F.from_json(json, RECOGNISED)["res"]
    polys = F.coalesce(res["dt_polys"], res["boxes"], F.array().cast("array<array<array<double>>>"))
    texts = F.coalesce(res["rec_texts"], F.array().cast("array<string>"))
    poly = lambda i: F.transform(F.get(polys, i), lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return F.transform(texts, lambda t, i: F.struct(i.alias("text_idx"), t.alias("text"), poly(i).alias("poly"))).cast(DETECTIONS)
