"""Queries for sinks, streams and hooks: each writes what the tables give and reads it again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sealstone.checkpoints import saved
from sealstone.operators import verdict
from sealstone.plans import inputs
from sealstone.plans.checks import _fresh
from sealstone.plans.oracle import FX
from sealstone.plans.verdicts import verdict_v1
from sealstone.rules import load_rules
from sealstone.sources import hooks, tables
from sealstone.streaming import incremental

QUERIES, SQL = {}, {}
RESULT = "order_id string, keyword string, paste_error int"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = FX + sql
        return f

    return register


def _results(spark: SparkSession, d: str) -> DataFrame:
    return saved(verdict_v1(spark, d).select("order_id", "keyword", "paste_error"), "results")


def _halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    first = F.col("order_id").cast("long") % 2 == 0
    return df.where(first), df.where(~first)


@query("SELECT order_id, keyword, paste_error FROM verdict1")
def append_csv(spark, d):
    path = _fresh(spark, "csv")
    for part in _halves(_results(spark, d)):
        tables.append_csv(part, path)
    return tables.read_results(spark, path, RESULT).withColumn("keyword", F.coalesce("keyword", F.lit("")))


@query("SELECT order_id, nullif(keyword, '') AS keyword, paste_error, 3 AS n_fields FROM verdict1")
def append_jsonl(spark, d):
    """Nulls are kept as fields."""
    path = _fresh(spark, "jsonl")
    for part in _halves(_results(spark, d).withColumn("keyword", F.nullif("keyword", F.lit("")))):
        tables.append_jsonl(part, path)
    lines = spark.read.text(path).withColumn("r", F.from_json("value", RESULT))
    return lines.select("r.*", F.size(F.expr("json_object_keys(value)")).alias("n_fields"))


@query("SELECT order_id, 2 AS copies FROM verdict1")
def dual_sink(spark, d):
    csv, js = _fresh(spark, "csv"), _fresh(spark, "jsonl")
    tables.append_both(_results(spark, d), csv, js)
    both = tables.read_results(spark, csv, RESULT).select("order_id").unionByName(spark.read.schema(RESULT).json(js).select("order_id"))
    return both.groupBy("order_id").agg(F.count("*").cast("int").alias("copies"))


@query("SELECT order_id, keyword, paste_error FROM verdict1 WHERE false")
def empty_result(spark, d):
    path = _fresh(spark, "empty")
    tables.create_empty(verdict_v1(spark, d).select("order_id", "keyword", "paste_error"), path)
    return tables.read_results(spark, path, RESULT)


@query("SELECT order_id, length(order_id) AS digits FROM fx_orders")
def incremental_run(spark, d):
    """Orders that come in two files, the second with those of the first again; each is judged once."""
    src, out, mark = _fresh(spark, "orders"), _fresh(spark, "judged"), _fresh(spark, "progress")
    orders = inputs.orders(spark, d)
    for part in (_halves(orders)[0], orders):
        part.write.mode("append").parquet(src)
        stream = incremental.new_orders(spark, src, "parquet", "order_id string, lob string")
        incremental.run_available(stream, lambda df: df.select("order_id", F.length("order_id").alias("digits")), out, mark).awaitTermination()
    return spark.read.parquet(out).select("order_id", "digits")


@query("SELECT 0 AS batch, count(*) AS done, 0 AS failed FROM fx_orders WHERE CAST(order_id AS BIGINT) % 2 = 0 UNION ALL SELECT 1, count(*), count(*) FILTER (WHERE length(order_id) = 3) FROM fx_orders WHERE CAST(order_id AS BIGINT) % 2 = 1")
def live_progress(spark, d):
    """What a run tells batch by batch; here odd ids of three digits fail."""
    src, out, mark, told = _fresh(spark, "orders"), _fresh(spark, "judged"), _fresh(spark, "progress"), []
    for part in _halves(inputs.orders(spark, d)):
        part.write.mode("append").parquet(src)
        stream = incremental.new_orders(spark, src, "parquet", "order_id string, lob string")
        error = F.when((F.length("order_id") == 3) & (F.col("order_id").cast("long") % 2 == 1), "unreadable").alias("error")
        incremental.run_available(stream, lambda df: df.select("order_id", error), out, mark, progress=lambda *x: told.append(x)).awaitTermination()
    return spark.createDataFrame(told, "batch int, done long, failed long")


@query("SELECT 50 * (i + 1) AS done, CAST(50 * (i + 1) // 500 * 0 AS BIGINT) AS failed, round(100 * 50 * (i + 1) / n, 4) AS percent FROM (SELECT unnest(range(n // 50)) AS i, n FROM (SELECT count(*) AS n FROM fx_orders))")
def progress_steps(spark, d):
    """What a run tells at each fiftieth order, over two batches; times are left out."""
    src, out, mark, told = _fresh(spark, "orders"), _fresh(spark, "judged"), _fresh(spark, "progress"), []
    orders = saved(inputs.orders(spark, d), "orders")
    for part in _halves(orders):
        part.coalesce(1).write.mode("append").parquet(src)
    stream = incremental.new_orders(spark, src, "parquet", "order_id string, lob string", files_per_batch=1)
    run = incremental.run_available(stream, lambda df: df.select("order_id"), out, mark, steps=told.append, total=orders.count())
    run.awaitTermination()
    return spark.createDataFrame([(p.done, p.failed, round(p.percent, 4)) for p in told if p.eta_h >= 0], "done long, failed long, percent double")


@query("SELECT DISTINCT CAST(user_id AS VARCHAR) AS order_id FROM events")
def once_within_delay(spark, d):
    """A stream of events, of which each user's first counts; all lie within the delay."""
    src, out = _fresh(spark, "events"), _fresh(spark, "once")
    spark.read.parquet(f"{d}/events.parquet").select(F.col("user_id").cast("string").alias("order_id"), F.col("ts").cast("timestamp").alias("at")).repartition(2).write.parquet(src)
    stream = spark.readStream.schema("order_id string, at timestamp").option("maxFilesPerTrigger", 1).parquet(src)
    once = incremental.once_within(stream, "at", "36500 days")
    once.writeStream.format("parquet").option("path", out).option("checkpointLocation", _fresh(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("order_id string").parquet(out)


_RULE = """SELECT CASE p_partkey % 11 WHEN 0 THEN ' ' WHEN 1 THEN 'twice' WHEN 2 THEN 'UNKNOWN LOB' ELSE 'line ' || p_partkey END AS lob,
  CASE p_partkey % 7 WHEN 0 THEN '{broken' ELSE '{"sticker_count": "' || CASE p_partkey % 5 WHEN 0 THEN 'three' WHEN 1 THEN 'single_only' ELSE 'dual_required' END
    || '", "scan_sticker": ' || CASE p_partkey % 4 WHEN 0 THEN '{"x_min": 0.1, "x_max": 0.' || (p_size % 10) || '5}' WHEN 1 THEN '[{"y_max": 0.5}, "no", {"y_min": 0.5}]' WHEN 2 THEN '[]' ELSE '{"y_max": 1.5}' END
    || ', "front_face_aspect_range": [1.5, ' || (p_size % 3) || '.0], "unofficial_color": {"mode": "' || CASE p_partkey % 3 WHEN 0 THEN 'brown_box' ELSE 'white_box' END || '"}}' END AS rule, p_partkey, p_size FROM part"""


@query(f""", book AS ({_RULE}), tests AS (SELECT *, trim(lob) AS name, count(*) OVER (PARTITION BY trim(lob)) > 1 AS twice, p_partkey % 7 = 0 AS broken FROM book)
  SELECT name AS lob, CASE WHEN len(list_filter(reasons, lambda x: x IS NOT NULL)) = 0 THEN CASE p_partkey % 4 WHEN 1 THEN 2 ELSE 1 END END AS n_zones, list_filter(reasons, lambda x: x IS NOT NULL)::VARCHAR AS reasons FROM (
    SELECT *, [CASE WHEN name = '' THEN 'no name' END, CASE WHEN name = 'UNKNOWN LOB' THEN 'reserved name' END, CASE WHEN twice THEN 'name comes twice' END, CASE WHEN broken THEN 'not JSON' END,
      CASE WHEN NOT broken AND p_partkey % 5 = 0 THEN 'unknown sticker_count' END, CASE WHEN NOT broken AND p_partkey % 4 = 2 THEN 'no scan zone' END, CASE WHEN NOT broken AND (p_partkey % 4 = 3 OR p_partkey % 4 = 0 AND p_size % 10 = 0) THEN 'bad zone' END,
      CASE WHEN NOT broken AND p_size % 3 < 2 THEN 'bad aspect range' END] AS reasons FROM tests) t""")
def rule_book_load(spark, d):
    """A book of one rule for each part, good and bad ones."""
    book = spark.sql(_RULE.replace("{", "{{").replace("}", "}}").replace("FROM part", "FROM {part}"), part=spark.read.parquet(f"{d}/part.parquet")).select("lob", "rule")
    good, refused = load_rules(saved(book, "book"))
    told = F.concat(F.lit("["), F.array_join("reasons", ", "), F.lit("]"))
    return good.select("lob", F.size("scan_zones").alias("n_zones"), F.lit("[]").alias("reasons")).unionByName(refused.select("lob", F.lit(None).cast("int").alias("n_zones"), told.alias("reasons")))


@query("SELECT order_id, count(*) AS n FROM fx_orders GROUP BY order_id")
def once_per_order(spark, d):
    """Orders sent twice in one batch, judged once each."""
    src, out, mark = _fresh(spark, "orders"), _fresh(spark, "judged"), _fresh(spark, "progress")
    orders = inputs.orders(spark, d)
    orders.unionByName(orders).write.parquet(src)
    stream = incremental.new_orders(spark, src, "parquet", "order_id string, lob string")
    incremental.run_available(stream, lambda df: df.select("order_id"), out, mark, once_per_order=True).awaitTermination()
    return spark.read.parquet(out).groupBy("order_id").agg(F.count("*").alias("n"))


@query("SELECT order_id, image_idx, CASE WHEN j = 3 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN j = 3 THEN 0 ELSE length(order_id) + 6 END AS n_bytes FROM fx_photos")
def fetch_hook(spark, d):
    """A stub fetcher that gives the url's bytes, and fails for some."""

    def fetch(url: str) -> bytes:
        if url.endswith("!"):
            raise OSError("not there")
        return url.encode()

    url = F.concat(F.lit("img/"), F.col("order_id"), F.lit("/"), F.col("image_idx").cast("string"), F.when(F.col("j") == 3, "!").otherwise(""))
    got = hooks.fetched(inputs.photos(spark, d).withColumn("url", url), fetch)
    return got.select("order_id", "image_idx", "status", F.coalesce(F.length("content"), F.lit(0)).alias("n_bytes"))


@query("SELECT order_id, image_idx, count(*) AS n_texts, count(*) FILTER (WHERE is_seal) AS n_seals FROM pb GROUP BY ALL")
def recogniser_hook(spark, d):
    """A stub recogniser that finds its result in the photo's content."""
    texts = F.struct(F.struct(F.col("detections.text").alias("rec_texts")).alias("res"))
    of = inputs.photos(spark, d).select("order_id", "image_idx", "status", F.to_json(texts).cast("binary").alias("content"))
    found = hooks.recognised(of, lambda: bytes.decode)
    return found.select("order_id", "image_idx", F.size("detections").cast("long").alias("n_texts"), F.size(F.filter("detections", lambda x: x["text"].contains("扫码即领"))).cast("long").alias("n_seals"))


@query("""SELECT c_custkey::VARCHAR AS order_id, (1 + c_custkey % 2)::INT AS image_idx, CASE WHEN c_custkey % 7 = 0 OR c_custkey % 5 = 0 THEN 'missing' ELSE 'ok' END AS status,
  CASE WHEN c_custkey % 7 = 0 OR c_custkey % 5 = 0 THEN 0 ELSE length(n_name) + 1 END AS n_bytes FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def photo_source(spark, d):
    """Photos in an object store, found by their urls: a file for each nation, which its customers' photos share; some have a wrong url or none."""
    path = _fresh(spark, "photos")
    spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").alias("nation"), "n_name").repartition("nation").write.partitionBy("nation").text(path)
    url = F.when(F.col("c_custkey") % 7 == 0, "elsewhere").when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("nation="), F.col("c_nationkey").cast("string")))
    of = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").cast("string").alias("order_id"), (1 + F.col("c_custkey") % 2).cast("int").alias("image_idx"), url.alias("url"))
    got = tables.stored(of, tables.read_photos(spark, path), F.regexp_extract("path", r"(nation=\d+)", 1))
    return got.select("order_id", "image_idx", "status", F.coalesce(F.length("content"), F.lit(0)).alias("n_bytes"))


@query("SELECT order_id, stamp_time FROM stamps")
def photo_stamps(spark, d):
    return verdict.first_stamp(inputs.photos(spark, d)).select("order_id", F.col("stamp.time").alias("stamp_time"))
