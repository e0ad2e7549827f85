"""Queries that write a table to the shared folder and read it back: scans of
partly broken files, sinks, published partitions, incremental runs, names of
files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import documents, sinks
from ..sources.work import new_path
from ..streaming import incremental
from .common import read

ORDER = "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string"


def broken_scan(spark, d):
    """Orders as JSON lines by status; each seventh is cut off in its middle."""
    path = new_path(spark, "orders-json")
    line = F.to_json(F.struct("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"))
    o = read(spark, d, "orders").withColumn("l", line)
    o = o.select("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, F.substring("l", 1, 20)).otherwise(F.col("l")).alias("value"))
    o.write.partitionBy("o_orderstatus").text(path)
    rows = documents.json_rows(spark, path, ORDER).withColumn("status", F.regexp_extract("file", "o_orderstatus=([^/]*)", 1))
    sums = rows.filter("error IS NULL").groupBy("status").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.sum("o_custkey").alias("customers"))
    return documents.scan_report(rows, "status").join(sums, "status", "left").select("status", "records", "errors", "first_error", "total", "customers")


def sink_round_trips(spark, d):
    """Conversations through each sink and back; texts have line breaks,
    quotes, and are null where a turn's number is a multiple of five."""
    schema = "conv_id long, turn int, role string, text string"
    quoted = F.when(F.col("turn") % 5 != 0, F.concat(F.lit('"a", '), "text", F.lit("\\ \n'\"")))
    x = read(spark, d, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("int"), "role", quoted.alias("text"))
    paths = {n: new_path(spark, n) for n in ("csv", "json", "parquet")}
    sinks.write_quoted_csv(x, paths["csv"])
    sinks.write_documents(x, paths["json"], "conv_id")
    sinks.publish(x, paths["parquet"], "role")
    back = {"csv": sinks.read_quoted_csv(spark, paths["csv"], schema), "json": spark.read.schema(schema).json(paths["json"]), "parquet": sinks.published(spark, paths["parquet"], "role")}
    code = F.conv(F.substring(F.md5("text"), 1, 7), 16, 10).cast("long")
    told = lambda n: back[n].agg(F.lit(n).alias("sink"), F.count("*").alias("rows"), F.count("text").alias("texts"), F.sum(F.length("text")).alias("characters"), F.sum(code).alias("digest"), F.sum(F.col("conv_id") * (F.col("turn") + 1)).alias("keys"))
    return told("csv").unionByName(told("json")).unionByName(told("parquet"))


def published_partitions(spark, d):
    """Parts by brand, then some brands once more with other prices: only
    these are replaced, and all hold what was noted."""
    path, x = new_path(spark, "parts"), read(spark, d, "part").select("p_brand", "p_partkey", "p_retailprice")
    sinks.publish(x, path, "p_brand")
    sinks.publish(x.filter("p_brand LIKE '%#1%'").withColumn("p_retailprice", -F.col("p_retailprice")), path, "p_brand")
    got = sinks.published(spark, path, "p_brand").groupBy("p_brand").agg(F.round(F.sum("p_retailprice"), 2).alias("total"))
    return got.join(sinks.verified(spark, path, "p_brand"), "p_brand").select("p_brand", "total", "rows", "good")


EVENT = "event_id long, ts timestamp, user_id long, value double"


def incremental_events(spark, d):
    """A stream of a folder that grows between two runs, the second of which
    goes on from the first one's checkpoint; events that come again are
    dropped by their keys in its state."""
    folder, target, checkpoint = (new_path(spark, n) for n in ("chunks", "target", "stream"))
    e = read(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("long").alias("user_id"), F.col("value").cast("double").alias("value"))
    early = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    for grown in (e.filter(early), e.filter(~early).unionByName(e.filter(early & (F.col("user_id") % 3 == 0)))):
        grown.write.mode("append").parquet(folder)
        stream = incremental.new_chunks(spark, folder, EVENT, "event_id", "ts", "3650 days")
        incremental.run(stream, lambda b: b.select("event_id", "user_id", "value"), target, checkpoint).awaitTermination()
    got = incremental.results(spark, target)
    return got.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"), F.sum("event_id").alias("ids"))


def associated_names(spark, d):
    """Words of the benchmark as names, words of conversations as files."""
    words = lambda t, n: read(spark, d, t).select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]+)"))).alias(n)).distinct()
    return documents.associate(words("benchmark", "name"), words("conversations", "stem"), "name", "stem")


QUERIES = {f.__name__: f for f in (broken_scan, sink_round_trips, published_partitions, incremental_events, associated_names)}

_X = """X AS (SELECT conv_id, turn, CASE WHEN turn % 5 <> 0 THEN '"a", ' || text || '\\ ' || chr(10) || '''"' END AS text FROM conversations)"""
ORACLE_SQL = {
    "broken_scan": """WITH L AS (SELECT *, o_orderkey % 7 = 0 AS bad FROM orders)
SELECT o_orderstatus AS status, count(*) FILTER (NOT bad) AS records, count(*) FILTER (bad) AS errors, min(substr('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey, 1, 20)) FILTER (bad) AS first_error,
  round(sum(o_totalprice) FILTER (NOT bad), 2) AS total, sum(o_custkey) FILTER (NOT bad) AS customers FROM L GROUP BY 1""",
    "sink_round_trips": f"""WITH {_X} SELECT sink, count(*) AS rows, count(text) AS texts, sum(length(text)) AS characters, sum(('0x' || substr(md5(text), 1, 7))::BIGINT) AS digest, sum(conv_id * (turn + 1)) AS keys
FROM X, (VALUES ('csv'), ('json'), ('parquet')) AS s(sink) GROUP BY sink""",
    "published_partitions": "SELECT p_brand, round(sum(CASE WHEN p_brand LIKE '%#1%' THEN -p_retailprice ELSE p_retailprice END), 2) AS total, count(*) AS rows, true AS good FROM part GROUP BY 1",
    "incremental_events": "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1",
    "associated_names": """WITH N AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS name FROM benchmark), S AS (SELECT lower(w) AS p, min(w) AS file FROM (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS w FROM conversations) GROUP BY 1),
M AS (SELECT name, arg_min(file, {'a': lower(name) <> p, 'b': length(p), 'c': p}) AS file FROM N JOIN S ON contains(lower(name), p) OR contains(p, lower(name)) GROUP BY name)
SELECT name, file FROM N LEFT JOIN M USING (name)""",
}
