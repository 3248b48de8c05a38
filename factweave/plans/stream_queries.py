"""Batch forms of the stream operators, over events as update records; tests compare them with real streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from factweave.plans.registry import query, table
from factweave.streaming import records as R


def _records(spark, d):
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("identifier"), F.date_trunc("hour", "ts").alias("ts"), "event_id")


@query("r1_dedup", "SELECT DISTINCT user_id::VARCHAR AS identifier, date_trunc('hour', ts)::TIMESTAMP AS ts FROM events")
def r1(spark, d):
    return R.deduplicate_batch(_records(spark, d)).select("identifier", "ts")


@query("r2_delay_window", "WITH m AS (SELECT max(ts) AS now FROM events) SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events, m GROUP BY user_id, now HAVING max(ts) < now - INTERVAL 1 DAY")
def r2(spark, d):
    """What a one-day wait with renewal has released when the last record arrives."""
    e = table(spark, d, "events")
    last = e.groupBy("user_id").agg(F.max("ts").alias("ts"), F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
    now = e.agg(F.max("ts").alias("now"))
    return last.join(F.broadcast(now), F.expr("ts < now - interval 1 day")).select("user_id", "ts", "event_id")


@query("a12_r18_throughput", "SELECT time_bucket(INTERVAL 10 MINUTE, ts)::TIMESTAMP AS start, count(*) AS n FROM events GROUP BY 1")
def r18(spark, d):
    return R.throughput(table(spark, d, "events")).select(F.col("window.start").alias("start"), "n")


@query("r10_hash_merge", """WITH t AS (SELECT user_id AS page, event_type AS extractor, md5(event_id::VARCHAR) AS hash, event_id AS i FROM events),
    old AS (SELECT page, extractor, hash FROM t WHERE i % 3 <> 0), new AS (SELECT page, extractor, hash FROM t WHERE i % 3 <> 1 AND page % 2 = 0),
    o AS (SELECT DISTINCT *, 1 AS b FROM old WHERE page IN (SELECT page FROM new)), n AS (SELECT DISTINCT *, 1 AS a FROM new)
    SELECT page, extractor, hash, CASE WHEN b IS NULL THEN 'add' WHEN a IS NULL THEN 'delete' ELSE 'keep' END AS action FROM n FULL JOIN o USING (page, extractor, hash)""")
def r10(spark, d):
    t = table(spark, d, "events").select(F.col("user_id").alias("page"), F.col("event_type").alias("extractor"), F.md5(F.col("event_id").cast("string").cast("binary")).alias("hash"), F.col("event_id").alias("i"))
    return R.hash_merge(t.where("i % 3 != 0").drop("i"), t.where("i % 3 != 1 and page % 2 = 0").drop("i"), [])


@query("r9_r17_apply", """WITH t AS (SELECT user_id AS page, event_type AS extractor, md5(event_id::VARCHAR) AS hash, event_id AS i FROM events),
    new AS (SELECT page, extractor, hash FROM t WHERE i % 3 <> 1 AND page % 2 = 0)
    SELECT page, extractor, hash FROM t WHERE i % 3 <> 0 AND page NOT IN (SELECT page FROM new) UNION ALL SELECT page, extractor, hash FROM new""")
def r17(spark, d):
    t = table(spark, d, "events").select(F.col("user_id").alias("page"), F.col("event_type").alias("extractor"), F.md5(F.col("event_id").cast("string").cast("binary")).alias("hash"), F.col("event_id").alias("i"))
    old = t.where("i % 3 != 0").drop("i")
    return R.apply_changes(old, R.hash_merge(old, t.where("i % 3 != 1 and page % 2 = 0").drop("i"), []))
