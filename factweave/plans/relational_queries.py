"""Joins, aggregations, windows and sorts of the extraction and its statistics."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from factweave.plans.registry import query, table


@query("j1_page_text", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P'")
def j1(spark, d):
    return table(spark, d, "orders").where("o_orderstatus = 'P'").join(table(spark, d, "customer"), F.expr("o_custkey = c_custkey")).select("o_orderkey", "c_name")


@query("j2_language_links", "SELECT d.doc_id, l.quality FROM documents d JOIN labels l USING (doc_id) WHERE lang <> 'en'")
def j2(spark, d):
    return table(spark, d, "documents").where("lang != 'en'").join(table(spark, d, "labels"), "doc_id").select("doc_id", "quality")


@query("j3_chain", "SELECT r_name, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def j3(spark, d):
    # counted by customer before the joins with the dimensions
    n = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("k"))
    j = n.join(table(spark, d, "customer"), "c_custkey").join(table(spark, d, "nation"), F.expr("c_nationkey = n_nationkey")).join(table(spark, d, "region"), F.expr("n_regionkey = r_regionkey"))
    return j.groupBy("r_name").agg(F.sum("k").alias("n"))


@query("j8_parents", "SELECT n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA' ORDER BY n_name")
def j8(spark, d):
    return table(spark, d, "nation").join(table(spark, d, "region").where("r_name != 'ASIA'"), F.expr("n_regionkey = r_regionkey"), "left").select("n_name", "r_name").orderBy("n_name")


@query("j16_optional", "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def j16(spark, d):
    n = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("k"))
    return table(spark, d, "customer").join(n, F.expr("c_custkey = o_custkey"), "left").select("c_custkey", F.coalesce("k", F.lit(0)).alias("n"))


@query("j17_existence", "SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS labelled FROM documents")
def j17(spark, d):
    hit = table(spark, d, "labels").select("doc_id").distinct().withColumn("labelled", F.lit(True))
    return table(spark, d, "documents").select("doc_id").join(hit, "doc_id", "left").select("doc_id", F.coalesce("labelled", F.lit(False)).alias("labelled"))


@query("j18_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def j18(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.expr("c_custkey = o_custkey"), "left_anti").select("c_custkey")


@query("j19_as_of", "SELECT conv_id, turn, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_user FROM conversations")
def j19(spark, d):
    """The last row above of a kind: a running last value in document order."""
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, 0)
    return table(spark, d, "conversations").select("conv_id", "turn", F.last(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True).over(w).alias("last_user"))


@query("j20_nearest_section", "SELECT user_id, event_id, arg_max(e2, e2) AS section FROM (SELECT a.user_id, a.event_id, b.event_id AS e2 FROM events a LEFT JOIN events b ON a.user_id = b.user_id AND b.event_id <= a.event_id AND b.event_type = 'purchase') GROUP BY ALL")
def j20(spark, d):
    w = W.partitionBy("user_id").orderBy("event_id").rowsBetween(W.unboundedPreceding, 0)
    return table(spark, d, "events").select("user_id", "event_id", F.last(F.when(F.col("event_type") == "purchase", F.col("event_id")), ignorenulls=True).over(w).alias("section"))


@query("j22_renames", "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN 'accepted' WHEN l_returnflag = 'R' THEN 'returned' ELSE l_returnflag END AS flag FROM lineitem")
def j22(spark, d):
    names = spark.createDataFrame([("A", "accepted"), ("R", "returned")], "old string, new string")
    return table(spark, d, "lineitem").join(F.broadcast(names), F.expr("l_returnflag = old"), "left").select("l_orderkey", "l_linenumber", F.coalesce("new", "l_returnflag").alias("flag"))


@query("a1_template_counts", "SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (WHERE l_discount <> 0) AS filled FROM lineitem GROUP BY ALL")
def a1(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_discount") != 0).alias("filled"))


@query("a2_counts_hits", "SELECT user_id, event_type, sum(value) AS total, count(*) AS hits FROM events GROUP BY ALL")
def a2(spark, d):
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("hits"))


@query("a3_cluster_counts", "SELECT label, count(*) AS n FROM embeddings GROUP BY label")
def a3(spark, d):
    return table(spark, d, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("a4_degree_top", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 20")
def a4(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l_partkey").limit(20)


@query("a8_rates", "SELECT event_type, count(*) AS total, count(DISTINCT user_id) AS kept, 1 - count(DISTINCT user_id) / count(*)::DOUBLE AS saved FROM events GROUP BY event_type")
def a8(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("total"), F.countDistinct("user_id").alias("kept")).withColumn("saved", 1 - F.col("kept") / F.col("total"))


@query("a11_size_totals", "SELECT source, sum(len(string_split(text, chr(10)))) AS lines, sum(octet_length(encode(text))) AS bytes FROM documents GROUP BY source")
def a11(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.sum(F.size(F.split("text", "\n"))).alias("lines"), F.sum(F.octet_length("text")).alias("bytes"))


@query("w2_forward_fill", "SELECT o_custkey, o_orderkey, last_value(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM orders")
def w2(spark, d):
    w = W.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(W.unboundedPreceding, 0)
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", F.last(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")), ignorenulls=True).over(w).alias("filled"))


@query("w3_first_match", "SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS first_key, arg_min(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY o_custkey")
def w3(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_key"), F.min_by("o_orderstatus", "o_orderkey").alias("status"))


@query("w4_best_match", "SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_extendedprice DESC, l_linenumber) AS k FROM lineitem) WHERE k = 1")
def w4(spark, d):
    best = F.min_by("l_linenumber", F.struct("l_quantity", -F.col("l_extendedprice"), "l_linenumber"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(best.alias("l_linenumber"))


@query("o1_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def o1(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("o5_property_sort", "SELECT n_regionkey, list_sort(list(n_name)) AS names FROM nation GROUP BY n_regionkey")
def o5(spark, d):
    return table(spark, d, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n_name")).alias("names"))
