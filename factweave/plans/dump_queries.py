"""Dump filters: pages stand for (doc_id, source, lang), revisions for conversation turns or orders."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from factweave.operators import dumps as D
from factweave.plans.registry import query, table

_NS = "CAST(doc_id % 18 AS INT) - 2"


def _pages(spark, d):
    return table(spark, d, "documents").select("doc_id", (F.col("doc_id") % 18 - 2).cast("int").alias("ns"), F.col("source").alias("title"), "lang", "n_chars")


@query("f1_namespace_filter", f"SELECT doc_id, {_NS} AS ns FROM documents WHERE {_NS} NOT IN (1, 3, 10)")
def f1(spark, d):
    return _pages(spark, d).where(D.namespace_filter(F.col("ns"), "!NS_TALK,user_talk,10")).select("doc_id", "ns")


@query("f2_not_talk", f"SELECT doc_id, {_NS} AS ns FROM documents WHERE {_NS} < 0 OR ({_NS}) % 2 = 0")
def f2(spark, d):
    return _pages(spark, d).where(D.not_talk(F.col("ns"))).select("doc_id", "ns")


@query("f3_latest_revision", "SELECT conv_id, arg_max(turn, turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id")
def f3(spark, d):
    return D.latest(table(spark, d, "conversations").select("conv_id", "turn", "role", "text"), "conv_id", "turn")


@query("f4_title_regex", "SELECT c_custkey, c_name FROM customer WHERE regexp_full_match(c_name, 'Customer#0+[1-5]+')")
def f4(spark, d):
    return table(spark, d, "customer").where(D.title_matches(F.col("c_name"), "Customer#0+[1-5]+")).select("c_custkey", "c_name")


@query("f5_subject_list", f"SELECT doc_id, ns, title FROM (SELECT doc_id, {_NS} AS ns, source AS title FROM documents) WHERE (CASE WHEN ns > 0 AND ns % 2 = 1 THEN ns - 1 ELSE ns END) || ':' || title IN ('0:src1', '2:src4', '14:src0')")
def f5(spark, d):
    listed = spark.createDataFrame([("0:src1",), ("2:src4",), ("14:src0",)], "title string")
    subject = F.concat_ws(":", F.when((F.col("ns") > 0) & (F.col("ns") % 2 == 1), F.col("ns") - 1).otherwise(F.col("ns")), "title")
    return D.in_list(_pages(spark, d), listed, subject).select("doc_id", "ns", "title")


@query("f6_exact_list", "SELECT doc_id, source AS title FROM documents WHERE source IN ('src1', 'src7')")
def f6(spark, d):
    listed = spark.createDataFrame([("src1",), ("src7",), ("src1",)], "title string")
    return D.in_list(_pages(spark, d), listed, F.col("title")).select("doc_id", "title")


@query("f7_article_list", f"SELECT doc_id, {_NS} AS ns FROM documents WHERE {_NS} <> 0 OR source IN ('src2', 'src3')")
def f7(spark, d):
    listed = spark.createDataFrame([("src2",), ("src3",)], "title string")
    pages = _pages(spark, d)
    return pages.where("ns != 0").unionByName(D.in_list(pages.where("ns = 0"), listed, F.col("title"))).select("doc_id", "ns")


@query("f9_time_bounds", "SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01'")
def f9(spark, d):
    return table(spark, d, "orders").where("o_orderdate > timestamp'1995-01-01' and o_orderdate < timestamp'1996-01-01'").select("o_orderkey")


@query("f12_stream_filter", f"SELECT doc_id FROM (SELECT doc_id, {_NS} AS ns, source AS title FROM documents) WHERE ns IN (0, 10, 14) OR (ns = 2 AND title LIKE 'src1%')")
def f12(spark, d):
    return _pages(spark, d).where(D.stream_filter(F.col("ns"), F.col("title"), "src1")).select("doc_id")


@query("f13_accept_counts", f"SELECT count(*) FILTER (WHERE ns >= 0) AS accepted, count(*) FILTER (WHERE ns < 0) AS rejected FROM (SELECT {_NS} AS ns FROM documents)")
def f13(spark, d):
    return _pages(spark, d).agg(F.count_if(F.col("ns") >= 0).alias("accepted"), F.count_if(F.col("ns") < 0).alias("rejected"))


@query("f20_ignored_names", "SELECT doc_id, source FROM documents WHERE NOT (source IN ('src0', 'src5') OR regexp_matches(source, '^src1[0-9]$'))")
def f20(spark, d):
    return table(spark, d, "documents").where(~(F.col("source").isin("src0", "src5") | F.col("source").rlike("^src1[0-9]$"))).select("doc_id", "source")


@query("f22_conditions", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Finished' WHEN contains(o_orderpriority, 'URGENT') THEN 'Urgent' WHEN o_orderpriority IS NOT NULL THEN 'Known' ELSE 'Other' END AS cls FROM orders")
def f22(spark, d):
    cls = F.when(F.lower("o_orderstatus") == "f", "Finished").when(F.col("o_orderpriority").contains("URGENT"), "Urgent").when(F.col("o_orderpriority").isNotNull(), "Known").otherwise("Other")
    return table(spark, d, "orders").select("o_orderkey", cls.alias("cls"))


@query("f23_page_types", f"SELECT CASE WHEN n_chars < 50 THEN 'deleted' WHEN ns = 10 AND title LIKE '%9' THEN '10/doc' ELSE ns::VARCHAR END AS type, count(*) AS n FROM (SELECT {_NS} AS ns, source AS title, n_chars FROM documents) GROUP BY 1")
def f23(spark, d):
    title = F.when(F.col("title").endswith("9"), F.concat("title", F.lit("/doc"))).otherwise(F.col("title"))
    return _pages(spark, d).groupBy(D.page_type(F.col("ns"), title, F.col("n_chars") < 50).alias("type")).agg(F.count(F.lit(1)).alias("n"))


@query("f26_label_search", "SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'a') OR contains(p_name, 'blue') OR regexp_matches(p_name, '(?i)GREEN') ORDER BY p_name, p_partkey LIMIT 20")
def f26(spark, d):
    hit = F.col("p_name").startswith("a") | F.col("p_name").contains("blue") | F.col("p_name").rlike("(?i)GREEN")
    return table(spark, d, "part").where(hit).select("p_partkey", "p_name").orderBy("p_name", "p_partkey").limit(20)


@query("s6_title_pages", "SELECT doc_id, source FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 50 OFFSET 10")
def s6(spark, d):
    return table(spark, d, "documents").where("lang = 'en'").select("doc_id", "source").orderBy("doc_id").offset(10).limit(50)


@query("s6e_by_language", "SELECT lang, count(*) AS n, sum(n_chars) AS chars FROM documents GROUP BY lang")
def s6e(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("k22_download_table", "PIVOT (SELECT source, lang FROM documents) ON lang IN ('de', 'en', 'es', 'fr') USING count(*) GROUP BY source")
def k22(spark, d):
    return table(spark, d, "documents").groupBy("source").pivot("lang", ["de", "en", "es", "fr"]).agg(F.count(F.lit(1))).fillna(0)
