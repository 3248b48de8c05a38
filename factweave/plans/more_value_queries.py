"""Shapes of values, unit templates, labels, ids and filters, on driver tables rendered as text."""

from __future__ import annotations

from pyspark.sql import functions as F

from factweave.functions import media
from factweave.functions import text as X
from factweave.functions import values as V
from factweave.operators import triples as T
from factweave.plans.registry import query, table
from factweave.streaming import records as R


@query("n5_old_numbers", "SELECT o_orderkey, round(o_totalprice, 2) AS number FROM orders")
def n5(spark, d):
    """French text with English marks, German text with its own."""
    t = table(spark, d, "orders").withColumn("en", F.format_number(F.round("o_totalprice", 2), 2)).withColumn("lang", F.when(F.col("o_orderkey") % 2 == 0, "fr").otherwise("de"))
    return t.select("o_orderkey", V.parse_number_old(F.when(F.col("lang") == "fr", F.col("en")).otherwise(F.translate("en", ",.", ".,")), F.col("lang")).alias("number"))


@query("n7_unit_templates", """SELECT p_partkey, CASE p_partkey % 5 WHEN 1 THEN p_size * 30.48 + 3 * 2.54 ELSE p_size::DOUBLE END AS value, (['mi', 'centimetre', 'm', 'inch', 'squareKilometre'])[1 + p_partkey % 5] AS unit FROM part""")
def n7(spark, d):
    forms = ["about {{convert|%d|mi|km|1}}", "{{height|ft=%d|in=3}}", "{{height|m=%d}}", "{{Auto in|%d|2}}", "{{km2_to_mi2|%d}}"]
    text = F.coalesce(*(F.when(F.col("p_partkey") % 5 == k, F.format_string(f, "p_size")) for k, f in enumerate(forms)))
    return table(spark, d, "part").select("p_partkey", V.template_quantity(text).alias("q")).select("p_partkey", "q.value", "q.unit")


@query("n11_infobox_money", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN 1.5e6 ELSE round(o_totalprice, 2) END AS value, CASE o_orderkey % 3 WHEN 1 THEN 'euro' ELSE 'usDollar' END AS unit FROM orders")
def n11(spark, d):
    k, n = F.col("o_orderkey") % 3, F.format_number(F.round("o_totalprice", 2), 2)
    text = F.when(k == 0, F.concat(F.lit("$"), n)).when(k == 1, F.concat(n, F.lit(" EUR"))).otherwise("$1.5 million")
    return table(spark, d, "orders").select("o_orderkey", V.infobox_money(text, {"$": "usDollar", "EUR": "euro"}).alias("m")).select("o_orderkey", "m.value", "m.unit")


@query("n14_first_quantity", "SELECT p_partkey, CASE WHEN p_partkey % 4 < 3 THEN (1000 + p_size)::DOUBLE END AS value, CASE WHEN p_partkey % 4 < 3 THEN 'http://unit/mm' END AS unit FROM part")
def n14(spark, d):
    forms = ["1,%03d mm", "1,%03dmm", "1,%03d mm (13 in)", "1,%03d mm and more"]
    text = F.coalesce(*(F.when(F.col("p_partkey") % 4 == k, F.format_string(f, "p_size")) for k, f in enumerate(forms)))
    return table(spark, d, "part").select("p_partkey", V.first_quantity(text, {"mm": "http://unit/mm", "in": "http://unit/in"}).alias("q")).select("p_partkey", "q.value", "q.unit")


@query("n18_value_shapes", "SELECT (['integer', 'grouped', 'float', 'large', 'picture', 'rank', 'percent', 'link', 'text'])[1 + p_partkey % 9] AS shape, count(*) AS n FROM part GROUP BY ALL")
def n18(spark, d):
    forms = ["-%d", "1,0%02d", "1,000.%d", "%d.5 million", "[[Image:a b-%d.JPG|20px]]", "%d<sup>th</sup>", "%d %%", "[[a %d]]", "a %d"]
    text = F.coalesce(*(F.when(F.col("p_partkey") % 9 == k, F.format_string(f, "p_size")) for k, f in enumerate(forms)))
    return table(spark, d, "part").select(V.value_shape(text).alias("shape")).groupBy("shape").agg(F.count(F.lit(1)).alias("n"))


@query("x14_predicates", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'birthPlace' WHEN 1 THEN 'a_percent_C3' ELSE 'size' || p_size END AS p, CASE p_partkey % 3 WHEN 0 THEN 'birthPlace' WHEN 1 THEN 'a%C3_' ELSE 'size' || p_size END AS q FROM part")
def x14(spark, d):
    k = F.col("p_partkey") % 3
    name = F.when(k == 0, "placeOfBirth").when(k == 1, "a%C3").otherwise(F.concat(F.lit("size"), "p_size"))
    names = {"placeOfBirth": "birthPlace"}
    return table(spark, d, "part").select("p_partkey", X.predicate_name(name, names).alias("p"), X.predicate_name(name, names, False).alias("q"))


@query("x26_isbn", """WITH n AS (SELECT p_partkey, lpad(((p_partkey * 7919 + 12345) % 1000000000)::VARCHAR, 9, '0') AS b FROM part), c AS (SELECT *, list_sum(list_transform(range(1, 10), lambda i: b[i]::INT * (11 - i))) % 11 AS r FROM n)
    SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN b || CASE (11 - r) % 11 WHEN 10 THEN 'X' ELSE ((11 - r) % 11)::VARCHAR END END AS isbn FROM c""")
def x26(spark, d):
    """Numbers with their check digit, and with a wrong one."""
    b = F.lpad(((F.col("p_partkey") * 7919 + 12345) % 1000000000).cast("string"), 9, "0")
    s = F.aggregate(F.sequence(F.lit(1), F.lit(9)), F.lit(0), lambda a, i: a + F.substr(F.col("b"), i, F.lit(1)).cast("int") * (11 - i))
    t = table(spark, d, "part").withColumn("b", b).withColumn("c", (11 - s % 11 + F.col("p_partkey") % 2) % 11)
    text = F.concat(F.lit("ISBN "), F.substr("b", F.lit(1), F.lit(1)), F.lit("-"), F.substr("b", F.lit(2)), F.lit("-"), F.when(F.col("c") == 10, "x").otherwise(F.col("c").cast("string")), F.lit("."))
    return t.select("p_partkey", X.isbn(text).alias("isbn"))


@query("x27_labels", "SELECT p_partkey, p_name || ' (' || p_size || ' & more)' AS label FROM part")
def x27(spark, d):
    title = F.concat(F.when(F.col("p_partkey") % 2 == 0, "Category:").otherwise("Template:"), F.translate("p_name", " ", "_"), F.lit("_%28"), "p_size", F.lit("_%26_more%29"))
    return table(spark, d, "part").select("p_partkey", X.label_of_title(title).alias("label"))


@query("x28_list_items", "SELECT p_partkey, unnest(['first ' || p_size, p_name, 'last']) AS item FROM part")
def x28(spark, d):
    text = F.concat(F.lit("first "), "p_size", F.lit(" ;bn1; "), "p_name", F.lit(";;x; la\nst"))
    return table(spark, d, "part").select("p_partkey", F.explode(X.list_items(text)).alias("item"))


@query("x31_cleaners", "SELECT p_partkey, lower(p_name[1]) || replace(p_name[2:], ' ', '') AS t FROM part")
def x31(spark, d):
    return table(spark, d, "part").select("p_partkey", X.clean_by(X.lower_first(F.concat("p_name", F.lit(" (x)"))), [(r"\([^)]*\)", ""), (r"\s+", "")]).alias("t"))


_SIGNS = "'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'"


@query("x32_short_ids", f"SELECT o_orderkey, list_aggregate(list_transform(range(14, -1, -1), lambda i: ({_SIGNS})[1 + ((o_orderkey * 1000003) // (62::HUGEINT ** i)::HUGEINT % 62)::INT]), 'string_agg', '') AS id FROM orders")
def x32(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.short_id(F.col("o_orderkey") * 1000003).alias("id"))


@query("f24_english_twins", "SELECT doc_id, 'T' || doc_id AS title FROM documents WHERE lang <> 'en' AND doc_id % 3 <> 0")
def f24(spark, d):
    t = table(spark, d, "documents").where("lang != 'en'").withColumn("source", F.concat(F.lit("text [[de:x]] "), F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("[[en: T"), "doc_id", F.lit(" ]]"))).otherwise("")))
    return t.select("doc_id", X.english_twin(F.col("source")).alias("title")).where("title is not null")


@query("f17_valid_triples", "SELECT CASE p_partkey % 4 WHEN 1 THEN '_:b' || p_partkey ELSE 'http://x.org/' || p_partkey END AS s, CASE p_partkey % 4 WHEN 1 THEN p_name ELSE 'http://x.org/o' END AS o FROM part WHERE p_partkey % 4 < 2")
def f17(spark, d):
    """Sound; a blank node to be repaired; a broken subject; a broken URI object."""
    k = F.col("p_partkey") % 4
    s = F.when(k == 1, F.concat(F.lit("_:b-"), "p_partkey", F.lit("!"))).when(k == 2, "x y").otherwise(F.concat(F.lit("http://x.org/"), "p_partkey"))
    t = table(spark, d, "part").select(s.alias("s"), F.lit("http://x.org/p").alias("p"), F.when(k == 1, F.col("p_name")).when(k == 3, "http://x y").otherwise("http://x.org/o").alias("o"), F.when(k == 1, "literal").otherwise("uri").alias("o_kind"))
    return T.valid_triples(t).select("s", "o")


@query("f25_statement_filter", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'N' AND l_partkey NOT IN (1, 2) AND l_suppkey NOT IN (1, 2) AND l_partkey <> 5 AND l_suppkey <> 5 AND l_partkey <> l_suppkey")
def f25(spark, d):
    cond = T.statement_filter(["l_returnflag"], ["l_partkey", "l_suppkey"], (5,), ignored_predicates=("N",), ignored_objects=(1, 2), avoid_cycles=2)
    return table(spark, d, "lineitem").where(cond).select("l_orderkey", "l_linenumber")


@query("f27_media_types", "SELECT * FROM (VALUES ('*/*', 'c/d'), ('c/d', 'c/d'), ('a/b;q=0.8,c/d;q=0.6', 'a/b'), ('a/*;q=0.9,*/*;q=0.1', 'a/b'), ('x/y', NULL), ('', 'c/d')) t(accept, chosen)")
def f27(spark, d):
    """Not a table's operation: the header's cases, chosen on the driver."""
    cases = ["*/*", "c/d", "a/b;q=0.8,c/d;q=0.6", "a/*;q=0.9,*/*;q=0.1", "x/y", ""]
    rows = [(c, media.best_variant(c, ["a/b;q=0.7", "c/d;q=0.8"])) for c in cases]
    return spark.createDataFrame(rows, "accept string, chosen string")


@query("r13_replace_pages", "SELECT user_id AS page, event_id AS hash FROM events WHERE (event_id % 2 = 0 AND user_id % 3 <> 0) OR (event_id % 2 = 1 AND user_id % 3 = 0) UNION ALL SELECT user_id, event_id FROM events WHERE event_id % 2 = 0 AND user_id % 3 = 0 AND user_id NOT IN (SELECT user_id FROM events WHERE event_id % 2 = 1)")
def r13(spark, d):
    t = table(spark, d, "events").select(F.col("user_id").alias("page"), F.col("event_id").alias("hash"))
    return R.replace_pages(t.where("hash % 2 = 0"), t.where("hash % 2 = 1 and page % 3 = 0"))


@query("r14_edit_statistics", """WITH f AS (SELECT user_id, min(ts) AS ts FROM events GROUP BY user_id, time_bucket(INTERVAL 10 MINUTE, ts)), w AS (SELECT user_id, ts, time_bucket(INTERVAL 5 MINUTE, ts) AS b FROM f)
    SELECT start::TIMESTAMP AS start, count(*) AS edits, count(DISTINCT user_id) AS pages FROM (SELECT user_id, b AS start FROM w UNION ALL SELECT user_id, b - INTERVAL 5 MINUTE FROM w) GROUP BY start""")
def r14(spark, d):
    return R.edit_statistics(table(spark, d, "events").select(F.col("user_id").alias("key"), "ts"))
