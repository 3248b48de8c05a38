"""Twins, images, places, beginnings, redirects, schema pages and external tables, on pages written from tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from factweave.operators import extractors as E
from factweave.operators import external as V
from factweave.plans.registry import query, table

B = "http://r/"


def _suppliers(spark, d, source):
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("page_id"), F.concat(F.lit("supplier "), "s_suppkey").alias("title"), F.lit(0).alias("ns"), source.alias("source"))


_S = f"'{B}Supplier_' || s_suppkey"


@query("e10_twins", f"SELECT s_suppkey AS page_id, {_S} AS s, 'sameAs' AS p, 'http://' || CASE s_nationkey % 3 WHEN 0 THEN 'de' ELSE 'fr' END || '.r/N_' || s_nationkey AS o FROM supplier WHERE s_nationkey % 3 < 2")
def e10(spark, d):
    """German and French twins; a third language has no base."""
    links = table(spark, d, "supplier").select(F.col("s_suppkey").alias("page_id"), F.get(F.array(F.lit("de"), F.lit("fr"), F.lit("ko")), F.col("s_nationkey") % 3).alias("lang"), F.concat(F.lit("n "), "s_nationkey").alias("title"))
    return E.twins(links, _suppliers(spark, d, F.lit("")), B, {"de": "http://de.r/", "fr": "http://fr.r/"}).select("page_id", "s", "p", "o")


@query("e11_image_facts", f"""WITH i AS (SELECT s_suppkey, 'Pic_' || s_nationkey || '.svg' AS f FROM supplier WHERE s_nationkey % 4 <> 1), u AS (SELECT *, 'http://f/' || left(md5(f), 1) || '/' || left(md5(f), 2) || '/' || f AS a, 'http://f/thumb/' || left(md5(f), 1) || '/' || left(md5(f), 2) || '/' || f || '/90px-' || f || '.png' AS b, 'http://w/wiki/Image:' || f AS r FROM i)
    SELECT s_suppkey AS page_id, x.s, x.p, x.o FROM u, LATERAL (VALUES ({_S}, 'depiction', a), (a, 'thumbnail', b), ({_S}, 'pageThumbnail', b), (b, 'rights', r), (a, 'rights', r)) AS x(s, p, o)""")
def e11(spark, d):
    nonfree = table(spark, d, "nation").where("n_nationkey % 4 = 1").select(F.concat(F.lit("Pic_"), "n_nationkey", F.lit(".svg")).alias("file"))
    return E.image_facts(_suppliers(spark, d, F.format_string("[[File:pic %d.svg|90px]] text", "s_nationkey")), nonfree, B, "http://f", "http://w").select("page_id", "s", "p", "o")


@query("e16_place_facts", f"SELECT s_suppkey AS page_id, {_S} AS s, x.p, x.o FROM supplier, LATERAL (VALUES ('lat', (s_nationkey + 0.5)::DOUBLE::VARCHAR), ('long', '-10.25'), ('point', (s_nationkey + 0.5)::DOUBLE::VARCHAR || ' -10.25'), ('featureClass', 'city'), ('population', s_suppkey::VARCHAR)) AS x(p, o)")
def e16(spark, d):
    source = F.format_string("text {{coord|%d|30|N|10|15|W|type:city(%d)|display=title}}", "s_nationkey", "s_suppkey")
    return E.place_facts(_suppliers(spark, d, source), B, True).select("page_id", "s", "p", "o")


@query("e20_abstract_facts", f"SELECT s_suppkey AS page_id, {_S} AS s, x.p, x.o FROM supplier, LATERAL (VALUES ('comment', s_name || ' is one. It is two.'), ('abstract', s_name || ' is one. It is two. Three.')) AS x(p, o)")
def e20(spark, d):
    return E.abstract_facts(_suppliers(spark, d, F.concat(F.lit("{{a|{{b}}}}'''"), "s_name", F.lit("''' is [[one]]. It is two. Three.\n== More ==\ntext"))), B).select("page_id", "s", "p", "o")


@query("e24_superclass_facts", f"SELECT DISTINCT '{B}Order' || l_orderkey AS s, 'sc:' || replace(p_brand, '#', '') AS o FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 48")
def e24(spark, d):
    from factweave.operators.relational import superclass_links

    pages = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_partkey").alias("category"))
    links = superclass_links(pages, table(spark, d, "part").where("p_size > 48").select(F.col("p_partkey").alias("category"), F.col("p_brand").alias("superclass")))
    return links.select(F.concat(F.lit(B + "Order"), "page").alias("s"), F.concat(F.lit("sc:"), "class").alias("o"))


@query("e26_e36_template_redirects", "SELECT n_nationkey AS template_id, 'old_' || s_suppkey AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 3 = 0")
def e26(spark, d):
    """Redirects to known templates; pages of another namespace, and names that are known, give nothing."""
    s = table(spark, d, "supplier")
    pages = s.select(F.concat(F.lit("Template:Old "), "s_suppkey").alias("title"), F.when(F.col("s_suppkey") % 3 == 1, 0).otherwise(10).alias("ns"), F.format_string("#redirect [[Template:Nation %d|x]]", "s_nationkey").alias("source"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("template_id"), F.concat(F.lit("Nation "), "n_nationkey").alias("name"))
    known = n.unionByName(s.where("s_suppkey % 3 = 2").select(F.lit(-1).alias("template_id"), F.concat(F.lit("Old "), "s_suppkey").alias("name")))
    return E.template_redirects(pages, known)


@query("e26_property_statistics", "SELECT l_returnflag AS template, l_linenumber::VARCHAR AS key, count(*) AS uses, count(DISTINCT l_orderkey) AS pages, count(*) FILTER (WHERE l_discount > 0) AS filled FROM lineitem GROUP BY ALL")
def e26_stats(spark, d):
    t = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page_id"), F.col("l_returnflag").alias("template"), F.col("l_linenumber").cast("string").alias("key"), F.when(F.col("l_discount") > 0, "x").otherwise(" ").alias("value"))
    return E.property_statistics(t)


@query("e38_booleans_enumerations", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS b, CASE WHEN contains(p_type, 'BRASS') THEN 'Brass' WHEN contains(p_type, 'STEEL') THEN 'Steel' END AS e FROM part")
def e38(spark, d):
    text = F.when(F.col("p_partkey") % 3 == 0, "Yes, indeed").when(F.col("p_partkey") % 3 == 1, " false").otherwise("unknown")
    return table(spark, d, "part").select("p_partkey", E.parsed_boolean(text).alias("b"), E.parsed_enumeration(F.col("p_type"), {"brass": "Brass", "steel": "Steel"}).alias("e"))


@query("e41_e42_schema_pages", f"""SELECT 'P' || n_nationkey AS source_page, '{B}C' || n_nationkey AS s, x.p, x.o FROM nation, LATERAL (VALUES ('rdf:type', 'owl:Class'), ('rdfs:label', n_name), ('rdfs:subClassOf', '{B}' || CASE n_regionkey WHEN 1 THEN 'One' ELSE 'R' || n_regionkey END)) AS x(p, o)""")
def e41(spark, d):
    """Class pages, one parent renamed."""
    null = F.lit(None).cast("string")
    n = table(spark, d, "nation").select(F.concat(F.lit("P"), "n_nationkey").alias("source_page"), F.concat(F.lit("C"), "n_nationkey").alias("name"), F.lit("class").alias("kind"), F.col("n_name").alias("label"), F.concat(F.lit("R"), "n_regionkey").alias("parent"), null.alias("domain"), null.alias("range"))
    renames = spark.createDataFrame([("R1", "One")], "old string, new string")
    return E.ontology_axioms(E.renamed_definitions(n, renames), B).select("source_page", "s", "p", "o")


@query("v1_wide_regions", "SELECT n_nationkey::VARCHAR AS geocode, n_name AS name, max(c_acctbal) FILTER (WHERE c_mktsegment = 'BUILDING') AS \"BUILDING\", max(c_acctbal) FILTER (WHERE c_mktsegment = 'MACHINERY') AS \"MACHINERY\" FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def v1(spark, d):
    stats = table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("geocode"), F.col("c_mktsegment").alias("indicator"), F.col("c_acctbal").alias("value"))
    return V.wide_regions(stats, table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("geocode"), F.col("n_name").alias("name")), ["BUILDING", "MACHINERY"])


_LETTERS = "translate({}::VARCHAR, '0123456789', 'abcdefghij')"


@query("v3_linked_authors", "SELECT o_orderkey AS book, o_custkey AS person FROM orders JOIN customer ON o_custkey = c_custkey")
def v3(spark, d):
    """Creators as ``Surname, Given, 1800-1870``."""
    letters = lambda c: F.translate(F.col(c).cast("string"), "0123456789", "abcdefghij")
    books = table(spark, d, "orders").select(F.col("o_orderkey").alias("book"), F.concat(F.lit("Mc"), letters("o_custkey"), F.lit(", Jo, 1800-1870")).alias("creator"))
    return V.linked_authors(books, table(spark, d, "customer").select(F.col("c_custkey").alias("person"), F.concat(F.lit("Jo Mc"), letters("c_custkey")).alias("name")))


@query("v4_book_links", "SELECT p_partkey AS page_id, 'http://b/' || x AS o FROM part, LATERAL (VALUES ('0306406152'), ('9780306406157')) AS t(x) WHERE p_partkey % 2 = 0")
def v4(spark, d):
    source = F.when(F.col("p_partkey") % 2 == 0, "a ISBN 0-306-40615-2 b ISBN-13: 978-0-306-40615-7 c isbn 0306406152").otherwise("ISBN 0-306-40615-3")
    return V.book_links(table(spark, d, "part").select(F.col("p_partkey").alias("page_id"), source.alias("source")), "http://b/")


@query("v7_mapping_tables", """WITH c AS (SELECT DISTINCT p_brand AS name FROM part UNION SELECT 'Thing'), k AS (SELECT name, row_number() OVER (ORDER BY name) AS id FROM c)
    SELECT 'class' AS tbl, id::INT AS id, name, CASE WHEN name <> 'Thing' THEN (SELECT id FROM k WHERE name = 'Thing') END::INT AS other FROM k
    UNION ALL SELECT 'template_class', t.template_id::INT, t.uri, k.id::INT FROM (SELECT 'T' || p_brand AS uri, p_brand, row_number() OVER (ORDER BY 'T' || p_brand) AS template_id FROM (SELECT DISTINCT p_brand FROM part)) t JOIN k ON k.name = t.p_brand""")
def v7(spark, d):
    sheet = table(spark, d, "part").select(F.concat(F.lit("T"), "p_brand").alias("template"), F.col("p_brand").alias("class"), F.lit("Thing").alias("parent"), F.concat(F.lit("size"), F.col("p_size") % 3).alias("template_property"), F.lit("size").alias("property"), F.lit("integer").alias("range"), F.lit("cm").alias("unit")).distinct()
    t = V.mapping_tables(sheet)
    classes = t["class"].select(F.lit("class").alias("tbl"), "id", "name", F.col("parent_id").alias("other"))
    links = t["template_class"].join(t["template_uri"], "template_id").select(F.lit("template_class").alias("tbl"), F.col("template_id").alias("id"), F.col("uri").alias("name"), F.col("class_id").alias("other"))
    return classes.unionByName(links)


@query("o2_by_clicks", "SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks, max(ts) AS last FROM events GROUP BY user_id ORDER BY clicks DESC, last DESC, user_id LIMIT 20")
def o2(spark, d):
    """Saved searches by clicks, then by the time they were saved."""
    s = table(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "click").alias("clicks"), F.max("ts").alias("last"))
    return s.orderBy(F.desc("clicks"), F.desc("last"), "user_id").limit(20)


@query("o6_sorted_statistics", "SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL ORDER BY lang, source")
def o6(spark, d):
    return table(spark, d, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")).orderBy("lang", "source")


@query("a10_time_shares", "SELECT event_type, sum(value) AS total, sum(value) / (SELECT sum(value) FROM events) * 100 AS share FROM events GROUP BY event_type")
def a10(spark, d):
    """Time a component and its percentage of the whole."""
    t = table(spark, d, "events").groupBy("event_type").agg(F.sum("value").alias("total"))
    return t.join(F.broadcast(t.agg(F.sum("total").alias("whole")))).select("event_type", "total", (F.col("total") / F.col("whole") * 100).alias("share"))  # a row a component
