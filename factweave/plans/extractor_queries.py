"""Extractors, sinks, class expressions and quality categories, over pages and records written from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from factweave.operators import expressions as C
from factweave.operators import extractors as E
from factweave.operators import quality as Z
from factweave.plans.registry import query, table
from factweave.sources import writers as K

B = "http://example.org/resource/"
_S = f"'{B}Supplier_' || s_suppkey"


def supplier_pages(spark, d, source, ns=0, title=None):
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("page_id"), F.lit(ns).alias("ns"), (F.concat(F.lit("supplier "), "s_suppkey") if title is None else title).alias("title"), source.alias("source"))


@query("e4_article_categories", f"SELECT s_suppkey AS page_id, {_S} AS s, 'subject' AS p, '{B}Category:' || c AS o, 'uri' AS o_kind, NULL::VARCHAR AS datatype FROM supplier, LATERAL (VALUES ('Nation_' || s_nationkey), ('All')) AS t(c)")
def e4(spark, d):
    source = F.format_string("x [[Category:nation %d|%s]] y [[Category:All]] z [[Category:All]]", "s_nationkey", "s_name")
    return E.article_categories(supplier_pages(spark, d, source), B)


@query("e5_skos_categories", f"SELECT s_suppkey AS page_id, '{B}Category:C' || s_suppkey AS s, p, o, k AS o_kind, NULL::VARCHAR AS datatype FROM supplier, LATERAL (VALUES ('prefLabel', 'C' || s_suppkey, 'literal'), ('type', 'Concept', 'uri'), ('broader', '{B}Category:Nation_' || s_nationkey, 'uri'), ('broader', '{B}Category:Top', 'uri')) AS t(p, o, k)")
def e5(spark, d):
    source = F.format_string("[[Category:Nation_%d| ]] and [[Category:top]]", "s_nationkey")
    return E.skos_categories(supplier_pages(spark, d, source, 14, F.concat(F.lit("Category:C"), "s_suppkey")), B)


@query("e7_disambiguation", f"SELECT s_suppkey AS page_id, {_S} || '_%28disambiguation%29' AS s, 'disambiguates' AS p, {_S} || '_Ltd' AS o, 'uri' AS o_kind, NULL::VARCHAR AS datatype FROM supplier WHERE s_suppkey % 2 = 0")
def e7(spark, d):
    source = F.format_string("* [[supplier %d Ltd|x]]\n* [[Other]] %s", "s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, "{{Disambig}}").otherwise(""))
    return E.disambiguations(supplier_pages(spark, d, source, title=F.concat(F.lit("supplier "), "s_suppkey", F.lit(" (disambiguation)"))), B)


@query("e12_homepage", f"SELECT s_suppkey AS page_id, {_S} AS s, 'homepage' AS p, CASE s_suppkey % 2 WHEN 0 THEN 'http://named.org/' ELSE 'http://official.org/' END || s_suppkey AS o, 'uri' AS o_kind, NULL::VARCHAR AS datatype FROM supplier")
def e12(spark, d):
    named = F.format_string("{{Infobox|name=a| Website = [http://named.org/%d site]}}", "s_suppkey")
    listed = F.format_string("text [http://no.org official]\n== External links ==\n* [http://x.org blog]\n* [http://official.org/%d The Official site]\n== Notes ==", "s_suppkey")
    return E.homepage(supplier_pages(spark, d, F.when(F.col("s_suppkey") % 2 == 0, named).otherwise(listed)), B)


@query("e14_persondata", f"""SELECT s_suppkey AS page_id, {_S} AS s, p, o, k AS o_kind, t AS datatype FROM supplier, LATERAL (VALUES ('name', 'Doe, J' || s_suppkey, 'literal', NULL), ('givenName', 'J' || s_suppkey, 'literal', NULL), ('surname', 'Doe', 'literal', NULL),
    ('description', 'seller', 'literal', NULL), ('birth', '1950-03-0' || (1 + s_suppkey % 9), 'literal', 'date'), ('birthPlace', '{B}Nation_' || s_nationkey, 'uri', NULL), ('type', 'Person', 'uri', NULL)) AS f(p, o, k, t)""")
def e14(spark, d):
    source = F.format_string("a {{Persondata\n| NAME = Doe, J%d\n| SHORT DESCRIPTION = seller\n| DATE OF BIRTH = [[%d March]] [[1950]]\n| PLACE OF BIRTH = [[nation %d|home]]\n| DATE OF DEATH =\n| PLACE OF DEATH =\n}} b", "s_suppkey", F.pmod("s_suppkey", F.lit(9)) + 1, "s_nationkey")
    return E.persondata(supplier_pages(spark, d, source), B)


@query("e15_authority_ids", f"""SELECT s_suppkey AS page_id, {_S} AS s, p, o, 'literal' AS o_kind, NULL::VARCHAR AS datatype FROM supplier, LATERAL (SELECT * FROM (VALUES (0, 'individualisedPnd', lpad(s_suppkey::VARCHAR, 9, '1')), (1, 'individualisedPnd', lpad(s_suppkey::VARCHAR, 9, '2')), (1, 'nonIndividualisedPnd', lpad(s_suppkey::VARCHAR, 9, '3')), (2, 'nonIndividualisedPnd', lpad(s_suppkey::VARCHAR, 9, '4'))) AS t(m, p, o) WHERE m = s_suppkey % 3)""")
def e15(spark, d):
    n = lambda c: F.lpad(F.col("s_suppkey").cast("string"), 9, c)
    kind = F.col("s_suppkey") % 3
    source = F.when(kind == 0, F.concat(F.lit("{{Normdaten|TYP=p|PND="), n("1"), F.lit("}}"))).when(kind == 1, F.concat(F.lit("{{PND|"), n("2"), F.lit("|"), n("3"), F.lit("}}"))).otherwise(F.concat(F.lit("{{PNDfehlt|"), n("4"), F.lit("}} {{PND|123}}")))
    return E.authority_ids(supplier_pages(spark, d, source), B)


@query("e25_meta_information", f"""SELECT o_orderkey AS page_id, '{B}Order_' || o_orderkey AS s, p, o, k AS o_kind, t AS datatype FROM orders, LATERAL (VALUES ('modified', strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ'), 'literal', 'dateTime'), ('oaiIdentifier', o_custkey::VARCHAR, 'literal', 'integer'),
    ('revision', 'http://w.org/w/index.php?title=order_' || o_orderkey || '&oldid=' || o_custkey, 'uri', NULL), ('editLink', 'http://w.org/w/index.php?title=order_' || o_orderkey || '&action=edit', 'uri', NULL)) AS f(p, o, k, t)""")
def e25(spark, d):
    r = table(spark, d, "orders").select(F.col("o_orderkey").alias("page_id"), F.concat(F.lit("order "), "o_orderkey").alias("title"), F.col("o_custkey").alias("oai_id"), F.col("o_custkey").alias("revision"), F.col("o_orderdate").alias("modified"))
    return E.meta_information(r, B, "http://w.org")


@query("e39_semantic_links", f"SELECT s_suppkey AS page_id, {_S} AS s, p, o, k AS o_kind, NULL::VARCHAR AS datatype FROM supplier, LATERAL (VALUES ('located in', '{B}Nation_' || s_nationkey, 'uri'), ('label', s_name, 'literal')) AS t(p, o, k)")
def e39(spark, d):
    return E.semantic_links(supplier_pages(spark, d, F.format_string("[[located_in::nation %d]] [[plain]] [[label:= %s]]", "s_nationkey", "s_name")), B)


@query("k12_insert_statements", "SELECT 'INSERT INTO nation (n_nationkey,n_name) VALUES ' AS head, (SELECT count(*) FROM nation) AS n, sum(length('(' || n_nationkey || ',''' || n_name || '\\''s'')'))::BIGINT AS bytes FROM nation")
def k12(spark, d):
    """Rows are counted and measured in the statements themselves; blocks depend on partitions."""
    n = table(spark, d, "nation").select("n_nationkey", F.concat("n_name", F.lit("'s")).alias("n_name"))
    tuples = K.insert_statements(n, "nation").select(F.regexp_extract("value", r"^(.*? VALUES )", 1).alias("head"), F.explode(F.regexp_extract_all("value", F.lit(r"(\([0-9]+,'(?:[^'\\]|\\.)*'\))"), F.lit(1))).alias("t"))
    return tuples.groupBy("head").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("t")).alias("bytes"))


def _histories(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_custkey").alias("page_id"), F.concat(F.lit("c & "), "o_custkey").alias("title"), F.col("o_orderkey").alias("ordinal"), F.col("o_orderkey").alias("rev_id"), F.col("o_orderdate").alias("ts"), F.concat(F.lit("<"), "o_orderpriority").alias("text"))


@query("k13_index_documents", "SELECT '<document><id>' || o_custkey || '</id><group>0</group><timestamp>' || epoch(o_orderdate)::BIGINT || '</timestamp><title>c &amp; ' || o_custkey || '</title><body>&lt;' || o_orderpriority || '</body></document>' AS value FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1")
def k13(spark, d):
    return K.index_documents(_histories(spark, d))


@query("k9_page_export", "SELECT '<page><title>c &amp; ' || o_custkey || '</title><id>' || o_custkey || '</id>' || string_agg('<revision><id>' || o_orderkey || '</id><timestamp>' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '</timestamp><text>&lt;' || o_orderpriority || '</text></revision>', '' ORDER BY o_orderkey) || '</page>' AS value FROM orders GROUP BY o_custkey")
def k9(spark, d):
    return K.page_export(_histories(spark, d))


@query("k17_class_tree", "SELECT ' \"' || n_name || '\" -> \"' || r_name || '\";' AS value FROM nation JOIN region ON n_regionkey = r_regionkey")
def k17(spark, d):
    regions = table(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("label"))
    return K.class_tree(table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id"), F.col("n_name").alias("label")).unionByName(regions))


@query("k16_owl_elements", f"""SELECT '<owl:Class rdf:about="{B}N' || n_nationkey || '"><rdfs:label xml:lang="en">' || n_name || '</rdfs:label><rdfs:subClassOf rdf:resource="{B}R' || n_regionkey || '"/></owl:Class>' AS value FROM nation
    UNION ALL SELECT '<owl:ObjectProperty rdf:about="{B}in' || r_regionkey || '"><rdfs:domain rdf:resource="{B}N1"/><rdfs:range rdf:resource="{B}R' || r_regionkey || '"/></owl:ObjectProperty>' FROM region""")
def k16(spark, d):
    null = F.lit(None).cast("string")
    c = table(spark, d, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("name"), F.col("n_name").alias("label"), F.concat(F.lit("R"), "n_regionkey").alias("parent"), null.alias("equivalent"))
    p = table(spark, d, "region").select(F.concat(F.lit("in"), "r_regionkey").alias("name"), null.alias("label"), F.lit("object").alias("kind"), F.lit("N1").alias("domain"), F.concat(F.lit("R"), "r_regionkey").alias("range"), F.lit(False).alias("functional"))
    return K.owl_elements(c.unionByName(c.limit(1).withColumn("name", F.lit("owl:Thing"))), p, B)


@query("x29_class_expressions", f"""SELECT 'N' || n_nationkey AS name, NULL::VARCHAR AS error, s, p, o, k AS o_kind FROM nation, LATERAL (VALUES
    ('{B}N' || n_nationkey, 'rdfs:subClassOf', '_:N' || n_nationkey || 'x2', 'bnode'), ('_:N' || n_nationkey || 'x2', 'rdf:type', 'owl:Class', 'uri'), ('_:N' || n_nationkey || 'x2', 'owl:intersectionOf', '_:N' || n_nationkey || 'x4', 'bnode'),
    ('_:N' || n_nationkey || 'x1', 'rdf:type', 'owl:Restriction', 'uri'), ('_:N' || n_nationkey || 'x1', 'owl:onProperty', '{B}in', 'uri'), ('_:N' || n_nationkey || 'x1', 'owl:someValuesFrom', '{B}R' || n_regionkey, 'uri'),
    ('_:N' || n_nationkey || 'x4', 'rdf:first', '{B}Nation', 'uri'), ('_:N' || n_nationkey || 'x4', 'rdf:rest', '_:N' || n_nationkey || 'x3', 'bnode'), ('_:N' || n_nationkey || 'x3', 'rdf:first', '_:N' || n_nationkey || 'x1', 'bnode'), ('_:N' || n_nationkey || 'x3', 'rdf:rest', 'rdf:nil', 'uri')) AS t(s, p, o, k)
    UNION ALL SELECT 'R' || r_regionkey, ') expected at token 2, found the end', NULL, NULL, NULL, NULL FROM region""")
def x29(spark, d):
    n = table(spark, d, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("name"), F.concat(F.lit("Nation and (in some R"), "n_regionkey", F.lit(")")).alias("expression"))
    broken = table(spark, d, "region").select(F.concat(F.lit("R"), "r_regionkey").alias("name"), F.lit("(Broken").alias("expression"))
    return C.class_axioms(n.unionByName(broken), B)


@query("z5_pattern_counts", "SELECT o_custkey AS snippet, 'Date*' || count(*) || ' Integer*' || count(*) || ' Resource*' || count(*) || ' String*' || count(*) AS pattern, (4 * count(*))::BIGINT AS triples FROM orders GROUP BY o_custkey")
def z5(spark, d):
    o = table(spark, d, "orders")
    x = "^^<http://www.w3.org/2001/XMLSchema#"
    objects = F.array(F.concat(F.lit('"'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(f'"{x}date>')), F.concat(F.lit('"'), "o_orderkey", F.lit(f'"{x}integer>')), F.concat(F.lit(f"<{B}"), "o_orderkey", F.lit(">")), F.concat(F.lit('"'), "o_orderpriority", F.lit('"@en')))
    return Z.pattern_counts(o.select(F.col("o_custkey").alias("snippet"), F.explode(objects).alias("o")), "snippet", B)


@query("z6_relevant_triples", "SELECT l_orderkey || CASE WHEN l_linenumber > 1 THEN '__' || l_linenumber ELSE '' END AS s, l_partkey AS o FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def z6(spark, d):
    t = table(spark, d, "lineitem").select(F.concat(F.col("l_orderkey").cast("string"), F.when(F.col("l_linenumber") > 1, F.concat(F.lit("__"), "l_linenumber")).otherwise("")).alias("s"), F.col("l_partkey").alias("o"))
    return Z.relevant(t, table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("s")))
