"""Infobox and mapping operators over pages written from the star schema, so that the tables say what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from factweave.functions import cascade as C
from factweave.functions import units as U
from factweave.operators import infobox as I
from factweave.operators import mapping as M
from factweave.plans.registry import query, table

B, P, O = "http://example.org/resource/", "http://example.org/property/", "http://example.org/ontology/"
_X = C.XSD


def customer_pages(spark, d):
    """One page a customer: an infobox, and a second template with an address.

    A row of some bytes becomes a page, so a file that Spark reads in one task holds pages for many: rows are dealt before.
    """
    c = table(spark, d, "customer").repartition(4 * spark.sparkContext.defaultParallelism, "c_custkey")
    source = F.format_string(
        "Intro text.\n{{Infobox customer\n| customer_name = '''%s'''\n| nation = [[Nation %d|home]]\n| balance = %s\n| segments = %s<br />OTHER\n| height = %d cm\n| active1 = 1990 – 1999\n| where = {{coord|%d|30|0|N|8|15|E}}\n}}\nMore. {{Address | street name = Street %d | city = [[City]]}}",
        "c_name", "c_nationkey", F.format_string("%.2f", "c_acctbal"), "c_mktsegment", "c_custkey", F.pmod("c_custkey", F.lit(80)), F.pmod("c_custkey", F.lit(7)),
    )
    return c.select(F.col("c_custkey").alias("page_id"), F.concat(F.lit("customer "), "c_custkey").alias("title"), source.alias("source"))


_PAGE = f"'{B}Customer_' || c_custkey"


@query("e13_infobox", f"""WITH v AS (SELECT c_custkey AS page_id, {_PAGE} AS s, * FROM customer),
    f AS (SELECT page_id, s, 'customerName' AS p, c_name AS o, 'literal' AS o_kind, NULL::VARCHAR AS datatype FROM v
    UNION ALL SELECT page_id, s, 'nation', '{B}Nation_' || c_nationkey, 'uri', NULL FROM v
    UNION ALL SELECT page_id, s, 'balance', printf('%.2f', c_acctbal), 'literal', '{_X}decimal' FROM v
    UNION ALL SELECT page_id, s, 'segments', c_mktsegment || ' OTHER', 'literal', NULL FROM v
    UNION ALL SELECT page_id, s, 'height', c_custkey::VARCHAR, 'literal', 'centimetre' FROM v
    UNION ALL SELECT page_id, s, 'active', '1990 – 1999', 'literal', NULL FROM v
    UNION ALL SELECT page_id, s, 'where', s || '/where/coord', 'uri', NULL FROM v
    UNION ALL SELECT page_id, s, 'streetName', 'Street ' || c_custkey % 7, 'literal', NULL FROM v
    UNION ALL SELECT page_id, s, 'city', '{B}City', 'uri', NULL FROM v)
    SELECT page_id, s, p, o, o_kind, datatype FROM f""")
def e13(spark, d):
    t = I.infobox_triples(I.template_properties(customer_pages(spark, d)), "en", B, P)
    return t.where(~F.col("p").endswith("usesTemplate") & ~F.col("s").contains("/where/")).withColumn("p", F.substr("p", F.lit(len(P) + 1)))


@query("x10_x11_template_properties", """SELECT c_custkey AS page_id, template, ordinal, key, value FROM customer, (VALUES ('Infobox customer', 0, 'height'), ('coord', 0, '1'), ('coord', 0, '4'), ('Address', 1, 'street name')) AS k(template, ordinal, key),
    LATERAL (SELECT CASE key WHEN 'height' THEN c_custkey || ' cm' WHEN '1' THEN (c_custkey % 80)::VARCHAR WHEN '4' THEN 'N' ELSE 'Street ' || c_custkey % 7 END AS value)""")
def x10(spark, d):
    t = I.template_properties(customer_pages(spark, d))
    return t.where(F.col("key").isin("height", "street name") | ((F.col("template") == "coord") & F.col("key").isin("1", "4"))).select("page_id", "template", "ordinal", "key", "value")


def _tables(spark):
    templates = spark.createDataFrame([("Infobox customer", "Buyer", None, None), ("Address", "Place", "Agent", "addressOf")], "template string, class string, corr_class string, corr_property string")
    rules = spark.createDataFrame(
        [
            ("Infobox customer", "customer_name", "simple", "name", None, None, None, None), ("Infobox customer", "nation", "simple", "country", None, None, None, None),
            ("Infobox customer", "balance", "simple", "balance", None, None, None, None), ("Infobox customer", "segments", "node", "segment", None, "label", "Segment", None),
            ("Infobox customer", "height", "simple", "height", None, None, None, "Length"), ("Infobox customer", "active1", "interval", "activeStart", None, "activeEnd", None, None),
            ("Infobox customer", "where", "geo", None, None, None, None, None), ("Address", "city", "simple", "city", None, None, None, None),
        ],
        "template string, key string, kind string, property string, key2 string, property2 string, node_class string, unit string",
    )
    ontology = spark.createDataFrame(
        [("name", "string", True), ("country", "object", False), ("balance", "double", True), ("label", "string", False), ("height", "metre", True), ("activeStart", "gYear", True), ("activeEnd", "gYear", True), ("city", "object", False), ("segment", "object", False)],
        "property string, range string, functional boolean",
    )
    ancestors = spark.createDataFrame([("Buyer", "Buyer"), ("Buyer", "Agent"), ("Buyer", "Thing"), ("Agent", "Agent"), ("Agent", "Thing"), ("Place", "Place"), ("Place", "Thing"), ("Thing", "Thing")], "class string, ancestor string")
    return templates, rules, ontology, ancestors


@query("e22_e30_e34_mapping", f"""WITH v AS (SELECT c_custkey AS page_id, {_PAGE} AS s, {_PAGE} || '__Street_' || c_custkey % 7 AS a, * FROM customer),
    n AS (SELECT v.*, k, CASE k WHEN 1 THEN c_mktsegment ELSE 'OTHER' END AS part, s || '__Segments__' || k AS sub FROM v, (VALUES (1), (2)) AS t(k)),
    g AS (SELECT v.*, printf('%.8f', c_custkey % 80 + 0.5) AS lat FROM v)
    SELECT page_id, s, 'rdf:type' AS p, '{O}' || c AS o, 'uri' AS o_kind, NULL::VARCHAR AS datatype FROM v, (VALUES ('Buyer'), ('Agent'), ('Thing')) AS t(c)
    UNION ALL SELECT page_id, a, 'rdf:type', '{O}' || c, 'uri', NULL FROM v, (VALUES ('Place'), ('Thing')) AS t(c)
    UNION ALL SELECT page_id, a, '{O}addressOf', s, 'uri', NULL FROM v UNION ALL SELECT page_id, a, '{O}city', '{B}City', 'uri', NULL FROM v
    UNION ALL SELECT page_id, s, '{O}name', c_name, 'literal', '{_X}string' FROM v UNION ALL SELECT page_id, s, '{O}country', '{B}Nation_' || c_nationkey, 'uri', NULL FROM v
    UNION ALL SELECT page_id, s, '{O}activeStart', '1990', 'literal', '{_X}gYear' FROM v UNION ALL SELECT page_id, s, '{O}activeEnd', '1999', 'literal', '{_X}gYear' FROM v
    UNION ALL SELECT page_id, s, '{O}segment', sub, 'uri', NULL FROM n UNION ALL SELECT page_id, sub, 'rdf:type', '{O}Segment', 'uri', NULL FROM n UNION ALL SELECT page_id, sub, '{O}label', part, 'literal', '{_X}string' FROM n
    UNION ALL SELECT page_id, s, 'geo:lat', lat, 'literal', '{_X}double' FROM g UNION ALL SELECT page_id, s, 'geo:long', '8.25000000', 'literal', '{_X}double' FROM g UNION ALL SELECT page_id, s, 'georss:point', lat || ' 8.25000000', 'literal', NULL FROM g""")
def e22(spark, d):
    """All rules but those whose numbers are rendered (see the next query)."""
    t = M.map_pages(I.template_properties(customer_pages(spark, d)), *_tables(spark), "en", B, O)
    return t.where(~F.col("p").isin(O + "balance", O + "height"))


@query("e31_mapped_numbers", f"SELECT c_custkey AS page_id, '{O}balance' AS p, round(c_acctbal, 2) AS value, '{_X}double' AS datatype FROM customer UNION ALL SELECT c_custkey, '{O}height', c_custkey / 100.0, 'metre' FROM customer")
def e31(spark, d):
    t = M.map_pages(I.template_properties(customer_pages(spark, d)), *_tables(spark), "en", B, O)
    return t.where(F.col("p").isin(O + "balance", O + "height")).select("page_id", "p", F.col("o").cast("double").alias("value"), "datatype")


@query("e23_unmapped", "SELECT 'Address' AS template, 'street name' AS key, count(*) AS n FROM customer")
def e23(spark, d):
    templates, rules, _, _ = _tables(spark)
    return M.unmapped(I.template_properties(customer_pages(spark, d)), templates, rules)


@query("e35_redirects", "WITH RECURSIVE r(source, target) AS (SELECT p_partkey, p_partkey - 1 FROM part WHERE p_partkey % 10 <> 0 UNION ALL SELECT r.source, r.target - 1 FROM r WHERE r.target % 10 <> 0) SELECT source, target FROM r WHERE target % 10 = 0")
def e35(spark, d):
    return M.resolve_redirects(table(spark, d, "part").where("p_partkey % 10 != 0").select(F.col("p_partkey").alias("source"), (F.col("p_partkey") - 1).alias("target")))


@query("n6_quantities", "SELECT p_partkey, p_size::DOUBLE AS value, CASE p_partkey % 3 WHEN 0 THEN 'kilometre' WHEN 1 THEN 'squareMile' ELSE 'centimetre' END AS unit FROM part WHERE p_partkey % 3 < 2 UNION ALL SELECT p_partkey, p_size * 30.48 + 2 * 2.54, 'centimetre' FROM part WHERE p_partkey % 3 = 2")
def n6(spark, d):
    size = F.col("p_size").cast("string")
    text = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("{{convert|"), size, F.lit("|km|mi}}"))).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("about "), size, F.lit(" sqmi (more)"))).otherwise(F.concat(size, F.lit(" ft 2 in")))
    return table(spark, d, "part").select("p_partkey", C.quantity(text, F.lit("en")).alias("q")).select("p_partkey", "q.value", "q.unit")


@query("n15_two_hop", "SELECT p_partkey, p_size * 1609.344 / 1000 AS km, (p_size + 459.67) * 5 / 9 - 273.15 AS celsius FROM part")
def n15(spark, d):
    s = F.col("p_size").cast("double")
    hop = lambda a, b: U.from_standard(U.to_standard(s, F.lit(a)), F.lit(b))
    return table(spark, d, "part").select("p_partkey", hop("mile", "kilometre").alias("km"), hop("degreeFahrenheit", "degreeCelsius").alias("celsius"))


@query("e13a_value_cascade", f"""SELECT p_partkey, o, 'literal' AS o_kind, datatype FROM part, LATERAL (VALUES (p_size::VARCHAR, '{_X}integer'), ('1234' || lpad(p_size::VARCHAR, 3, '0'), '{_X}integer'), (p_size || '000000', '{_X}integer'), (p_size::VARCHAR, 'rank'), (p_size::VARCHAR, 'percent'), (p_size::VARCHAR, 'euro'), ('2001-05-' || lpad((1 + p_size % 28)::VARCHAR, 2, '0'), '{_X}date'), (p_name, NULL)) AS t(o, datatype)""")
def e13a(spark, d):
    size = F.col("p_size").cast("string")
    texts = F.array(size, F.concat(F.lit("1,234,"), F.lpad(size, 3, "0")), F.concat(size, F.lit(" million")), F.concat(size, F.lit("th")), F.concat(size, F.lit(" %")), F.concat(F.lit("€"), size), F.concat((F.col("p_size") % 28 + 1).cast("string"), F.lit(" May 2001")), F.concat(F.lit("'''"), "p_name", F.lit("'''")))
    t = table(spark, d, "part").select("p_partkey", F.explode(texts).alias("text"))
    return t.select("p_partkey", F.explode(C.typed_values(F.col("text"), F.lit("en"), B)).alias("v")).select("p_partkey", "v.*")
