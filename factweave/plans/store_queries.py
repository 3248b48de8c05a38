"""Sources and sinks: what they read and write, on pages and revisions made from tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from factweave.plans.registry import query, table
from factweave.sources import readers as S
from factweave.sources import writers as K


def _pages(spark, d):
    t = table(spark, d, "documents")
    return t.select(F.col("doc_id").alias("page_id"), F.when(F.col("doc_id") % 3 == 0, 14).when(F.col("doc_id") % 3 == 1, 10).otherwise(0).alias("ns"), F.col("source").alias("title"), (F.col("n_chars") % 4 == 0).alias("is_redirect"))


_SETS = "SELECT doc_id AS page_id, CASE doc_id % 3 WHEN 0 THEN 14 WHEN 1 THEN 10 ELSE 0 END AS ns, source AS title, n_chars % 4 = 0 AS r FROM documents"


@query("s6a_d_title_sets", f"""SELECT 'all articles' AS which, page_id, title FROM ({_SETS}) WHERE ns = 0 UNION ALL SELECT 'articles', page_id, title FROM ({_SETS}) WHERE ns = 0 AND NOT r
    UNION ALL SELECT 'categories', page_id, 'Category:' || title FROM ({_SETS}) WHERE ns = 14 AND NOT r UNION ALL SELECT 'all templates', page_id, 'Template:' || title FROM ({_SETS}) WHERE ns = 10
    UNION ALL SELECT 'templates', page_id, 'Template:' || title FROM ({_SETS}) WHERE ns = 10 AND NOT r""")
def s6(spark, d):
    out = None
    for which in S.PAGE_SETS:
        one = S.titles(_pages(spark, d), which).select(F.lit(which).alias("which"), "page_id", "title")
        out = one if out is None else out.unionByName(one)
    return out


@query("s6a_twins", f"SELECT p.page_id, 't' || quality AS title FROM ({_SETS}) p JOIN labels ON doc_id = page_id WHERE ns = 0 AND toxic = 0")
def s6_twins(spark, d):
    links = table(spark, d, "labels").select(F.col("doc_id").alias("page_id"), F.when(F.col("toxic") == 0, "en").otherwise("fr").alias("lang"), F.concat(F.lit("t"), "quality").alias("title"))
    return S.titles(_pages(spark, d), "all articles", links, "en")


@query("s7_page_source", "SELECT o_orderkey AS page_id, o_orderstatus AS title, c_name AS text FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey = 7")
def s7(spark, d):
    pages = table(spark, d, "orders").select(F.col("o_orderkey").alias("page_id"), F.col("o_orderstatus").alias("title"), F.col("o_custkey").alias("latest"))
    return S.page_source(pages, table(spark, d, "customer").select(F.col("c_custkey").alias("text_id"), F.col("c_name").alias("text")), 7)


@query("s16_xpath_rows", "SELECT o_custkey, o_orderkey::VARCHAR AS found, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1)::INT AS n FROM orders")
def s16(spark, d):
    x = F.concat(F.lit('<o k="'), "o_orderkey", F.lit('"/>'))
    docs = table(spark, d, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", x.alias("x")))).alias("r"))
    return S.xpath_rows(docs.select("o_custkey", F.concat(F.lit("<r>"), F.array_join("r.x", ""), F.lit("</r>")).alias("value")), "/r/o/@k").select("o_custkey", "n", "found")


@query("s18_sparql_json", "SELECT 'n' || n_nationkey AS s, 'name' AS p, n_name AS o, 'literal' AS o_kind, NULL::VARCHAR AS datatype, 'en' AS lang FROM nation UNION ALL SELECT 'n' || n_nationkey, 'in', 'r' || n_regionkey, 'uri', NULL, NULL FROM nation")
def s18(spark, d):
    """Two answers a nation and one in a language that is not asked for."""
    text = F.format_string(
        '{"head": {}, "results": {"bindings": [{"s": {"type": "uri", "value": "n%d"}, "p": {"type": "uri", "value": "name"}, "o": {"type": "literal", "xml:lang": "en", "value": "%s"}}, '
        '{"s": {"type": "uri", "value": "n%d"}, "p": {"type": "uri", "value": "name"}, "o": {"type": "literal", "xml:lang": "fr", "value": "x"}}, '
        '{"s": {"type": "uri", "value": "n%d"}, "p": {"type": "uri", "value": "in"}, "o": {"type": "uri", "value": "r%d"}}]}}', "n_nationkey", "n_name", "n_nationkey", "n_nationkey", "n_regionkey")
    return S.sparql_json(table(spark, d, "nation").select(text.alias("value")), lang="en")


@query("s19_sparql_xml", "SELECT n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'r' || n_regionkey END AS region FROM nation")
def s19(spark, d):
    region = F.when(F.col("n_nationkey") % 2 == 0, F.format_string('<binding name="region"><uri>r%d</uri></binding>', "n_regionkey")).otherwise("")
    text = F.concat(F.lit('<sparql><results><result><binding name="name"><literal xml:lang="en">'), "n_name", F.lit("</literal></binding>"), region, F.lit("</result></results></sparql>"))
    return S.sparql_xml(table(spark, d, "nation").select(text.alias("value")), ["name", "region"])


@query("s23_v2_factbook", "SELECT n_nationkey, n_name AS name, 1000.0 * (n_nationkey + 1) AS area, 'Land ' || (n_nationkey + 1) AS neighbour, 10.5 + n_nationkey AS km FROM nation UNION ALL SELECT n_nationkey, n_name, 1000.0 * (n_nationkey + 1), 'Old Sea', 1784 FROM nation")
def s23(spark, d):
    text = F.format_string('<country name="%s"><geo><area> %d,000 </area><bounds>Land %d %s km, Old Sea 1,784 km</bounds></geo></country>', "n_name", F.col("n_nationkey") + 1, F.col("n_nationkey") + 1, F.col("n_nationkey") + 10.5)
    t = S.xml_columns(table(spark, d, "nation").select("n_nationkey", text.alias("value")), {"name": "/country/@name", "area": "/country/geo/area", "bounds": "/country/geo/bounds"}, "n_nationkey")
    return t.join(S.borders(t, "n_nationkey", "bounds"), "n_nationkey").select("n_nationkey", "name", S.number_or_null("area").alias("area"), "neighbour", "km")


@query("s27_namespaces", "SELECT n_nationkey - 2 AS ns, CASE WHEN n_nationkey = 2 THEN '' ELSE n_name END AS name FROM nation")
def s27(spark, d):
    one = F.when(F.col("n_nationkey") == 2, F.lit('<namespace key="0" case="first-letter" />')).otherwise(F.format_string('<namespace key="%d" case="first-letter">%s</namespace>', F.col("n_nationkey") - 2, "n_name"))
    site = table(spark, d, "nation").agg(F.concat(F.lit("<siteinfo><namespaces>"), F.array_join(F.collect_list(one), "\n"), F.lit("</namespaces></siteinfo>")).alias("value"))
    return S.namespaces_of(site)


def _revisions(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_custkey").alias("page_id"), F.lit(0).alias("ns"), F.concat(F.lit("page "), "o_custkey").alias("title"), F.col("o_orderkey").alias("ordinal"), F.col("o_orderkey").alias("rev_id"), F.col("o_orderdate").alias("ts"), F.concat("o_orderpriority", F.lit(" é")).alias("text"))


_LAST = "SELECT *, o_orderkey = max(o_orderkey) OVER (PARTITION BY o_custkey) AS last, strftime(o_orderdate, '%Y%m%d%H%M%S') AS st FROM orders"


@query("k10_sql_current_old", f"SELECT CASE WHEN last THEN 'cur' ELSE 'old' END AS tbl, CASE WHEN last THEN o_custkey ELSE o_orderkey END AS id, 0 AS ns, 'page_' || o_custkey AS title, o_orderpriority || ' é' AS text, st AS timestamp, translate(st, '0123456789', '9876543210') AS inverse FROM ({_LAST})")
def k10(spark, d):
    """The rows of both tables."""
    cur, old = K.current_and_old_rows(_revisions(spark, d))
    return cur.toDF("id", "ns", "title", "text", "timestamp", "inverse").withColumn("tbl", F.lit("cur")).unionByName(old.toDF("id", "ns", "title", "text", "timestamp", "inverse").withColumn("tbl", F.lit("old")))


@query("k11_page_rows", f"""SELECT 'page' AS tbl, o_custkey AS id, 'page_' || o_custkey AS a, o_orderkey AS b, octet_length(encode(o_orderpriority || ' é')) AS n FROM ({_LAST}) WHERE last
    UNION ALL SELECT 'revision', o_orderkey, st, o_custkey, 0 FROM ({_LAST}) UNION ALL SELECT 'text', o_orderkey, o_orderpriority || ' é', 0, 0 FROM orders""")
def k11(spark, d):
    """The rows of the three tables, under common names."""
    page, revision, text = K.page_revision_text_rows(_revisions(spark, d))
    zero = F.lit(0).cast("long")
    rows = page.select(F.lit("page").alias("tbl"), F.col("page_id").alias("id"), F.col("page_title").alias("a"), F.col("page_latest").alias("b"), F.col("page_len").cast("long").alias("n"))
    rows = rows.unionByName(revision.select(F.lit("revision").alias("tbl"), F.col("rev_id").alias("id"), F.col("rev_timestamp").alias("a"), F.col("rev_page").alias("b"), zero.alias("n")))
    return rows.unionByName(text.select(F.lit("text").alias("tbl"), F.col("old_id").alias("id"), F.col("old_text").alias("a"), zero.alias("b"), zero.alias("n")))


@query("k4_routing", "SELECT 'o' || l_orderkey AS s, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE 'other' END AS dataset FROM lineitem")
def k4(spark, d):
    t = table(spark, d, "lineitem").select(F.concat(F.lit("o"), "l_orderkey").alias("s"), F.col("l_returnflag").alias("extractor_id"))
    return K.routed(t, {"A": "accepted", "R": "returned"}, "other").drop("extractor_id")


@query("k2_decoded", "SELECT 'http://x/' || replace(p_name, ' ', '_') || '/é' AS s, 'http://x/p' AS p, p_type || ' %41' AS o FROM part")
def k2(spark, d):
    t = table(spark, d, "part").select(F.concat(F.lit("http://x/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("/%C3%A9")).alias("s"), F.lit("http://x/p").alias("p"), F.concat("p_type", F.lit(" %41")).alias("o"), F.lit("literal").alias("o_kind"))
    return K.decoded(t).drop("o_kind")


@query("k18_mapping_templates", "SELECT '{{TemplateMapping' || chr(10) || '| mapToClass = R' || n_regionkey || chr(10) || '| mappings =' || chr(10) || string_agg('{{PropertyMapping | templateProperty = ' || n_name || ' | ontologyProperty = n' || n_nationkey || ' }}', chr(10) ORDER BY n_name) || chr(10) || '}}' AS value FROM nation GROUP BY n_regionkey")
def k18(spark, d):
    m = table(spark, d, "nation").select(F.concat(F.lit("T"), "n_regionkey").alias("template"), F.concat(F.lit("R"), "n_regionkey").alias("class"), F.col("n_name").alias("template_property"), F.concat(F.lit("n"), "n_nationkey").alias("property"))
    return K.mapping_templates(m)


@query("k18_schema_templates", "SELECT 'n' || n_nationkey AS name, '{{Class' || chr(10) || '| rdfs:label@en = ' || n_name || chr(10) || CASE WHEN n_regionkey = 1 THEN '' ELSE '| rdfs:subClassOf = r' || n_regionkey || chr(10) END || '}}' AS value FROM nation")
def k18_schema(spark, d):
    return K.schema_templates(table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("name"), F.col("n_name").alias("label"), F.when(F.col("n_regionkey") != 1, F.concat(F.lit("r"), "n_regionkey")).alias("parent")))


@query("k19_count_sheet", "SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS \"F\", count(*) FILTER (WHERE l_linestatus = 'O') AS \"O\", count(*) FILTER (WHERE l_linestatus IN ('F', 'O')) AS total FROM lineitem GROUP BY l_returnflag")
def k19(spark, d):
    n = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    return K.count_sheet(n, "l_returnflag", "l_linestatus", ["F", "O"], "n")


@query("k21_record_files", "SELECT event_id || '.txt' AS name, 'identifier=' || event_id || chr(10) || 'title=' || event_type || chr(10) || 'ts=' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || chr(10) || 'op=' || CASE WHEN event_id % 5 = 0 THEN 'delete' ELSE 'update' END || chr(10) || '**********' || chr(10) || CASE WHEN event_id % 5 = 0 THEN '' ELSE props END AS value FROM events")
def k21(spark, d):
    r = table(spark, d, "events").select(F.col("event_id").cast("string").alias("identifier"), F.col("event_type").alias("title"), "ts", F.when(F.col("event_id") % 5 == 0, "delete").otherwise("update").alias("op"), F.col("props").alias("source"))
    return K.record_files(r)


@query("k9_page_lines", """SELECT o_custkey AS page_id, o_orderkey AS ordinal, CASE WHEN o_orderkey = min(o_orderkey) OVER w THEN '<page><title>page ' || o_custkey || '</title><id>' || o_custkey || '</id>' ELSE '' END
    || '<revision><id>' || o_orderkey || '</id><timestamp>' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '</timestamp><text>' || o_orderpriority || ' é</text></revision>' || CASE WHEN o_orderkey = max(o_orderkey) OVER w THEN '</page>' ELSE '' END AS value
    FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def k9_lines(spark, d):
    return K.page_export_lines(_revisions(spark, d))


@query("f12b_schema_pages", "SELECT doc_id FROM documents WHERE 200 + doc_id % 5 IN (200, 202)")
def f12b(spark, d):
    from factweave.operators import dumps as D

    return table(spark, d, "documents").where(D.schema_filter(F.col("doc_id") % 5 + 200) & D.accept_all()).select("doc_id")


@query("f21_template_filters", "SELECT doc_id, source FROM documents WHERE (starts_with(source, 'src1') OR source = 'src2') AND source <> 'src12' AND n_chars > 100")
def f21(spark, d):
    from factweave.operators import dumps as D

    return table(spark, d, "documents").where(D.template_filter(F.col("source"), ["SRC1*", "src2"], ["src12"], [F.col("n_chars") > 100])).select("doc_id", "source")


@query("n9a_currencies", "SELECT p_partkey, (p_size * 1000 + 500)::DOUBLE AS value, (['swedishKrona', 'southKoreanWon', 'brazilianReal', 'zambianKwacha'])[1 + p_partkey % 4] AS unit FROM part")
def n9a(spark, d):
    """Codes and names of the international list, before and after the number."""
    from factweave.functions import cascade as C
    from factweave.functions import units as U

    n, k = F.format_number(F.col("p_size") * 1000 + 500, 0), F.col("p_partkey") % 4
    text = F.when(k == 0, F.concat(F.lit("SEK "), n)).when(k == 1, F.concat(n, F.lit(" South Korean won"))).when(k == 2, F.concat(F.lit("BRL"), n)).otherwise(F.concat(n, F.lit(" ZMK")))
    return table(spark, d, "part").select("p_partkey", C.money(text, F.lit("en"), U.WORLD_CURRENCIES).alias("m")).select("p_partkey", "m.value", "m.unit")


@query("v5_inserted_rows", "SELECT p_partkey::VARCHAR AS id, p_name || ' \\n it''s (\"a\", b); ' || chr(10) || p_brand AS name, CASE WHEN p_size % 2 = 0 THEN p_size::VARCHAR END AS size FROM part")
def v5(spark, d):
    """A dump's statements written and read back: quotes, backslashes, line ends, brackets and nulls."""
    name = F.concat("p_name", F.lit(' \\n it\'s ("a", b); \n'), "p_brand")
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), name.alias("name"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("size"))
    return S.inserted_rows(K.insert_statements(rows, "parts", block=2000), "parts", ["id", "name", "size"])


def _catalogue(spark, d):
    p = table(spark, d, "part")
    bag = F.format_string("<rdf:Bag><rdf:li>B%d</rdf:li><rdf:li>C%d</rdf:li></rdf:Bag>", F.col("p_size"), F.col("p_size"))
    creator = F.when(F.col("p_partkey") % 2 == 0, bag).otherwise(F.format_string("A%d", F.col("p_size")))
    book = F.concat(
        F.format_string('<pgterms:etext rdf:ID="etext%d"><dc:publisher>&pg;</dc:publisher><dc:title rdf:parseType="Literal">%s &amp; more</dc:title><dc:creator>', "p_partkey", "p_name"), creator,
        F.format_string("</dc:creator><dc:contributor>%s [Translator]</dc:contributor><dc:created><dcterms:W3CDTF><rdf:value>2001-02-03</rdf:value></dcterms:W3CDTF></dc:created><dc:subject><dcterms:LCSH><rdf:value>%s</rdf:value></dcterms:LCSH></dc:subject></pgterms:etext>", "p_brand", "p_type"),
    )
    file = F.format_string('<pgterms:file rdf:about="&f;%d.txt"><dc:format><dcterms:IMT><rdf:value>text/plain</rdf:value></dcterms:IMT></dc:format><dcterms:extent>%d</dcterms:extent><dcterms:modified><dcterms:W3CDTF><rdf:value>2002-03-04</rdf:value></dcterms:W3CDTF></dcterms:modified><dcterms:isFormatOf rdf:resource="#etext%d" /></pgterms:file>', "p_partkey", "p_size", "p_partkey")
    return S.catalogue_tables(p.select(book.alias("value")), p.select(file.alias("value")), {"pg": "The Press", "f": "http://f/"})


@query("s24_catalogue_texts", "SELECT p_partkey AS text_id, 'The Press' AS publisher, p_name || ' & more' AS title, DATE '2001-02-03' AS created FROM part")
def s24(spark, d):
    return _catalogue(spark, d)["texts"].select("text_id", "publisher", "title", "created")


@query("s24_catalogue_names", """SELECT 'creator' AS kind, p_partkey AS text_id, x AS name, NULL::VARCHAR AS type FROM (SELECT p_partkey, unnest(CASE WHEN p_partkey % 2 = 0 THEN ['B' || p_size, 'C' || p_size] ELSE ['A' || p_size] END) AS x FROM part)
    UNION ALL SELECT 'contributor', p_partkey, p_brand, 'Translator' FROM part UNION ALL SELECT 'subject', p_partkey, p_type, NULL FROM part""")
def s24_names(spark, d):
    t, null = _catalogue(spark, d), F.lit(None).cast("string").alias("type")
    out = t["creators"].select(F.lit("creator").alias("kind"), "text_id", "name", null)
    out = out.unionByName(t["contributors"].select(F.lit("contributor").alias("kind"), "text_id", "name", "type"))
    return out.unionByName(t["subjects"].select(F.lit("subject").alias("kind"), "text_id", F.col("subject").alias("name"), null))


@query("s24_catalogue_files", "SELECT p_partkey AS text_id, 'http://f/' || p_partkey || '.txt' AS url, 'text/plain' AS format1, NULL::VARCHAR AS format2, DATE '2002-03-04' AS modified, p_size::BIGINT AS extent FROM part")
def s24_files(spark, d):
    return _catalogue(spark, d)["files"]


def _region_triples(spark, d):
    return table(spark, d, "nation").select(F.concat(F.lit("http://r/"), "n_regionkey").alias("s"), F.lit("http://p/has").alias("p"), F.concat(F.lit("http://n/"), "n_nationkey").alias("o"), F.lit("uri").alias("o_kind"))


_REGION_LINE = "'<http://r/' || n_regionkey || '> <http://p/has> <http://n/' || n_nationkey || '> .'"


@query("k6b_k7_statements", f"""SELECT 'insert' AS kind, 'http://r/' || n_regionkey AS s, 'INSERT INTO GRAPH <http://g> {{ ' || string_agg({_REGION_LINE}, ' ' ORDER BY {_REGION_LINE}) || ' }}' AS value FROM nation GROUP BY n_regionkey
    UNION ALL SELECT 'delete', 'http://r/' || n_regionkey, 'DELETE FROM GRAPH <http://g> {{ ' || {_REGION_LINE} || ' }}' FROM nation
    UNION ALL SELECT 'filter', 'http://r/' || r_regionkey, 'DELETE FROM GRAPH <http://g> {{ <http://r/' || r_regionkey || '> ?p ?o }} FROM <http://g> WHERE {{ <http://r/' || r_regionkey || '> ?p ?o . FILTER (!(str(?p) LIKE ''http://k/%'')) }}' FROM region""")
def k6b(spark, d):
    """A statement a subject, one a triple, and deletes that keep what other extractors wrote."""
    t = _region_triples(spark, d)
    out = K.update_statements(t, "http://g").withColumn("kind", F.lit("insert"))
    out = out.unionByName(K.update_statements(t, "http://g", False, True).withColumn("kind", F.lit("delete")))
    regions = table(spark, d, "region").select(F.concat(F.lit("http://r/"), "r_regionkey").alias("s"))
    return out.unionByName(K.delete_by_filter(regions, "http://g", [("p", "http://k/")]).withColumn("kind", F.lit("filter"))).select("kind", "s", "value")


@query("e29_marked_pages", "SELECT p_partkey AS page_id, 'http://r/Part_' || p_partkey AS s, 'kind' AS p, 'compound' AS o FROM part WHERE p_size % 5 = 0")
def e29(spark, d):
    from factweave.operators import extractors as E

    source = F.when(F.col("p_size") % 5 == 0, "text {{chembox header}} text").otherwise("text {{chembox}} text")
    pages = table(spark, d, "part").select(F.col("p_partkey").alias("page_id"), F.concat(F.lit("part "), "p_partkey").alias("title"), source.alias("source"))
    return E.marked_pages(pages, "http://r/", "{{chembox header}}", "kind", "compound").select("page_id", "s", "p", "o")
