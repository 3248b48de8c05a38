"""Queries over raw pages and documents: links, labels, cleaning, abstracts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from factweave.functions import text as X
from factweave.plans.registry import query, table

BASE = "http://example.org/resource/"
_LINKS = r'<a href="([^"]*)">([^<]*)</a>'


def page_links(pages):
    """page_id, pos, target, label of every anchor, in document order."""
    pairs = F.arrays_zip(F.regexp_extract_all("html", F.lit(_LINKS), F.lit(1)).alias("target"), F.regexp_extract_all("html", F.lit(_LINKS), F.lit(2)).alias("label"))
    return pages.select("page_id", F.posexplode(pairs).alias("pos", "l")).select("page_id", "pos", F.col("l.target").alias("target"), F.col("l.label").alias("label"))


_LINK_SQL = rf"""links AS (SELECT page_id, unnest(range(len(t)))::INT AS pos, unnest(t) AS target, unnest(l) AS label FROM (
    SELECT page_id, regexp_extract_all(html, '{_LINKS}', 1) AS t, regexp_extract_all(html, '{_LINKS}', 2) AS l FROM pages))"""


@query("e2_e3_page_links", rf"""WITH {_LINK_SQL},
    f AS (SELECT 'wikilink' AS p FROM links WHERE target LIKE '/%' UNION ALL SELECT 'externalLink' FROM links WHERE target LIKE 'http%'
          UNION ALL SELECT 'label' FROM pages WHERE regexp_extract(html, '<title>([^<]*)</title>', 1) <> '')
    SELECT p, count(*) AS n FROM f GROUP BY p""")
def e2_e3(spark, d):
    pages = table(spark, d, "pages")
    kinds = page_links(pages).select(F.when(F.col("target").startswith("/"), "wikilink").when(F.col("target").startswith("http"), "externalLink").alias("p"))
    labels = pages.where(F.regexp_extract("html", r"<title>([^<]*)</title>", 1) != "").select(F.lit("label").alias("p"))
    return kinds.where("p is not null").unionByName(labels).groupBy("p").agg(F.count(F.lit(1)).alias("n"))


@query("e2_distinct_links", rf"WITH {_LINK_SQL} SELECT DISTINCT page_id, CASE target[2:2] WHEN 'ß' THEN 'SS' ELSE upper(target[2:2]) END || target[3:] AS target FROM links WHERE target LIKE '/%' AND target NOT LIKE '%:%' AND octet_length(encode(target)) <= 255")
def e2_distinct(spark, d):
    links = page_links(table(spark, d, "pages")).where(F.col("target").startswith("/") & ~F.col("target").contains(":") & (F.octet_length("target") <= 255))
    return links.select("page_id", X.upper_first(F.substr("target", F.lit(2))).alias("target")).distinct()


@query("e3_external_links_20", rf"""WITH {_LINK_SQL},
    k AS (SELECT page_id, pos, target, row_number() OVER (PARTITION BY page_id, regexp_replace(lower(target), '[^a-z0-9]', '', 'g') ORDER BY pos) AS dup FROM links)
    SELECT page_id, target, row_number() OVER (PARTITION BY page_id ORDER BY pos)::INT AS n FROM k WHERE dup = 1 QUALIFY n <= 20""")
def e3_external(spark, d):
    """The first twenty links of a page that differ in letters and digits."""
    key = F.regexp_replace(F.lower("target"), "[^a-z0-9]", "")
    first = page_links(table(spark, d, "pages")).withColumn("dup", F.row_number().over(W.partitionBy("page_id", key).orderBy("pos"))).where("dup = 1")
    return first.withColumn("n", F.row_number().over(W.partitionBy("page_id").orderBy("pos"))).where("n <= 20").select("page_id", "target", "n")


@query("o4_first_links", rf"WITH {_LINK_SQL} SELECT page_id, pos, target FROM links WHERE pos < 5")
def o4(spark, d):
    targets = F.slice(F.regexp_extract_all("html", F.lit(_LINKS), F.lit(1)), 1, 5)
    return table(spark, d, "pages").select("page_id", F.posexplode(targets).alias("pos", "target"))


@query("u6_distinct_link_array", rf"SELECT page_id, len(list_distinct(regexp_extract_all(html, '{_LINKS}', 1))) AS n FROM pages")
def u6(spark, d):
    return table(spark, d, "pages").select("page_id", F.size(F.array_distinct(F.regexp_extract_all("html", F.lit(_LINKS), F.lit(1)))).cast("long").alias("n"))


@query("e1_label", "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS label, regexp_extract(html, '<html lang=\"([a-z-]+)\"', 1) AS lang FROM pages")
def e1(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("label"), F.regexp_extract("html", '<html lang="([a-z-]+)"', 1).alias("lang"))


@query("e8_byte_count", "SELECT doc_id, octet_length(encode(text)) AS n_bytes FROM documents")
def e8(spark, d):
    return table(spark, d, "documents").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"))


@query("e9_page_uri", "SELECT page_id, 'http://example.org/page/' || page_id AS page, CASE WHEN url LIKE '%/en/%' THEN 'wikipage-en' ELSE 'foaf:page' END AS p FROM pages")
def e9(spark, d):
    return table(spark, d, "pages").select("page_id", F.concat(F.lit("http://example.org/page/"), "page_id").alias("page"), F.when(F.col("url").contains("/en/"), "wikipage-en").otherwise("foaf:page").alias("p"))


@query("e6_f14_redirects", "SELECT doc_id, regexp_matches(text, '(?i)^\\s*#redirect') AS redirect, regexp_extract(text, '\\[\\[([^\\]|]*)', 1) AS target FROM documents")
def e6(spark, d):
    return table(spark, d, "documents").select("doc_id", F.col("text").rlike(r"(?i)^\s*#redirect").alias("redirect"), F.regexp_extract("text", r"\[\[([^\]|]*)", 1).alias("target"))


@query("f15_any_keyword", "SELECT doc_id, contains(text, 'License') OR contains(text, 'licensed') AS hit FROM documents")
def f15(spark, d):
    return table(spark, d, "documents").select("doc_id", (F.col("text").contains("License") | F.col("text").contains("licensed")).alias("hit"))


@query("f16_valid_uri", r"""SELECT page_id, regexp_matches(url, '^(?:https?|ftp)://[^\s/?#<>"{}|\\^`]+[^\s<>"{}|\\^`]*$') AND octet_length(encode(url)) <= 255 AS valid FROM pages""")
def f16(spark, d):
    return table(spark, d, "pages").select("page_id", X.valid_uri(F.col("url")).alias("valid"))


@query("x8_strip_html", r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \n\t]+', ' ', 'g')) AS text FROM pages""")
def x8(spark, d):
    return table(spark, d, "pages").select("page_id", F.trim(F.regexp_replace(X.strip_tags(F.col("html")), "[ \n\t]+", " ")).alias("text"))


@query("x7_entities", "SELECT page_id, replace(replace(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&') AS title FROM pages")
def x7(spark, d):
    return table(spark, d, "pages").select("page_id", X.unescape_basic(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))


@query("f10_truncate_bytes", "SELECT doc_id, left(text, list_max(list_filter(range(0, 256), lambda i: octet_length(encode(left(text, i))) <= 255))) AS comment FROM documents")
def f10(spark, d):
    return table(spark, d, "documents").select("doc_id", X.truncate_bytes(F.col("text"), 255).alias("comment"))


@query("x4_clean_space", "SELECT doc_id, trim(regexp_replace(text, '[ _]+', ' ', 'g'), ' ') AS t FROM documents")
def x4(spark, d):
    return table(spark, d, "documents").select("doc_id", X.clean_space(F.col("text")).alias("t"))


@query("x3_case_first", "SELECT p_partkey, upper(left(p_name, 1)) || p_name[2:] AS u, lower(left(p_brand, 1)) || p_brand[2:] AS l FROM part")
def x3(spark, d):
    return table(spark, d, "part").select("p_partkey", X.upper_first(F.col("p_name")).alias("u"), X.lower_first(F.col("p_brand")).alias("l"))


@query("x6_emphasis", "SELECT p_partkey, replace(replace(replace('''''''''''' || p_name || ''''''''''' and ''''' || p_type || '''''', '''''''''''', ''), '''''''', ''), '''''', '') AS t FROM part")
def x6(spark, d):
    marked = F.concat(F.lit("'''''"), "p_name", F.lit("''''' and ''"), "p_type", F.lit("''"))
    return table(spark, d, "part").select("p_partkey", X.strip_emphasis(marked).alias("t"))


@query("x9_links", "SELECT page_id, split_part(regexp_extract(url, '://(.*)$', 1), '/', 1) AS target, list_extract(string_split(url, '/'), -1) AS label FROM pages")
def x9(spark, d):
    piped = F.replace(F.regexp_extract("url", "://(.*)$", 1), F.lit("/"), F.lit("|"))
    return table(spark, d, "pages").select("page_id", X.link_target(piped).alias("target"), X.link_label(F.replace("url", F.lit("/"), F.lit("|"))).alias("label"))


@query("x12_camel_case", "SELECT p_partkey, list_aggregate(list_transform(list_filter(regexp_split_to_array(lower(p_type), '[^a-z0-9]+'), lambda w: w <> ''), lambda w, i: CASE WHEN i = 1 THEN w ELSE upper(w[1:1]) || w[2:] END), 'string_agg', '') AS name FROM part")
def x12(spark, d):
    return table(spark, d, "part").select("p_partkey", X.camel_case(F.col("p_type")).alias("name"))


@query("x13_fold_digit", "SELECT c_custkey, regexp_replace(c_name || '_leader' || (c_custkey % 20), '([^0-9_])[0-9]$', '\\1') AS name FROM customer")
def x13(spark, d):
    return table(spark, d, "customer").select("c_custkey", X.fold_digit(F.concat("c_name", F.lit("_leader"), F.col("c_custkey") % 20)).alias("name"))


@query("x22_image_url", "WITH f AS (SELECT p_partkey, replace(p_name, ' ', '_') || '.svg' AS n FROM part) SELECT p_partkey, 'http://img/' || left(md5(n), 1) || '/' || left(md5(n), 2) || '/' || n AS full_url, 'http://img/thumb/' || left(md5(n), 1) || '/' || left(md5(n), 2) || '/' || n || '/200px-' || n || '.png' AS thumb FROM f")
def x22(spark, d):
    name = F.concat("p_name", F.lit(".svg"))
    return table(spark, d, "part").select("p_partkey", X.image_url(name, "http://img").alias("full_url"), X.image_url(name, "http://img", 200).alias("thumb"))


@query("x23_similarity", "SELECT a.n_name AS a, b.n_name AS b, 1 - levenshtein(a.n_name, b.n_name) / greatest(length(a.n_name), length(b.n_name))::DOUBLE AS sim FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def x23(spark, d):
    n = table(spark, d, "nation")
    a, b = n.select(F.col("n_name").alias("a"), F.col("n_nationkey").alias("i"), "n_regionkey"), n.select(F.col("n_name").alias("b"), F.col("n_nationkey").alias("j"), "n_regionkey")
    return a.join(b, "n_regionkey").where("i < j").select("a", "b", X.similarity(F.col("a"), F.col("b")).alias("sim"))


@query("x24_predicate_label", "SELECT DISTINCT event_type, lower(regexp_replace('has' || upper(left(event_type, 1)) || event_type[2:], '([A-Z])', ' \\1', 'g')) AS label FROM events")
def x24(spark, d):
    return table(spark, d, "events").select("event_type", X.label_of_camel(F.concat(F.lit("has"), X.upper_first(F.col("event_type")))).alias("label")).distinct()


@query("x20_short_abstract", """WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1))[1:501] AS s FROM documents)
    SELECT doc_id, array_to_string(s[1:len(list_filter(range(1, len(s) + 1), lambda k: list_sum(list_transform(s[1:k], lambda x: octet_length(encode(x)))) + greatest(k - 1, 1) <= 500))], ' ') AS abstract FROM s""")
def x20(spark, d):
    return table(spark, d, "documents").select("doc_id", X.short_abstract(F.col("text")).alias("abstract"))


@query("x1_x2_title_round_trip", """WITH t AS (SELECT p_partkey, trim(regexp_replace(p_name || ' / ' || p_type || '_é', '[ _]+', ' ', 'g')) AS t FROM part), u AS (SELECT p_partkey, upper(t[1]) || t[2:] AS t FROM t)
    SELECT p_partkey, replace(replace(url_encode(replace(t, ' ', '_')), '%2F', '/'), '%3A', ':') AS encoded, t AS decoded FROM u""")
def x1(spark, d):
    name = F.concat(F.lit("  "), "p_name", F.lit(" / "), "p_type", F.lit("_é"))
    return table(spark, d, "part").select("p_partkey", X.wiki_encode(name).alias("encoded"), X.wiki_decode(X.wiki_encode(name)).alias("decoded"))


@query("x5_titles", "SELECT * FROM (VALUES (' _ émile _ Zola _ ', 0, 'Émile Zola'), ('AC%2FDC', 0, 'AC/DC'), (' Category : Impossible ', 14, 'Impossible'), ('a#b', 0, NULL)) t(title, ns, text)")
def x5(spark, d):
    rows = spark.createDataFrame([(" _ émile _ Zola _ ",), ("AC%2FDC",), (" Category : Impossible ",), ("a#b",)], "title string")
    return rows.select("title", X.namespace_of(F.col("title")).alias("ns"), X.title_text(F.col("title")).alias("text"))
