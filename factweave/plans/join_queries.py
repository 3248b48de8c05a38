"""Joins, set operations, path searches, category classes and tables, through the library's operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from factweave.operators import classes as C
from factweave.operators import graph as G
from factweave.operators import relational as R
from factweave.operators import tables as B
from factweave.plans.graph_queries import _EDGES, edges
from factweave.plans.registry import query, table

_SUBJECTS = "SELECT DISTINCT regexp_extract(url, '^(.*?://[^/]*/[^/]*)', 1) AS s FROM pages WHERE page_id % 10 = 0"


@query("j10_prefix_join", f"SELECT page_id FROM pages WHERE NOT EXISTS (SELECT 1 FROM ({_SUBJECTS}) WHERE starts_with(url, s || '/'))")
def j10(spark, d):
    """Sub-resources of the first path parts of some pages go."""
    pages = table(spark, d, "pages")
    subjects = pages.where("page_id % 10 = 0").select(F.regexp_extract("url", "^(.*?://[^/]*/[^/]*)", 1).alias("subject"))
    return R.sub_resources(pages.select("page_id", "url"), subjects, "url", keep=False).select("page_id")


@query("j9_chain", "SELECT o_orderkey, c_custkey, n_nationkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey % 97 = 0")
def j9(spark, d):
    got = R.chain(edges(spark, d), 2, F.col("node").startswith("o") & (F.substring("node", 2, 20).cast("bigint") % 97 == 0), F.col("node").startswith("n"))
    number = lambda c: F.substring(c, 2, 20).cast("bigint")
    return got.select(number("n0").alias("o_orderkey"), number("n1").alias("c_custkey"), number("n2").cast("int").alias("n_nationkey"))


@query("j11_same_cluster", "SELECT x.s_suppkey AS a, y.s_suppkey AS b, x.s_nationkey AS cluster, abs(x.s_suppkey % 7 - y.s_suppkey % 7) AS depth_gap FROM supplier x JOIN supplier y ON x.s_nationkey = y.s_nationkey AND y.s_suppkey = x.s_suppkey + 3")
def j11(spark, d):
    m = table(spark, d, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_nationkey").alias("cluster"), (F.col("s_suppkey") % 7).alias("depth"))
    return R.same_cluster(m, m.select(F.col("node").alias("a"), (F.col("node") + 3).alias("b")))


@query("j21_group_membership", "SELECT l_returnflag AS extractor, 'o' || l_orderkey AS s, l_linestatus AS p, 'p' || l_partkey AS o FROM lineitem")
def j21(spark, d):
    t = table(spark, d, "lineitem").withColumn("axiom", F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"))
    axioms = t.select("axiom", F.explode(F.map_from_arrays(F.array(*map(F.lit, "spo")), F.array(F.concat(F.lit("o"), "l_orderkey"), F.col("l_linestatus"), F.concat(F.lit("p"), "l_partkey")))).alias("role", "value"))
    return R.membership(axioms, t.select("axiom", F.col("l_returnflag").alias("extractor")))


@query("j6_renamed_annotations", "SELECT user_id, CASE event_type WHEN 'click' THEN 'clicked' WHEN 'view' THEN 'viewed' END AS property FROM events WHERE event_type IN ('click', 'view')")
def j6(spark, d):
    renames = spark.createDataFrame([("click", "clicked"), ("view", "viewed")], "old string, new string")
    return R.renamed_annotations(table(spark, d, "events").select("user_id", F.col("event_type").alias("property")), renames)


@query("j4_superclass", "SELECT DISTINCT l_orderkey AS page, replace(p_brand, '#', '') AS class FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 45")
def j4(spark, d):
    pages = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_partkey").alias("category"))
    facts = table(spark, d, "part").where("p_size > 45").select(F.col("p_partkey").alias("category"), F.col("p_brand").alias("superclass"))
    return R.superclass_links(pages, facts)


@query("j12_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def j12(spark, d):
    """Items that a member refers to."""
    return R.having_members(table(spark, d, "customer"), table(spark, d, "orders").where("o_totalprice > 200000"), "c_custkey", "o_custkey").select("c_custkey")


@query("f8_revision_list", "SELECT 'revision' AS kind, o_orderkey AS id FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49) UNION ALL SELECT DISTINCT 'page', o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)")
def f8(spark, d):
    """The listed revisions and the pages that keep one."""
    revisions = table(spark, d, "orders").select(F.col("o_custkey").alias("page"), F.col("o_orderkey").alias("revision"))
    pages = table(spark, d, "customer").select(F.col("c_custkey").alias("page"))
    ids = table(spark, d, "lineitem").where("l_quantity > 49").select(F.col("l_orderkey").alias("revision"))
    kept, left = R.pages_with_revisions(pages, revisions, ids, "page", "revision")
    return kept.select(F.lit("revision").alias("kind"), F.col("revision").alias("id")).unionByName(left.select(F.lit("page").alias("kind"), F.col("page").alias("id")))


@query("u5_contains_all", "SELECT o_orderkey, count(l_orderkey) = count(*) AS complete FROM (SELECT o_orderkey, unnest([1, 2, 3]) AS line FROM orders) LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = line GROUP BY o_orderkey")
def u5(spark, d):
    """Does an order have the first three lines?"""
    wanted = table(spark, d, "orders").select("o_orderkey", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("line"))
    present = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("line"))
    return R.contains_all(wanted, present, "o_orderkey", ["line"])


@query("v6_pattern_inserts", "SELECT p_partkey, 'rdf:type' AS p, 'Brass' AS o FROM part WHERE p_type LIKE '%BRASS' UNION ALL SELECT p_partkey, 'rdf:type', 'Standard' FROM part WHERE p_type LIKE 'STANDARD%'")
def v6(spark, d):
    return R.pattern_types(table(spark, d, "part"), "p_partkey", "p_type", {"%BRASS": "Brass", "STANDARD%": "Standard"})


@query("a9_totals", "SELECT (SELECT count(*) FROM lineitem) AS triples, count(*) FILTER (WHERE doc_id % 18 - 2 = 0 AND n_chars >= 100) AS articles, count(*) FILTER (WHERE doc_id % 18 - 2 = 14) AS categories, count(*) FILTER (WHERE n_chars < 100) AS redirects FROM documents")
def a9(spark, d):
    pages = table(spark, d, "documents").select((F.col("doc_id") % 18 - 2).alias("ns"), (F.col("n_chars") < 100).alias("is_redirect"))
    return R.totals(table(spark, d, "lineitem"), pages)


@query("a5_guarded_counts", "SELECT (SELECT count(*) FROM orders) AS n_before, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS n_after, 0::BIGINT AS added, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS deleted, true AS ok")
def a5(spark, d):
    o = table(spark, d, "orders")
    return R.guarded(o, o.where("o_orderstatus != 'P'"), ["o_orderkey"])


@query("j14_similar_names", "SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey AND 1 - levenshtein(a.p_type, b.p_type) / greatest(length(a.p_type), length(b.p_type))::DOUBLE > 0.8")
def j14(spark, d):
    return R.similar_pairs(table(spark, d, "part"), ["p_brand", "p_size"], "p_partkey", "p_type", 0.8)


@query("u0b_neighbours", f"WITH {_EDGES} SELECT node, count(*) AS n FROM (SELECT a AS node, b AS x FROM edges UNION SELECT b, a FROM edges) GROUP BY node")
def u0b(spark, d):
    return R.neighbours(edges(spark, d)).groupBy("node").agg(F.count(F.lit(1)).alias("n"))


@query("p2_middle_paths", f"""WITH {_EDGES}, two AS (SELECT x.a AS n0, x.p AS p1, y.b AS m, y.p AS p2 FROM edges x JOIN edges y ON x.b = y.a)
    SELECT x.a AS n0, x.b AS m, y.n0 AS z, x.p || '|' || y.p1 || '/' || y.p2 AS trail, 1 AS split FROM edges x JOIN two y ON x.b = y.m WHERE x.a = 's1' AND y.n0 LIKE 'c%' UNION ALL
    SELECT x.n0, x.m, y.a, x.p1 || '/' || x.p2 || '|' || y.p, 2 FROM two x JOIN edges y ON x.m = y.b WHERE x.n0 = 's1' AND y.a LIKE 'c%' UNION ALL
    SELECT x.a, x.b, y.n0, x.p || '|' || y.p1 || '/' || y.p2, 1 FROM edges x JOIN two y ON x.b = y.m WHERE FALSE""")
def p2(spark, d):
    """From one supplier and from the customers to what both reach, in three edges split both ways."""
    m = G.middle_paths(edges(spark, d), F.col("node") == "s1", F.col("node").startswith("c"), 3)
    return m.select("n0", "m", "z", F.concat(F.array_join("left", "/"), F.lit("|"), F.array_join("right", "/")).alias("trail"), "split")


@query("u0c_path_families", f"""WITH {_EDGES} SELECT 'forward' AS family, x.a AS n0, y.b AS z, x.p || ' ' || x.b || ' ' || y.p AS trail FROM edges x JOIN edges y ON x.b = y.a WHERE x.a LIKE 's%' AND y.b LIKE 'r%'
    UNION ALL SELECT 'toward', x.a, y.a, x.p || ' ' || x.b || ' ' || y.p FROM edges x JOIN edges y ON x.b = y.b WHERE x.a LIKE 's%' AND y.a LIKE 'r%' AND x.a <> y.a""")
def u0c(spark, d):
    """Suppliers and regions: chains there (back there are none), and what both point to (nothing)."""
    return G.path_families(edges(spark, d), F.col("node").startswith("s"), F.col("node").startswith("r"), 2)


@query("p5_deepening", f"WITH {_EDGES} SELECT 3 AS length, x.a AS n0, z.b AS n3 FROM edges x JOIN edges y ON x.b = y.a JOIN edges z ON y.b = z.a WHERE x.a IN ('o1', 'o2', 'o3') AND z.b LIKE 'r%'")
def p5(spark, d):
    length, found = G.deepening(edges(spark, d), F.col("node").isin("o1", "o2", "o3"), F.col("node").startswith("r"), 4)
    return found.select(F.lit(length).alias("length"), "n0", "n3")


@query("p7_distance_bounds", "SELECT a.n_nationkey AS a, b.n_nationkey AS b, 0 AS least, 1 + CASE WHEN a.n_regionkey = b.n_regionkey THEN 0 ELSE 2 END AS most FROM nation a JOIN nation b ON b.n_nationkey = a.n_nationkey + 1")
def p7(spark, d):
    """Nations under regions under one root."""
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    parents = n.select(F.concat(F.lit("n"), "n_nationkey").alias("name"), F.concat(F.lit("r"), "n_regionkey").alias("parent")).unionByName(r.select(F.concat(F.lit("r"), "r_regionkey").alias("name"), F.lit("root").alias("parent"))).unionByName(r.limit(1).select(F.lit("root").alias("name"), F.lit(None).cast("string").alias("parent")))
    pairs = n.select(F.concat(F.lit("n"), "n_nationkey").alias("a"), F.concat(F.lit("n"), F.col("n_nationkey") + 1).alias("b"))
    number = lambda c: F.substring(c, 2, 9).cast("int")
    return G.distance_bounds(parents, pairs).select(number("a").alias("a"), number("b").alias("b"), "least", "most")


@query("p12_best_labels", "SELECT source AS s, arg_min(doc_id::VARCHAR, (CASE lang WHEN 'fr' THEN 0 WHEN 'de' THEN 1 ELSE 2 END, lang, doc_id::VARCHAR)) AS label FROM documents WHERE lang IS NOT NULL GROUP BY source")
def p12(spark, d):
    labels = table(spark, d, "documents").where("lang is not null").select(F.col("source").alias("s"), F.col("doc_id").cast("string").alias("label"), "lang")
    return G.best_labels(labels, ["fr", "de"]).select("s", "label")


_TREE = "SELECT p_partkey AS id, p_partkey // 3 AS parent FROM part"
_KIND = "CASE WHEN id = 14 THEN 1 WHEN id % 10 = 4 THEN 2 WHEN id % 2 = 0 THEN 1 ELSE 0 END"


def _categories(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"))
    name = lambda c: F.concat(F.lit("C"), c)
    links = p.select(name(F.col("id")).alias("child"), name(F.floor(F.col("id") / 3)).alias("parent"))
    members = p.where("id % 2 = 0").select(F.concat(F.lit("a"), "id").alias("article"), name(F.col("id")).alias("category"))
    kinds = C.category_classes(p.select(name(F.col("id")).alias("category")), members, ["%4"], ("C14",))
    return links, members, kinds


@query("e27_category_classes", f"SELECT 'C' || id AS category, {_KIND} AS kind FROM ({_TREE})")
def e27(spark, d):
    return _categories(spark, d)[2]


@query("e27_superclasses", f"""WITH RECURSIVE t AS (SELECT id, parent, {_KIND} AS kind FROM ({_TREE})), up(id, cur, n) AS (
    SELECT id, parent, 1 FROM t WHERE kind = 1 UNION ALL SELECT up.id, t.parent, n + 1 FROM up JOIN t ON t.id = up.cur WHERE t.kind <> 1 AND n < 10)
    SELECT 'C' || t.id AS class, coalesce('C' || max(up.cur), 'Thing') AS superclass FROM t LEFT JOIN (SELECT up.id, up.cur FROM up JOIN t k ON k.id = up.cur AND k.kind = 1 AND k.id <> up.id) up ON up.id = t.id WHERE t.kind = 1 GROUP BY t.id""")
def e27_super(spark, d):
    links, _, kinds = _categories(spark, d)
    return C.superclasses(kinds, links)


@query("e28_article_classes", f"""WITH RECURSIVE t AS (SELECT id, parent, {_KIND} AS kind FROM ({_TREE})), up(id, cur, n) AS (
    SELECT id, id, 0 FROM t WHERE id % 2 = 0 UNION ALL SELECT up.id, t.parent, n + 1 FROM up JOIN t ON t.id = up.cur WHERE t.kind <> 1 AND n < 3)
    SELECT DISTINCT 'a' || up.id AS article, 'C' || cur AS class FROM up JOIN t ON t.id = cur AND t.kind = 1""")
def e28(spark, d):
    links, members, kinds = _categories(spark, d)
    return C.article_classes(members, links, kinds)


@query("g10_table_templates", "SELECT o_custkey AS page_id, \"row\", f.key, f.value FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS \"row\" FROM orders), LATERAL (VALUES ('date', strftime(o_orderdate, '%Y-%m-%d')), ('price', o_totalprice::DECIMAL(18, 2)::VARCHAR)) AS f(key, value) WHERE o_custkey % 2 = 0")
def g10(spark, d):
    """A table a customer: a caption row, a header, a row an order; odd ones lack a header that the mapping needs."""
    from pyspark.sql import Window as W

    o = table(spark, d, "orders").select("o_custkey", (F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")) + 1).alias("row"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("x"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("y"))
    cust = o.select("o_custkey").distinct()
    last = F.when(F.col("o_custkey") % 2 == 0, "Total price in Euro").otherwise("Remark")
    cells = [cust.select("o_custkey", F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit("Orders, by date").alias("text"))]
    cells += [cust.select("o_custkey", F.lit(1).alias("row"), F.lit(k).alias("col"), c.alias("text")) for k, c in enumerate((F.lit("No."), F.lit("Order date"), last))]
    cells += [o.select("o_custkey", "row", F.lit(k).alias("col"), c.alias("text")) for k, c in enumerate((F.lit("1"), F.col("x"), F.col("y")))]
    out = cells[0]
    for c in cells[1:]:
        out = out.unionByName(c)
    got = B.pseudo_templates(out.select(F.col("o_custkey").alias("page_id"), F.lit(0).alias("table_id"), "row", "col", "text"), {"date": ["date"], "price": ["cost", "total & price"]})
    return got.select("page_id", (F.col("row") - 1).cast("bigint").alias("row"), "key", "value")
